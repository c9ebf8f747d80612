"""Conversation structure repair: a generalised LR parse over the grammar of roles, with weighted delete, rerole and insert actions.

Grammar, on the first letters of roles: a conversation is empty, or one ``s`` at most and then pairs ``u a``. Rows may be kept (0), given the
role user or assistant (1), deleted (2), and empty turns of these roles inserted (5). Blank rows and repeats must be deleted; a truncated
row that stays costs 5 more. The cheapest repair is taken, of equal ones that whose audit (the actions' first letters) is least in ASCII.

The graph-structured stack: a node is (row, stack top), its edges are the actions to the next node. The grammar leaves four stack tops:
nothing, a system turn, an open pair, whole pairs. Nodes are made from the last row to the first; equal stack tops merge, and keep the
minimum of (cost, audit). As an action's letter decides the next node, the audit to compare is one letter long: the walk from the first row
takes the least letter among the cheapest actions, and no text of an audit is ever compared.

A conversation may be of any length, and be a third of all rows. Rows (without their texts) are dealt out by ranges of (conversation, turn),
and a conversation that spans several blocks is parsed in pieces: first each piece gives a table of what it costs from each stack top to
each other one, from which the driver (two rows a block at most) works out the costs behind each piece; then each piece says which top it
leaves for each one that it is entered with, and the driver works out the tops; then all pieces are parsed. Texts join by row id at the end.

Rows are taken in the order of turn (null first), role, hash of the text. Repeats are equal in role and text to an earlier row of their
conversation. Null role or text: one space, so neither a role of the grammar nor a text. Null ids form one conversation. An empty table
gives no rows, very long texts stay whole, and other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
FAR = 10**9
#: Stack tops: nothing, a system turn, an open pair, whole pairs. Where each letter leads; no entry: a syntax error.
EMPTY, SYSTEM, OPEN, PAIRS = range(4)
SHIFT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: OPEN, SYSTEM: OPEN, PAIRS: OPEN}, "a": {OPEN: PAIRS}}
#: The role that is looked for at each top.
WANTED = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
ACCEPTED = (0, FAR, FAR, 0)
LEGAL = ("su", "ua", "au")


def inserted(after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs at each top if turns may be inserted before going on."""
    to_open, to_pairs = min(after[OPEN], after[PAIRS] + INSERT), min(after[PAIRS], after[OPEN] + INSERT)
    return min(after[EMPTY], to_open + INSERT), min(after[SYSTEM], to_open + INSERT), to_open, to_pairs


def shifted(top: int, letter: str, fault: int, after: tuple[int, ...], rerole: bool) -> tuple[int, int]:
    """Cost and next top if a row stays, as it is or with the role that is wanted."""
    to = SHIFT[WANTED[top]][top] if rerole else SHIFT.get(letter, {}).get(top)
    return (FAR, top) if to is None or fault in (BLANK, DUPLICATE) else (after[to] + rerole * REROLE + (fault == TRUNCATED) * CUT, to)


def parse(letters: list[str], faults: list[int], behind: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The nodes' costs, from each row's place to the end; ``behind``: the costs behind the last row."""
    nodes = [behind]
    for letter, fault in zip(reversed(letters), reversed(faults), strict=True):
        after = nodes[-1]
        nodes.append(inserted(tuple(min(after[t] + DELETE, shifted(t, letter, fault, after, False)[0], shifted(t, letter, fault, after, True)[0]) for t in range(4))))
    return nodes[::-1]


def walk(letters: list[str], faults: list[int], nodes: list[tuple[int, ...]], top: int, last: bool) -> tuple[list[tuple[str, str, int]], int]:
    """The actions (letter, role's letter, row) from ``top`` on, and the top behind them. last: the conversation ends with these rows."""
    out: list[tuple[str, str, int]] = []
    at, n = 0, len(letters)
    while True:
        cost = nodes[at][top]
        if at == n and (not last or ACCEPTED[top] == cost):
            return out, top
        if at < n and nodes[at + 1][top] + DELETE == cost:
            out.append(("D", "", at))
            at += 1
            continue
        to = SHIFT[WANTED[top]][top]
        if nodes[at][to] + INSERT == cost:
            out.append(("I", WANTED[top], at))
            top = to
            continue
        for rerole in (False, True):
            whole, to = shifted(top, letters[at], faults[at], nodes[at + 1], rerole)
            if whole == cost:
                out.append(("R" if rerole else "K", WANTED[top] if rerole else letters[at], at))
                top = to
                break
        at += 1


class Piece:
    """Rows of one conversation in one block; ``edge``: 0 inside, else 1 for the block's first piece, 2 for its last, 3 for both."""

    def __init__(self, block: int, conv: int | None) -> None:
        self.block, self.conv, self.first = block, conv, True
        self.ids: list[int] = []
        self.roles: list[str] = []
        self.letters: list[str] = []
        self.faults: list[int] = []


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Piece, int]]:
    """Pieces with their edges, from rows (place, conv, role, fault, id) in order."""
    now: Piece | None = None
    for b in batches:
        for place, conv, role, fault, row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            block = place >> 33
            if now is None or now.block != block or now.conv != conv:
                if now is not None:
                    yield now, now.first + 2 * (now.block != block)
                first = now is None or now.block != block
                now = Piece(block, conv)
                now.first = first
            now.ids.append(row)
            now.roles.append(role)
            now.letters.append(role[:1])
            now.faults.append(fault)
    if now is not None:
        yield now, now.first + 2


def over_blocks(rows: DataFrame, schema: dict[str, str], each: Callable[[Piece, int], Iterator[tuple]]) -> DataFrame:
    """Runs each(piece, edge) on the pieces, which are whole whatever the files' splits."""
    common.find_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for piece, edge in pieces(batches):
            for row in each(piece, edge):
                out.append(row)
                if len(out) == 10_000:
                    yield common.batch(schema, list(zip(*out, strict=True)))
                    out = []
        if out:
            yield common.batch(schema, list(zip(*out, strict=True)))

    dealt = rows.withColumn("block", F.expr("shiftright(place, 33)")).repartition("block").sortWithinPartitions("place")
    return dealt.select("place", "conv", "role", "fault", "id").mapInArrow(run, common.ddl(schema))


def joined(table: list[int], behind: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(table[4 * s + t] + behind[t] for t in range(4)) for s in range(4))


def linked(rows: DataFrame) -> tuple[dict, dict, dict]:
    """By (block, conversation) of pieces at blocks' edges: costs behind them (if the conversation goes on), the role before them, the top
    that they are entered with."""

    def table(piece: Piece, edge: int) -> Iterator[tuple]:
        if edge:
            units = [tuple(0 if t == k else FAR for t in range(4)) for k in range(4)]
            columns = [parse(piece.letters, piece.faults, u)[0] for u in units]
            yield piece.block, edge, piece.conv, [min(FAR, columns[t][s]) for s in range(4) for t in range(4)], piece.letters[-1]

    edges = sorted(over_blocks(rows, {"block": "long", "edge": "int", "conv": "long", "table": "array<long>", "letter": "string"}, table).collect(), key=lambda r: (r["block"], r["edge"]))
    behind, before, tops = {}, {}, {}
    on = [a["block"] != b["block"] and a["conv"] == b["conv"] for a, b in zip(edges, edges[1:], strict=False)]
    costs = inserted(ACCEPTED)
    for k in range(len(edges) - 1, -1, -1):
        goes_on = k < len(on) and on[k]
        costs = joined(edges[k + 1]["table"], costs) if goes_on else inserted(ACCEPTED)
        if goes_on:
            behind[edges[k]["block"], edges[k]["conv"]] = costs
            before[edges[k + 1]["block"], edges[k + 1]["conv"]] = edges[k]["letter"]
    if behind:

        def leave(piece: Piece, edge: int) -> Iterator[tuple]:
            if edge and (piece.block, piece.conv) in behind:
                nodes = parse(piece.letters, piece.faults, behind[piece.block, piece.conv])
                yield piece.block, edge, piece.conv, [walk(piece.letters, piece.faults, nodes, top, False)[1] if nodes[0][top] < FAR else top for top in range(4)]

        left = {(r["block"], r["conv"]): r["tops"] for r in over_blocks(rows, {"block": "long", "edge": "int", "conv": "long", "tops": "array<long>"}, leave).collect()}
        for a, b, goes_on in zip(edges, edges[1:], on, strict=False):
            if goes_on:
                tops[b["block"], b["conv"]] = left[a["block"], a["conv"]][tops.get((a["block"], a["conv"]), EMPTY)]
    return behind, before, tops


EDITS = {"conv": "long", "block": "long", "at": "long", "edit": "string", "new_role": "string", "id": "long", "fault": "int", "cost": "long", "illegal": "long"}


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each action: conv_id, block, at (their order), edit (K, R, D, I), role and text of what stays or comes in (null: deleted),
    fault (1 blank, 2 duplicate, 3 truncated, else 0; null: inserted), cost, illegal (1 where this row's role can't follow the row before)."""
    told = {"conv": F.col(f"`{conv_col}`").cast("long"), "turn": F.col(f"`{turn_col}`").cast("long"), "role": F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")), "text": F.coalesce(F.col(f"`{text_col}`"), F.lit(" "))}
    rows = common.written(df.select(*(c.alias(k) for k, c in told.items()), F.monotonically_increasing_id().alias("id")), keep=True)
    seen = F.rtrim("text", F.lit(SPACE))
    flag = F.when(seen == "", BLANK).when(F.right(seen, F.lit(1)).isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    narrow = rows.select("conv", "turn", "role", F.md5("text").alias("tie"), flag.alias("flag"), "id")
    first = narrow.filter(F.col("flag") != BLANK).groupBy("conv", "role", "tie").agg(F.min(F.struct("turn", "id")).alias("first")).select("first.id", F.lit(1).alias("one"))
    fault = F.when((F.col("flag") != BLANK) & F.col("one").isNull(), DUPLICATE).otherwise(F.col("flag"))
    order = ["conv", "turn", "role", "tie", "id"]
    placed = narrow.join(first, "id", "left").select(*order, fault.alias("fault")).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = common.written(placed.select("conv", "role", "fault", "id", F.monotonically_increasing_id().alias("place")), keep=True)
    behind, before, tops = linked(ranged)

    def edits(piece: Piece, edge: int) -> Iterator[tuple]:
        key = (piece.block, piece.conv)
        goes_on = behind.get(key)
        nodes = parse(piece.letters, piece.faults, goes_on or inserted(ACCEPTED))
        letter_before = before.get(key)
        for at, (edit, letter, row) in enumerate(walk(piece.letters, piece.faults, nodes, tops.get(key, EMPTY), goes_on is None)[0]):
            if edit == "I":
                yield piece.conv, piece.block, at, "I", ROLES[letter], -1 - (piece.block << 33) - at, None, INSERT, 0
                continue
            bad = row > 0 or letter_before is not None
            pair = (piece.letters[row - 1] if row else letter_before or "") + piece.letters[row]
            fault, cost = piece.faults[row], DELETE if edit == "D" else (edit == "R") * REROLE + (piece.faults[row] == TRUNCATED) * CUT
            role = None if edit == "D" else ROLES[letter] if edit == "R" else piece.roles[row]
            yield piece.conv, piece.block, at, edit, role, piece.ids[row], fault, cost, int(bad and pair not in LEGAL)

    made = over_blocks(ranged, EDITS, edits)
    kept = made.join(rows.select("id", "text"), "id", "left")
    text = F.when(F.col("edit") == "I", "").when(F.col("edit") != "D", F.col("text"))
    return kept.select(F.col("conv").alias("conv_id"), "block", "at", "edit", F.col("new_role").alias("role"), text.alias("text"), "fault", "cost", "illegal")


SUMS = {"conv": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string", "repaired_sha256": "string"}


def summed(edits: DataFrame) -> DataFrame:
    """One row a conversation. Rows pass in order and none are kept: a conversation of any length takes a letter of its audit a row."""
    common.find_package(edits.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        conv, open_, counts, audit, sha, any_ = None, False, [0] * 5, [], hashlib.sha256(), False
        close = lambda: [conv, *counts, "".join(audit), sha.hexdigest()]
        for b in batches:
            for c, edit, role, text, fault, cost, illegal in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if not open_ or c != conv:
                    if open_:
                        out.append(close())
                    conv, open_, counts, audit, sha, any_ = c, True, [0] * 5, [], hashlib.sha256(), False
                for k, v in enumerate((fault == BLANK, fault == DUPLICATE, fault == TRUNCATED, illegal, cost)):
                    counts[k] += v
                audit.append(edit)
                if edit != "D":
                    sha.update(f"{chr(10) * any_}{role}:{text}".encode())
                    any_ = True
            if len(out) > 1000:
                yield common.batch(SUMS, list(zip(*out, strict=True)))
                out = []
        if open_:
            out.append(close())
        if out:
            yield common.batch(SUMS, list(zip(*out, strict=True)))

    dealt = edits.repartition("conv_id").sortWithinPartitions("conv_id", "block", "at")
    return dealt.select("conv_id", "edit", "role", "text", "fault", "cost", "illegal").mapInArrow(run, common.ddl(SUMS))


def damage(df: DataFrame) -> DataFrame:
    """The rows of a table of conversations, some of them lost or changed, as the check sum of their key says."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    changed = df.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"), copies.alias("copies"),
    )
    return changed


def digests(df: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation after damage and repair."""
    damaged = damage(df)
    rows = damaged.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies", "copy")
    turn = F.when(F.col("copies") > 0, F.col("turn").cast("long"))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0))
    whole = damaged.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(gaps.cast("long").alias("gaps"))
    sums = summed(repair(rows))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    sha = F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    return whole.join(sums, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select("conv_id", "gaps", *zero, audit, sha)


def oracle() -> str:
    """The same in SQL: rows are folded from the last to the first, with the best (cost, audit, text) of each stack top. Insertions are
    steps of their own; two of them reach every top."""
    tops, wanted, leads = "espq", {"e": "user", "s": "user", "p": "assistant", "q": "user"}, {"e": "p", "s": "p", "p": "q", "q": "p"}
    none = "{'c': 1000000000, 'a': '', 't': ''}"
    staying = "CASE WHEN x.f = 3 THEN 5 ELSE 0 END"

    def step(letter: str, cost: str, to: str, said: str | None) -> str:
        text = f"r.{to}.t" if said is None else f"{said} || CASE WHEN r.{to}.t = '' THEN '' ELSE chr(10) || r.{to}.t END"
        return f"{{'c': {cost} + r.{to}.c, 'a': '{letter}' || r.{to}.a, 't': {text}}}"

    keep = lambda to: step("K", staying, to, "x.role || ':' || x.text")
    kept = {
        "e": f"CASE x.l WHEN 's' THEN {keep('s')} WHEN 'u' THEN {keep('p')} ELSE {none} END", "s": f"CASE x.l WHEN 'u' THEN {keep('p')} ELSE {none} END",
        "p": f"CASE x.l WHEN 'a' THEN {keep('q')} ELSE {none} END", "q": f"CASE x.l WHEN 'u' THEN {keep('p')} ELSE {none} END",
    }
    rerole = lambda t: step("R", f"1 + {staying}", leads[t], f"'{wanted[t]}:' || x.text")
    row = ", ".join(f"'{t}': CASE WHEN x.f IN (1, 2) THEN {step('D', '2', t, None)} ELSE list_min([{step('D', '2', t, None)}, {kept[t]}, {rerole(t)}]) END" for t in tops)
    insertion = ", ".join(f"'{t}': list_min([r.{t}, {step('I', '5', leads[t], f"'{wanted[t]}:'")}])" for t in tops)
    end = "{'c': 0, 'a': '', 't': ''}"
    insert = "{'l': '', 'f': 9, 'role': '', 'text': ''}"
    return rf"""
WITH k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), d AS (
    SELECT *, xor(4294967295, list_reduce(list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
                  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))), CAST(4294967295 AS BIGINT))) % 20 AS kind FROM k
), c AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM d
), n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos FROM c
), f AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2 WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 0 ELSE 3 END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM n
), g AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list_prepend({insert}, list_prepend({insert}, flatten(list([{{'l': left(role, 1), 'f': fault, 'role': role, 'text': text}}, {insert}, {insert}] ORDER BY pos DESC)))) AS steps FROM f GROUP BY conv_id
), b AS (SELECT * EXCLUDE steps, list_reduce(steps, lambda r, x: CASE WHEN x.f = 9 THEN {{{insertion}}} ELSE {{{row}}} END, {{'e': {end}, 's': {none}, 'p': {none}, 'q': {end}}}).e AS best FROM g)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
