import hashlib
import heapq
import random
import zlib

import pytest

from tidemark.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, id long, block string, fault string, place double"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Edits by growing (cost, audit): the first that ends well is the best."""
    lead = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    queue, best = [(0, "", 0, "", ())], {}
    while True:
        cost, audit, at, top, out = heapq.heappop(queue)
        if at == len(rows) and top in ("", "a"):
            return cost, audit, out
        if best.setdefault((at, top), cost) < cost:
            continue
        for letter, role in (("u", "user"), ("a", "assistant")):
            if letter in lead[top]:
                heapq.heappush(queue, (cost + 5, audit + "I", at, letter, (*out, role + ":")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, top, out))
            if fault not in (1, 2):
                more = cost + 5 * (fault == 3)
                if role[:1] in lead[top]:
                    heapq.heappush(queue, (more, audit + "K", at + 1, role[:1], (*out, f"{role}:{text}")))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if letter in lead[top]:
                        heapq.heappush(queue, (more + 1, audit + "R", at + 1, letter, (*out, f"{name}:{text}")))


def folded(rows):
    """The same for many rows: whole audits of all that can follow, from the last row to the first."""
    lead = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ()), "a": (0, "", ())}

    def insertions(best):
        for _ in range(3):
            more = {t: [best[t]] if t in best else [] for t in lead}
            for t in lead:
                more[t] += [(best[x][0] + 5, "I" + best[x][1], (names[x] + ":", *best[x][2])) for x in lead[t] if x in names and x in best]
            best = {t: min(v) for t, v in more.items() if v}
        return best

    best = insertions(best)
    for role, text, fault in reversed(rows):
        now = {}
        for t in lead:
            ways = [(best[t][0] + 2, "D" + best[t][1], best[t][2])] if t in best else []
            if fault not in (1, 2):
                ways += [(best[x][0] + (edit == "R") + 5 * (fault == 3), edit + best[x][1], (f"{name}:{text}", *best[x][2])) for x in lead[t] if x in best for edit, name in (("K", role), ("R", names.get(x))) if name and name[:1] == x]
            if ways:
                now[t] = min(ways)
        best = insertions(now)
    return best[""]


def plain(table):
    """All contract columns, conversation by conversation."""
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, told = set(), []
        for _, role, text in rows:
            fault = 1 if not text.strip(BLANKS) else 2 if (role, text) in seen else 0 if text.rstrip(BLANKS)[-1] in ".!?" else 3
            seen.add((role, text))
            told.append((role, text, fault))
        numbers = [t for t, _, _ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
        cost, audit, text = folded(told)
        out.append((conv, gaps, *(sum(f == k for _, _, f in told) for k in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return sorted(map(str, out))


def frame(spark, table):
    return spark.createDataFrame([(*r, 1, "b", "f", 0.5) for r in table], SCHEMA)


def got(df):
    return sorted(map(str, ((r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect())))


def conversations(seed, n, most, texts=("Yes.", "No!", "half", " ", "", None, "What?\n", "x")):
    r = random.Random(seed)
    return [(None if c == 3 else c, None if r.random() < 0.05 else t + 2 * (r.random() < 0.1), r.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), r.choice(texts) if r.random() < 0.4 else f"t{r.randrange(10**6)}{r.choice('.!?,')}") for c in range(n) for t in range(r.randrange(most))]


def test_same_as_the_cheapest_of_all_edits(spark):
    table = conversations(1, 60, 12) + [(500, 0, "user", "a" * 100_000 + "."), (500, 1, "assistant", "ünï 🎉."), (501, None, None, None)]
    assert got(turns.digests(frame(spark, table))) == plain(table)


def test_a_conversation_over_many_blocks(spark):
    """A third of all rows in one conversation, and one that has no id: pieces are linked over blocks."""
    r = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "tool", "system"]
    table = [(7, t, r.choice(roles), f"t{t % 150}{r.choice('.!,')}") for t in range(400)] + [(None, t, r.choice(roles), f"u{t}.") for t in range(200)] + conversations(2, 20, 6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = turns.repair(frame(spark, table))
        assert edits.filter("conv_id = 7").select("block").distinct().count() > 3
        assert got(turns.digests(frame(spark, table))) == plain(table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_that_are_all_the_same(spark):
    table = [(1, 5, "user", "Same."), *[(1, 6, "assistant", "Same.")] * 300]
    rows = turns.repair(frame(spark, table)).collect()
    assert len(rows) == 301 and sum(r.edit == "K" for r in rows) == 2 and sum(r.fault == 2 for r in rows) == 299


def test_edits_are_rows(spark):
    table = [(1, 0, "user", "Hi."), (1, 1, "user", "cut"), (1, 2, "assistant", "Yes."), (1, 3, "tool", ""), (1, 4, "user", "End.")]
    rows = turns.repair(frame(spark, table)).orderBy("block", "at").collect()
    assert [(r.edit, r.role, r.text, r.fault, r.cost) for r in rows] == [("K", "user", "Hi.", 0, 0), ("D", None, None, 3, 2), ("K", "assistant", "Yes.", 0, 0), ("D", None, None, 1, 2), ("D", None, None, 0, 2)]
    assert turns.repair(frame(spark, table).limit(0)).collect() == [] and turns.digests(frame(spark, table).limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_parse_and_walk(seed):
    r = random.Random(seed)
    rows = [(r.choice(["user", "assistant", "system", "x"]), "t", r.choice([0, 0, 0, 1, 2, 3, 3])) for _ in range(r.randrange(9))]
    letters, faults = [x[0][:1] for x in rows], [x[2] for x in rows]
    nodes = turns.parse(letters, faults, turns.inserted(turns.ACCEPTED))
    cost, audit, out = cheapest(rows)
    assert folded(rows) == (cost, audit, out)
    assert nodes[0][turns.EMPTY] == cost and "".join(e for e, _, _ in turns.walk(letters, faults, nodes, turns.EMPTY, True)[0]) == audit
