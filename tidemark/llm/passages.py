"""Exact removal of repeated passages: every byte of a string of ``LENGTH`` bytes that also starts elsewhere in the table goes.

``Cut`` says what a string is made of and how long it is: bytes (``BYTES``), or words between ASCII white space (``WORDS``: 51 words; white
space between two words that go goes too). Several cuts go through the same jobs. Units below are bytes or words.

Sampled suffixes are sorted first and all others are induced from them, with the common prefixes carried along, on the places where
repeats can be:

1. Sample: a position is an anchor if its ``gram`` units hash to the minimum of some ``span`` neighbouring positions. That depends on the
   text around it alone, so equal strings have equal anchors; every string of a cut's length has an anchor in its core.
2. Name: the units around an anchor that lie in every string having it in its core. A name that occurs once rules out all those strings.
3. Each anchor that is left stands for the strings whose first core anchor it is. They differ in the units to the left and to the right
   of the name: these are its tuple. Spark deals the tuples by name and sorts them by (name, right side), on disk where memory ends: that
   is the order of the suffixes that start at the name, with the common prefix of neighbours.
4. Induce: the order of the suffixes one unit further left follows from the unit before them and the order so far; a neighbour's common
   prefix is one more than the least one between them. Strings whose common prefix covers their length are repeats. What can't reach the
   length any more leaves the queue.
5. Equal tuples of a name are repeats: they are settled, and one of them goes on to answer others.
6. Recursion: the tuples of a name with over ``CLASS`` of them are named anew by the units that the left and the right half of their
   strings have in common, and fold again; so a class halves its strings until it is small. No task has to hold a class that grows with
   the table. (Steps 5 and 6 come before step 4.)

Equal texts count as one text (copies), removed whole if as long as a string. A text that repeats a tuple itself settles it at once, so
runs of one letter or short periods take few tuples. Texts lie in a table that is bucketed by their key, so that they are dealt once.
Names and keys of texts compare by 64 and 96 bits of hash; a false equality of names is told apart by the units beside them. Words of
``WORDS`` compare by 64 bits. Memory of a task: about 12 bytes a byte of its longest text, and some MB for blocks of ``BLOCK`` units.

Null text: empty. Texts shorter than a string lose nothing. Repeated rows are copies. Null ids are kept, and an empty table gives an empty
one. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, units

LENGTH = 400
#: Units of a block of a text; tuples of a name that one task sorts; tuples sorted side by side.
BLOCK, CLASS, SIDE = 1 << 16, 2000, 20_000


@dataclass(frozen=True)
class Cut:
    """Strings of ``length`` units; length >= 3 * span + gram - 2 gives every string an anchor in its core.

    An anchor at p stands in the core of the strings that start at p - last to p - first; its name is the units from p - first to p + after.
    """

    length: int
    gram: int
    span: int
    words: bool = False

    @property
    def first(self) -> int:
        return self.span

    @property
    def last(self) -> int:
        return self.length - self.span - self.gram + 1

    @property
    def after(self) -> int:
        return self.length - self.last

    @property
    def reach(self) -> int:
        """Units on each side of a name that its strings may take in; a string takes ``reach`` of them in all."""
        return self.last - self.first

    @property
    def least_bytes(self) -> int:
        return 2 * self.length - 1 if self.words else self.length


#: op9's strings, and passages of over 50 words.
BYTES, WORDS = Cut(LENGTH, 16, 128), Cut(51, 5, 16, words=True)


class Texts:
    """Units of some texts, one behind the other: ``code`` tells units apart (bytes, or 64-bit hashes of words)."""

    def __init__(self, raws: list[bytes], cut: Cut):
        self.cut = cut
        if cut.words:
            self.code, _, _, self.begin, self.end = units.words_of(raws)
        else:
            raw, self.begin, self.end = units.joined(raws)
            self.code = np.frombuffer(raw, np.uint8)
        self.n = len(self.code)

    def named(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchors that stand in the core of some string, their names and their texts; stretches (text, begin, end) of short periods."""
        c, none = self.cut, np.zeros(0, np.int64)
        found, periodic = [(none, none, none)], [np.zeros((0, 3), np.int64)]
        for low in range(c.first, self.n - c.after + 1, BLOCK):
            high = min(low + BLOCK, self.n - c.after + 1)
            sums = units.Sums(self.code[low - c.first : high - 1 + c.after])
            g = (sums.hashes(c.gram) >> np.uint64(32)).astype(np.uint32)
            best = sliding(sliding(g, c.span, np.minimum), c.span, np.maximum)
            at = np.flatnonzero(best[1 : 1 + high - low] == g[c.first : c.first + high - low])
            name = (sums.hashes(c.first + c.after, at) + np.uint64(c.words)).view(np.int64)
            at = at + low
            # a name lies in one text, and so do the neighbours that make its anchor
            text = np.searchsorted(self.begin, at, "right") - 1
            inside = (at - c.first >= self.begin[text]) & (at + c.after <= self.end[text])
            thin, stretches_here = self.thinned(at[inside], name[inside], text[inside])
            found.append(thin)
            periodic.append(stretches_here)
        return *(np.concatenate(x) for x in zip(*found, strict=True)), np.concatenate(periodic)

    def thinned(self, at: np.ndarray, name: np.ndarray, text: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        """Anchors without the inner ones of long stretches where one name comes again and again at one distance: there the text has a
        period, so all of the stretch repeats itself, and the anchors near its ends have all tuples that the inner ones have."""
        c, stays, out = self.cut, np.ones(len(at), bool), []
        step = np.diff(at)
        equal = (name[1:] == name[:-1]) & (text[1:] == text[:-1])
        inner = equal[1:] & equal[:-1] & (step[1:] == step[:-1])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inner, [False]]).astype(np.int8)))
        first, last = edges[::2], edges[1::2] + 1
        for i, j in zip(*(x[at[last] - at[first] > 4 * c.reach + c.span] for x in (first, last)), strict=True):
            begin, end, room = at[i] - c.first, at[j] + c.after, c.reach + 2 * step[i]
            if end - begin >= c.length + step[i]:
                stays[i : j + 1] &= (at[i : j + 1] <= at[i] + room) | (at[i : j + 1] >= at[j] - room)
                out.append((text[i], begin - self.begin[text[i]], end - self.begin[text[i]]))
        return (at[stays], name[stays], text[stays]), np.array(out, np.int64).reshape(-1, 3)


def sliding(x: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """f over each run of ``width`` (a power of two) neighbours."""
    step = 1
    while step < width:
        x = f(x[:-step], x[step:])
        step *= 2
    return x


def text_key(text: Column) -> dict[str, Column]:
    return {"k1": F.xxhash64(text), "k2": F.hash(text)}


NAMES = {"name": "long", "k1": "long", "k2": "int", "times": "int"}
#: name: null for strings that are settled, which start at base - most to base - least; cut: which of the cuts.
TUPLES = {"name": "long", "k1": "long", "k2": "int", "cut": "int", "base": "long", "least": "int", "most": "int", "left": "binary", "right": "binary"}
#: Units from ``begin`` to ``end`` go.
GONE = {"k1": "long", "k2": "int", "cut": "int", "begin": "long", "end": "long"}
RESULT = {"k1": "long", "k2": "int", "n_removed": "long", "n_spans": "long", "kept_sha256": "string", "n_passage_bytes": "long", "kept_text": "string"}


def flat(rows: list[tuple], schema: dict[str, str]) -> list:
    """Rows of (scalars and arrays) as flat columns: scalars are repeated along the arrays."""
    sizes = [len(r[0]) for r in rows]
    parts = ([r[k] if isinstance(r[k], np.ndarray) else np.full(n, r[k]) for r, n in zip(rows, sizes, strict=True)] for k in range(len(schema)))
    return [np.concatenate(p).astype(common.ARROW[t].to_pandas_dtype()) if p else [] for p, t in zip(parts, schema.values(), strict=True)]


def name_rows(cuts: tuple[Cut, ...]):
    def f(k1s, k2s, texts):
        raws, k1, k2, rows = [t.encode() for t in texts], np.array(k1s, np.int64), np.array(k2s, np.int64), []
        for cut in cuts:
            _, names, text, _ = Texts(raws, cut).named()
            order = np.lexsort((names, text))
            names, text = names[order], text[order]
            first = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (text[1:] != text[:-1]))) if len(names) else order
            rows.append((names[first], k1[text[first]], k2[text[first]], np.minimum(np.diff(first, append=len(names)), 2)))
        return flat(rows, NAMES)

    return f


def binaries(rows: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The first ``counts`` units of each row."""
    data = rows[np.arange(rows.shape[1]) < counts[:, None]].tobytes()
    ends = np.append(0, np.cumsum(counts * rows.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def tuple_columns(x: Texts, repeated: np.ndarray):
    """Blocks of (text, name, base, least, most, left, right); name is null and sides are empty for what is settled."""
    c, reach = x.cut, x.cut.reach
    at, names, text, periodic = x.named()
    shared = np.isin(names, repeated)
    # strings of an anchor start at base - least to base - most; those whose core holds a name that occurs once are ruled out
    gap = np.minimum(np.diff(at, prepend=-reach - 1), reach + 1)
    once = np.minimum.accumulate(np.append(np.where(shared, x.n + reach + 1, at), x.n + reach + 1)[::-1])[::-1][1:]
    n_left, n_right = np.minimum(at - c.first - x.begin[text], reach), np.minimum(x.end[text] - at - c.after, reach)
    least, most = np.maximum(np.maximum(0, reach - (once - at) + 1), reach - n_right), np.minimum(gap - 1, n_left)
    use = np.flatnonzero(shared & (least <= most))
    order = np.lexsort((names[use], text[use]))
    same = (names[use][order][1:] == names[use][order][:-1]) & (text[use][order][1:] == text[use][order][:-1])
    again = np.zeros(len(use), bool)
    again[order] = np.append(False, same) | np.append(same, False) if len(use) else False
    seen, sure, steps = {}, [], np.arange(reach)
    for low in range(0, len(use), 1 << 14):
        i, again_here = use[low : low + (1 << 14)], again[low : low + (1 << 14)]
        left = x.code[np.maximum((at[i] - c.first)[:, None] - 1 - steps, 0)]
        right = x.code[np.minimum((at[i] + c.after)[:, None] + steps, x.n - 1)]
        stays = np.ones(len(i), bool)
        for k in np.flatnonzero(again_here).tolist():
            # a tuple that its text has twice is settled; one of them stands for all in other texts
            key = (int(text[i[k]]), int(names[i[k]]), left[k, : n_left[i[k]]].tobytes(), right[k, : n_right[i[k]]].tobytes())
            if (first := seen.setdefault(key, int(i[k]))) != i[k]:
                stays[k] = False
                sure += [i[k]] if first < 0 else [i[k], first]
                seen[key] = -1
        i = i[stays]
        yield text[i], pa.array(names[i]), at[i] - c.first - x.begin[text[i]], least[i], most[i], binaries(left[stays], n_left[i]), binaries(right[stays], n_right[i])
    sure = np.array(sure, np.int64)
    base = at[sure] - c.first - x.begin[text[sure]]
    told = np.concatenate([np.stack([text[sure], base - most[sure], base - least[sure] + c.length], 1), periodic])
    for t in np.unique(told[:, 0]).tolist():
        begin, end = merged(*told[told[:, 0] == t, 1:].T)
        empty = pa.array([b""] * len(begin), pa.binary())
        yield np.full(len(begin), t), pa.nulls(len(begin), pa.int64()), end - c.length, np.zeros(len(begin), int), end - c.length - begin, empty, empty


def tuple_rows(cuts: tuple[Cut, ...]):
    def f(k1s, k2s, texts, repeated):
        raws, k1, k2 = [t.encode() for t in texts], np.array(k1s, np.int64), np.array(k2s, np.int32)
        shared = np.unique(np.concatenate([np.array(r, np.int64) for r in repeated]))
        out = []
        for k, cut in enumerate(cuts):
            for text, name, base, least, most, left, right in tuple_columns(Texts(raws, cut), shared):
                out.append([pa.array(a) for a in (k1[text], k2[text], np.full(len(text), k, np.int32), base, least.astype(np.int32), most.astype(np.int32))])
                out[-1] = [name, *out[-1], left, right]
        return [pa.concat_arrays(x) for x in zip(*out, strict=True)] if out else [[] for _ in TUPLES]

    return f


def matrix(values: pa.ChunkedArray, kind: type, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of units, and where a row has any."""
    size = np.dtype(kind).itemsize
    flat_values = pa.concat_arrays(values.chunks)
    _, offsets, data = flat_values.buffers()
    ends = np.frombuffer(offsets, np.int32)[flat_values.offset : flat_values.offset + len(flat_values) + 1].astype(np.int64)
    codes = np.frombuffer(data, np.uint8)[: ends[-1] // size * size].view(kind) if ends[-1] else np.zeros(1, kind)
    first, have = ends[:-1, None] // size + np.arange(width), np.arange(width) < np.diff(ends)[:, None] // size
    return codes[np.minimum(first, len(codes) - 1)], have


def lowest(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of x[low + 1 .. high] for each pair."""
    size = high - low
    out = np.empty(len(low), x.dtype)
    step, left = 1, np.ones(len(low), bool)
    while left.any():
        mine = left & (size < 2 * step)
        out[mine] = np.minimum(x[low[mine] + 1], x[high[mine] - step + 1])
        left &= ~mine
        if left.any():
            x = np.minimum(x[: len(x) - step], x[step:])
            step *= 2
    return out


def repeated_strings(group: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which strings of each tuple are repeats: a row a tuple, a column a number of units to the left.

    Tuples come sorted by (group, right side). Steps to the left induce each order from the one before; ``prefix`` is the common prefix of a
    suffix and the one before it, from its left end to ``reach`` units behind the name.
    """
    reach = left.shape[1]
    found = np.zeros((len(group), reach + 1), bool)
    same = (right[1:] == right[:-1]) & (right[1:] > 0)
    prefix = np.append(0, np.where(same.all(1), reach, (~same).argmax(1)))
    prefix[np.append(True, group[1:] != group[:-1])] = -1
    order, far = np.arange(len(group)), int(most.max(initial=-1))
    letters = int(left.max(initial=0)) + 1
    for a in range(far + 1):
        equal = np.flatnonzero(prefix >= reach)
        found[order[equal], a] = found[order[equal - 1], a] = True
        if a == far:
            break
        before = left[order, a].astype(np.int64)
        key = group[order] * letters + before
        turn = np.argsort(key, kind="stable")
        low, high = turn[:-1], turn[1:]
        together = (key[low] == key[high]) & (before[high] > 0)
        new = np.full(len(turn), -1, prefix.dtype)
        pairs = np.flatnonzero(together)
        new[pairs + 1] = lowest(prefix, low[pairs], high[pairs]) + 1
        # a suffix whose common prefix can't come to ``reach`` in the steps left takes no further part
        best = np.maximum(new, np.append(new[1:], -1))
        stay = best + (far - a - 1) >= reach
        if not stay.any():
            break
        # between two that stay lie only some that leave: their common prefix is the least one on the way
        kept = np.flatnonzero(stay)
        order = order[turn[kept]]
        prefix = np.append(-1, lowest(new, kept[:-1], kept[1:])) if len(kept) > 1 else np.full(1, -1, new.dtype)
    steps = np.arange(reach + 1)
    return found & (steps >= least[:, None]) & (steps <= most[:, None])


def induce(cuts: tuple[Cut, ...]):
    """Tuples in order of (name, right side) to GONE, whole names side by side."""

    def done(rows: pa.Table) -> pa.RecordBatch:
        out = []
        for k, cut in enumerate(cuts):
            part = rows.filter(pa.compute.equal(rows["cut"], k))
            if not part.num_rows:
                continue
            names = part["name"].to_numpy()
            group = np.cumsum(np.append(0, names[1:] != names[:-1]))
            many = np.bincount(group)[group] > 1
            if not many.any():
                continue
            part, group = part.filter(pa.array(many)), group[many]
            kind = np.uint64 if cut.words else np.uint8
            both, have = zip(*(matrix(part[c], kind, cut.reach) for c in ("left", "right")), strict=True)
            codes = np.stack(both)
            if cut.words:
                codes = np.unique(codes, return_inverse=True)[1].reshape(codes.shape)
            # units count from 1; 0 is behind an end
            both = np.where(np.stack(have), codes.astype(np.int32) + 1, 0)
            base, least, most = (part[c].to_numpy() for c in ("base", "least", "most"))
            found = repeated_strings(group, *both, least, most)
            edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, low = np.nonzero(edges > 0)
            high = np.nonzero(edges < 0)[1] - 1
            out.append((part["k1"].to_numpy()[row], part["k2"].to_numpy()[row], k, base[row] - high, base[row] - low + cut.length))
        return common.batch(GONE, flat(out, GONE))

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= SIDE:
                rows = pa.Table.from_batches(held)
                names = rows["name"].to_numpy()
                # the last name may go on in the next batch
                cut = int(np.flatnonzero(names != names[-1])[-1]) + 1 if names[0] != names[-1] else 0
                if cut:
                    yield done(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    return run


def equal_key() -> dict[str, Column]:
    return {"u1": F.xxhash64("left", F.lit(0), "right"), "u2": F.xxhash64(F.lit(1), "left", F.lit(0), "right")}


def folded(rows: DataFrame) -> DataFrame:
    """One row of each group of equal tuples of a name, as a table, with ``n`` (how many there are) and their key u1, u2."""
    same = ["name", "u1", "u2"]
    one = rows.withColumns(equal_key()).groupBy(*same).agg(F.count("*").alias("n"), F.first(F.struct(*(c for c in rows.columns if c != "name"))).alias("one"))
    return common.written(one.select(*same, "n", "one.*"))


def halves(hot: DataFrame, cuts: tuple[Cut, ...]) -> DataFrame:
    """Two rows a tuple, named by what their strings have in common: those that reach ``low`` to ``mid`` units to the left, and the others.
    Sides keep what these strings take in."""
    reach, size = of_cut([c.reach for c in cuts]), of_cut([8 if c.words else 1 for c in cuts])
    here = hot.withColumns({"mid": F.expr("cast((low + high) div 2 as int)"), "r": reach, "w": size})
    lower = here.withColumns({"name": F.xxhash64("name", F.lit(0), F.expr("substring(right, 1, (r - mid) * w)")), "high": F.col("mid"), "most": F.least("most", "mid")})
    upper = here.withColumns({"name": F.xxhash64("name", F.lit(1), F.expr("substring(left, 1, (mid + 1) * w)")), "low": F.col("mid") + 1, "least": F.greatest("least", F.col("mid") + 1)})
    # halves without strings of their own still answer others
    enough = F.expr("low <= high and octet_length(right) >= (r - high) * w and octet_length(left) >= low * w")
    sides = {"left": F.expr("substring(left, 1, high * w)"), "right": F.expr("substring(right, 1, (r - low) * w)")}
    return lower.unionByName(upper).filter(enough).withColumns(sides).drop("mid", "r", "w")


def of_cut(values: list[int]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.col("cut") + 1)


def settled(rows: DataFrame, cuts: tuple[Cut, ...]) -> DataFrame:
    length = of_cut([c.length for c in cuts])
    return rows.filter("least <= most").select("k1", "k2", "cut", (F.col("base") - F.col("most")).alias("begin"), (F.col("base") - F.col("least") + length).alias("end"))


def gone_units(tuples: DataFrame, cuts: tuple[Cut, ...]) -> DataFrame:
    """GONE of a written table of tuples."""
    common.find_package(tuples.sparkSession)
    out = [settled(tuples.filter("name is null"), cuts)]
    todo, cold = tuples.filter("name is not null").withColumns({"low": F.lit(0), "high": of_cut([c.reach for c in cuts])}), []
    while True:
        one = folded(todo)
        more = one.filter("n > 1").select("name", "u1", "u2")
        out.append(settled(todo.withColumns(equal_key()).drop("left", "right").join(more, ["name", "u1", "u2"], "left_semi"), cuts))
        hot = common.written(one.groupBy("name").count().filter(F.col("count") > CLASS).select("name"))
        if hot.isEmpty():
            break
        cold.append(one.join(hot, "name", "left_anti"))
        todo = common.written(halves(one.join(hot, "name", "left_semi").drop("n", "u1", "u2"), cuts))
    for x in cold:
        one = one.unionByName(x)
    dealt = one.select(*TUPLES).repartition("name").sortWithinPartitions("name", "right")
    found = dealt.mapInArrow(induce(cuts), common.ddl(GONE))
    for x in out:
        found = found.unionByName(x)
    return found


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches as maximal ones; those that touch join."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1]) if len(begin) else np.zeros(0, bool)
    return begin[new], end[np.append(new[1:], True)] if len(begin) else end


def stretches(raw: bytes, cut: Cut, whole: bool, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes go, as stretches: units between begin and end, or all of a copy that holds a string."""
    if not cut.words:
        return (np.array([0]), np.array([len(raw)])) if whole and len(raw) >= cut.length else merged(begin, end)
    if not whole and not len(begin):
        return begin, end
    _, at, stop = units.words(raw)
    if whole and len(at) >= cut.length:
        return np.array([0]), np.array([len(raw)])
    begin, end = merged(begin, end)
    return at[begin], stop[end - 1]


def result_rows(cuts: tuple[Cut, ...], with_text: bool):
    def f(k1s, k2s, texts, copies, which, begins, ends):
        rows = []
        for k1, k2, t, c, *gone in zip(k1s, k2s, texts, copies, which, begins, ends, strict=True):
            raw = t.encode()
            k, begin, end = (np.array(x or (), np.int64) for x in gone)
            parts = [stretches(raw, cut, c > 1, begin[k == i], end[k == i]) for i, cut in enumerate(cuts)]
            begin, end = parts[0]
            kept = hashlib.sha256(without(raw, begin, end)).hexdigest()
            passage_bytes = sum(int((e - b).sum()) for b, e in parts[1:])
            text = whole_letters(raw, *merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))) if with_text else None
            rows.append((k1, k2, int((end - begin).sum()), len(begin), kept, passage_bytes, text))
        return [list(c) for c in zip(*rows, strict=True)]

    return f


def without(raw: bytes, begin: np.ndarray, end: np.ndarray) -> bytes:
    return b"".join(raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)], strict=True))


def whole_letters(raw: bytes, begin: np.ndarray, end: np.ndarray) -> str:
    """What is kept as text: a letter stays whole if any of its bytes stays."""
    out, at = [], 0
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        while a < b and a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1  # its first byte stays
        cut_at = b
        while cut_at > a and cut_at < len(raw) and raw[cut_at] & 0xC0 == 0x80:
            cut_at -= 1  # its last byte stays
        out.append(raw[at:a])
        at = cut_at
    return b"".join([*out, raw[at:]]).decode()


def whole_texts(df: DataFrame, text_col: str, cuts: tuple[Cut, ...]) -> DataFrame:
    """k1, k2, text, copies: one row a distinct text that may hold a string, in buckets of k1 and k2."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = df.select(text.alias("text")).filter(F.octet_length("text") >= min(c.least_bytes for c in cuts)).withColumns(text_key(F.col("text")))
    return common.bucketed(docs.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies")), ["k1", "k2"])


def repeated_passages(df: DataFrame, text_col: str = "text", cuts: tuple[Cut, ...] = (BYTES, WORDS), with_text: bool = False) -> DataFrame:
    """RESULT for each distinct text that may lose something: k1 and k2 are the text's key (``text_key``); n_removed, n_spans and
    kept_sha256 tell of the first cut, n_passage_bytes of the others, kept_text of all together."""
    texts = whole_texts(df, text_col, cuts)
    with common.scratch(df.sparkSession):
        names = common.written(common.map_rows(texts, ["k1", "k2", "text"], NAMES, lambda: name_rows(cuts)))
        # texts are distinct, so a name of two rows stands in two texts
        shared = names.groupBy("name").agg(F.sum("times").alias("times")).filter("times > 1").select("name")
        places = names.join(shared, "name", "left_semi").groupBy("k1", "k2").agg(F.collect_set("name").alias("repeated"))
        tuples = common.written(common.map_rows(texts.join(places, ["k1", "k2"]), ["k1", "k2", "text", "repeated"], TUPLES, lambda: tuple_rows(cuts)), keep=True)
    gone = gone_units(tuples, cuts).groupBy("k1", "k2").agg(*(F.collect_list(c).alias(c) for c in ("cut", "begin", "end")))
    lost = texts.join(gone, ["k1", "k2"], "left").filter("cut is not null or copies > 1")
    return common.map_rows(lost, ["k1", "k2", "text", "copies", "cut", "begin", "end"], RESULT, lambda: result_rows(cuts, with_text))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row, by strings of LENGTH bytes; n_passage_bytes: bytes that lie in
    passages of over 50 words that stand elsewhere too."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"), *(c.alias(k) for k, c in text_key(text).items()))
    with common.scratch(df.sparkSession):
        lost = common.written(repeated_passages(df, text_col).drop("kept_text"), keep=True)
    out = rows.join(lost, ["k1", "k2"], "left")
    none = {"n_removed": F.lit(0), "n_spans": F.lit(0), "kept_sha256": F.col("whole"), "n_passage_bytes": F.lit(0)}
    return out.select("doc_id", "n_bytes", *(F.coalesce(k, v).alias(k) for k, v in none.items()))


def without_passages(df: DataFrame, text_col: str = "text", cuts: tuple[Cut, ...] = (BYTES,)) -> DataFrame:
    """df with the repeated strings of all cuts taken from its texts; letters that would be cut in part stay whole. Null texts stay null."""
    with common.scratch(df.sparkSession):
        lost = common.written(repeated_passages(df, text_col, cuts, with_text=True).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("kept_text").alias("__kept")), keep=True)
    text, keys = F.col(f"`{text_col}`"), text_key(F.col(f"`{text_col}`"))
    out = df.join(lost, (keys["k1"] == F.col("__k1")) & (keys["k2"] == F.col("__k2")), "left")
    return out.withColumn(text_col, F.coalesce("__kept", text)).select(*(F.col(f"`{c}`") for c in df.columns))
