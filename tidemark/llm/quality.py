"""Quality rules with adaptive thresholds: mergeable quantile sketches per language and source replace fixed cutoffs.

1. Each text gets its measures (Python, one pass); they are written once.
2. A sketch of a measure is a histogram over buckets whose width is 1/64 of their power of two: it is a plain (group, bucket, count)
   table, so sketches merge by adding counts, in any order, with the same result. A quantile's relative error is at most 1/64.
3. Thresholds of each (language, source) come from the quantiles of its own sketch, merged with ``PRIOR`` times its language's sketch
   scaled to one document, so that small groups lean on their language.
4. The measures are joined with the thresholds and filtered.

A document that passes the base rules is kept unless a measure lies beyond its group's fence: a middle quantile plus ``FENCE`` times its
distance from the lower quartile, both told by the sketch, whose resolution is the least distance. No measure has a cutoff of its own: what
is usual in a source passes there and not elsewhere. The middle is the median; for signs, which most texts lack, the upper quartile. Junk
lies at the upper end, so it doesn't move the fence before it makes up half (of signs, a quarter) of a group. Repeated words and lines have
no fence, as the base rules and their counts cover them.

Null text: no words, so the base rules reject it. Null language or source: a group of its own. Repeated rows count as often as they come.
An empty table gives no rows. A text is measured whole, in memory that grows with it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

MEASURES = {
    "doc_id": "long", "lang": "string", "source": "string", "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "n_upper": "long",
}
WINDOW = 8
#: Measures: numerator, denominator, parts of one, the quantile (in hundredths) that the fence starts from.
FEATURES = {"symbols": ("n_symbols", "word_chars", 10_000, 75), "upper": ("n_upper", "word_chars", 10_000, 50), "word_length": ("word_chars", "n_words", 100, 50)}
LOWER, FENCE, PRIOR = 25, 12, 50
#: Buckets of a power of two, as a power of two.
FINE = 6
#: Groups whose thresholds may be broadcast; with more of them the join shuffles.
BROADCAST_GROUPS = 10_000


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight that occur twice or more in the text, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    # a random-looking 64-bit value for each word, then a polynomial over eight of them
    x = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    for step, k in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F), (4, 0xE7037ED1A0B428DB)):
        x = x[:-step] * np.uint64(k) + x[step:]
    ordered = np.sort(x)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # equal values only nominate windows; the words decide
    places = np.flatnonzero(np.isin(x, twice)).tolist()
    seen: dict[tuple, int] = {}
    for p in places:
        w = tuple(words[p : p + WINDOW])
        seen[w] = seen.get(w, 0) + 1
    covered = np.zeros(len(words) + 1, np.int64)
    for p in places:
        if seen[tuple(words[p : p + WINDOW])] > 1:
            covered[p] += 1
            covered[p + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()] if b"\n" in raw else [raw] * bool(words)
    blank = sum(map(text.count, " \t\n\r\x0b\x0c"))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return len(words), len(text) - blank, sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), repeated_words(words), upper


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document with MEASURES."""

    def make():
        return lambda ids, texts, langs, sources: [ids, langs, sources, *(list(c) for c in zip(*map(measure, texts), strict=True))]

    return common.map_rows(df, [id_col, text_col, lang_col, source_col], MEASURES, make)


def features() -> dict[str, Column]:
    """The measures that get thresholds, as whole numbers."""
    return {k: F.expr(f"if({b} > 0, ({scale} * {a}) div {b}, 0)") for k, (a, b, scale, _) in FEATURES.items()}


def sketch(measured: DataFrame) -> DataFrame:
    """language, source, feature, bucket, n: mergeable by adding n. The lowest buckets hold one value each, above them a power of two has 2**FINE."""
    values = F.explode(F.array(*(F.struct(F.lit(k).alias("feature"), c.alias("v")) for k, c in features().items())))
    bits = "length(bin(v))"
    return (
        measured.select(key("lang").alias("language"), key("source").alias("origin"), values.alias("x"))
        .select("language", "origin", "x.feature", "x.v")
        .withColumn("bucket", F.expr(f"if(v < {2 << FINE}, v, {1 << FINE} * ({bits} - {FINE + 1}) + shiftright(v, {bits} - {FINE + 1}))"))
        .groupBy("language", "origin", "feature", "bucket")
        .agg(F.count("*").alias("n"))
    )


def key(column: str) -> Column:
    """A text that is never null and tells null from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def thresholds(sketches: DataFrame) -> DataFrame:
    """language, origin and a fence for each feature. A group's buckets count in full, its language's as PRIOR documents in all."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products of two counts
    language = sketches.groupBy("language", "feature", "bucket").agg(F.sum("n").alias("n"))
    total = language.groupBy("language", "feature").agg(F.sum("n").alias("total"))
    groups = sketches.select("language", "origin", "feature").distinct()
    own = sketches.join(total, ["language", "feature"]).select("language", "origin", "feature", "bucket", (wide("n") * wide("total")).alias("w"))
    lent = groups.join(language, ["language", "feature"]).select("language", "origin", "feature", "bucket", (wide("n") * F.lit(PRIOR)).alias("w"))
    merged = own.unionByName(lent).groupBy("language", "origin", "feature", "bucket").agg(F.sum("w").alias("w"))
    group = Window.partitionBy("language", "origin", "feature")
    placed = merged.withColumn("below", F.sum("w").over(group.orderBy("bucket"))).withColumn("all", F.sum("w").over(group))
    n = 1 << FINE
    low = F.expr(f"if(bucket < {2 * n}, bucket, shiftleft(bucket % {n} + {n}, cast(bucket div {n} - 1 as int)))")
    high = F.expr(f"if(bucket < {2 * n}, bucket, shiftleft(bucket % {n} + {n + 1}, cast(bucket div {n} - 1 as int)) - 1)")
    start = F.create_map(*(F.lit(x) for k, v in FEATURES.items() for x in (k, v[3])))[F.col("feature")]
    at = lambda q, edge: F.min(F.when(F.col("below") * 100 >= F.col("all") * q, edge))
    fences = placed.groupBy("language", "origin", "feature").agg(at(F.lit(LOWER), low).alias("low"), at(start, high).alias("middle"))
    fences = fences.withColumn("fence", F.col("middle") + FENCE * (F.col("middle") - F.col("low") + 1))
    return fences.groupBy("language", "origin").agg(*(F.max(F.when(F.col("feature") == k, F.col("fence"))).alias(f"{k}_fence") for k in FEATURES))


def assess(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and the measures beyond their fences."""
    measured = common.written(measures(df, id_col, text_col, lang_col, source_col))
    fences = common.written(thresholds(sketch(measured)))
    if fences.count() <= BROADCAST_GROUPS:
        fences = F.broadcast(fences)
    rows = measured.withColumns(features()).withColumns({"language": key("lang"), "origin": key("source")}).join(fences, ["language", "origin"], "left")
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    beyond = F.array_compact(F.array(*(F.when(F.col(k) > F.col(f"{k}_fence"), F.lit(k)) for k in FEATURES)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.size(beyond) == 0)).alias("kept"), F.array_join(beyond, ",").alias("beyond"))
