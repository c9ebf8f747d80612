"""Uniform shuffle into shards by a hypergeometric communication matrix, with Spark's own functions only.

1. Each row gets its block (its input partition, folded to at most ``BLOCKS``) and a number; this narrow table is written, so that all
   later steps see the same rows after the loss of an executor.
2. Shard sizes are fixed: counts at most one apart. Long shards are cut into ``RANGES`` ranges of slots at most, so that no task gets a
   whole shard. How many rows of each block go to each range is drawn exactly as a uniform permutation would deal them: a multivariate
   hypergeometric draw a block. The driver draws it from the block counts, a table whose size is bounded by BLOCKS x SHARDS x RANGES.
3. Rows are permuted within their block and dealt out by the matrix, exchanged, and permuted again within their range.

Null text: size 1, checksum of the empty text. Null ids and repeated rows are rows like any others. An empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARDS, BLOCKS, RANGES, RANGE_ROWS = 16, 1024, 16, 1_000_000


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """How many good ones are among n drawn from good + bad without replacement; exact inversion, starting at the mode."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    at_mode = math.exp(choose(good, mode) + choose(bad, n - mode) - choose(good + bad, n))
    u, up, down, p_up, p_down = rng.random() - at_mode, mode, mode, at_mode, at_mode
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def deal(rng: random.Random, rows: int, room: list[int]) -> list[int]:
    """Multivariate hypergeometric: of the free places ``room``, how many of each kind ``rows`` rows take; room is lowered."""
    out, left = [], sum(room)
    for k, have in enumerate(room):
        n = hypergeometric(rng, have, left - have, rows)
        left, rows = left - have, rows - n
        room[k] -= n
        out.append(n)
    return out


def split_evenly(total: int, parts: int) -> list[int]:
    return [total // parts + (k < total % parts) for k in range(parts)]


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = common.written(
        df.select(
            F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.pmod(F.spark_partition_id(), F.lit(BLOCKS)).alias("block"), F.monotonically_increasing_id().alias("row"),
        )
    )
    counts = sorted((r["block"], r["n"]) for r in rows.groupBy("block").agg(F.count("*").alias("n")).collect())  # at most BLOCKS rows
    total = sum(n for _, n in counts)
    ranges = max(1, min(RANGES, -(-total // (shards * RANGE_ROWS))))
    sizes = [split_evenly(n, ranges) for n in split_evenly(total, shards)]
    rng, room, matrix = random.Random(seed), [sum(s) for s in sizes], []
    inner = [list(s) for s in sizes]
    for block, n in counts:
        to_shards = deal(rng, n, room)
        matrix.append({"block": block, "shard_ends": prefix(to_shards), "range_ends": [prefix(deal(rng, k, inner[s])) for s, k in enumerate(to_shards)]})
    starts = [[0, *prefix(s)[:-1]] for s in sizes]
    dealt = df.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(matrix)), "array<struct<block: int, shard_ends: array<bigint>, range_ends: array<array<bigint>>>>")).alias("m")).select("m.*")
    local = rows.withColumn("r", F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("row", F.lit(seed)), "row")))
    # the first shard, and there the first range, whose end is not before the row's place
    before = lambda ends, at: F.size(F.filter(ends, lambda e: e < at))
    sent = (
        local.join(F.broadcast(dealt), "block")
        .withColumn("shard", before(F.col("shard_ends"), F.col("r")))
        .withColumn("in_shard", F.col("r") - F.when(F.col("shard") > 0, F.expr("shard_ends[shard - 1]")).otherwise(0))
        .withColumn("part", before(F.expr("range_ends[shard]"), F.col("in_shard")))
        .select("doc_id", "size", "text_crc32", "row", "shard", "part")
    )
    again = Window.partitionBy("shard", "part").orderBy(F.xxhash64("row", F.lit(seed + 1)), "row")
    first = F.from_json(F.lit(json.dumps(starts)), "array<array<bigint>>")
    slot = F.element_at(F.element_at(first, F.col("shard") + 1), F.col("part") + 1) + F.row_number().over(again) - 1
    return sent.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def prefix(values: list[int]) -> list[int]:
    out, total = [], 0
    for v in values:
        total += v
        out.append(total)
    return out
