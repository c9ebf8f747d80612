"""Search for parts of words through a table of runs of three letters: only texts that have all runs of the words are read."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import fold
from ..sources.sheets import find_package, kept

Q = 3
#: Folders of the runs, and of the texts.
BUCKETS, PARTS = 64, 64
#: Texts whose ids are listed together, run by run.
TEXTS = 1000
#: Candidates that may be broadcast; more of them are joined by a shuffle.
BROADCAST_ROWS = 100_000


class TextIndex:
    """Folded texts of some columns by id, in ``parts`` folders, and which texts have which runs of letters, in ``BUCKETS`` folders.

    A search reads the folders of its words' runs, keeps the ids that have all of them, reads the folders of those ids' texts and looks for
    the words in them: runs only nominate, so rows are the same as a scan's. Words of fewer letters than a run take part in that last step
    only; a search without any longer word looks through all texts. A row is a run and those of up to ``TEXTS`` ids that have it, so a run that
    nearly all texts have is many rows, split over tasks as they are written.
    """

    def __init__(self, df: DataFrame, id_col: str, columns: list[str], parts: int = PARTS) -> None:
        find_package(df.sparkSession)
        texts = df.select(F.col(id_col).alias("id"), fold(F.concat_ws(" ", *columns)).alias("text")).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
        self.texts = kept(texts.hint("rebalance", F.col("part")), "part")

        id_type = dict(self.texts.dtypes)["id"]

        def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, TEXTS):
                    ids, texts_ = (c.slice(at, TEXTS) for c in b.columns)
                    have: dict[str, list[int]] = {}
                    for k, text in enumerate(texts_.to_pylist()):
                        for g in {text[j : j + Q] for j in range(len(text) - Q + 1)}:
                            have.setdefault(g, []).append(k)
                    ends = list(accumulate(map(len, have.values()), initial=0))
                    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids.take(pa.array(list(chain.from_iterable(have.values())), pa.int32())))
                    yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.string()), listed], names=["gram", "ids"])

        told = self.texts.select("id", "text").mapInArrow(runs, f"gram string, ids array<{id_type}>").withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int"))
        self.runs = kept(told.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "gram"), "bucket")
        self.parts = parts

    def candidates(self, words: list[str]) -> DataFrame | None:
        """id, part of the texts that have all runs of the (folded) words; None if no word has any."""
        grams = sorted({w[k : k + Q] for w in words for k in range(len(w) - Q + 1)})
        if not grams:
            return None
        spark = self.texts.sparkSession
        buckets = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "gram string").select(F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int")).distinct().collect()]
        found = self.runs.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(grams)).select("gram", F.explode("ids").alias("id"))
        have = found.groupBy("id").agg(F.count_distinct("gram").alias("n")).filter(F.col("n") == len(grams))
        return have.select("id", F.pmod(F.xxhash64("id"), F.lit(self.parts)).cast("int").alias("part"))

    def search(self, words: str) -> DataFrame:
        """id of the texts that contain every word, accents and case apart; repeated ids come as often as they are there."""
        spark = self.texts.sparkSession
        folded = spark.range(1).select(*(fold(F.lit(w)).alias(f"w{k}") for k, w in enumerate(words.split()))).first()
        folded = list(folded or [])
        texts, few = self.texts, self.candidates(folded)
        if few is not None:
            few = kept(few)
            parts = [r["part"] for r in few.select("part").distinct().collect()]  # PARTS numbers at most
            texts = texts.filter(F.col("part").isin(parts)) if parts else texts.limit(0)
            texts = texts.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, ["id", "part"], "left_semi")
        for w in folded:
            texts = texts.filter(F.contains("text", F.lit(w)))
        return texts.select("id")
