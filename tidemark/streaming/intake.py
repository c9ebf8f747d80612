"""Folder intake as a stream: each micro-batch appends the files whose content is new, once.

The file source's checkpoint remembers files, a history of contents lies beside the rows, one row a file; rows and history are published
together (``versions.Store``), and a batch that is run again finds its number published and changes nothing. Equal rows inside a file stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.versions import Part, Store

ROWS, HISTORY = "rows", "history"


def content(place: Column, columns: list[str]) -> Column:
    """A fingerprint of a group's rows and their order. A row is hashed with its place in the file, and the hashes are added up where they
    are read: a file may be of any size, and the splits in which it is read don't matter."""
    h1, h2 = F.xxhash64(place, *columns), F.xxhash64(F.lit(1), place, *columns)
    sums = [F.count("*"), F.sum(h1.cast("decimal(38,0)")), F.bit_xor(h1), F.sum(h2.cast("decimal(38,0)")), F.bit_xor(h2)]
    return F.sha2(F.concat_ws(":", *(s.cast("string") for s in sums)), 256)


def contents(rows: DataFrame, place: Column, columns: list[str]) -> DataFrame:
    """file, content, n_rows of each file."""
    return rows.groupBy("file").agg(content(place, columns).alias("content"), F.count("*").alias("n_rows"))


def line_places(lines: DataFrame) -> DataFrame:
    """Lines (value, file, start: where their split begins) with ``place``, their number in the file, whatever its splits: a split's lines
    are numbered as they are read, and splits by the counts of those before them. Counts, a row a split, go to the lines, which stay where
    they are read."""
    # a task numbers its rows in order
    read = lines.withColumn("__id", F.monotonically_increasing_id())
    splits = read.groupBy("file", "start").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = splits.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return read.join(F.broadcast(before), ["file", "start"]).withColumn("place", F.col("__id") - F.col("__first") + F.col("__before")).drop("__id", "__first", "__before")


def lines_of(df: DataFrame) -> DataFrame:
    """value, file, start of a text source."""
    return df.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def intake(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, files_per_batch: int = 8, name: str = "intake") -> StreamingQuery:
    """Reads all Parquet files that arrived in ``folder``, in micro-batches, into the table ``rows`` of the store at ``target``; files whose
    content came before are left out."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format("parquet").load(folder)
    stream = reader.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("__row"))

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        store = Store(session, target)
        now = store.latest()
        if int(now.batches.get(name, -1)) >= batch_id:
            return
        columns = [c for c in batch.columns if c not in ("file", "__row")]
        found = contents(batch, F.col("__row"), columns).select("content", "file").collect()  # files_per_batch rows at most
        prefixes = sorted({r["content"][:2] for r in found})
        have = store.read(HISTORY, now, prefixes)
        known = {r["content"] for r in have.filter(F.col("content").isin([r["content"] for r in found])).collect()} if have is not None else set()
        fresh: dict[str, str] = {}
        for r in sorted(found, key=lambda r: r["file"]):
            if r["content"] not in known:
                fresh.setdefault(r["content"], r["file"])
        rows = batch.filter(F.col("file").isin(list(fresh.values()))).drop("file", "__row")
        told = session.createDataFrame([(c, f, c[:2]) for c, f in fresh.items()], "content string, file string, prefix string")
        store.publish([Part(ROWS, rows, append=True), Part(HISTORY, told, "prefix", tuple(sorted({c[:2] for c in fresh})), append=True)], now, batch=(name, str(batch_id)))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
