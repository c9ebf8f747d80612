"""From documents to packed sequences: toxic documents go, one document of each group of near-duplicates stays, repeated passages are cut,
personal data is replaced, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents (n_chars follows the text).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, jaccard, packing, passages, pii, toxicity


def measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, common.documents(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words go, however short the words; so do strings of op9's length, which may have fewer."""
    return measured(passages.without_passages(docs, cuts=(passages.BYTES, passages.WORDS)))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured(pii.without_pii(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("repeated passages", cut_passages), ("personal data", replace_pii), ("packing", pack)]

#: Toxicity scores, byte-level passages and tokens are beyond SQL: tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces, as a table: each stage's own tables and the one that it has read are deleted once its output is written."""
    docs = common.documents(spark, sf_dir)
    with common.scratch(spark) as last:
        for _, stage in STAGES[:-1]:
            with common.scratch(spark) as done:
                done += last
                last.clear()
                docs = common.written(stage(spark, docs, sf_dir), keep=True)
        return common.written(STAGES[-1][1](spark, docs, sf_dir), keep=True)
