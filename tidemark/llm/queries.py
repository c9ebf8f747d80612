"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, centroids, chat, jaccard, media, oracles, packing, passages, pii, quality, sharding, toxicity, turns, urls
from .common import documents


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(documents(spark, sf_dir, "conversations"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digests(documents(spark, sf_dir))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(media.read(media.store(documents(spark, sf_dir))))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digests(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digests(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(documents(spark, sf_dir, "pages"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(documents(spark, sf_dir, "embeddings"))


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.digests(documents(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_chat": op1_chat, "op2_jaccard": op2_jaccard, "op3_media": op3_media, "op4_bpe": op4_bpe, "op5_toxicity": op5_toxicity, "op6_sharding": op6_sharding, "op7_packing": op7_packing, "op8_quality": op8_quality, "op9_passages": op9_passages, "op10_pii": op10_pii, "op11_urls": op11_urls, "op12_centroids": op12_centroids, "op13_turns": op13_turns}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat": chat.ORACLE, "op2_jaccard": oracles.JACCARD, "op8_quality": oracles.QUALITY, "op11_urls": urls.ORACLE, "op12_centroids": centroids.oracle(), "op13_turns": turns.oracle()}
