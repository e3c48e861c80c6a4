"""The ten operators as queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidefeed.llm import bpe, media, mixing, pivots, quality, secret_scan, sharding, simhash, suffix, toxicity
from tidefeed.llm.storage import read

#: The rank file of op10 and of the pipeline's last stage; a parameter of the operator.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SHARDS = [f"shard-{i:03}" for i in range(64)]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(read(spark, sf_dir, "documents"))


def op5_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(read(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(media.to_media(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_quality, op2_sharding, op3_simhash, op4_suffix, op5_pivots, op6_mixing, op7_media, op8_toxicity, op9_secrets, op10_bpe)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_sharding": sharding.ORACLE.format(n=len(SHARDS), size=sharding.table_size(len(SHARDS))),
        "op6_mixing": mixing.ORACLE.format(power=mixing.TEMPER, resolution=mixing.RESOLUTION, block=mixing.BLOCK),
        "op9_secrets": secret_scan.oracle(),
    }
