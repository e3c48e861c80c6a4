"""Raw documents to token ids: five stages, each over all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidefeed.llm import bpe, mixing, secret_scan, simhash, toxicity
from tidefeed.llm.queries import RANKS
from tidefeed.llm.storage import cut, read

#: Source weights are the sources' own shares to this power.
POWER = 0.9
#: What a worker of the last stage keeps; less than op10 does, as its process also holds the first stage's models.
STEPS, PIECES = 120_000, 150_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the grammar scores 0.5 or more; it learns from the labels of its input."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    if model is None:  # nothing says what is toxic
        return docs
    return toxicity.with_score(docs, model, "_toxicity").where("_toxicity < 0.5").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of texts that share 0.8 or more of their shingles of five words."""
    return simhash.keep_first(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the schedule; those of a source that runs out before the others come again."""
    return mixing.in_order(mixing.mix(docs, power=POWER)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, source, n_tokens, ids, decoded_sha256)``: the ids, and the hash of the text that they decode to."""
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "source"), steps=STEPS, pieces=PIECES, decoded="decoded_sha256")
    return coded.selectExpr("doc_id", "source", "CAST(size(ids) AS BIGINT) AS n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("byte_level_bpe", encode),
]

#: The grammar's weights are learned, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next.

    Null and empty texts pass all stages but the second, which keeps one of them; null ids are kept;
    columns beyond those of ``documents`` go along to the last stage; no rows, no rows.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
