"""Which labelled rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most about so many labelled rows are learnt from: those of the smallest hash of their id.
TRAINING_ROWS = 30_000


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null of a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def training_labels(labels: DataFrame, label: str, usable: Column, bound: int = TRAINING_ROWS) -> DataFrame:
    """``(doc_id, label)``, one row for an id (its largest label), null ids and labels left out.

    Of more than ``bound`` rows, each is taken with probability bound / rows by the hash of its id; so
    the table is small enough to broadcast.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("double")).alias("label"))
    n = rows.count()
    if n <= bound:
        return rows
    cell = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30))
    return rows.where(cell < int(bound / n * (1 << 30)))
