"""Tables in, scratch tables out: the only place of this subpackage that knows about paths."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidefeed.sources.scratch import fresh_path
from tidefeed.sources.shipping import ship

__all__ = ["apart", "cut", "cut_at", "read", "ship", "sliced"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: ends its lineage and outlives any executor."""
    return cut_at(df, label)[0]


def cut_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As cut(), with the path, which ``remove`` takes once no later plan reads the table."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def apart(names: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, lengthened until none is among ``names``, in which case doesn't count."""
    taken, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        taken.add(w.lower())
        out.append(w)
    return out


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to what is held as Python objects at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
