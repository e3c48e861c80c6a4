"""The change feed as streams: before-images and transactions as keyed state, offsets in the checkpoint."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidefeed.sources.reader import register
from tidefeed.sources.scratch import fresh_path
from tidefeed.sources.segments import write_segments

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PairImages(StatefulProcessor):
    """For a table, or a row of one, the before-image that waits for its after-image. Absent values have a flag, as pandas has no null beside NaN."""

    def __init__(self, keys: tuple[str, ...] = ("file_no",)):
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "value double, absent boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        entries = pd.concat(list(rows)).sort_values("seq")
        held = tuple(self.held.get()) if self.held.exists() else None
        out = []
        for seq, code, value, absent in zip(entries["seq"], entries["code"], entries["value"].astype(float), entries["absent"], strict=True):
            if code == "R.UB":
                held = (0.0 if absent else float(value), bool(absent))
            else:
                before, missing = held or (0.0, True)
                out.append((seq, *key, before, missing, 0.0 if absent else value, absent))
                held = None
        if held is None:
            self.held.clear()
        else:
            self.held.update(held)
        yield pd.DataFrame(out, columns=["seq", *self.keys, "before", "no_before", "after", "no_after"])

    def close(self) -> None:
        pass


class OpenTransactions(StatefulProcessor):
    """For a commit cycle, whether a start has been seen that no end has followed. With ``ttl_ms``, one that is never ended is forgotten."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "mark boolean", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        entries = pd.concat(list(rows)).sort_values("seq")
        now = bool(self.open.exists() and self.open.get()[0])
        out = []
        for seq, code in zip(entries["seq"], entries["code"], strict=True):
            if code in ("C.SC", "C.CM"):
                now = code == "C.SC"
            else:
                out.append((seq, str(key[0]) if now else None))
        if now:
            self.open.update((now,))
        else:
            self.open.clear()
        yield pd.DataFrame(out, columns=["seq", "tx"])

    def close(self) -> None:
        pass


def run_to_end(stream: DataFrame, label: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Run a stream over all that is there now, into Parquet, and read the result.

    With the ``checkpoint`` and ``out`` of an earlier run it goes on where that one ended, each entry once.
    """
    spark = stream.sparkSession
    out = out or fresh_path(spark, f"{label}-out")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint or fresh_path(spark, f"{label}-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def as_stream(entries: DataFrame, most: int = 1_000_000) -> DataFrame:
    """The journal written as segment files, and streamed from them in pages of ``most`` entries."""
    spark = entries.sparkSession
    path = fresh_path(spark, "journal")
    stored = entries.withColumnRenamed("seq", "number")
    write_segments(stored, path)
    register(spark)
    schema = T.StructType().add("segment", "string").add("seq", "long")
    for f in stored.schema:
        schema = schema if f.name in ("rcv", "rseq") else schema.add(f.name, f.dataType)
    stream = spark.readStream.format("journal").schema(schema).option("path", path).option("maxEntries", most).load()
    rcv = F.regexp_extract("segment", "([0-9]+)", 1).cast("long")
    return stream.select(F.col("number").alias("seq"), rcv.alias("rcv"), F.col("seq").alias("rseq"), *(c for c in schema.names if c not in ("segment", "seq", "number")))


def pair_stream(entries: DataFrame, keys: tuple[str, ...] = ("file_no",)) -> DataFrame:
    """``(seq, *keys, before, after)`` of after-images, as with_before() pairs them.

    A task holds what a batch has of a key. ``keys`` with the row's number spread a table
    over tasks, and pair interleaved updates of it.
    """
    entries.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    images = entries.where("code IN ('R.UB', 'R.UP')").select(*keys, "seq", "code", "value", F.col("value").isNull().alias("absent"))
    schema = T.StructType().add("seq", "long")
    for k in keys:
        schema = schema.add(k, entries.schema[k].dataType)
    for x in ("before", "after"):
        schema = schema.add(x, "double").add(f"no_{x}", "boolean")
    out = images.groupBy(*keys).transformWithStateInPandas(PairImages(keys), schema, "Append", "None")
    kept = lambda x: F.when(~F.col(f"no_{x}"), F.coalesce(F.col(x), F.lit(float("nan")))).alias(x)
    return out.select("seq", *keys, kept("before"), kept("after"))


def transaction_stream(entries: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    entries.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    wanted = entries.where("code IN ('C.SC', 'C.CM', 'R.PT', 'R.UP', 'R.DL')").select("cycle", "seq", "code")
    return wanted.groupBy("cycle").transformWithStateInPandas(OpenTransactions(ttl_ms), "seq long, tx string", "Append", "ProcessingTime" if ttl_ms else "None")


def windowed(entries: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Entries by kind in tumbling windows of entry time; what comes later than ``late`` is left out."""
    return entries.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width), "code").agg(F.count("*").alias("n"))
