"""Neighbours and running totals along a whole-number order, without one task that sees all rows.

The order is cut into buckets of equal width. Windows run inside buckets; what goes
across is one row for each bucket, whose window is as much smaller as a bucket is wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDTH = 1024


def _bucketed(rows: DataFrame, order: str, width: int) -> DataFrame:
    return rows.withColumn("_bucket", F.floor(F.col(order) / width))


def neighbour(rows: DataFrame, order: str, value: str, output: str, ahead: bool = True, width: int = WIDTH) -> DataFrame:
    """``output``: the ``value`` of the following row, or of the one before; null at the end."""
    held = _bucketed(rows, order, width)
    within, across = Window.partitionBy("_bucket").orderBy(order), Window.orderBy("_bucket")
    one = F.struct(F.col(value).alias("x"))
    edge = F.min_by if ahead else F.max_by
    step = F.lead if ahead else F.lag
    edges = held.groupBy("_bucket").agg(edge(one, F.col(order)).alias("_edge")).select("_bucket", step("_edge").over(across).alias("_beyond"))
    return held.join(edges, "_bucket").withColumn(output, F.coalesce(step(one).over(within), F.col("_beyond"))["x"]).drop("_bucket", "_beyond")


def running(rows: DataFrame, order: str, totals: dict[str, Column], width: int = WIDTH) -> DataFrame:
    """For each name the sum of its column up to and with the row."""
    held = _bucketed(rows.withColumns({f"_in_{k}": c for k, c in totals.items()}), order, width)
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = held.groupBy("_bucket").agg(*(F.sum(f"_in_{k}").alias(f"_sum_{k}") for k in totals))
    sums = sums.select("_bucket", *(F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in totals))
    out = held.join(sums, "_bucket").withColumns({k: F.col(f"_before_{k}") + F.sum(f"_in_{k}").over(within) for k in totals})
    return out.drop("_bucket", *(f"_{x}_{k}" for k in totals for x in ("in", "before")))
