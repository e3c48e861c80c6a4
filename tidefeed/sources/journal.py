"""The journal and its metadata as DataFrames.

``journal`` derives an ordered journal from the table ``events``: monotone sequence
``seq``, segment ``rcv`` with restarting ``rseq``, table ``file_no``, commit ``cycle``
and ``code`` (journal code and entry type).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.operators.ordered import neighbour
from tidefeed.sources.scratch import kept

SEGMENT, CYCLE = 1000, 50
ATTACHED, DETACHED, PARTIAL = 1, 2, 5

#: The same journal for DuckDB.
JOURNAL_SQL = """J AS (
  SELECT event_id + 1 AS seq, event_id // 1000 AS rcv, event_id % 1000 + 1 AS rseq, ts, user_id, user_id % 10 AS file_no, event_id // 50 AS cycle, value,
    CASE event_type WHEN 'signup' THEN 'R.PT' WHEN 'click' THEN 'R.UB' WHEN 'view' THEN 'R.UP' WHEN 'error' THEN 'R.DL'
      ELSE CASE event_id % 7 WHEN 0 THEN 'C.SC' WHEN 1 THEN 'C.CM' WHEN 2 THEN 'D.CG' WHEN 3 THEN 'F.OP' WHEN 4 THEN 'R.BR' WHEN 5 THEN 'R.UR' ELSE 'R.DR' END END AS code
  FROM events)"""
RECEIVERS_SQL = """R AS (
  SELECT rcv, min(seq) AS first_seq, max(seq) AS last_seq, min(rseq) AS first_rseq, max(rseq) AS last_rseq, count(*) AS entries, min(ts) AS attached,
    lead(rcv) OVER (ORDER BY rcv) AS next_rcv,
    CASE WHEN lead(rcv) OVER (ORDER BY rcv) IS NULL THEN 1 WHEN rcv % 4 = 3 THEN 5 ELSE 2 END AS status
  FROM J GROUP BY rcv)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_of(event_type: Column, event_id: Column) -> Column:
    rest = {0: "C.SC", 1: "C.CM", 2: "D.CG", 3: "F.OP", 4: "R.BR", 5: "R.UR"}
    other = F.lit("R.DR")
    for k, v in rest.items():
        other = F.when(event_id % 7 == k, v).otherwise(other)
    for k, v in {"signup": "R.PT", "click": "R.UB", "view": "R.UP", "error": "R.DL"}.items():
        other = F.when(event_type == k, v).otherwise(other)
    return other


def as_journal(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    return events.select(
        (e + 1).alias("seq"), F.expr(f"event_id div {SEGMENT}").alias("rcv"), (e % SEGMENT + 1).alias("rseq"), "ts", "user_id",
        (F.col("user_id") % 10).alias("file_no"), F.expr(f"event_id div {CYCLE}").alias("cycle"), "value", code_of(F.col("event_type"), e).alias("code"),
    )


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_journal(table(spark, sf_dir, "events"))


def receivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each segment: metadata, as small as the number of segments. The journal is read once for it, whatever is done with it."""
    stats = journal(spark, sf_dir).groupBy("rcv").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.min("rseq").alias("first_rseq"), F.max("rseq").alias("last_rseq"), F.count("*").alias("entries"), F.min("ts").alias("attached")
    )
    stats = kept(stats, "segments")
    status = F.when(F.col("next_rcv").isNull(), ATTACHED).when(F.col("rcv") % 4 == 3, PARTIAL).otherwise(DETACHED)
    return neighbour(stats, "rcv", "rcv", "next_rcv").withColumn("status", status)
