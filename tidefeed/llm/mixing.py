"""Mixing sources to target weights by Pfair scheduling.

Time runs in slots, each of one block of documents. Block j of a source of weight w
is released at slot floor(j / w) and is due at slot ceil((j + 1) / w); of the released
blocks the one that is due first goes next. With weights that add up to one, every
block meets its window, so after each slot a source has had its share of the weights
themselves to less than a block: weights are whole numbers over their sum, and nothing
is rounded on the way.

When each source has had whole blocks only, at the sum of the weights over their common
divisor, the schedule begins anew. So one task works out one such period, or all slots
if these are fewer; its size depends on the weights, not on the data. Default weights
have a sum of about RESOLUTION. Weights with more digits are scheduled as exactly, at
one step of that task for each slot.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidefeed.llm.storage import apart, ship

BLOCK, TEMPER, RESOLUTION = 16, 0.7, 1_000_000
#: Documents of a source that a task ranks, about.
RANKED = 10_000


def tempered(counts: dict[str, int], power: float = TEMPER) -> dict[str, int]:
    """Target weights between the sources' own shares (power 1) and equal ones (power 0), in millionths, 1 at least."""
    total = sum(n**power for n in counts.values())
    return {s: max(1, math.floor(n**power / total * RESOLUTION)) for s, n in counts.items()}


def whole(weights: dict[str, float | Fraction]) -> dict[str, int]:
    """The same proportions in whole numbers, exactly; a float counts as its shortest decimal."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights are positive")
    scale = math.lcm(*(w.denominator for w in exact.values())) if exact else 1
    return {s: int(w * scale) for s, w in exact.items()}


def _due(j: int, w: int, total: int) -> int:
    return -(-(j + 1) * total // w)


def earliest_first(weights: list[int], slots: int) -> Iterator[tuple[int, int]]:
    """(source, block) of each slot: of the released blocks the one that is due first; ties go by place."""
    total = sum(weights)
    waiting = [(0, i, 0) for i in range(len(weights))]  # release, source, block
    ready: list[tuple[int, int, int]] = []
    for t in range(slots):
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (_due(j, weights[i], total), i, j))
        _, i, j = heapq.heappop(ready)
        yield i, j
        heapq.heappush(waiting, ((j + 1) * total // weights[i], i, j + 1))


def horizon(counts: list[int], weights: list[int], block: int) -> int:
    """The slot by which the last block of every source is due."""
    total = sum(weights)
    return max((_due(-(-n // block) - 1, w, total) for n, w in zip(counts, weights, strict=True)), default=0)


def schedule(spark: SparkSession, names: list[str], weights: list[int], slots: int) -> DataFrame:
    """``(source, block, slot)`` of the first ``slots`` slots."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n in (n for b in batches for n in b.column(0).to_pylist()):
            at, going = 0, earliest_first(weights, n)
            while part := list(islice(going, 100_000)):
                yield pa.record_batch([pa.array([names[i] for i, _ in part], pa.string()), pa.array([j for _, j in part], pa.int64()), pa.array(range(at, at + len(part)), pa.int64())], names=["source", "block", "slot"])
                at += len(part)

    return spark.range(slots, slots + 1, 1, 1).mapInArrow(run, "source string, block long, slot long")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, power: float = TEMPER) -> DataFrame:
    """``docs`` in mixed order, with ``epoch``, ``block``, ``slot`` and ``position`` (columns of these names are replaced).

    Goes on until each source has been through once; a source that runs out earlier
    starts anew (epoch 1, 2, ...), so no row is lost and the weights hold throughout.
    Within a source, rows go by the MD5 of their doc_id, then by doc_id and a hash of
    their other columns, so the order is the same at every run; rows equal in all of
    them change places at will. Without ``weights`` they are tempered(); else every
    source needs one above 0. A null source is the source of the empty name; null ids
    and equal ones are allowed; no rows, no rows. Other columns stay, whatever their names.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("epoch", "block", "slot", "position")]
    own, order, tie, deal, rank, start, count, most, turn = apart([*docs.columns, "epoch", "block", "slot", "position"], *(f"_{x}" for x in ("source", "order", "tie", "deal", "rank", "start", "count", "most", "turn")))
    hidden = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if f.name in keep and "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.coalesce(F.col("source"), F.lit("")).alias(own), hidden.alias(order), F.xxhash64(*hashed).alias(tie))
    # One row for each source.
    counts = dict(sorted((r[0], r[1]) for r in rows.groupBy(own).count().collect()))
    wanted = whole(weights) if weights else tempered(counts, power)
    names, whole_weights = list(counts), [wanted[s] for s in counts]
    slots = horizon(list(counts.values()), whole_weights, block)
    # Hexadecimal digits by which a source's documents are dealt over tasks to be ranked.
    digits = max(1, math.ceil(math.log(max(counts.values(), default=1) / RANKED + 1, 16)))
    rows = rows.withColumn(deal, F.substring(order, 1, digits))
    dealt = rows.groupBy(own, deal).agg(F.count("*").alias(count))
    before = Window.partitionBy(own).orderBy(deal).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.select(own, deal, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(start))
    place = F.row_number().over(Window.partitionBy(own, deal).orderBy(order, "doc_id", tie))
    ranked = rows.withColumn(rank, place).join(starts, [own, deal]).withColumn(rank, F.col(rank) + F.col(start) - 1)
    total, divisor = sum(whole_weights), max(1, math.gcd(*whole_weights))
    period = total // divisor
    # No source has more blocks than its share of all slots, rounded up.
    sizes = [(s, n, -(-w * slots // total) * block, w // divisor) for (s, n), w in zip(counts.items(), whole_weights, strict=True)]
    of_source = spark.createDataFrame(sizes, T.StructType().add(own, "string").add(count, "long").add(most, "long").add(turn, "long"))
    turns = ranked.join(F.broadcast(of_source), own)
    turns = turns.withColumn("epoch", F.explode(F.expr(f"CASE WHEN {rank} < {most} THEN sequence(0L, ({most} - 1 - {rank}) div {count}) ELSE array(0L) END")))
    turns = turns.withColumn(rank, F.col(rank) + F.col("epoch") * F.col(count)).withColumn("block", F.expr(f"{rank} div {block}")).withColumn(start, F.expr(f"block % {turn}"))
    of_slot = schedule(spark, names, whole_weights, min(slots, period)).select(F.col("source").alias(own), F.col("block").alias(start), F.col("slot").alias(order))
    out = turns.drop(order).join(of_slot, [own, start]).withColumn("slot", F.expr(f"block div {turn} * {period} + {order}")).where(F.col("slot") < slots)
    return out.select(*(F.col(f"`{c}`") for c in keep), "epoch", "block", "slot", (F.col("slot") * block + F.expr(f"{rank} % {block}")).alias("position"))


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of mix() so that files, and rows within files, follow the schedule. Nothing is dropped; no rows, no rows."""
    return mixed.repartitionByRange("position").sortWithinPartitions("position")


ORACLE = """
WITH RECURSIVE sizes AS (
  SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1
), weighted AS (
  SELECT source, n, greatest(1, CAST(floor(pow(n, {power}) / sum(pow(n, {power})) OVER () * {resolution}) AS BIGINT)) AS w, row_number() OVER (ORDER BY source) AS id FROM sizes
), lists AS (
  SELECT list(w ORDER BY id) AS ws, CAST(sum(w) AS BIGINT) AS total, max((((n + {block} - 1) // {block}) * (SELECT sum(w) FROM weighted)::BIGINT + w - 1) // w) AS slots FROM weighted
), edf(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(ws, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM lists
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: d + (i = p)::BIGINT), p
  FROM (
    SELECT t, done, list_min(list_transform(range(1, len(ws) + 1), lambda i:
             CASE WHEN done[i] * total // ws[i] <= t + 1 THEN ((done[i] + 1) * total + ws[i] - 1) // ws[i] * 100000 + i END)) % 100000 AS p
    FROM edf, lists WHERE t + 1 < slots
  )
), slots AS (
  SELECT pick AS id, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS block FROM edf WHERE t >= 0
), ranked AS (
  SELECT doc_id, source AS own, coalesce(source, '') AS source,
         row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS r
  FROM documents
), places AS (
  SELECT slots.id, n, block, slot, unnest(range(0, {block})) AS k, source FROM slots JOIN weighted ON weighted.id = slots.id
)
SELECT doc_id, own AS source, (block * {block} + k) // n AS epoch, block, slot, slot * {block} + k AS position
FROM places JOIN ranked ON ranked.source = places.source AND ranked.r = (block * {block} + k) % n
"""
