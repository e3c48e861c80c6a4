"""Segments of a journal: chains, what is still joined, restarts, what a cache may keep."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.operators.ordered import running
from tidefeed.sources.scratch import fresh_path

# Status codes.
STATUSES = {1: "Attached", 2: "OnlineSavedDetached", 3: "SavedDetachedNotFreed", 4: "SavedDetachedFreed", 5: "Partial", 6: "Empty"}
ATTACHED, JOINED = 1, (1, 2, 3)


def status_name(code: Column) -> Column:
    """Name of a status code; null of an unknown one."""
    out = F.lit(None).cast("string")
    for k, v in STATUSES.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def last_joined(receivers: DataFrame) -> DataFrame:
    """The attached segment and those before it, in order of attachment, back to the last one that isn't online.

    Segments without a time of attachment are left out. What counts is the newest break,
    one aggregate, not a window over all segments.
    """
    known = receivers.where("attached IS NOT NULL")
    broken = known.agg(F.max(F.when(~F.col("status").isin(*JOINED), F.col("attached"))).alias("_broken"))
    return known.join(F.broadcast(broken)).where("_broken IS NULL OR attached > _broken").drop("_broken")


def chain_numbers(receivers: DataFrame) -> DataFrame:
    """``(rcv, chain)``: joined segments that next_rcv links have one chain, named by its first segment.

    A link to a segment that isn't joined ends a chain; of two segments with one next the
    smaller links. Pointers to the segment before are doubled until none is left, so
    the rounds grow with the logarithm of the longest chain, each one equi-join.
    Links in a ring have no first segment: they are left out after the last round.
    """
    spark = receivers.sparkSession
    usable = receivers.where(F.col("status").isin(*JOINED)).select("rcv", "next_rcv")
    before = usable.groupBy(F.col("next_rcv").alias("rcv")).agg(F.min("rcv").alias("back"))
    # Where a pointer ends, root is the first segment; until then back is 1, 2, 4, ... segments away.
    now = usable.select("rcv").join(before, "rcv", "left").select("rcv", F.col("rcv").alias("root"), "back")
    now = now.withColumn("root", F.coalesce("back", "root"))
    rounds = max(1, usable.count()).bit_length() + 1
    for _ in range(rounds):
        there = now.select(F.col("rcv").alias("back"), F.col("root").alias("far_root"), F.col("back").alias("far_back"))
        path = fresh_path(spark, "chains")
        now.join(there, "back", "left").select("rcv", F.coalesce("far_root", "root").alias("root"), F.col("far_back").alias("back")).write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        if now.where("back IS NOT NULL").isEmpty():
            break
    return now.where("back IS NULL").select("rcv", F.col("root").alias("chain"))


def restarts(receivers: DataFrame) -> DataFrame:
    """``(rcv, restart)``: whether a segment's numbers begin below the end of the one that names it as its next."""
    ends = receivers.where("next_rcv IS NOT NULL").groupBy(F.col("next_rcv").alias("rcv")).agg(F.max("last_rseq").alias("_end"))
    return receivers.join(ends, "rcv", "left").select("rcv", F.coalesce(F.col("first_rseq") < F.col("_end"), F.lit(False)).alias("restart"))


def keep_only(cached: DataFrame, listed: DataFrame) -> DataFrame:
    """Cached segments that the newest list still has."""
    return cached.join(listed.select("rcv").distinct(), "rcv", "left_semi")


def cacheable(receivers: DataFrame) -> DataFrame:
    """Segments whose details won't change: detached ones with a known status and time."""
    return receivers.where(F.col("status").isNotNull() & F.col("attached").isNotNull() & (F.col("status") != ATTACHED))


def behind(receivers: DataFrame, positions: DataFrame) -> DataFrame:
    """``positions(rcv, rseq, ...)`` with ``behind``: the entries after each, counted by segment, so restarts don't matter; null where the segment is unknown."""
    counted = running(receivers.select("rcv", "last_rseq", "entries"), "rcv", {"upto": F.col("entries")})
    total = receivers.agg(F.sum("entries").alias("total"))
    found = positions.join(counted, "rcv", "left").join(F.broadcast(total))
    return found.withColumn("behind", F.col("total") - F.col("upto") + F.col("last_rseq") - F.col("rseq")).select(*positions.columns, "behind")


@dataclass(frozen=True)
class Details:
    """What is known of a segment."""

    name: str
    status: int | None
    attached: float | None
    entries: int = 0


@dataclass
class ReceiverCache:
    """Details of segments by name, on the driver: none of an attached segment, or of one whose status or time is unknown."""

    held: dict[str, Details] = field(default_factory=dict)

    def put(self, details: Details) -> None:
        if details.status not in (None, ATTACHED) and details.attached is not None:
            self.held[details.name] = details

    def get(self, name: str, status: int | None, attached: float | None) -> Details | None:
        """The details under their newest status, if they are of the same attachment."""
        found = self.held.get(name)
        if found is None or found.attached != attached or status in (None, ATTACHED):
            return None
        if found.status != status:
            self.held[name] = found = replace(found, status=status)
        return found

    def keep_only(self, names: Iterable[str]) -> None:
        wanted = set(names)
        self.held = {k: v for k, v in self.held.items() if k in wanted}
