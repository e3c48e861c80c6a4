"""Planning which stretch of the journal a batch reads, over segments that may restart their numbers."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.operators.ordered import neighbour, running
from tidefeed.sources.scratch import kept


@dataclass(frozen=True)
class Segment:
    name: str
    first: int
    last: int


@dataclass(frozen=True)
class Position:
    """The last entry seen; not processed: the entry itself is still to do."""

    offset: int
    segment: str
    processed: bool = True


@dataclass(frozen=True)
class Range:
    start: Position
    end: Position

    @property
    def empty(self) -> bool:
        return self.start.processed and (self.start.offset, self.start.segment) == (self.end.offset, self.end.segment)


def next_range(segments: list[Segment], start: Position, most: int) -> Range | None:
    """The next stretch of about ``most`` entries; None if the start's segment isn't in the list.

    A stretch never straddles a restart of the numbers: it ends before it, unless all
    up to it is processed; then it begins behind it.
    """
    names = [s.name for s in segments]
    if start.segment not in names:
        return None
    rest = segments[names.index(start.segment) :]
    left, at, before = most, start.offset, None
    for s in rest:
        if before is not None:
            at = s.first
            if s.first < before.last:
                if not (start.processed and (start.offset, start.segment) == (before.last, before.name)):
                    return Range(start, Position(before.last, before.name))
                # entries count from the first one, which is not done yet
                start, left = Position(s.first, s.name, processed=False), most - 1
        if left <= s.last - at:
            return Range(start, Position(at + left, s.name))
        left -= s.last - at + 1
        before = s
    return Range(start, Position(before.last, before.name))


def in_segment(start: Position, end: Position, most: int) -> Range:
    """Both in one segment: at most ``most`` entries on."""
    if start.segment != end.segment:
        raise ValueError("start and end are in different segments")
    return Range(start, replace(end, offset=min(end.offset, start.offset + most)))


def refreshed(segments: list[Segment], end: Segment) -> list[Segment]:
    """The list with the newest state of its last segment: replaced if known, else appended."""
    names = [s.name for s in segments]
    return [end if s.name == end.name else s for s in segments] if end.name in names else [*segments, end]


def indexed(receivers: DataFrame, first: str = "first_seq", last: str = "last_seq") -> DataFrame:
    """``(seg, first, last, run, before)``: segments in their order, ``run`` counting restarts of the numbers, ``before`` the entries ahead in the run.

    A table in the shared folder: plans use it several times.
    """
    r = receivers.select(F.col("rcv").alias("seg"), F.col(first).alias("first"), F.col(last).alias("last"))
    r = neighbour(r, "seg", "last", "_end", ahead=False)
    r = running(r, "seg", {"run": F.coalesce(F.col("first") < F.col("_end"), F.lit(False)).cast("long"), "upto": F.col("last") - F.col("first") + 1})
    ahead = r.groupBy("run").agg(F.min(F.col("upto") - (F.col("last") - F.col("first") + 1)).alias("_ahead"), F.max("upto").alias("_all"))
    r = r.join(ahead, "run")
    size = F.col("last") - F.col("first") + 1
    found = r.select("seg", "first", "last", "run", (F.col("upto") - size - F.col("_ahead")).alias("before"), (F.col("_all") - F.col("_ahead")).alias("total"))
    return kept(found, "segment-index")


def find_ranges(starts: DataFrame, receivers: DataFrame, most: int, first: str = "first_seq", last: str = "last_seq") -> DataFrame:
    """For each ``(start_id, rcv, seq[, processed])`` its next range: ``(start_id, start_rcv, start_seq, end_rcv, end_seq)``, by the rule of next_range().

    A start in an unknown segment has none. A segment is found by the number of its
    entries in the run: both sides are dealt by bins as wide as a mean segment, so a
    start meets a few segments, not all.
    """
    segments = indexed(receivers, first, last)
    done = F.col("processed") if "processed" in starts.columns else F.lit(True)
    at = starts.withColumn("_done", done).join(segments.withColumnRenamed("seg", "rcv"), "rcv")
    at = at.withColumn("_at", F.col("before") + F.col("seq") - F.col("first"))
    # At the end of a run that is done the range begins behind the restart, its first entry included.
    heads = segments.where("before = 0").select((F.col("run") - 1).alias("run"), F.col("seg").alias("_head"), F.col("first").alias("_first"), F.col("total").alias("_total"))
    at = at.join(heads, "run", "left")
    moves = F.col("_done") & (F.col("_at") >= F.col("total") - 1) & F.col("_head").isNotNull()
    at = at.select(
        "start_id", F.when(moves, F.col("run") + 1).otherwise(F.col("run")).alias("run"), F.when(moves, F.col("_head")).otherwise(F.col("rcv")).alias("start_rcv"), F.when(moves, F.col("_first")).otherwise(F.col("seq")).alias("start_seq"),
        F.when(moves, F.least(F.lit(most - 1), F.col("_total") - 1)).otherwise(F.greatest("_at", F.least(F.col("_at") + most, F.col("total") - 1))).alias("_end"),
    )
    width = segments.agg(F.greatest(F.lit(1), F.floor(F.avg(F.col("last") - F.col("first") + 1))).alias("_width"))
    bin_of = lambda x: F.floor(x / F.col("_width"))
    binned = segments.join(F.broadcast(width)).withColumn("_bin", F.explode(F.sequence(bin_of(F.col("before")), bin_of(F.col("before") + F.col("last") - F.col("first")))))
    found = at.join(F.broadcast(width)).withColumn("_bin", bin_of(F.col("_end"))).drop("_width").join(binned.drop("_width", "total"), ["run", "_bin"])
    found = found.where((F.col("_end") >= F.col("before")) & (F.col("_end") <= F.col("before") + F.col("last") - F.col("first")))
    return found.select("start_id", "start_rcv", "start_seq", F.col("seg").alias("end_rcv"), (F.col("first") + F.col("_end") - F.col("before")).alias("end_seq"))


def pages(receivers: DataFrame, most: int) -> DataFrame:
    """Pages of ``most`` entries over the whole chain: ``(page, end_rcv, end_seq)``, from segment metadata alone."""
    r = running(receivers.select("rcv", "first_seq", "entries"), "rcv", {"upto": F.col("entries")})
    total = receivers.agg(F.sum("entries").alias("total"))
    r = r.join(F.broadcast(total)).withColumn("before", F.col("upto") - F.col("entries")).withColumn("page", F.explode(F.sequence(F.expr(f"before div {most}"), F.expr(f"(upto - 1) div {most}"))))
    r = r.withColumn("last", F.least((F.col("page") + 1) * most, F.col("total"))).where("last > before AND last <= upto")
    return r.select("page", F.col("rcv").alias("end_rcv"), (F.col("first_seq") + F.col("last") - F.col("before") - 1).alias("end_seq"))


def all_ranges(segments: list[Segment], start: Position, most: int) -> list[Range]:
    """The ranges from a start to the end of the list, one after the other; none if the start's segment isn't in it."""
    out: list[Range] = []
    while (found := next_range(segments, start, most)) is not None and not found.empty and (not out or found.end != out[-1].end):
        out.append(found)
        start = replace(found.end, processed=True)
    return out
