"""A journal as a data source: ``spark.read`` and ``spark.readStream.format("journal")``, after register().

Offsets are (segment, sequence, processed), kept in the checkpoint. What there is to read is
planned as ranges of the planner in operators.ranges, each a page of ``maxEntries`` at most
that never straddles a restart of the numbers, and cut at segments; pages are the input
partitions, so one run reads to the end however small they are. The driver reads the ends
of segment files, not their entries.

Options: ``path`` (a folder of segment files, see sources.segments), ``maxEntries``,
``onDataLoss`` (fail, or reset: read from the start of the chain), ``startSegment`` and
``startSeq`` (a position that is done), ``badEntries`` (fail, or keep: a row with the line in
``bad``), and those of Criteria.from_options().
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from tidefeed.operators.criteria import Criteria, InvalidFilter
from tidefeed.operators.ranges import Position, Segment, all_ranges
from tidefeed.sources.segments import Folder, lines_between
from tidefeed.sources.shipping import ship


class InvalidPosition(Exception):
    """The journal no longer holds the position: its segment is gone."""


class ReadFailure(Exception):
    """Any other failure of the journal."""


# What a failure code means: the error to raise, or None for an empty answer that still moves on.
FAILURES = {"CPF7053": InvalidPosition, "CPF9801": InvalidPosition, "CPF7054": InvalidPosition, "CPF7060": InvalidFilter, "CPF7062": None}
GONE, REFUSED, EMPTY = "CPF7053", "CPF7060", "CPF7062"
#: Rows of an Arrow batch.
ROWS = 4096


def failure(code: str) -> type[Exception] | None:
    return FAILURES.get(code, ReadFailure)


def fail(code: str, what: str) -> None:
    """Raises what a code means; an empty answer is none."""
    kind = failure(code)
    if kind is not None:
        raise kind(f"{code}: {what}")


class Stretch(InputPartition):
    """Entries ``first`` to ``last`` of one segment."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class Pages:
    """What both readers share: which stretches lie between two offsets, and how one is read."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.folder = Folder.of(options["path"])
        self.most = int(options.get("maxentries", options.get("maxEntries", 1_000_000)))
        self.reset = options.get("ondataloss", options.get("onDataLoss", "fail")) == "reset"
        self.keep_bad = options.get("badentries", options.get("badEntries", "fail")) == "keep"
        segment = options.get("startsegment", options.get("startSegment", ""))
        self.begin = {"segment": segment, "seq": int(options.get("startseq", options.get("startSeq", 0))), "processed": True}
        try:
            self.criteria = Criteria.from_options(options)
        except InvalidFilter as e:
            fail(REFUSED, str(e))
        self.schema = schema
        self.low, self.high = None, None

    def end(self, segments: list[Segment]) -> dict:
        return {"segment": segments[-1].name, "seq": segments[-1].last, "processed": True} if segments else dict(self.begin)

    def known(self, segments: list[Segment], at: dict) -> bool:
        return not at["segment"] or at["segment"] in {s.name for s in segments}

    def start(self, segments: list[Segment], at: dict) -> Position:
        """The position to read from; one in a lost segment is an error, or the head of the chain."""
        if not self.known(segments, at):
            if not self.reset:
                fail(GONE, at["segment"])
            at = {"segment": ""}
        return Position(at["seq"], at["segment"], at["processed"]) if at["segment"] else Position(segments[0].first, segments[0].name, processed=False)

    def stretches(self, start: dict, end: dict) -> list[Stretch]:
        segments = self.folder.segments()
        if not segments or not end["segment"] or start == end:
            fail(EMPTY, "nothing to read")
            return []
        names = [s.name for s in segments]
        # What came after the end was planned isn't part of it.
        cut = [s if s.name != end["segment"] else Segment(s.name, s.first, min(s.last, end["seq"])) for s in segments[: names.index(end["segment"]) + 1]]
        out = []
        for r in all_ranges(cut, self.start(cut, start), self.most):
            inside = cut[names.index(r.start.segment) : names.index(r.end.segment) + 1]
            for s in inside:
                first = r.start.offset + r.start.processed if s.name == r.start.segment else s.first
                last = r.end.offset if s.name == r.end.segment else s.last
                if self.low is not None:
                    first = max(first, self.low)
                if self.high is not None:
                    last = min(last, self.high)
                if first <= last:
                    out.append(Stretch(str(self.folder.path / s.name), first, last))
        return out

    def rows(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, segment, held = to_arrow_schema(self.schema), Path(part.path).name, []
        try:
            for number, entry, line in lines_between(part.path, part.first, part.last):
                if number is None:
                    if not self.keep_bad:
                        raise ReadFailure(f"{segment}: {line[:200]!r}")
                    held.append({"segment": segment, "bad": line.decode("utf-8", "replace")})
                elif self.criteria.wants(entry):
                    held.append(entry | {"segment": segment})
                if len(held) == ROWS:
                    yield self._batch(held, arrow)
                    held = []
        except FileNotFoundError:
            fail(GONE, part.path)
        if held:
            yield self._batch(held, arrow)

    def _batch(self, rows: list[dict], arrow: pa.Schema) -> pa.RecordBatch:
        columns = []
        for f in arrow:
            values = [r.get(f.name) for r in rows]
            columns.append(pa.array(values, pa.string()).cast(f.type) if pa.types.is_temporal(f.type) else pa.array(values, f.type))
        return pa.RecordBatch.from_arrays(columns, schema=arrow)


class JournalStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.pages = Pages(options, schema)

    def initialOffset(self) -> dict:  # noqa: N802
        return dict(self.pages.begin)

    def latestOffset(self) -> dict:  # noqa: N802
        """The true end, so that a trigger that runs once reads all; how much a task reads is a matter of pages."""
        return self.pages.end(self.pages.folder.segments())

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return self.pages.stretches(start, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return self.pages.rows(partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class JournalBatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.pages = Pages(options, schema)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Bounds of ``seq`` narrow the stretches; Spark tests every filter again."""
        for f in filters:
            if getattr(f, "attribute", None) == ("seq",):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.pages.low = max(self.pages.low or f.value, f.value)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.pages.high = min(self.pages.high if self.pages.high is not None else f.value, f.value)
            yield f

    def partitions(self) -> list[Stretch]:
        return self.pages.stretches(self.pages.begin, self.pages.end(self.pages.folder.segments())) or [Stretch("", 1, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return self.pages.rows(partition) if partition.path else iter(())


class JournalSource(DataSource):
    """The schema may be given: ``segment``, ``bad``, and any fields of the entries."""

    @classmethod
    def name(cls) -> str:
        return "journal"

    def schema(self) -> str:
        return "segment string, seq long, code string, file_no long, value double, bad string"

    def streamReader(self, schema: StructType) -> JournalStreamReader:  # noqa: N802
        return JournalStreamReader(dict(self.options), schema)

    def reader(self, schema: StructType) -> JournalBatchReader:
        return JournalBatchReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Makes ``format("journal")`` known to the session and its workers."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(JournalSource)
