"""Running a feed: heartbeats, a watchdog, restarts after failures, and where its events go."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidefeed.operators.criteria import InvalidFilter

#: Formats of a sink that are part of Spark here.
FORMATS = ("json", "csv", "parquet", "orc")


class Heartbeat(StreamingQueryListener):
    """Calls ``send(offset)`` when a query's position has moved, at most every ``every`` seconds."""

    def __init__(self, send: Callable[[Any], None], every: float = 60.0, clock: Callable[[], float] = time.monotonic):
        self.send, self.every, self.clock = send, every, clock
        self.last: float | None = None
        self.seen: Any = None

    def position(self, offset: Any) -> None:
        now = self.clock()
        if offset != self.seen and (self.last is None or now - self.last >= self.every):
            self.last, self.seen = now, offset
            self.send(offset)

    def onQueryStarted(self, event: Any) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event: Any) -> None:  # noqa: N802
        self.position([s.endOffset for s in event.progress.sources])

    def onQueryIdle(self, event: Any) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: Any) -> None:  # noqa: N802
        pass


class Watchdog:
    """Calls ``bark`` if nobody has called alive() for ``wait`` seconds, again and again until stopped."""

    def __init__(self, bark: Callable[[], None], wait: float = 60.0):
        self.bark, self.wait = bark, wait
        self.last = time.monotonic()
        self.stopped = threading.Event()
        self.thread = threading.Thread(target=self._run, daemon=True)

    def start(self) -> Watchdog:
        self.alive()
        self.thread.start()
        return self

    def alive(self) -> None:
        self.last = time.monotonic()

    def stop(self) -> None:
        self.stopped.set()
        if self.thread.is_alive():
            self.thread.join()

    def _run(self) -> None:
        while not self.stopped.wait(self.wait):
            if time.monotonic() - self.last > self.wait:
                self.bark()

    @classmethod
    def of(cls, query: StreamingQuery, wait: float = 60.0) -> Watchdog:
        """Stops a query that makes no progress."""
        return cls(query.stop, wait).start()


def fatal(error: BaseException) -> bool:
    """Whether trying again makes no sense: the journal refuses the filter."""
    return isinstance(error, InvalidFilter) or InvalidFilter.__name__ in str(error)


def keep_running(start: Callable[[], Any], attempts: int | None = None, pause: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Any:
    """What ``start()`` returns; it is called again after a failure, for ever or so many times, unless the failure is fatal."""
    tried = 0
    while True:
        try:
            return start()
        except Exception as e:
            tried += 1
            if fatal(e) or tried == attempts:
                raise
            sleep(pause)


def write_events(events: DataFrame, kind: str, path: str, partition: list[str] | None = None) -> None:
    """Events as files of one of FORMATS, any nested image as JSON where the format has no columns in columns."""
    if kind not in FORMATS:
        raise ValueError(f"no sink for {kind} here; one of {FORMATS}")
    if kind == "csv":
        nested = [f.name for f in events.schema if f.dataType.simpleString().startswith(("struct", "map", "array"))]
        events = events.withColumns({c: F.to_json(c) for c in nested})
    writer = events.write.format(kind).mode("append")
    (writer.partitionBy(*partition) if partition else writer).save(path)


def progress_row(query: StreamingQuery) -> dict[str, Any]:
    """The last position and counts of a query, for a table of heartbeats."""
    last = query.lastProgress
    return {"batch": last["batchId"], "rows": last["numInputRows"], "offsets": json.dumps([s["endOffset"] for s in last["sources"]])} if last else {}
