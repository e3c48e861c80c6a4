"""Segment files of a journal: JSON lines, a file for each segment, in the order of their names.

What is known of a segment is its first and its last entry, read from both ends of its
file; closed segments are looked at once. Within a file, entries are found by bisecting
its bytes, as their numbers ascend.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.operators.ranges import Segment

#: Bytes that are read at a time from the end of a file.
TAIL = 1 << 16


def local(path: str) -> Path:
    """A folder that every machine sees under one name, as a path or a file: address."""
    return Path(path.removeprefix("file://").removeprefix("file:"))


def _number(line: bytes) -> int | None:
    try:
        return int(json.loads(line)["seq"])
    except (ValueError, KeyError, TypeError):
        return None


def _next_number(f: BinaryIO, at: int, end: int) -> tuple[int, int] | None:
    """(place, number) of the first line from ``at`` on that has one."""
    f.seek(at)
    while at < end:
        line = f.readline()
        if not line:
            break
        if (found := _number(line)) is not None:
            return at, found
        at += len(line)
    return None


def _last_number(f: BinaryIO, size: int) -> int | None:
    held, at = b"", size
    while at > 0:
        step = min(TAIL, at)
        at -= step
        f.seek(at)
        held = f.read(step) + held
        lines = held.split(b"\n")
        for line in reversed(lines if at == 0 else lines[1:]):
            if line.strip() and (found := _number(line)) is not None:
                return found
    return None


def place_of(f: BinaryIO, size: int, seq: int) -> int:
    """Where the first entry of at least ``seq`` begins, by bisection; the file's size if there is none."""
    low, high = 0, size
    while low < high:
        middle = (low + high) // 2
        f.seek(middle)
        if middle:
            f.seek(middle - 1)
            f.readline()  # to the beginning of a line
        at = f.tell()
        found = _next_number(f, at, size) if at < high else None
        if found is None or found[0] >= high or found[1] >= seq:
            high = middle
        else:
            low = found[0] + 1
    f.seek(max(0, low - 1))
    if low:
        f.readline()
    found = _next_number(f, f.tell(), size)
    while found and found[1] < seq:
        f.seek(found[0])
        f.readline()
        found = _next_number(f, f.tell(), size)
    return found[0] if found else size


@dataclass
class Folder:
    """The segments of a folder. What a file of the same size and time said before is taken for granted."""

    path: Path
    known: dict[str, tuple[int, int, Segment | None]]

    @classmethod
    def of(cls, path: str) -> Folder:
        return cls(local(path), {})

    def segments(self) -> list[Segment]:
        out = []
        for p in sorted(self.path.glob("seg-*.json")):
            stat = p.stat()
            seen = self.known.get(p.name)
            if seen is None or seen[:2] != (stat.st_size, stat.st_mtime_ns):
                seen = (stat.st_size, stat.st_mtime_ns, self._look(p, stat.st_size))
                self.known[p.name] = seen
            if seen[2]:
                out.append(seen[2])
        return out

    @staticmethod
    def _look(p: Path, size: int) -> Segment | None:
        with p.open("rb") as f:
            first, last = _next_number(f, 0, size), _last_number(f, size)
        return None if first is None or last is None else Segment(p.name, first[1], last)


def lines_between(path: str, first: int, last: int) -> Iterator[tuple[int | None, dict[str, Any] | None, bytes]]:
    """(number, entry, line) of the entries from ``first`` to ``last``; number and entry are None of a line that can't be read."""
    p = Path(path)
    size = p.stat().st_size
    with p.open("rb") as f:
        begin = _next_number(f, 0, size)
        # What can't be read ahead of the first entry belongs to it.
        f.seek(0 if begin is None or begin[1] >= first else place_of(f, size, first))
        for line in f:
            if not line.strip():
                continue
            try:
                entry = json.loads(line)
                number = int(entry["seq"])
            except (ValueError, KeyError, TypeError):
                yield None, None, line.rstrip(b"\n")
                continue
            if number > last:
                return
            yield number, entry, line


def write_segments(entries: DataFrame, path: str, segment: str = "rcv", seq: str = "rseq") -> int:
    """The entries as segment files in a folder that all machines share; returns their number. Rows of a segment go to one task, in their order.

    A file is written under another name first, so a task that is run again leaves whole files.
    """
    target = local(path)
    target.mkdir(parents=True, exist_ok=True)
    rest = [c for c in entries.columns if c not in (segment, seq)]
    line = F.to_json(F.struct(F.col(seq).alias("seq"), *rest))
    rows = entries.select(F.col(segment).cast("long").alias("k"), F.col(seq).alias("s"), line.alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, n = None, None, 0

        def close() -> None:
            if out:
                out.close()
                Path(out.name).rename(target / f"seg-{now:05}.json")

        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k != now:
                    close()
                    now, n = k, n + 1
                    out = (target / f".{k}-{uuid.uuid4().hex}.tmp").open("w")
                out.write(x + "\n")
        close()
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    return rows.repartitionByRange("k").sortWithinPartitions("k", "s").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
