import json

import pytest
from pyspark.sql.types import StructType

from tidefeed import dump
from tidefeed.operators.criteria import InvalidFilter
from tidefeed.sources import segments as files
from tidefeed.sources.reader import InvalidPosition, JournalSource, JournalStreamReader, ReadFailure, failure, register
from tidefeed.streaming import changes

SCHEMA = StructType().add("segment", "string").add("seq", "long")
RANGES = [(1, 4), (5, 9), (1, 3), (3, 4)]  # the third restarts, the last goes on


def write(folder, ranges=RANGES, extra=""):
    for k, (first, last) in enumerate(ranges):
        lines = [json.dumps({"seq": s, "code": "R.PT" if s % 2 else "C.SC", "file_no": k, "value": 1.0}) for s in range(first, last + 1)]
        (folder / f"seg-{k:05}.json").write_text(extra + "\n".join(lines) + "\n")


EVERY = [(f"seg-{k:05}.json", s) for k, (a, b) in enumerate(RANGES) for s in range(a, b + 1)]


def seen(rows):
    return sorted((r["segment"], r["seq"]) for r in rows)


@pytest.mark.parametrize("most", [1, 3, 100])
def test_one_run_reads_to_the_end(spark, tmp_path, most):
    register(spark)
    write(tmp_path)
    assert seen(spark.read.format("journal").option("path", str(tmp_path)).option("maxEntries", most).load().collect()) == EVERY
    stream = lambda: spark.readStream.format("journal").option("path", str(tmp_path)).option("maxEntries", most).load()
    out, check = (f"file://{tmp_path}/{x}" for x in ("out", "check"))
    assert seen(changes.run_to_end(stream(), "j", check, out).collect()) == EVERY
    write(tmp_path, [*RANGES[:3], (3, 6), (7, 8)])  # the last one has grown, and one is new
    spark.catalog.refreshByPath(out)
    assert seen(changes.run_to_end(stream(), "j", check, out).collect()) == sorted([*EVERY, *((f"seg-{k:05}.json", s) for k, s in ((3, 5), (3, 6), (4, 7), (4, 8)))])


def test_criteria_and_bounds(spark, tmp_path):
    register(spark)
    write(tmp_path)
    read = lambda: spark.read.format("journal").option("path", str(tmp_path))
    assert seen(read().option("codes", "R").load().where("seq >= 3 AND seq < 9").collect()) == sorted(x for x in EVERY if x[1] % 2 and 3 <= x[1] < 9)
    with pytest.raises(Exception, match="InvalidFilter"):
        read().option("codes", "R,?").load().collect()
    given = read().schema("value double, segment string").load()
    assert given.columns == ["value", "segment"] and given.count() == len(EVERY)


def test_lost_segment(spark, tmp_path):
    register(spark)
    write(tmp_path)
    read = spark.read.format("journal").option("path", str(tmp_path)).option("startSegment", "seg-00099.json").option("startSeq", 3)
    with pytest.raises(Exception, match="CPF7053"):
        read.load().collect()
    assert seen(read.option("onDataLoss", "reset").load().collect()) == EVERY
    at = spark.read.format("journal").option("path", str(tmp_path)).option("startSegment", "seg-00001.json").option("startSeq", 9)
    assert seen(at.load().collect()) == EVERY[9:]
    (tmp_path / "empty").mkdir()
    assert spark.read.format("journal").option("path", str(tmp_path / "empty")).load().collect() == []


def test_bad_entries(spark, tmp_path):
    register(spark)
    write(tmp_path, extra='{"seq": 0, broken\n')
    read = spark.read.format("journal").option("path", str(tmp_path))
    with pytest.raises(Exception, match="ReadFailure"):
        read.load().collect()
    rows = read.option("badEntries", "keep").load().collect()
    assert sorted((r["segment"], r["seq"]) for r in rows if r["seq"] is not None) == EVERY
    assert [r["bad"] for r in rows if r["seq"] is None] == ['{"seq": 0, broken'] * len(RANGES)


def test_driver_looks_at_the_ends_only(tmp_path, monkeypatch):
    write(tmp_path, [(1, 50_000)])
    folder = files.Folder.of(f"file://{tmp_path}")
    found = folder.segments()
    assert [(s.first, s.last) for s in found] == [(1, 50_000)]
    monkeypatch.setattr(files.Folder, "_look", staticmethod(lambda *a: pytest.fail("looked again")))
    assert folder.segments() == found
    path = str(tmp_path / "seg-00000.json")
    size = (tmp_path / "seg-00000.json").stat().st_size
    for seq in (0, 1, 2, 777, 49_999, 50_000, 50_001):
        with open(path, "rb") as f:
            at = files.place_of(f, size, seq)
            f.seek(at)
            line = f.readline()
            assert (json.loads(line)["seq"] == max(1, seq)) if line else seq == 50_001


def test_offsets_of_the_stream_reader(tmp_path):
    write(tmp_path)
    reader = JournalStreamReader({"path": str(tmp_path), "maxEntries": "3"}, SCHEMA)
    end = reader.latestOffset()
    assert end == {"segment": "seg-00003.json", "seq": 4, "processed": True}
    parts = reader.partitions(reader.initialOffset(), end)
    assert all(p.last - p.first <= 3 for p in parts) and reader.partitions(end, end) == []
    assert [failure(c) for c in ("CPF7053", "CPF7060", "CPF7062", "CPF1")] == [InvalidPosition, InvalidFilter, None, ReadFailure]


def test_segments_are_written_in_their_order(spark, tmp_path):
    entries = spark.createDataFrame([(k % 3, k, "R.PT") for k in range(60, 0, -1)], "rcv long, rseq long, code string").repartition(7)
    assert files.write_segments(entries, f"file://{tmp_path}") == 3
    folder = files.Folder.of(str(tmp_path))
    assert [s.name for s in folder.segments()] == ["seg-00000.json", "seg-00001.json", "seg-00002.json"]
    assert [json.loads(x)["seq"] for x in (tmp_path / "seg-00001.json").read_text().splitlines()] == list(range(1, 61, 3))


def test_dump(tmp_path):
    write(tmp_path, [(1, 2)], extra="broken\n")
    assert list(dump.entries(str(tmp_path), {})) == ["seg-00000.json ? broken", 'seg-00000.json 1 R.PT ADD_ROW {"file_no": 0, "value": 1.0}', 'seg-00000.json 2 C.SC START_COMMIT {"file_no": 0, "value": 1.0}']
    assert len(list(dump.entries(str(tmp_path), {"codes": "C"}))) == 2
