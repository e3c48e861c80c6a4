import pytest
from pyspark.sql import functions as F

from tidefeed.config import FeedConfig
from tidefeed.operators import catalog_tables, health, offsets, ordered, ranges, receivers, snapshot, transforms
from tidefeed.operators.criteria import ALL, AVAILABLE_CHAIN, CURRENT, CURRENT_CHAIN, Criteria, InvalidFilter
from tidefeed.operators.offsets import FeedOffset
from tidefeed.operators.ranges import Position, Segment, all_ranges, next_range
from tidefeed.streaming import running


def segments(spark, rows):
    return spark.createDataFrame(rows, "rcv long, status int, next_rcv long, attached long")


def chains(spark, rows):
    return {r["rcv"]: r["chain"] for r in receivers.chain_numbers(segments(spark, rows)).collect()}


def test_chains_follow_links(spark):
    line = [(i, 2, i + 1 if i < 6 else None, i) for i in range(1, 7)]
    assert chains(spark, [(1, 5, 2, 1), *line[1:3]]) == {2: 2, 3: 2}  # a partial one is left out
    assert chains(spark, line) == dict.fromkeys(range(1, 7), 1)
    assert chains(spark, [*line[:3], (4, 2, None, 4), *line[4:]]) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}
    assert chains(spark, [(1, 2, 3, 1), (2, 2, None, 2), (3, 1, None, 3)]) == {1: 1, 3: 1, 2: 2}
    assert chains(spark, [(9, 2, 4, 1), (4, 3, 7, 2), (7, 1, None, 3), (5, 6, 9, 0), (3, 4, None, 0)]) == {9: 9, 4: 9, 7: 9}
    assert chains(spark, []) == {}


def test_last_joined(spark):
    got = receivers.last_joined(segments(spark, [(3, 2, None, 3), (1, 5, None, 1), (2, 2, None, 2), (8, 2, None, None)])).orderBy("attached").collect()
    assert [r["rcv"] for r in got] == [2, 3]
    assert receivers.last_joined(segments(spark, [(1, 2, None, 1), (2, 1, None, 2)])).count() == 2


def test_neighbours_and_totals_across_buckets(spark):
    rows = [(k, float(k % 5) if k % 7 else None) for k in (0, 1, 2, 5, 9, 10, 11, 30, 31, 64)]
    df = spark.createDataFrame(rows, "k long, v double")
    for width in (1, 4, 1000):
        ahead = {r["k"]: r["n"] for r in ordered.neighbour(df, "k", "v", "n", width=width).collect()}
        back = {r["k"]: r["n"] for r in ordered.neighbour(df, "k", "v", "n", ahead=False, width=width).collect()}
        assert ahead == {k: (rows[i + 1][1] if i + 1 < len(rows) else None) for i, (k, _) in enumerate(rows)}
        assert back == {k: (rows[i - 1][1] if i else None) for i, (k, _) in enumerate(rows)}
        total = {r["k"]: r["t"] for r in ordered.running(df, "k", {"t": F.coalesce("v", F.lit(0.0))}, width=width).collect()}
        assert total == {k: sum(v or 0 for _, v in rows[: i + 1]) for i, (k, _) in enumerate(rows)}


@pytest.mark.parametrize("most", [1, 3, 10, 1000])
def test_find_ranges_is_next_range(spark, most):
    listed = [(0, 1, 10), (1, 11, 20), (2, 21, 30), (3, 41, 50), (4, 1, 10), (5, 1, 1), (6, 1, 7), (7, 8, 40), (8, 2, 9)]
    names = {k: Segment(str(k), a, b) for k, a, b in listed}
    asked = [(i, k, s, done) for i, (k, s, done) in enumerate((k, s, d) for k, a, b in listed for s in {a, (a + b) // 2, b} for d in (True, False))]
    got = {r["start_id"]: (r["start_rcv"], r["start_seq"], r["end_rcv"], r["end_seq"]) for r in ranges.find_ranges(spark.createDataFrame([*asked, (999, 77, 1, True)], "start_id int, rcv long, seq long, processed boolean"), spark.createDataFrame(listed, "rcv long, first_seq long, last_seq long"), most).collect()}
    want = {}
    for i, k, s, done in asked:
        r = next_range(list(names.values()), Position(s, str(k), done), most)
        want[i] = (int(r.start.segment), r.start.offset, int(r.end.segment), r.end.offset)
    assert got == want


def test_all_ranges_cover_each_entry_once():
    listed = [Segment("a", 1, 10), Segment("b", 1, 5), Segment("c", 6, 6), Segment("d", 2, 9)]
    for most in (1, 2, 7, 100):
        at = Position(1, "a", processed=False)
        got = []
        for r in all_ranges(listed, at, most):
            names = [s.name for s in listed]
            for s in listed[names.index(r.start.segment) : names.index(r.end.segment) + 1]:
                first = r.start.offset + r.start.processed if s.name == r.start.segment else s.first
                got += [(s.name, k) for k in range(first, (r.end.offset if s.name == r.end.segment else s.last) + 1)]
        assert got == [(s.name, k) for s in listed for k in range(s.first, s.last + 1)]


def test_behind_counts_by_segment(spark):
    r = spark.createDataFrame([(0, 10, 10), (1, 5, 5), (2, 8, 8)], "rcv long, last_rseq long, entries long")
    got = receivers.behind(r, spark.createDataFrame([(0, 4), (1, 5), (2, 8), (9, 1)], "rcv long, rseq long")).collect()
    assert {(x["rcv"], x["rseq"]): x["behind"] for x in got} == {(0, 4): 19, (1, 5): 8, (2, 8): 0, (9, 1): None}


def test_receiver_cache():
    cache = receivers.ReceiverCache()
    for d in (receivers.Details("a", 2, 1.0), receivers.Details("b", 1, 2.0), receivers.Details("c", None, 3.0), receivers.Details("d", 3, None)):
        cache.put(d)
    assert set(cache.held) == {"a"} and cache.get("a", 2, 9.0) is None and cache.get("a", 1, 1.0) is None
    assert cache.get("a", 4, 1.0).status == 4 and cache.held["a"].status == 4
    cache.keep_only(["b"])
    assert cache.held == {}


def test_criteria(spark):
    for bad in ({"codes": ("?",)}, {"types": ("XX",)}, {"receivers": "*NONE"}, {"start": "*LAST"}, {"end": "x"}, {"most": 0}, {"indicator_length": 24}):
        with pytest.raises(InvalidFilter):
            Criteria(**bad)
    assert Criteria(indicator_length=32).with_(codes=("R",)).types == (ALL,)
    asked = Criteria.from_options({"codes": "R, C", "types": "PT,SC", "files": "1,2", "start": "3", "receivers": "0:4", "most": "5"})
    assert asked == Criteria(codes=("R", "C"), types=("PT", "SC"), files=(1, 2), start=3, receivers=(0, 4), most=5) and Criteria.from_options({}) == Criteria()
    rows = [(s, c, f, s // 4, s % 2) for s, (c, f) in enumerate([("R.PT", 1), ("R.UP", 1), ("C.SC", 2), ("R.PT", 2), ("C.SC", 9), ("R.PT", 1), ("F.OP", 1), ("R.PT", 7)])]
    entries = spark.createDataFrame(rows, "seq long, code string, file_no long, rcv long, user_id long")
    for c in (Criteria(), asked, Criteria(codes=("R",), end=4), Criteria(users=(1,), types=("PT",))):
        assert sorted(r["seq"] for r in c.apply(entries).collect()) == [s for s, code, f, _, u in rows if c.wants({"seq": s, "code": code, "file_no": f, "user_id": u})][: c.most]
    listed = segments(spark, [(0, 5, 1, 0), (1, 2, 2, 1), (2, 1, None, 2)])
    every = spark.createDataFrame([(k,) for k in range(3)], "rcv long").withColumn("seq", F.col("rcv"))
    found = {r: sorted(x["rcv"] for x in Criteria(receivers=r).apply(every, listed).collect()) for r in (CURRENT, CURRENT_CHAIN, AVAILABLE_CHAIN)}
    assert found == {CURRENT: [2], CURRENT_CHAIN: [1, 2], AVAILABLE_CHAIN: [1, 2]}


def test_config():
    c = FeedConfig.from_options({"database.hostname": "h", "database.schema": "app", "secure": "false", "from_ccsid": "37", "to_ccsid": "1146", "snapshot.mode": "never", "other": "x"})
    assert (c.schema, c.secure, c.override, c.topic_prefix, c.max_entries, c.buffer_size, c.max_journal_timeout) == ("APP", False, (37, 1146), "h", 1_000_000, 131_072, 60_000)
    assert FeedConfig().override is None and c.reader_options("p") == {"path": "p", "maxEntries": "1000000"}
    assert c.jdbc_options("T", "db")["dbtable"] == "APP.T" and c.jdbc_options("T", "db")["url"].startswith("jdbc:db://h;date format=iso")
    for bad in ({"snapshot_mode": "x"}, {"max_entries": 0}):
        with pytest.raises(ValueError):
            c.with_(**bad)


def test_offsets(spark):
    at = FeedOffset(18_446_644_000_000_000_000, "RCV1", "LIB", 7, True, "a,b", True)
    assert FeedOffset.load(at.store()) == at
    for blank in ({}, {"event_sequence": "null"}, {"event_sequence": " "}, {"event_sequence": None}):
        assert FeedOffset.load(blank).blank
    assert FeedOffset().store()["event_sequence"] == "null" and FeedOffset.load(FeedOffset().store()) == FeedOffset()
    moved = at.moved(1, "RCV2", False)
    assert (moved.seq, moved.receiver, moved.time, moved.library) == (1, "RCV2", 7, "LIB") and at.moved(1, "RCV2", False, 9).time == 9
    assert at.same_place(at.moved(at.seq, "RCV1", True, 99)) and not at.same_place(moved)
    end = FeedOffset(50, "RCV9", "LIB")
    assert offsets.snapshot_offset(at, end, ["c"]) == (at, FeedOffset(50, "RCV9", "LIB", processed=True))
    assert offsets.snapshot_offset(FeedOffset(), end, [])[0].seq == 50 and offsets.snapshot_offset(at, end, []) == (at, at)
    assert offsets.added_tables("a, b", "b,c, c ,d") == ["c", "d"] and offsets.added_tables(None, "a") == offsets.added_tables("a", None) == []
    twice = spark.createDataFrame([(0, 1), (1, 1), (1, 1)], "rcv long, rseq long")
    assert offsets.resumed(twice).count() == 2


def test_snapshot(spark):
    known = spark.createDataFrame([("A", "T1", "J1", "L"), ("A", "T2", "J1", "L"), ("A", "T3", "J2", "L"), ("B", "T4", "J3", "L")], "sch string, tab string, jrn string, lib string")
    assert snapshot.discover(known, "A", ["T1", "T2"]).collect() == snapshot.discover(known, "A", ["T2"]).collect()
    assert snapshot.discover(known, "B", []).first()["jrn"] == "J3"
    for schema, tables in (("A", ["T1", "T3"]), ("A", ["T1", "T4"]), ("A", []), ("C", [])):
        with pytest.raises(snapshot.NoJournal):
            snapshot.discover(known, schema, tables)
    t = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    got = snapshot.snapshot(spark, {"t": t, "u": t}, {"t": "SELECT v FROM {t} WHERE k = 2"})
    assert [tuple(r) for r in got["t"].collect()] == [("y", "READ")] and got["u"].count() == 2
    assert snapshot.schemas_only({"t": t}) == {"t": "k int, v string"}
    lists = lambda text: spark.createDataFrame([(text,)], "includes string")
    assert [r["item"] for r in snapshot.new_tables(lists("a, b"), lists("b,c")).collect()] == ["c"]
    assert snapshot.new_tables(lists(None), lists("b,c")).collect() == [] == snapshot.new_tables(lists("a"), lists(None)).collect()


def test_names(spark):
    names = spark.createDataFrame([("S", "LONG_NAME_OF_IT", "L1"), ("T", "LONG_NAME_OF_IT", "L2")], "schema string, long_name string, system_name string")
    asked = spark.createDataFrame([("S", "LONG_NAME_OF_IT"), ("S", "SHORT"), ("S", "ANOTHER_LONG_NAME"), ("T", "LONG_NAME_OF_IT")], "schema string, long_name string")
    assert {(r["schema"], r["long_name"]): r["system_name"] for r in catalog_tables.system_names(asked, names).collect()} == {("S", "LONG_NAME_OF_IT"): "L1", ("S", "SHORT"): "SHORT", ("S", "ANOTHER_LONG_NAME"): None, ("T", "LONG_NAME_OF_IT"): "L2"}
    back = spark.createDataFrame([("S", "L1"), ("T", "L1"), ("S", "")], "schema string, system_name string")
    assert {(r["schema"], r["system_name"]): r["long_name"] for r in catalog_tables.long_names(back, names).collect()} == {("S", "L1"): "LONG_NAME_OF_IT", ("T", "L1"): "L1", ("S", ""): ""}


def test_lower_case_all(spark):
    df = spark.createDataFrame([(1, 2)], "KEY_COLUMN1 int, Other int")
    low, name = transforms.lower_case_all(df, "com.foo.ThingKey")
    assert (low.columns, name) == (["key_column1", "other"], "com.foo.thingkey")
    assert transforms.lower_case_all(df, "com.foo.thing") == (df, "com.foo.thing") and transforms.lower_case_all(df, None) == (df, None)
    with pytest.raises(ValueError):
        transforms.lower_case_all(df.toDF("a", "A"), "X")
    with pytest.raises(ValueError):
        transforms.TopicRePrefix("")


def test_health_and_logs(spark):
    states = lambda *rows: spark.createDataFrame(list(rows), "connector string, http int, state string, task string")
    assert health.exit_code(states(("a", 200, "RUNNING", "UNASSIGNED"))) == 0 == health.exit_code(states())
    assert health.exit_code(states(("a", 200, "RUNNING", "RUNNING"), ("b", 200, "FAILED", "RUNNING"))) == 1
    now = [0.0]
    limit = health.RateLimit(10, lambda: now[0])
    passed = []
    for t in (0, 5, 10, 11, 20, 22):
        now[0] = t
        passed.append(limit())
    assert passed == [True, False, False, True, False, True]


def test_running():
    now, sent = [0.0], []
    beat = running.Heartbeat(sent.append, 10, lambda: now[0])
    for t, at in ((0, 1), (3, 2), (11, 2), (30, 2), (40, 3)):
        now[0] = t
        beat.position(at)
    assert sent == [1, 2, 3]
    barked = running.threading.Event()
    dog = running.Watchdog(barked.set, 0.05).start()
    assert barked.wait(5)
    dog.stop()
    calls = []

    def start():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("gone")
        return "done"

    assert running.keep_running(start, sleep=lambda s: None) == "done" and len(calls) == 3
    for error, n in ((InvalidFilter("x"), 1), (ConnectionError("y"), 2)):
        calls.clear()

        def broken(error=error):
            calls.append(1)
            raise error

        with pytest.raises(type(error)):
            running.keep_running(broken, attempts=2, sleep=lambda s: None)
        assert len(calls) == n


def test_sinks(spark, tmp_path):
    events = spark.createDataFrame([(1, ("a", 2.0)), (2, None)], "seq long, after struct<k: string, v: double>")
    for kind in ("json", "parquet", "orc"):
        running.write_events(events, kind, f"file://{tmp_path}/{kind}")
        assert sorted(map(str, spark.read.schema(events.schema).format(kind).load(f"file://{tmp_path}/{kind}").collect())) == sorted(map(str, events.collect()))
    running.write_events(events, "csv", f"file://{tmp_path}/csv")
    with pytest.raises(ValueError):
        running.write_events(events, "avro", "x")
