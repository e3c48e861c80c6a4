import __spark_entry__
from tidefeed.operators import feed
from tidefeed.sources.journal import journal
from tidefeed.streaming import changes

SF = "/root/testdata/sf0.001"


def replay(rows):
    held, out = {}, []
    for r in sorted(rows, key=lambda r: r["seq"]):
        if r["code"] == "R.UB":
            held[r["file_no"]] = r["value"]
        elif r["code"] == "R.UP":
            out.append((r["seq"], held.pop(r["file_no"], None), r["value"]))
    return sorted(out)


def test_pairing_is_the_replay(spark):
    j = journal(spark, SF)
    got = sorted((r["seq"], r["before"], r["value"]) for r in feed.with_before(j).collect())
    assert got == replay(j.collect())


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    j = journal(spark, SF).cache()
    cut = j.count() // 2
    source, out, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    for part in (j.where(f"seq <= {cut}"), j.where(f"seq > {cut}")):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(j.schema).parquet(source)
        got = changes.run_to_end(changes.pair_stream(stream), "pairs", check, out)
    spark.catalog.refreshByPath(out)
    none = lambda x: None if x is None or x != x else x
    assert sorted((r["seq"], none(r["before"]), r["after"]) for r in got.collect()) == replay(j.collect())


def test_entry(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["seq", "rcv", "ts", "file_no", "op", "before", "after", "tx"] and rows.count() > 0


def test_absent_values_and_open_updates(spark, tmp_path):
    rows = [(1, 1, "R.UB", None), (2, 1, "R.UP", 2.0), (3, 1, "R.UP", None), (4, 2, "R.UB", 4.0), (5, 2, "R.UP", float("nan"))]
    spark.createDataFrame(rows, "seq long, file_no long, code string, value double").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("seq long, file_no long, code string, value double").parquet(f"file://{tmp_path}/in")
    got = {r["seq"]: (r["before"], r["after"]) for r in changes.run_to_end(changes.pair_stream(stream), "pairs").collect()}
    assert got[2] == (None, 2.0) and got[3] == (None, None) and got[5][0] == 4.0 and got[5][1] != got[5][1]


def test_pairing_by_row_and_spread_inserts(spark):
    rows = [(1, 1, 7, "R.UB", 1.0), (2, 1, 8, "R.UB", 2.0), (3, 1, 7, "R.UP", 3.0), (4, 1, 8, "R.UP", 4.0), (5, 1, 7, "R.PT", 5.0)]
    entries = spark.createDataFrame([(*r, 0, 0, None) for r in rows], "seq long, file_no long, user_id long, code string, value double, rcv long, cycle long, ts timestamp")
    events = lambda **k: {r["seq"]: (r["before"], r["after"]) for r in feed.change_events(entries, **k).collect()}
    assert events() == {3: (2.0, 3.0), 4: (None, 4.0), 5: (None, 5.0)}
    assert events(keys=("file_no", "user_id")) == {3: (1.0, 3.0), 4: (2.0, 4.0), 5: (None, 5.0)}


def test_stream_pairs_by_row(spark, tmp_path):
    rows = [(1, 1, 7, "R.UB", 1.0), (2, 1, 8, "R.UB", 2.0), (3, 1, 7, "R.UP", 3.0), (4, 1, 8, "R.UP", 4.0), (5, 1, None, "R.UP", 5.0)]
    schema = "seq long, file_no long, user_id long, code string, value double"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in")
    got = changes.run_to_end(changes.pair_stream(stream, ("file_no", "user_id")), "pairs")
    assert got.columns == ["seq", "file_no", "user_id", "before", "after"]
    assert sorted(map(tuple, got.collect())) == [(3, 1, 7, 1.0, 3.0), (4, 1, 8, 2.0, 4.0), (5, 1, None, None, 5.0)]


def test_forgotten_transactions(spark, tmp_path):
    """With a time to live, state goes by the clock; such a query has no end, so it is stopped when all is read."""
    spark.createDataFrame([(1, 1, "C.SC"), (2, 1, "R.PT"), (3, 2, "R.PT")], "seq long, cycle long, code string").write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("seq long, cycle long, code string").parquet(f"file://{tmp_path}/in")
    rows: dict = {}
    query = changes.transaction_stream(stream, ttl_ms=60_000).writeStream.foreachBatch(lambda df, _: rows.update((r["seq"], r["tx"]) for r in df.collect())).option("checkpointLocation", f"file://{tmp_path}/check").start()
    for _ in range(300):
        if len(rows) == 2:
            break
        query.awaitTermination(0.1)
    query.stop()
    assert rows == {2: "1", 3: None}
