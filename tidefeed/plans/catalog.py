"""All queries of the engine, each with the same in SQL where SQL can say it."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidefeed.functions import codec
from tidefeed.functions import columns as fn
from tidefeed.operators import catalog_tables, feed, health, offsets, ranges, transforms
from tidefeed.operators import receivers as chain
from tidefeed.operators import snapshot as first_image
from tidefeed.operators.criteria import CURRENT, CURRENT_CHAIN, Criteria
from tidefeed.operators.ordered import running
from tidefeed.sources.journal import JOURNAL_SQL, RECEIVERS_SQL, journal, receivers, table
from tidefeed.sources.reader import FAILURES, ReadFailure, register
from tidefeed.sources.scratch import fresh_path
from tidefeed.sources.segments import write_segments
from tidefeed.sources.shipping import ship
from tidefeed.streaming import changes
from tidefeed.streaming import running as feeds

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; in ``sql``, J and R are the journal and its segments."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            views = ([JOURNAL_SQL] if " J" in sql or " R" in sql else []) + ([RECEIVERS_SQL] if " R" in sql else [])
            _SQL[f.__name__] = f"WITH RECURSIVE {', '.join([*views, 'nothing AS (SELECT 1)'])} {sql}"
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


INCLUDED = [1, 2, 3, 5, 7]
FILES_SQL = ", ".join(map(str, INCLUDED))


def _rows(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


def _values(rows: list[tuple]) -> str:
    lit = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


# --- scans and criteria ---------------------------------------------------


@query("SELECT seq, rcv, code, value FROM J WHERE seq BETWEEN 100 AND 900")
def journal_scan(spark, d):
    """An inclusive stretch of the journal; the bounds reach the scan as a filter on event_id."""
    return Criteria(start=100, end=900).apply(journal(spark, d)).select("seq", "rcv", "code", "value")


def _segment_files(spark, d) -> str:
    """The journal as segment files, whose numbers restart in each."""
    path = fresh_path(spark, "segments")
    write_segments(journal(spark, d).select("rcv", "rseq", "code", "file_no", "value"), path)
    register(spark)
    return path


_OF_FILES = ("CAST(regexp_extract(segment, '([0-9]+)', 1) AS BIGINT) AS rcv", "seq AS rseq")


@query("SELECT rcv, rseq, code, file_no, value FROM J")
def journal_source(spark, d):
    """The batch source over segment files, every entry once, in pages that end at restarts."""
    return spark.read.format("journal").option("path", _segment_files(spark, d)).option("maxEntries", 300).load().selectExpr(*_OF_FILES, "code", "file_no", "value")


@query("SELECT rcv, rseq, code FROM J WHERE rseq BETWEEN 200 AND 210 AND left(code, 1) = 'R'")
def journal_source_criteria(spark, d):
    """Criteria as options, and bounds of the number as a filter that narrows what is read."""
    rows = spark.read.format("journal").option("path", _segment_files(spark, d)).option("codes", "R").load()
    return rows.where("seq BETWEEN 200 AND 210").selectExpr(*_OF_FILES, "code")


@query("SELECT rcv, rseq, code, file_no, value FROM J")
def journal_stream_source(spark, d):
    """The streaming source: one run to the end of all segments, restarts included."""
    stream = spark.readStream.format("journal").option("path", _segment_files(spark, d)).option("maxEntries", 300).load()
    return changes.run_to_end(stream.selectExpr(*_OF_FILES, "code", "file_no", "value"), "journal")


@query("SELECT seq, rcv, code FROM J WHERE NOT (seq = 100 AND rcv = 0) AND seq >= 100")
def skip_processed(spark, d):
    """Resuming at a processed position: its entry isn't seen again."""
    return offsets.after(journal(spark, d), 100, 0, processed=True).select("seq", "rcv", "code")


@query("SELECT min(seq) > 0 AS has_data, max(CASE WHEN rcv > 0 THEN 1 ELSE 0 END) = 1 AS more FROM J WHERE seq > 100")
def has_data(spark, d):
    """Whether anything is behind a position, and whether it goes on in a later segment."""
    behind = offsets.after(journal(spark, d), 100, 0, processed=True)
    return behind.agg((F.count("*") > 0).alias("has_data"), F.coalesce(F.max("rcv") > 0, F.lit(False)).alias("more"))


_CODES = [("CPF7053",), ("CPF9801",), ("CPF7054",), ("CPF7060",), ("CPF7062",), ("CPF0000",)]


@query(f"""SELECT code, CASE WHEN code IN ('CPF7053', 'CPF9801', 'CPF7054') THEN 'InvalidPosition' WHEN code = 'CPF7060' THEN 'InvalidFilter'
  WHEN code = 'CPF7062' THEN 'none' ELSE 'ReadFailure' END AS error FROM ({_values(_CODES)}) t(code)""")
def error_classify(spark, d):
    named = F.create_map(*[F.lit(x) for k, v in FAILURES.items() for x in (k, v.__name__ if v else "none")])
    return _rows(spark, "code string", _CODES).select("code", F.coalesce(named[F.col("code")], F.lit(ReadFailure.__name__)).alias("error"))


@query("SELECT rcv, last_seq AS seq FROM R WHERE status = 1")
def current_position(spark, d):
    return receivers(spark, d).where("status = 1").select("rcv", F.col("last_seq").alias("seq"))


@query("SELECT rcv, status, attached, next_rcv FROM R")
def receiver_list(spark, d):
    return receivers(spark, d).select("rcv", "status", "attached", "next_rcv")


@query("SELECT rcv, first_seq, last_seq, first_rseq, last_rseq, entries FROM R")
def receiver_details(spark, d):
    return receivers(spark, d).select("rcv", "first_seq", "last_seq", "first_rseq", "last_rseq", "entries")


_JOURNALS = [("APP", "ORDERS", "QSQJRN", "APP"), ("APP", "ITEMS", "QSQJRN", "APP"), ("APP", "AUDIT", "AUDJRN", "SYS"), ("OTHER", "X", "XJRN", "OTHER")]


@query(f"SELECT DISTINCT jrn, lib FROM ({_values(_JOURNALS)}) t(sch, tab, jrn, lib) WHERE sch = 'APP' AND tab IN ('ORDERS', 'ITEMS')")
def journal_discovery(spark, d):
    """The one journal that the included tables share."""
    return first_image.discover(_rows(spark, "sch string, tab string, jrn string, lib string", _JOURNALS), "APP", ["ORDERS", "ITEMS"])


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'READ' AS op FROM customer")
def snapshot_scan(spark, d):
    return first_image.snapshot(spark, {"customer": table(spark, d, "customer")})["customer"]


@query("SELECT c_custkey, c_name, 'READ' AS op FROM customer WHERE c_acctbal > 0")
def snapshot_override(spark, d):
    """A table's snapshot by a statement of its own."""
    own = {"customer": "SELECT c_custkey, c_name FROM {customer} WHERE c_acctbal > 0"}
    return first_image.snapshot(spark, {"customer": table(spark, d, "customer")}, own)["customer"]


@query("SELECT 'tidefeed_nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'tidefeed_region', count(*) FROM region")
def catalog_tables_list(spark, d):
    """Tables that the session's catalogue has under a prefix, and their sizes."""
    for name in ("region", "nation"):
        table(spark, d, name).createOrReplaceTempView(f"tidefeed_{name}")
    each = [spark.table(t).agg(F.lit(t).alias("name"), F.count("*").alias("n")) for t in first_image.tables_of(spark, prefix="tidefeed_")]
    return reduce(DataFrame.unionByName, each)


@query("SELECT seq, code FROM J WHERE rcv BETWEEN 2 AND 4")
def criteria_receiver(spark, d):
    return Criteria(receivers=(2, 4)).apply(journal(spark, d)).select("seq", "code")


@query("SELECT seq, code FROM J WHERE rcv IN (SELECT rcv FROM R WHERE status = 1)")
def criteria_current(spark, d):
    return Criteria(receivers=CURRENT).apply(journal(spark, d), receivers(spark, d)).select("seq", "code")


@query("SELECT count(*) AS n, min(seq) AS low FROM J WHERE rcv > (SELECT coalesce(max(rcv), -1) FROM R WHERE status NOT IN (1, 2, 3))")
def criteria_current_chain(spark, d):
    """The chain of the attached segment, back to where one isn't joined."""
    return Criteria(receivers=CURRENT_CHAIN).apply(journal(spark, d), receivers(spark, d)).agg(F.count("*").alias("n"), F.min("seq").alias("low"))


@query("SELECT seq, code FROM J WHERE seq BETWEEN 1500 AND (SELECT max(seq) FROM J)")
def criteria_range(spark, d):
    """From an entry to *LAST."""
    return Criteria(start=1500).apply(journal(spark, d)).select("seq", "code")


@query("SELECT seq, code FROM J ORDER BY seq LIMIT 250")
def criteria_limit(spark, d):
    return Criteria(most=250).apply(journal(spark, d)).select("seq", "code")


@query("SELECT seq, code FROM J WHERE left(code, 1) IN ('C', 'D')")
def criteria_codes(spark, d):
    return Criteria(codes=("C", "D")).apply(journal(spark, d)).select("seq", "code")


@query("SELECT seq, code FROM J WHERE split_part(code, '.', 2) IN ('PT', 'DL', 'UP')")
def criteria_types(spark, d):
    return Criteria(types=("PT", "DL", "UP")).apply(journal(spark, d)).select("seq", "code")


@query(f"SELECT seq, file_no FROM J WHERE file_no IN ({FILES_SQL})")
def criteria_files(spark, d):
    return Criteria(files=tuple(INCLUDED)).apply(journal(spark, d)).select("seq", "file_no")


@query("SELECT seq, ts, cycle FROM J WHERE ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00' AND user_id IN (1, 2, 3, 5, 8, 13, 21)")
def criteria_time(spark, d):
    return Criteria(since="2024-01-02 00:00:00", until="2024-01-20 12:00:00", users=(1, 2, 3, 5, 8, 13, 21)).apply(journal(spark, d)).select("seq", "ts", "cycle")


# --- ranges and segments --------------------------------------------------

_STARTS = [(1, 0, 1), (2, 0, 700), (3, 2, 2500), (4, 5, 5001)]
_FIND = f"""SELECT start_id, end_rcv, end_seq FROM (
  SELECT s.start_id, R.rcv AS end_rcv, least(R.last_seq, s.seq + {{most}}) AS end_seq, row_number() OVER (PARTITION BY s.start_id ORDER BY R.rcv DESC) AS k
  FROM ({_values(_STARTS)}) s(start_id, rcv, seq) JOIN R ON R.rcv >= s.rcv AND R.first_seq <= s.seq + {{most}} WHERE s.rcv IN (SELECT rcv FROM R)) WHERE k = 1"""


def _starts(spark, r):
    return _rows(spark, "start_id int, rcv long, seq long", _STARTS).join(r.select("rcv"), "rcv", "left_semi")


@query(_FIND.format(most=1700))
def find_range(spark, d):
    r = receivers(spark, d)
    return ranges.find_ranges(_starts(spark, r), r, 1700).select("start_id", "end_rcv", "end_seq")


@query(_FIND.format(most=300))
def find_position(spark, d):
    r = receivers(spark, d)
    return ranges.find_ranges(_starts(spark, r), r, 300).select("start_id", "end_rcv", "end_seq")


_RESTARTS = [(1, 0, 1, True), (2, 0, 700, True), (3, 0, 1000, True), (4, 0, 1000, False), (5, 2, 999, True), (6, 4, 1000, True), (7, 99, 5, True)]


@query(f"""SELECT start_id, CASE WHEN moves THEN rcv + 1 ELSE rcv END AS start_rcv, CASE WHEN moves THEN 1 ELSE s END AS start_seq, CASE WHEN moves THEN rcv + 1 ELSE rcv END AS end_rcv,
  CASE WHEN moves THEN least(400, (SELECT last_rseq FROM R x WHERE x.rcv = q.rcv + 1)) ELSE least(last_rseq, s + 400) END AS end_seq
  FROM (SELECT x.start_id, x.rcv, x.s, R.last_rseq, flag = 1 AND s = R.last_rseq AND R.next_rcv IS NOT NULL AS moves FROM ({_values([(a, b, c, int(x)) for a, b, c, x in _RESTARTS])}) x(start_id, rcv, s, flag) JOIN R ON R.rcv = x.rcv) q""")
def find_range_restarts(spark, d):
    """Ranges over the numbers that restart in each segment: none goes across, one that is done moves behind the restart."""
    return ranges.find_ranges(_rows(spark, "start_id int, rcv long, seq long, processed boolean", _RESTARTS), receivers(spark, d), 400, "first_rseq", "last_rseq")


@query("SELECT rcv, least(last_seq, first_seq + 400) AS end_seq FROM R")
def paginate_same(spark, d):
    return receivers(spark, d).select("rcv", F.least("last_seq", F.col("first_seq") + 400).alias("end_seq"))


@query("SELECT (seq - 1) // 700 AS page, max(rcv) AS end_rcv, max(seq) AS end_seq FROM J GROUP BY 1")
def range_pages(spark, d):
    return ranges.pages(receivers(spark, d), 700)


@query("SELECT rcv, CASE WHEN rcv = (SELECT max(rcv) FROM R) THEN last_seq + 100 ELSE last_seq END AS last_seq FROM R")
def refresh_end(spark, d):
    """Newer metadata of the last segment replaces what the list says."""
    r = receivers(spark, d).select("rcv", "last_seq")
    newest = r.agg(F.max("rcv").alias("rcv"), (F.max("last_seq") + 100).alias("newer"))
    return r.join(F.broadcast(newest), "rcv", "full").select("rcv", F.coalesce("newer", "last_seq").alias("last_seq"))


@query("SELECT rcv, status FROM R WHERE rcv > (SELECT coalesce(max(rcv), -1) FROM R WHERE status NOT IN (1, 2, 3))")
def last_joined(spark, d):
    return chain.last_joined(receivers(spark, d)).select("rcv", "status")


@query(""", links(rcv, chain) AS (
  SELECT rcv, rcv FROM R a WHERE status IN (1, 2, 3) AND NOT EXISTS (SELECT 1 FROM R b WHERE b.next_rcv = a.rcv AND b.status IN (1, 2, 3))
  UNION ALL SELECT c.next_rcv, links.chain FROM links JOIN (SELECT * FROM R) c ON c.rcv = links.rcv JOIN (SELECT * FROM R) n ON n.rcv = c.next_rcv WHERE n.status IN (1, 2, 3)
) SELECT rcv, chain FROM links""")
def receiver_chain(spark, d):
    return chain.chain_numbers(receivers(spark, d))


@query("SELECT a.rcv, b.rcv AS next_rcv, b.first_seq AS next_first FROM R a LEFT JOIN (SELECT * FROM R) b ON a.next_rcv = b.rcv")
def receiver_next(spark, d):
    r = receivers(spark, d)
    other = r.select(F.col("rcv").alias("n"), F.col("first_seq").alias("next_first"))
    return r.join(other, F.col("next_rcv") == F.col("n"), "left").select("rcv", F.col("n").alias("next_rcv"), "next_first")


@query("SELECT rcv, coalesce(first_rseq < lag(last_rseq) OVER (ORDER BY rcv), false) AS restart FROM R")
def reset_detect(spark, d):
    return chain.restarts(receivers(spark, d))


@query("SELECT rcv FROM R WHERE status != 1 AND rcv >= 2")
def cache_prune(spark, d):
    """Of the cached segments, those detached, the ones that a newer list still has: its first two are gone."""
    r = receivers(spark, d)
    return chain.keep_only(chain.cacheable(r), r.where("rcv >= 2")).select("rcv")


@query("SELECT rcv, attached, status FROM R WHERE status != 5 ORDER BY attached DESC")
def receiver_browse(spark, d):
    return receivers(spark, d).where("status != 5").select("rcv", "attached", "status").orderBy(F.desc("attached"))


@query("SELECT ts, code, user_id, seq FROM J ORDER BY ts DESC")
def journal_browse(spark, d):
    return journal(spark, d).select("ts", "code", "user_id", "seq").orderBy(F.desc("ts"))


@query("SELECT last_seq AS seq, CAST(rcv AS VARCHAR) AS receiver, CAST(floor(epoch(attached)) AS BIGINT) AS time, rcv % 2 = 0 AS processed FROM R WHERE rcv % 3 != 0 UNION ALL SELECT NULL, NULL, NULL, false FROM R WHERE rcv % 3 = 0")
def offset_roundtrip(spark, d):
    """Positions as the maps that a checkpoint stores, and back; each third one is blank."""
    seq = F.when(F.col("rcv") % 3 != 0, F.col("last_seq"))
    stored = offsets.stored_map(seq, F.col("attached"), F.col("rcv"), F.col("rcv") % 2 == 0)
    return offsets.loaded(receivers(spark, d).select(stored.alias("stored"))).select(F.col("seq").cast("long").alias("seq"), "receiver", "time", "processed")


# --- the feed -------------------------------------------------------------

_KIND_SQL = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in feed.KINDS.items()) + " END"


@query(f"SELECT seq, code, {_KIND_SQL} AS kind FROM J")
def classify_entries(spark, d):
    return journal(spark, d).select("seq", "code", feed.kind(F.col("code")).alias("kind"))


@query("SELECT seq, code FROM J WHERE code NOT IN ('F.OP', 'F.CL')")
def filter_ignored(spark, d):
    return feed.without_ignored(journal(spark, d)).select("seq", "code")


@query(f"SELECT seq, code, file_no FROM J WHERE file_no IN ({FILES_SQL}) OR code LIKE 'C.%'")
def filter_tables(spark, d):
    return feed.of_tables(journal(spark, d), INCLUDED).select("seq", "code", "file_no")


_PAIRED_SQL = "SELECT seq, file_no, CASE WHEN lc = 'R.UB' THEN lv END AS before, value AS after FROM (SELECT *, lag(code) OVER w AS lc, lag(value) OVER w AS lv FROM J WHERE code IN ('R.UB', 'R.UP') WINDOW w AS (PARTITION BY file_no ORDER BY seq)) WHERE code = 'R.UP'"


@query(_PAIRED_SQL)
def pair_before_after(spark, d):
    return feed.with_before(journal(spark, d)).select("seq", "file_no", "before", F.col("value").alias("after"))


_TX_SQL = "SELECT *, CASE WHEN last_value(CASE WHEN code IN ('C.SC', 'C.CM') THEN code END IGNORE NULLS) OVER (PARTITION BY cycle ORDER BY seq) = 'C.SC' THEN CAST(cycle AS VARCHAR) END AS tx FROM J"


@query(f"SELECT seq, code, tx FROM ({_TX_SQL}) WHERE code IN ('R.PT', 'R.UP', 'R.DL')")
def attach_tx(spark, d):
    return feed.with_transaction(journal(spark, d)).where("code IN ('R.PT', 'R.UP', 'R.DL')").select("seq", "code", "tx")


@query(f"""SELECT t.seq, rcv, ts, t.file_no, CASE code WHEN 'R.PT' THEN 'CREATE' WHEN 'R.UP' THEN 'UPDATE' ELSE 'DELETE' END AS op,
  CASE code WHEN 'R.UP' THEN p.before WHEN 'R.DL' THEN value END AS before, CASE WHEN code != 'R.DL' THEN value END AS after, tx
  FROM ({_TX_SQL}) t LEFT JOIN ({_PAIRED_SQL}) p ON p.seq = t.seq WHERE code IN ('R.PT', 'R.UP', 'R.DL') AND t.file_no IN ({FILES_SQL})""")
def change_events(spark, d):
    return feed.change_events(journal(spark, d), INCLUDED)


@query(f"SELECT tx, file_no, count(*) AS n FROM ({_TX_SQL}) WHERE tx IS NOT NULL AND code IN ('R.PT', 'R.DL') GROUP BY ALL")
def tx_event_counts(spark, d):
    """Inserts and deletes by transaction and table; updates don't count."""
    return feed.with_transaction(journal(spark, d)).where("tx IS NOT NULL AND code IN ('R.PT', 'R.DL')").groupBy("tx", "file_no").agg(F.count("*").alias("n"))


@query("SELECT cycle, min(CASE WHEN code = 'C.SC' THEN seq END) AS began, max(CASE WHEN code = 'C.CM' THEN seq END) AS ended, count(*) AS entries FROM J GROUP BY cycle HAVING count_if(code IN ('C.SC', 'C.CM')) > 0")
def tx_summary(spark, d):
    seq, code = F.col("seq"), F.col("code")
    sums = journal(spark, d).groupBy("cycle").agg(F.min(F.when(code == "C.SC", seq)).alias("began"), F.max(F.when(code == "C.CM", seq)).alias("ended"), F.count("*").alias("entries"))
    return sums.where("began IS NOT NULL OR ended IS NOT NULL")


@query("SELECT seq, file_no, sum(CASE WHEN code IN ('D.CG', 'D.CT') THEN 1 ELSE 0 END) OVER (PARTITION BY file_no ORDER BY seq)::BIGINT AS version FROM J")
def schema_versions(spark, d):
    return feed.schema_versions(journal(spark, d)).select("seq", "file_no", "version")


@query("SELECT rcv, rseq, code FROM J WHERE seq > 500")
def dedupe_resume(spark, d):
    """Two overlapping deliveries, each entry once, known by its segment and its number in it."""
    j = journal(spark, d)
    return offsets.resumed(j.where("seq > 500 AND seq <= 2500").union(j.where("seq > 2000"))).select("rcv", "rseq", "code")


@query("SELECT c_custkey, CASE WHEN c_custkey % 14 = 0 THEN 'length' ELSE 'amount' END AS error FROM customer WHERE c_custkey % 7 = 0")
def dead_letter(spark, d):
    """Records that can't be decoded go aside with the reason: a broken decimal, or cut short."""
    broken = F.when(F.col("c_custkey") % 14 == 0, F.expr("substring(record, 1, 20)")).when(F.col("c_custkey") % 7 == 0, F.concat(F.expr("substring(record, 1, 4)"), F.lit(b"\xee"), F.expr("substring(record, 6)"))).otherwise(F.col("record"))
    decoded = codec.decode_records(_records(spark, d).withColumn("record", broken), FIELDS)
    return codec.with_dead_letters(decoded, ["c_custkey"])[1]


_CUT = "(SELECT max(seq) // 2 FROM J)"


@query(f"SELECT c_custkey AS key, 'READ' AS op, {_CUT} AS seq FROM customer UNION ALL SELECT user_id, 'CHANGE', seq FROM J WHERE code IN ('R.PT', 'R.UP', 'R.DL') AND seq > {_CUT}")
def snapshot_stream_merge(spark, d):
    """A snapshot at a cut, then the changes behind it."""
    j = journal(spark, d)
    changed = j.where("code IN ('R.PT', 'R.UP', 'R.DL')").withColumn("key", F.col("user_id"))
    return first_image.with_feed(table(spark, d, "customer"), changed, "c_custkey", j.agg(F.expr("max(seq) div 2").alias("cut")))


@query(f"SELECT file_no, arg_max(after, seq) AS value FROM (SELECT seq, file_no, code, value AS after FROM J WHERE code IN ('R.PT', 'R.UP', 'R.DL')) GROUP BY file_no HAVING arg_max(code, seq) != 'R.DL'")
def latest_state(spark, d):
    return feed.latest_state(feed.change_events(journal(spark, d)))


_POSITIONS = [(0, 1), (0, 750), (2, 1000), (3, 17), (99, 1)]


@query(f"SELECT p.rcv, p.rseq, CASE WHEN p.rcv IN (SELECT rcv FROM R) THEN (SELECT count(*) FROM J WHERE J.rcv > p.rcv OR J.rcv = p.rcv AND J.rseq > p.rseq) END AS behind FROM ({_values(_POSITIONS)}) p(rcv, rseq)")
def lag_metrics(spark, d):
    """Entries behind a position, counted by segment; none of a segment that is gone."""
    return chain.behind(receivers(spark, d), _rows(spark, "rcv long, rseq long", _POSITIONS))


@query("SELECT 'RCV' || lpad(CAST(rcv AS VARCHAR), 5, '0') AS receiver, (46 + 8 - 1 + 32 + count(*) * 219)::BIGINT AS bytes, sum(46 + 8 - 1 + 32 + count(*) * 219) OVER (ORDER BY rcv)::BIGINT AS total FROM J GROUP BY rcv")
def bytes_transferred(spark, d):
    """Bytes of each block, by its own header, and in all."""
    sizes = _first_headers(spark, d).select("receiver", F.col("total_bytes").cast("long").alias("bytes")).withColumn("_k", F.substring("receiver", 4, 5).cast("long"))
    return running(sizes, "_k", {"total": F.col("bytes")}).select("receiver", "bytes", "total")


# --- names, columns, catalogue --------------------------------------------

_NAMES = [("F1", "CUSTOMER_ACCOUNTS"), ("F2", "ORDER_LINES"), ("F5", "PRICE_HISTORY")]
_COLUMNS = [("LIB", "F1", "ID", 1, 37, 10, 10), ("LIB", "F1", "NAME", 2, 285, 40, 20), ("LIB", "F2", "ID", 1, None, 8, 0), ("LIB", "F5", "TEXT", 3, 13488, 20, 10)]
_COLUMNS_DDL = "schema string, `table` string, `column` string, place int, ccsid int, octets int, length int"
_COLUMNS_SQL = f"({_values(_COLUMNS)}) c(\"schema\", \"table\", \"column\", place, ccsid, octets, length)"
_KEYS = [("LIB", "F1", "ID"), ("LIB", "F2", "ID"), ("LIB", "F9", "ID")]


@query("SELECT seq, rtrim('F' || file_no) AS file, 'LIB' AS library, 'M' || (seq % 3) AS member FROM J")
def split_object(spark, d):
    """File, library and member out of the 30 characters of an object name."""
    name = F.concat(F.rpad(F.concat(F.lit("F"), F.col("file_no").cast("string")), 10, " "), F.rpad(F.lit("LIB"), 10, " "), F.rpad(F.concat(F.lit("M"), (F.col("seq") % 3).cast("string")), 10, " "))
    return journal(spark, d).select("seq", *fn.object_parts(name))


@query(f"SELECT file_no, coalesce(n.long_name, 'F' || file_no) AS long_name, count(*) AS n FROM J LEFT JOIN ({_values(_NAMES)}) n(system_name, long_name) ON n.system_name = 'F' || file_no GROUP BY ALL")
def resolve_names(spark, d):
    by = journal(spark, d).groupBy("file_no").agg(F.count("*").alias("n")).withColumn("system_name", F.concat(F.lit("F"), F.col("file_no").cast("string")))
    return catalog_tables.long_names(by, _rows(spark, "system_name string, long_name string", _NAMES)).select("file_no", "long_name", "n")


@query(f"""SELECT p_type AS long_name, coalesce(n.system_name, CASE WHEN length(p_type) <= 10 THEN p_type END) AS system_name FROM (SELECT DISTINCT p_type FROM part) LEFT JOIN
  ({_values([("PROMO", "P1"), ("ECONOMY ANODIZED STEEL", "P2")])}) n(long_name, system_name) ON n.long_name = p_type""")
def resolve_system_names(spark, d):
    """From long names to system names; one that is too long to be one, and unknown, has none."""
    names = _rows(spark, "schema string, long_name string, system_name string", [("LIB", "PROMO", "P1"), ("LIB", "ECONOMY ANODIZED STEEL", "P2"), ("OTHER", "SMALL", "P3")])
    asked = table(spark, d, "part").select(F.lit("LIB").alias("schema"), F.col("p_type").alias("long_name")).distinct()
    return catalog_tables.system_names(asked, names).select("long_name", "system_name")


@query(f"SELECT seq, c.\"column\", place FROM J LEFT JOIN {_COLUMNS_SQL} ON c.\"table\" = 'F' || file_no WHERE code = 'R.PT'")
def attach_schema(spark, d):
    cols = _rows(spark, _COLUMNS_DDL, _COLUMNS).select("table", "column", "place")
    j = journal(spark, d).where("code = 'R.PT'").withColumn("table", F.concat(F.lit("F"), F.col("file_no").cast("string")))
    return j.join(cols, "table", "left").select("seq", "column", "place")


@query(f"SELECT c.\"table\", c.\"column\", place FROM {_COLUMNS_SQL} JOIN ({_values(_KEYS)}) k(s, t, col) ON k.s = c.\"schema\" AND k.t = c.\"table\" AND k.col = c.\"column\"")
def key_columns(spark, d):
    keys = _rows(spark, "schema string, `table` string, `column` string", _KEYS)
    return _rows(spark, _COLUMNS_DDL, _COLUMNS).join(keys, ["schema", "table", "column"]).select("table", "column", "place").orderBy("table", "place")


@query(f"SELECT c.\"table\", c.\"column\", CASE coalesce(ccsid, -1) WHEN 37 THEN 1146 ELSE coalesce(ccsid, -1) END AS ccsid FROM {_COLUMNS_SQL}")
def ccsid_lookup(spark, d):
    known = _rows(spark, _COLUMNS_DDL, _COLUMNS)
    given = known.select("schema", F.col("table").alias("system_name"), F.col("table").alias("long_name"), "column", "ccsid")
    return catalog_tables.code_pages(known.select("schema", "table", "column"), given, 37, 1146).select("table", "column", "ccsid")


@query(f"SELECT c.\"table\", c.\"column\", greatest(1, coalesce(octets // nullif(length, 0), 1)) AS bytes_per_char FROM {_COLUMNS_SQL}")
def bytes_per_char(spark, d):
    return catalog_tables.bytes_per_char(_rows(spark, _COLUMNS_DDL, _COLUMNS)).select("table", "column", "bytes_per_char")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def project_columns(spark, d):
    """A table without the columns that a list of patterns leaves out."""
    return catalog_tables.without_columns(table(spark, d, "orders"), ["o_cust.*", "o_order(status|date)"])


_INCLUDES = [("db.app.orders, app.items,parts",), ("app.audit",)]


@query("SELECT * FROM (VALUES ('app', 'orders'), ('app', 'items'), ('main', 'parts'), ('app', 'audit')) t(\"schema\", \"table\")")
def parse_includes(spark, d):
    return catalog_tables.parse_includes(_rows(spark, "includes string", _INCLUDES), "main")


@query("SELECT * FROM (VALUES ('app', 'orders', 'orders'), ('app', 'items', 'items'), ('main', 'parts', 'parts'), ('app', 'customer_accounts', 'CUST1')) t(\"schema\", \"table\", system_name)")
def short_includes(spark, d):
    """Included tables by their system names; one that has none is dropped."""
    names = _rows(spark, "schema string, long_name string, system_name string", [("app", "customer_accounts", "CUST1")])
    listed = _rows(spark, "includes string", [("db.app.orders, app.items,parts",), ("app.customer_accounts, app.unknown_long_name, ",), (None,)])
    return catalog_tables.short_includes(listed, names, "main")


@query("SELECT * FROM (VALUES ('b.new'), ('c.other')) t(item)")
def new_tables(spark, d):
    """Tables that the new include list has and the old one hadn't."""
    listed = lambda text: _rows(spark, "includes string", [(text,)])
    return first_image.new_tables(listed("a.one"), listed("a.one, b.new, c.other"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 4 NOT IN (0, 1)")
def filter_system(spark, d):
    """Tables outside the system's schemas, in whatever letters these are written."""
    schema = F.element_at(F.array(*map(F.lit, ("QSYS", "qsys2", "app", "QGPL"))), (F.col("c_custkey") % 4 + 1).cast("int")).alias("schema")
    return first_image.user_schemas(table(spark, d, "customer").select("c_custkey", "c_name", schema)).drop("schema")


@query(f"SELECT DISTINCT 'F' || file_no AS \"table\" FROM J WHERE file_no IN ({FILES_SQL}) AND file_no < 7 ORDER BY 1")
def captured_tables(spark, d):
    """All tables that are both requested and let through by the filter."""
    name = F.concat(F.lit("F"), F.col("file_no").cast("string")).alias("table")
    j = journal(spark, d)
    return first_image.captured(j.select(name), j.where(F.col("file_no").isin(INCLUDED)).select(name), lambda t: t < "F7")


_KINDS = [("DECIMAL", 9, 2), ("NUMERIC", 5, 0), ("SMALLINT", 2, 0), ("VARCHAR", 20, 0), ("CHAR () FOR BIT DATA", 10, 0), ("VARCHAR (20) FOR BIT DATA", 20, 0), ("TIMESTAMP", 26, 0), ("DATALINK", 9, 0), ("DOUBLE", 8, 0), ("XML", 44, 0)]


@query(f"""SELECT name, CASE WHEN name LIKE '%FOR BIT DATA' THEN 'binary' WHEN name IN ('DECIMAL', 'NUMERIC') THEN 'decimal(' || len || ',' || scale || ')' WHEN name = 'SMALLINT' THEN 'smallint' WHEN name IN ('VARCHAR', 'XML') THEN 'string'
  WHEN name = 'TIMESTAMP' THEN 'timestamp_ntz' WHEN name = 'DOUBLE' THEN 'double' END AS spark_type FROM ({_values(_KINDS)}) t(name, len, scale)""")
def type_map(spark, d):
    return _rows(spark, "name string, len int, scale int", _KINDS).select("name", catalog_tables.spark_type(F.col("name"), F.col("len"), F.col("scale")).alias("spark_type"))


_MODES = [("initial", True, False), ("initial", True, True), ("initial", False, False), ("schema_only", False, False), ("when_needed", False, True), ("never", False, False)]


@query(f"SELECT mode, done, added, CASE WHEN done AND NOT added THEN 'skip' WHEN mode IN ('initial', 'when_needed') THEN 'data' ELSE 'schema' END AS task FROM ({_values([(a, str(b).lower() == 'true', c) for a, b, c in _MODES])}) t(mode, done, added)")
def snapshot_mode(spark, d):
    rows = _rows(spark, "mode string, done boolean, added boolean", _MODES)
    return rows.withColumn("task", first_image.task(F.col("done"), F.col("added"), F.col("mode")))


# --- functions ------------------------------------------------------------


@query("SELECT c_custkey, rpad(c_name, 10, ' ') AS short_right, lpad(c_name, 24, ' ') AS long_left, CASE WHEN length(c_name) >= 12 THEN c_name ELSE rpad(c_name, 12, ' ') END AS whole FROM customer")
def fn_pad(spark, d):
    c = F.col("c_name")
    return table(spark, d, "customer").select("c_custkey", fn.pad_right(c, 10).alias("short_right"), fn.pad_left(c, 24).alias("long_left"), fn.pad_right_whole(c, 12).alias("whole"))


@query("SELECT c_custkey, c_name AS trimmed FROM customer")
def fn_trim(spark, d):
    dirty = F.concat(F.lit("\t \x01"), F.col("c_name"), F.lit(" \r\n"))
    return table(spark, d, "customer").select("c_custkey", fn.trim_controls(dirty).alias("trimmed"))


@query("SELECT page_id, trim(regexp_replace(html, '[\\p{Cc}\\p{Cf}\\p{Co}]', '?', 'g')) AS cleaned FROM pages")
def fn_clean_text(spark, d):
    return table(spark, d, "pages").select("page_id", fn.clean_text(F.col("html")).alias("cleaned"))


@query("SELECT p_partkey, list_aggregate(list_transform(list_filter(string_split(upper(replace(p_type, ' ', '_')), '_'), lambda x: x != ''), lambda x: upper(x[1:1]) || lower(x[2:])), 'string_agg', '') AS camel FROM part")
def fn_camel(spark, d):
    return table(spark, d, "part").select("p_partkey", fn.camel(F.upper(F.regexp_replace("p_type", " ", "_"))).alias("camel"))


@query("SELECT p_partkey, upper(p_name[1:1]) || lower(p_name[2:]) AS capital FROM part")
def fn_capitalize(spark, d):
    return table(spark, d, "part").select("p_partkey", fn.capitalize(F.col("p_name")).alias("capital"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 != 0 THEN strftime(date_trunc('second', o_orderdate), '%Y-%m-%d %H:%M:%S') END AS attached FROM orders")
def fn_cyymmdd(spark, d):
    text = F.concat((F.year("o_orderdate") >= 2000).cast("int").cast("string"), F.date_format("o_orderdate", "yyMMddHHmmss"))
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "broken").otherwise(text).alias("t"))
    return o.select("o_orderkey", F.date_format(fn.attach_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("attached"))


@query("SELECT seq, CASE WHEN seq % 3 != 0 THEN CAST(left(lpad(CAST(seq % 100000 AS VARCHAR), 5, '0'), 2) AS INT) END AS chain FROM J")
def fn_chain(spark, d):
    five = F.lpad((F.col("seq") % 100000).cast("string"), 5, "0")
    return journal(spark, d).select("seq", fn.chain_number(F.when(F.col("seq") % 3 == 0, "12").otherwise(five)).alias("chain"))


@query("SELECT o_orderkey, o_orderkey AS decoded FROM orders")
def fn_binary_int(spark, d):
    raw = F.unhex(F.lpad(F.hex("o_orderkey"), 8, "0"))
    return table(spark, d, "orders").select("o_orderkey", fn.big_endian(raw).alias("decoded"))


@query("SELECT c_custkey, c_name AS text, c_custkey - 500 AS signed, CAST(c_custkey AS BIGINT) * 1000000007 AS big FROM customer")
def fn_binary(spark, d):
    """Text of page 37, a signed number of four bytes, a number in twenty digits."""
    ship(spark)

    def stored(batches):
        import pyarrow as pa

        for b in batches:
            rows = [(codec.encode_text(n.ljust(30), 37), (k - 500).to_bytes(4, "big", signed=True), str(k * 1000000007).rjust(20, "0")) for k, n in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.record_batch([b.column(0), *map(pa.array, zip(*rows, strict=True))], names=["c_custkey", "t", "n", "z"])

    raw = table(spark, d, "customer").select("c_custkey", "c_name").mapInArrow(stored, "c_custkey long, t binary, n binary, z string")
    return raw.select("c_custkey", fn.ebcdic(F.col("t")).alias("text"), fn.signed_big_endian(F.col("n"), 4).alias("signed"), fn.big_number(F.col("z")).cast("long").alias("big"))


@query("SELECT c_custkey, hex(c_name) AS dump FROM customer")
def fn_hex(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.hex(F.encode("c_name", "UTF-8")).alias("dump"))


@query("SELECT rcv, CASE status WHEN 1 THEN 'Attached' WHEN 2 THEN 'OnlineSavedDetached' WHEN 5 THEN 'Partial' END AS status FROM R")
def fn_status(spark, d):
    return receivers(spark, d).select("rcv", chain.status_name(F.col("status")).alias("status"))


_DEFAULTS = [("DATE", "'2020-01-02'"), ("TIMESTAMP", "2020-01-02-03.04.05.000006"), ("DECIMAL", "1.005"), ("DECIMAL", "x"), ("INTEGER", " 12 "), ("CHAR", "'abc'"), ("TIMESTAMP", "CURRENT_TIMESTAMP"), ("BOOLEAN", "1"), ("CHAR", "NULL"), ("TIME", "'03.04.05'"), ("NUMERIC", "-2.345"), ("VARBINARY", "'ab'"), ("BIGINT", "9000000000"), ("DOUBLE", "1.5")]
_PARSED = ["18263", "1577934245", "1.01", None, "12", "abc", None, "true", None, "11045", "-2.35", "6162", "9000000000", "1.5"]


@query(f"SELECT * FROM ({_values([(*a, b) for a, b in zip(_DEFAULTS, _PARSED, strict=True)])}) t(kind, raw, parsed)")
def fn_default_value(spark, d):
    return _rows(spark, "kind string, raw string", _DEFAULTS).withColumn("parsed", fn.default_value(F.col("kind"), F.col("raw")))


@query("SELECT DISTINCT file_no, 'host.LIB.F' || file_no AS topic FROM J")
def fn_topic(spark, d):
    return journal(spark, d).select("file_no").distinct().withColumn("topic", fn.topic("host", [F.lit("LIB"), F.concat(F.lit("F"), F.col("file_no").cast("string"))]))


# --- binary records -------------------------------------------------------

FIELDS = [
    codec.Field("id", "integer"), codec.Field("amount", "packed", 9, 2), codec.Field("rate", "zoned", 5, 3), codec.Field("name", "char", 25), codec.Field("note", "varchar", 20, ccsid=285), codec.Field("ratio", "double"),
    codec.Field("wide", "varchar", 25, ccsid=13488), codec.Field("day", "date"), codec.Field("clock", "time"), codec.Field("moment", "timestamp"), codec.Field("picture", "xml"), codec.Field("raw", "varbinary", 4),
]


def _records(spark, d):
    """Customers as fixed-layout records."""
    import datetime as dt

    import pyarrow as pa

    ship(spark)

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                k = r["c_custkey"]
                at = dt.datetime(2000, 1, 1) + dt.timedelta(days=k, hours=k % 24, seconds=k, microseconds=k % 1000)
                row = {"id": k, "amount": round(r["c_acctbal"], 2), "rate": 1.5, "name": r["c_name"], "note": r["c_mktsegment"], "ratio": r["c_acctbal"], "wide": r["c_name"], "day": at, "clock": at, "moment": at, "picture": "", "raw": bytes([k % 256])}
                row |= {k: codec.Decimal(str(row[k])) for k in ("amount", "rate")}
                out.append(codec.encode_record(FIELDS, row))
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], names=["c_custkey", "record"])

    return table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_name", "c_mktsegment").mapInArrow(run, "c_custkey long, record binary")


_AT = "(TIMESTAMP '2000-01-01' + to_days(CAST(c_custkey AS INT)) + to_hours(c_custkey % 24) + to_seconds(c_custkey) + to_microseconds(c_custkey % 1000))"


@query(f"""SELECT CAST(c_custkey AS INT) AS id, round(c_acctbal, 2) AS amount, CAST(1.5 AS DOUBLE) AS rate, rpad(c_name, 25, ' ') AS name, c_mktsegment AS note, c_acctbal AS ratio, c_name AS wide, strftime({_AT}, '%Y-%m-%d') AS day,
  strftime({_AT}, '%H:%M:%S') AS clock, strftime({_AT}, '%Y-%m-%d %H:%M:%S.%f') AS moment, '' AS picture, lpad(hex(c_custkey % 256), 2, '0') AS raw, CAST(NULL AS VARCHAR) AS decode_error FROM customer""")
def decode_row(spark, d):
    rows = codec.decode_records(_records(spark, d).select("record"), FIELDS)
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ("amount", "rate")} | {"day": F.col("day").cast("string"), "raw": F.hex("raw")})
    return rows.withColumn("moment", F.date_format("moment", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _blocks(spark, d):
    """The journal as binary blocks of one segment each; the first entry names its segment."""
    import pandas as pd

    ship(spark)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        name = f"RCV{pdf['rcv'].iat[0]:05}"
        rows = zip(pdf["seq"], pdf["cycle"], pdf["code"], pdf["file_no"], strict=True)
        entries = [codec.encode_entry({"sequence": s, "commit_cycle": c}, {"journal_code": k[0], "entry_type": k[2:], "object": f"{'F' + str(f):10}{'LIB':10}{'MEM':10}"}, None if i else (name, "LIB")) for i, (s, c, k, f) in enumerate(rows)]
        return pd.DataFrame({"block": [codec.encode_block(entries, False, name, "LIB", int(pdf["seq"].iat[-1]))]})

    return journal(spark, d).select("rcv", "seq", "cycle", "code", "file_no").groupBy("rcv").applyInPandas(run, "block binary")


def _first_headers(spark, d):
    import pandas as pd

    @F.pandas_udf("receiver string, entries int, seq long, total_bytes int")
    def first(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(h["receiver"], h["entries"], h["sequence"], h["total_bytes"]) for h in map(codec.decode_first, x)], columns=["receiver", "entries", "seq", "total_bytes"])

    return _blocks(spark, d).select(first("block").alias("h")).select("h.*")


@query("SELECT 'RCV' || lpad(CAST(rcv AS VARCHAR), 5, '0') AS receiver, CAST(count(*) AS INT) AS entries, max(seq) AS seq, CAST(46 + 8 - 1 + 32 + count(*) * 219 AS INT) AS total_bytes FROM J GROUP BY rcv")
def decode_first_header(spark, d):
    return _first_headers(spark, d)


@query("""SELECT seq AS sequence, cycle AS commit_cycle, code, 'F' || rpad(CAST(file_no AS VARCHAR), 9, ' ') || 'LIB       MEM' AS object, '' AS job, '' AS "user",
  CASE WHEN rseq = min(rseq) OVER (PARTITION BY rcv) THEN 'RCV' || lpad(CAST(rcv AS VARCHAR), 5, '0') END AS receiver, CASE WHEN rseq = min(rseq) OVER (PARTITION BY rcv) THEN 'LIB' END AS library FROM J""")
def decode_entry_header(spark, d):
    return codec.explode_blocks(_blocks(spark, d))


@query("SELECT 'RCV' || lpad(CAST(rcv AS VARCHAR), 5, '0') AS name, 'LIB' AS library, strftime(date_trunc('second', attached), '%Y-%m-%d %H:%M:%S') AS attached, status, CAST((rcv // 10) % 100 AS INT) AS chain FROM R")
def decode_receiver_info(spark, d):
    """Lists of receivers as bytes, and their entries."""
    import pandas as pd

    ship(spark)

    @F.pandas_udf("binary")
    def listed(rcv: pd.Series, status: pd.Series, attached: pd.Series) -> pd.Series:
        row = lambda r, s, a: {"name": f"RCV{r:05}", "library": "LIB", "number": f"{r // 10 % 100:02}000", "attached": f"{a.year // 100 - 19}{a:%y%m%d%H%M%S}", "status": s, "size": 1}
        return pd.Series([codec.encode_receivers([row(*x)]) for x in zip(rcv, status, attached, strict=True)])

    lists = receivers(spark, d).select(listed("rcv", "status", "attached").alias("receivers"))
    return codec.explode_receivers(lists).withColumn("attached", F.date_format("attached", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def null_overlay(spark, d):
    """An indicator of 1 makes a field null; 0 and 9 leave it."""
    c = table(spark, d, "customer").withColumn("_null", F.when(F.col("c_custkey") % 3 == 1, F.array(F.lit(1), F.lit(0))).when(F.col("c_custkey") % 3 == 2, F.array(F.lit(9), F.lit(1))).otherwise(F.array(F.lit(0), F.lit(9))))
    return c.select("c_custkey", *(F.when(F.element_at("_null", i) != 1, F.col(n)).alias(n) for i, n in ((1, "c_name"), (2, "c_acctbal"))))


@query("SELECT c_custkey, c_name AS decoded FROM customer")
def decode_varchar(spark, d):
    """A two-byte count, the bytes, and padding."""
    raw = F.concat(F.unhex(F.lpad(F.hex(F.length("c_name")), 4, "0")), F.encode("c_name", "UTF-8"), F.unhex(F.lit("0000")))
    x = table(spark, d, "customer").select("c_custkey", raw.alias("x"))
    return x.select("c_custkey", F.decode(F.expr("substring(x, 3, cast(conv(hex(substring(x, 1, 2)), 16, 10) as int))"), "UTF-8").alias("decoded"))


_SIGNS = "£$[^~¢¯"


@query(f"SELECT c_custkey, translate('{_SIGNS}' || c_name, '{_SIGNS}', '$¢£[¯^~') AS declared, '{_SIGNS}' || c_name AS actual FROM customer")
def ccsid_override(spark, d):
    """Text stored in page 1146 in a column that declares page 37, read as declared and as stored."""
    ship(spark)
    field = codec.Field("text", "varchar", 40, ccsid=37)

    def stored(batches):
        import pyarrow as pa

        for b in batches:
            rows = [(len(_SIGNS + n).to_bytes(2, "big") + codec.encode_text(_SIGNS + n, 1146)).ljust(field.size, b"\0") for n in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(rows, pa.binary())], names=["c_custkey", "record"])

    rows = table(spark, d, "customer").select("c_custkey", "c_name").mapInArrow(stored, "c_custkey long, record binary")
    read = lambda name, override: codec.decode_records(rows, [field], override=override).select("c_custkey", F.col("text").alias(name))
    return read("declared", None).join(read("actual", (37, 1146)), "c_custkey")


@query("SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string')) t(place, name, kind)")
def schema_roundtrip(spark, d):
    """A schema as catalogue rows, and from them as a schema again."""
    back = catalog_tables.struct_of(catalog_tables.catalogue_of(table(spark, d, "orders").schema))
    return _rows(spark, "place int, name string, kind string", [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(back)])


# --- record transforms ----------------------------------------------------


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def smt_lowercase(spark, d):
    n = table(spark, d, "nation")
    return transforms.lower_case_all(n.toDF(*(c.upper() for c in n.columns)), "com.foo.Nation")[0]


@query("SELECT DISTINCT 'Db.LIB.' || upper(replace(p_type, ' ', '_')) AS topic, 'myschema.' || lower(replace(p_type, ' ', '_')) AS moved FROM part")
def smt_topic(spark, d):
    """Topics of tables under another prefix."""
    topics = table(spark, d, "part").select(F.concat(F.lit("Db.LIB."), F.upper(F.regexp_replace("p_type", " ", "_"))).alias("was")).distinct().withColumn("topic", F.col("was"))
    return transforms.TopicRePrefix("myschema")(topics).select(F.col("was").alias("topic"), F.col("topic").alias("moved"))


_CAMEL_SQL = "list_aggregate(list_transform(list_filter(string_split(upper(replace(p_type, ' ', '_')), '_'), lambda x: x != ''), lambda x: upper(x[1:1]) || lower(x[2:])), 'string_agg', '')"


@query(f"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'com.acme.' || {_CAMEL_SQL} || 'Key' WHEN 1 THEN 'com.acme.' || {_CAMEL_SQL} || 'Value' ELSE 'db.' || upper(replace(p_type, ' ', '_')) END AS renamed FROM part")
def smt_repackage(spark, d):
    """Schema names of keys and values as names of a package; others stay."""
    t, k = F.upper(F.regexp_replace("p_type", " ", "_")), F.col("p_partkey") % 3
    name = F.when(k == 0, F.concat(F.lit("db.com.schema."), t, F.lit(".Key"))).when(k == 1, F.concat(F.lit("db.com.schema."), t, F.lit(".Value"))).otherwise(F.concat(F.lit("db."), t))
    return table(spark, d, "part").select("p_partkey", fn.schema_name(name, "com.acme").alias("renamed"))


@query("SELECT seq, value, code = 'R.DL' AS __deleted FROM J WHERE code IN ('R.PT', 'R.UP', 'R.DL')")
def unwrap_rewrite(spark, d):
    """Events flattened to their newest image, deletes marked."""
    return feed.change_events(journal(spark, d)).select("seq", F.coalesce("after", "before").alias("value"), (F.col("op") == "DELETE").alias("__deleted"))


_EVENTS_SQL = f"""SELECT t.seq, CASE code WHEN 'R.PT' THEN 'CREATE' WHEN 'R.UP' THEN 'UPDATE' ELSE 'DELETE' END AS op,
  CASE code WHEN 'R.UP' THEN p.before WHEN 'R.DL' THEN value END AS before, CASE WHEN code != 'R.DL' THEN value END AS after, tx
  FROM ({_TX_SQL}) t LEFT JOIN ({_PAIRED_SQL}) p ON p.seq = t.seq WHERE code IN ('R.PT', 'R.UP', 'R.DL') AND t.file_no IN ({FILES_SQL})"""


def _sunk(spark, d, kind):
    """Events written in a format and read again."""
    path = fresh_path(spark, f"sink-{kind}")
    events = feed.change_events(journal(spark, d), INCLUDED).select("seq", "op", "before", "after", "tx")
    feeds.write_events(events, kind, path)
    return spark.read.schema(events.schema).format(kind).load(path)


@query(_EVENTS_SQL)
def sink_json(spark, d):
    return _sunk(spark, d, "json")


@query(_EVENTS_SQL)
def sink_csv(spark, d):
    return _sunk(spark, d, "csv")


@query(_EVENTS_SQL)
def sink_orc(spark, d):
    return _sunk(spark, d, "orc")


# --- health, logs, streams ------------------------------------------------

_STATES = [("c1", 200, "RUNNING", "RUNNING"), ("c1", 200, "RUNNING", "UNASSIGNED"), ("c2", 200, "RUNNING", "FAILED"), ("c3", 500, "RUNNING", "RUNNING")]


@query(f"SELECT connector, bool_and(http = 200 AND state IN ('RUNNING', 'UNASSIGNED') AND task IN ('RUNNING', 'UNASSIGNED')) AS ok FROM ({_values(_STATES)}) t(connector, http, state, task) GROUP BY 1")
def health_rollup(spark, d):
    return health.health(_rows(spark, "connector string, http int, state string, task string", _STATES))


@query("""SELECT '{"message":"segment read","data":{"rcv":' || rcv || ',"entries":' || entries || '}}' AS line FROM R""")
def structured_log(spark, d):
    return receivers(spark, d).select(health.log_line("segment read", rcv=F.col("rcv"), entries=F.col("entries")).alias("line"))


@query(_PAIRED_SQL)
def stream_pair(spark, d):
    return changes.run_to_end(changes.pair_stream(changes.as_stream(journal(spark, d))), "pairs")


@query(f"SELECT seq, tx FROM ({_TX_SQL}) WHERE code IN ('R.PT', 'R.UP', 'R.DL')")
def stream_tx(spark, d):
    return changes.run_to_end(changes.transaction_stream(changes.as_stream(journal(spark, d))), "transactions")


@query(f"SELECT seq, code, {_KIND_SQL} AS kind FROM J WHERE code NOT IN ('F.OP', 'F.CL')")
def stream_changes(spark, d):
    s = feed.without_ignored(changes.as_stream(journal(spark, d)))
    return changes.run_to_end(s.select("seq", "code", feed.kind(F.col("code")).alias("kind")), "changes")


@query("SELECT rcv, rseq FROM J")
def data_loss_policy(spark, d):
    """A position in a segment that is gone: with 'reset' reading starts again at the head of the chain; 'fail' stops."""
    lost = spark.read.format("journal").option("path", _segment_files(spark, d)).option("startSegment", "seg-99999.json").option("startSeq", 5)
    return lost.option("onDataLoss", "reset").load().selectExpr(*_OF_FILES)


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS began, code, count(*) AS n FROM J GROUP BY ALL")
def windowed_counts(spark, d):
    """Entries by kind in tumbling windows of entry time."""
    return changes.windowed(journal(spark, d)).select(F.col("window.start").cast("timestamp_ntz").alias("began"), "code", "n")
