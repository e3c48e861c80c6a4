"""From journal entries to change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Journal code and entry type to kind. R.DR is the undoing of a delete.
KINDS = {
    "R.PT": "ADD_ROW", "R.PX": "ADD_ROW_RRN", "R.UB": "BEFORE_IMAGE", "R.UP": "AFTER_IMAGE", "R.DL": "DELETE_ROW", "R.DR": "ROLLBACK_DELETE_ROW", "R.BR": "ROLLBACK_BEFORE_IMAGE",
    "R.UR": "ROLLBACK_AFTER_IMAGE", "D.CG": "FILE_CHANGE", "D.CT": "FILE_CREATED", "F.OP": "OPEN", "F.CL": "CLOSE", "C.SC": "START_COMMIT", "C.CM": "END_COMMIT",
}
IGNORED = ("F.OP", "F.CL")
OPERATIONS = {"R.PT": "CREATE", "R.PX": "CREATE", "R.UP": "UPDATE", "R.DL": "DELETE"}


def kind(code: Column) -> Column:
    """Kind of an entry; null of an unknown code."""
    return F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[code]


def without_ignored(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("code").isin(*(c for c in KINDS if c not in IGNORED)))


def of_tables(entries: DataFrame, files: list[int]) -> DataFrame:
    """Entries of the included tables, and commit entries, which concern no table."""
    return entries.where(F.col("file_no").isin(*files) | F.col("code").startswith("C."))


def with_before(entries: DataFrame, keys: tuple[str, ...] = ("file_no",)) -> DataFrame:
    """After-images with the before-image directly ahead of them; a table holds one at a time, and a use clears it.

    ``keys``: other columns, such as the row's number, to pair interleaved updates.
    """
    w = Window.partitionBy(*keys).orderBy("seq")
    images = entries.where(F.col("code").isin("R.UB", "R.UP"))
    images = images.withColumn("before", F.when(F.lag("code").over(w) == "R.UB", F.lag("value").over(w)))
    return images.where("code = 'R.UP'")


def with_transaction(entries: DataFrame) -> DataFrame:
    """``tx``: the commit cycle if it is open, that is, if its last commit entry so far starts it."""
    w = Window.partitionBy("cycle").orderBy("seq")
    mark = F.last(F.when(F.col("code").isin("C.SC", "C.CM"), F.col("code")), ignorenulls=True).over(w)
    return entries.withColumn("tx", F.when(mark == "C.SC", F.col("cycle").cast("string")))


def change_events(entries: DataFrame, files: list[int] | None = None, keys: tuple[str, ...] = ("file_no",)) -> DataFrame:
    """Inserts, updates and deletes with row images and transaction; everything that undoes is dropped.

    Two windows: one over commit cycles; one over images by ``keys``, as in with_before(). Inserts
    and deletes are spread by their numbers there, as they need no neighbour.
    """
    wanted = without_ignored(entries)
    wanted = of_tables(wanted, files) if files else wanted
    tagged = with_transaction(wanted).where(F.col("code").isin("R.UB", *OPERATIONS))
    alone = F.when(~F.col("code").isin("R.UB", "R.UP"), F.col("seq"))
    w = Window.partitionBy(*keys, alone).orderBy("seq")
    paired = tagged.withColumn("_held", F.when(F.lag("code").over(w) == "R.UB", F.lag("value").over(w)))
    op = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])[F.col("code")]
    before = F.when(F.col("code") == "R.UP", F.col("_held")).when(F.col("code") == "R.DL", F.col("value"))
    after = F.when(F.col("code") != "R.DL", F.col("value"))
    return paired.where("code != 'R.UB'").select("seq", "rcv", "ts", "file_no", op.alias("op"), before.alias("before"), after.alias("after"), "tx")


def schema_versions(entries: DataFrame) -> DataFrame:
    """``version``: how often the table's structure has changed so far."""
    w = Window.partitionBy("file_no").orderBy("seq")
    return entries.withColumn("version", F.sum(F.col("code").isin("D.CG", "D.CT").cast("long")).over(w))


def latest_state(changes: DataFrame, key: str = "file_no") -> DataFrame:
    """The newest image of each key, deleted keys left out: one partial and one final aggregate."""
    newest = changes.groupBy(key).agg(F.max_by(F.struct("op", "after"), "seq").alias("x"))
    return newest.where("x.op != 'DELETE'").select(key, F.col("x.after").alias("value"))
