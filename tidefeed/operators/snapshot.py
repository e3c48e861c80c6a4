"""The first image of the tables: which ones, what of them, and the cut between it and the feed."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SYSTEM = ("QSYS", "QSYS2")


class NoJournal(Exception):
    """The tables don't share exactly one journal in the schema."""


def discover(journals: DataFrame, schema: str, tables: list[str]) -> DataFrame:
    """``(jrn, lib)`` of ``journals(sch, tab, jrn, lib)`` that the tables share; without tables, that of the schema. NoJournal unless it is one."""
    asked = journals.where(F.col("sch") == schema)
    asked = asked.where(F.col("tab").isin(*tables)) if tables else asked
    found = asked.select("jrn", "lib").distinct()
    known = asked.select("tab").distinct()
    n, m = found.count(), known.count()
    if n != 1 or (tables and m != len(set(tables))):
        raise NoJournal(f"{n} journals of {m} tables in {schema}")
    return found


def tables_of(spark: SparkSession, schema: str | None = None, prefix: str = "", kinds: tuple[str, ...] = ("MANAGED", "EXTERNAL", "TEMPORARY")) -> list[str]:
    """Names of the catalogue's tables in a schema, of these kinds and with this prefix, in order."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if t.tableType in kinds and t.name.startswith(prefix))


def snapshot(spark: SparkSession, tables: Mapping[str, DataFrame], overrides: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Each table whole, or what its own statement selects, with ``op`` READ. A statement names its table in braces."""
    overrides = overrides or {}
    return {n: (spark.sql(overrides[n], **{n: df}) if n in overrides else df).withColumn("op", F.lit("READ")) for n, df in tables.items()}


def schemas_only(tables: Mapping[str, DataFrame]) -> dict[str, str]:
    """DDL of each table; no row is read."""
    return {n: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) for n, df in tables.items()}


def user_schemas(tables: DataFrame, column: str = "schema") -> DataFrame:
    return tables.where(~F.upper(column).isin(*SYSTEM))


def captured(every: DataFrame, requested: DataFrame, let_through: Callable[[Column], Column], column: str = "table") -> DataFrame:
    """Names of tables that are there, asked for and let through, in order."""
    return every.select(column).intersect(requested.select(column)).where(let_through(F.col(column))).orderBy(column)


def task(done: Column, added: Column, mode: Column) -> Column:
    """What a start has to do: nothing once a snapshot is complete and no table new, else data or schema by mode."""
    return F.when(done & ~added, "skip").when(mode.isin("initial", "when_needed"), "data").otherwise("schema")


def new_tables(old: DataFrame, new: DataFrame, column: str = "includes") -> DataFrame:
    """``(item)`` of new include lists that no old one has; a null list counts as none, and then nothing is new."""
    listed = lambda df: df.select(F.explode(F.split(F.col(column), ",")).alias("item")).select(F.trim("item").alias("item")).where("item != ''")
    known = old.agg(F.count(column).alias("n")).where("n > 0").select()
    return listed(new).distinct().join(listed(old).distinct(), "item", "left_anti").join(F.broadcast(known))


def with_feed(rows: DataFrame, changes: DataFrame, key: str, cut: DataFrame) -> DataFrame:
    """``(key, op, seq)``: the snapshot at ``cut(cut)``, of one row, then the changes behind it."""
    at = F.broadcast(cut)
    snap = rows.join(at).select(F.col(key).alias("key"), F.lit("READ").alias("op"), F.col("cut").alias("seq"))
    return snap.unionByName(changes.join(at, F.col("seq") > F.col("cut")).select("key", F.lit("CHANGE").alias("op"), "seq"))
