"""Joins of names, columns, code pages and widths with the table catalogue; all sides are metadata."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.functions import codec

#: Characters of a system name, at most.
SYSTEM_LENGTH = 10

# Type names of the source to Spark's.
TYPES = {
    "DECIMAL": "decimal", "NUMERIC": "decimal", "SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint", "REAL": "float", "DOUBLE": "double", "CHAR": "string", "NCHAR": "string", "GRAPHIC": "string", "VARGRAPHIC": "string", "CLOB": "string",
    "VARCHAR": "string", "NVARCHAR": "string", "VGRAPH": "string", "BINARY": "binary", "VARBINARY": "binary", "DATE": "date", "TIME": "string", "TIMESTAMP": "timestamp_ntz", "XML": "string",
}


def spark_type(name: Column, length: Column, scale: Column) -> Column:
    """Spark's type of a source type; null of an unknown one. Bit data is binary."""
    base = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])[F.regexp_replace(name, " *\\([0-9]*\\)", "")]
    base = F.when(name.endswith("FOR BIT DATA"), F.lit("binary")).otherwise(base)
    return F.when(base == "decimal", F.concat(F.lit("decimal("), length.cast("string"), F.lit(","), scale.cast("string"), F.lit(")"))).otherwise(base)


def long_names(entries: DataFrame, names: DataFrame) -> DataFrame:
    """``long_name`` of ``system_name``, which stands in for itself where no name is known; the empty name has the empty one.

    Names are known by schema if both sides have one.
    """
    by = ["schema", "system_name"] if "schema" in entries.columns and "schema" in names.columns else ["system_name"]
    return entries.join(names, by, "left").withColumn("long_name", F.coalesce("long_name", "system_name"))


def system_names(tables: DataFrame, names: DataFrame) -> DataFrame:
    """``system_name`` of ``(schema, long_name)``: the known one, or the name itself if it is short enough to be one; else null."""
    itself = F.when(F.length("long_name") <= SYSTEM_LENGTH, F.col("long_name"))
    return tables.join(names.select("schema", "long_name", "system_name").distinct(), ["schema", "long_name"], "left").withColumn("system_name", F.coalesce("system_name", itself))


def parse_includes(includes: DataFrame, default_schema: str) -> DataFrame:
    """``(schema, table)`` of each item of comma lists ``[db.]schema.table``; blank items and null lists have none."""
    item = F.explode(F.split("includes", ","))
    parts = includes.select(item.alias("item")).where("trim(item) != ''").select(F.split(F.trim("item"), "\\.").alias("p"))
    schema = F.nullif(F.try_element_at("p", F.lit(-2)), F.lit(""))
    return parts.select(F.coalesce(schema, F.lit(default_schema)).alias("schema"), F.element_at("p", -1).alias("table"))


def short_includes(includes: DataFrame, names: DataFrame, default_schema: str) -> DataFrame:
    """``(schema, table, system_name)`` of the items that have a system name; the others are dropped."""
    items = parse_includes(includes, default_schema).withColumnRenamed("table", "long_name")
    return system_names(items, names).where("system_name IS NOT NULL").withColumnRenamed("long_name", "table")


def without_columns(rows: DataFrame, patterns: list[str]) -> DataFrame:
    """The table without the columns whose whole name one of the patterns matches, in whatever letters."""
    return rows.select(*(F.col(f"`{c}`") for c in rows.columns if not any(re.fullmatch(p, c, re.IGNORECASE) for p in patterns)))


def struct_of(columns: list[tuple[str, str, int, int, bool]]) -> T.StructType:
    """Spark's schema of catalogue rows ``(name, type, length, scale, nullable)`` in their order; UnknownType as the decoders raise it."""
    out = T.StructType()
    for name, kind, length, scale, nullable in columns:
        f = codec.field_of(name, kind, length, scale)
        out = out.add(name, T.StructType.fromDDL(f.ddl)[0].dataType, nullable)
    return out


def catalogue_of(schema: T.StructType) -> list[tuple[str, str, int, int, bool]]:
    """The catalogue rows of a schema; the inverse of struct_of() for the types that the source has."""
    plain = {"smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "REAL", "double": "DOUBLE", "string": "VARCHAR", "binary": "VARBINARY", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}
    out = []
    for f in schema:
        if isinstance(f.dataType, T.DecimalType):
            out.append((f.name, "DECIMAL", f.dataType.precision, f.dataType.scale, f.nullable))
        elif f.dataType.simpleString() in plain:
            out.append((f.name, plain[f.dataType.simpleString()], 0, 0, f.nullable))
        else:
            raise codec.UnknownType(f"unsupported type {f.dataType.simpleString()} of column {f.name}")
    return out


def code_pages(columns: DataFrame, known: DataFrame, declared: int, actual: int) -> DataFrame:
    """Each column's code page by table name, short or long; -1 if none; ``declared`` is read as ``actual``."""
    short = known.select("schema", F.col("system_name").alias("table"), "column", "ccsid")
    both = short.union(known.select("schema", F.col("long_name").alias("table"), "column", "ccsid")).distinct()
    found = columns.join(both, ["schema", "table", "column"], "left").withColumn("ccsid", F.coalesce("ccsid", F.lit(-1)))
    return found.withColumn("ccsid", F.when(F.col("ccsid") == declared, actual).otherwise(F.col("ccsid")))


def bytes_per_char(columns: DataFrame) -> DataFrame:
    """Octets to characters of a column, at least 1, and 1 where the length is 0."""
    return columns.withColumn("bytes_per_char", F.greatest(F.lit(1), F.coalesce(F.expr("octets div nullif(length, 0)"), F.lit(1)).cast("int")))
