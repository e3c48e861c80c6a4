"""Scalar functions on columns; all stay in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_right(x: Column, n: int) -> Column:
    return F.rpad(x, n, " ")


def pad_left(x: Column, n: int) -> Column:
    return F.lpad(x, n, " ")


def pad_right_whole(x: Column, n: int) -> Column:
    """Pads but never truncates."""
    return F.when(F.length(x) >= n, x).otherwise(F.rpad(x, n, " "))


def trim_controls(x: Column) -> Column:
    """Without leading and trailing characters up to the space; null stays null."""
    return F.regexp_replace(x, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def clean_text(x: Column) -> Column:
    """Control, format, private, surrogate and unassigned characters become ?, then spaces are trimmed."""
    return F.trim(F.regexp_replace(x, "[\\p{Cc}\\p{Cf}\\p{Co}\\p{Cs}\\p{Cn}]", "?"))


def capitalize(x: Column) -> Column:
    return F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1 << 30)))


def camel(x: Column) -> Column:
    """Words between underscores, each capitalised; a single character is only raised."""
    words = F.filter(F.split(x, "_"), lambda w: w != "")
    return F.when(F.length(x) <= 1, F.upper(x)).otherwise(F.array_join(F.transform(words, capitalize), ""))


def attach_time(x: Column) -> Column:
    """CYYMMDDHHMMSS, C counting centuries from 1900; null if it isn't one."""
    century = (F.substring(x, 1, 1).try_cast("int") + 19).cast("string")
    return F.try_to_timestamp(F.concat(century, F.substring(x, 2, 12)), F.lit("yyyyMMddHHmmss"))


def chain_number(x: Column) -> Column:
    """The first two digits of a five-digit segment number."""
    return F.when(F.length(x) == 5, F.substring(x, 1, 2).try_cast("int"))


def big_endian(x: Column) -> Column:
    """An unsigned big-endian number of up to seven bytes."""
    return F.conv(F.hex(x), 16, 10).cast("long")


def signed_big_endian(x: Column, size: int) -> Column:
    """A signed big-endian number of ``size`` bytes, up to eight."""
    whole = F.conv(F.hex(F.substring(x, 1, size)), 16, 10).cast("decimal(20,0)")
    wrapped = F.when(whole >= F.lit(1 << (8 * size - 1)).cast("decimal(20,0)"), whole - F.lit(str(1 << 8 * size)).cast("decimal(21,0)")).otherwise(whole)
    return wrapped.cast("long")


def big_number(x: Column) -> Column:
    """A number in text of up to twenty digits, beyond what a long holds; null if it isn't one."""
    return F.trim(x).try_cast("decimal(20,0)")


def ebcdic(x: Column) -> Column:
    """Text of page 37 bytes, without its padding, by a table: Spark's own decode() has the page only under a legacy setting."""
    source = "".join(map(chr, range(256)))
    return F.rtrim(F.translate(F.decode(x, "ISO-8859-1"), source, bytes(range(256)).decode("cp037")))


def object_parts(x: Column) -> list[Column]:
    """``file``, ``library`` and ``member`` of an object name: ten characters each, filled with spaces."""
    return [trim_controls(F.substring(x, at, 10)).alias(n) for n, at in (("file", 1), ("library", 11), ("member", 21))]


def topic(prefix: str, parts: list[Column]) -> Column:
    """prefix.part.part; characters that no topic may have become an underscore."""
    return F.regexp_replace(F.concat_ws(".", F.lit(prefix), *parts), "[^A-Za-z0-9._-]", "_")


def topic_of_table(x: Column, prefix: str) -> Column:
    """prefix.table, from what stands behind the last dot, lowered."""
    return F.concat(F.lit(f"{prefix}."), F.lower(F.substring_index(x, ".", -1)))


def schema_name(x: Column, package: str) -> Column:
    """package.TableValue from db.schema.TABLE.Value; other names stay."""
    pattern = "^.*\\.([^.]*)\\.(Value|Key)$"
    return F.when(x.rlike(pattern), F.concat(F.lit(f"{package}."), camel(F.regexp_extract(x, pattern, 1)), F.regexp_extract(x, pattern, 2))).otherwise(x)


def _seconds_of_day(x: Column) -> Column:
    at = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.translate(x, ":", ".")), F.lit("yyyy-MM-dd HH.mm.ss"))
    return F.unix_timestamp(at).cast("string")


def _rounded(x: Column, scale: Column) -> Column:
    """Half up to a scale of 0 to 6 that a column gives."""
    value = x.try_cast("decimal(26,6)")
    out = F.lit(None).cast("string")
    for n in range(7):
        out = F.when(scale == n, F.round(value, n).cast(f"decimal(26,{n})").cast("string")).otherwise(out)
    return out


def default_value(kind: Column, raw: Column, scale: Column | int = 2) -> Column:
    """A column default as text of its typed value: dates as days, times of day as seconds, timestamps as seconds since 1970; null if it has none or isn't one."""
    scale = F.lit(scale) if isinstance(scale, int) else scale
    bare = F.regexp_replace(F.trim(raw), "^'|'$", "")
    stamp = F.try_to_timestamp(bare, F.lit("yyyy-MM-dd-HH.mm.ss.SSSSSS"))
    return (
        F.when(F.upper(F.trim(raw)).startswith("CURRENT") | (F.upper(F.trim(raw)) == "NULL"), None)
        .when(kind == "DATE", F.date_diff(bare.try_cast("date"), F.lit("1970-01-01").cast("date")).cast("string"))
        .when(kind == "TIMESTAMP", F.unix_timestamp(stamp).cast("string"))
        .when(kind == "TIME", _seconds_of_day(bare))
        .when(kind.isin("DECIMAL", "NUMERIC"), _rounded(bare, scale))
        .when(kind.isin("SMALLINT", "INTEGER", "BIGINT"), bare.try_cast("long").cast("string"))
        .when(kind.isin("REAL", "DOUBLE"), bare.try_cast("double").cast("string"))
        .when(kind.isin("BINARY", "VARBINARY"), F.hex(F.encode(bare, "UTF-8")))
        .when(kind == "BOOLEAN", F.lower(bare).isin("1", "true", "t").cast("string"))
        .otherwise(bare)
    )
