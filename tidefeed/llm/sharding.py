"""Placement of documents on shards by a permutation-filled lookup table.

Each shard has a preference order of all slots of a table of prime size, an offset
and a stride from the digest of its name; the shards take turns and claim their next
free slot. The table is as large as the number of shards says, not the data; it is
broadcast, and a document goes where its slot says. Adding or losing a shard moves
few slots beyond those it must.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.llm.storage import apart

#: Slots for each shard, at least.
SLOTS_PER_SHARD = 100


def table_size(shards: int) -> int:
    """The least prime above SLOTS_PER_SHARD slots for each shard."""
    n = max(2, shards * SLOTS_PER_SHARD + 1)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def fill_table(shards: list[str]) -> list[int]:
    """For each slot the index of its shard. The order of ``shards`` is that of the turns; names differ."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need names, each its own")
    size = table_size(len(shards))
    at = [_number(f"{s}/offset") % size for s in shards]
    stride = [_number(f"{s}/stride") % (size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + stride[i]) % size
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def slot(key: Column, size: int) -> Column:
    """The slot of a key: the first 48 bits of the MD5 of its text; null as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(size))


def place(docs: DataFrame, shards: list[str], key: str = "doc_id") -> DataFrame:
    """``docs`` with the columns ``slot`` and ``shard``, those of such names replaced.

    Rows with equal keys go together; a null key is placed as an empty text. Other
    columns stay, whatever their names. No rows, no rows.
    """
    table = fill_table(shards)
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("slot", "shard")]
    at, number = apart([*docs.columns, "slot", "shard"], "_slot", "_number")
    lookup = spark.createDataFrame(list(enumerate(table)), T.StructType().add(at, "long").add(number, "integer"))
    names = F.array(*map(F.lit, shards))
    placed = docs.withColumn(at, slot(F.col(f"`{key}`"), len(table))).join(F.broadcast(lookup), at)
    return placed.select(*(F.col(f"`{c}`") for c in keep), F.col(at).alias("slot"), F.element_at(names, F.col(number) + 1).alias("shard"))


def write_shards(placed: DataFrame, path: str, files: int = 1) -> None:
    """One folder for each shard, of about ``files`` files; the rows of a shard are dealt over them by their slots.

    Every row is written, repeated ones and those of null keys too; no rows, no folders.
    """
    (part,) = apart(placed.columns, "_file")
    spread = placed.withColumn(part, F.pmod(F.xxhash64("slot"), F.lit(files)))
    spread.repartition("shard", part).drop(part).write.partitionBy("shard").parquet(path)


ORACLE = """
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 3, '0') AS name FROM range(0, {n}) t(i)
), start AS (
  SELECT list(CAST('0x' || md5(name || '/offset')[1:12] AS BIGINT) % {size} ORDER BY i) AS pos,
         list(CAST('0x' || md5(name || '/stride')[1:12] AS BIGINT) % ({size} - 1) + 1 ORDER BY i) AS stride
  FROM shards
), fill(turn, pos, filled, won) AS (
  SELECT 0, pos, list_transform(range(0, {size}), lambda x: false), CAST(-1 AS BIGINT) FROM start
  UNION ALL
  SELECT turn + 1,
         list_transform(pos, lambda x, i: CASE WHEN i = turn % {n} + 1 THEN (claimed + s) % {size} ELSE x END),
         list_concat(list_append(filled[1:claimed], true), filled[claimed + 2:]),
         claimed
  FROM (
    SELECT fill.*, start.stride[turn % {n} + 1] AS s,
           list_filter(list_transform(range(0, {size}), lambda k: (fill.pos[turn % {n} + 1] + k * start.stride[turn % {n} + 1]) % {size}), lambda x: NOT filled[x + 1])[1] AS claimed
    FROM fill, start WHERE turn < {size}
  )
), slots AS (
  SELECT won AS slot, (turn - 1) % {n} AS i FROM fill WHERE turn > 0
)
SELECT d.doc_id, slots.slot, shards.name AS shard
FROM documents d
JOIN slots ON slots.slot = CAST('0x' || md5(coalesce(CAST(d.doc_id AS VARCHAR), ''))[1:12] AS BIGINT) % {size}
JOIN shards USING (i)
"""
