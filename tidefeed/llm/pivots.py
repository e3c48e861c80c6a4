"""Near-duplicate vectors through a pivot-permutation index.

Each vector is described by its nearest pivots, in order: a prefix of its permutation
of all pivots. Each pivot has an inverted list of the vectors whose prefix holds it.
Two vectors are candidates if their prefixes share at least SHARED pivots, where a
shared pivot counts if its places in the two differ by ``drift`` at most; candidates are
verified by their cosine.

A pair is dealt with in one list only, that of the first pivot that counts for it. So
a list is compared as a whole, in blocks, and no pair leaves its task but as a count of
links and an edge of a forest. A list above ``block`` vectors is divided by the second
pivot that a candidate must share; what is still above it, as a dense group can be, is
dealt out as a triangle of block pairs over many tasks.

The prefix grows with the number of pivots, as the more there are, the less do two near
vectors agree on which are nearest. No two pivots lie close to each other: in a large
group of near vectors, many pivots would be all but equally near to each member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.llm.components import components, unite
from tidefeed.llm.storage import cut, ship

#: Of pivots with so large a cosine only one is kept.
CLOSE = 0.8
#: Pivots that candidates share, at least.
SHARED = 2
#: All lengths of vectors together have so many pivots at most; vectors of a length without any are compared all with all.
MOST_PIVOTS, FEWEST = 4096, 32


def pivot_count(vectors: int) -> int:
    """Half the root of the number of vectors, from 32 to 4096."""
    return max(FEWEST, min(MOST_PIVOTS, math.isqrt(max(vectors, 0)) // 2))


def prefix_length(pivots: int) -> int:
    """How many pivots describe a vector: 7 of 32, 8 of 100, 10 of 4096."""
    return 4 + round(math.log2(max(pivots, 2)) / 2)


@dataclass
class Pivots:
    """The pivots of one length of vectors; their numbers begin at ``base``."""

    base: int
    vectors: np.ndarray
    prefix: int

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the nearest pivots of each row, the nearest first."""
        k = min(self.prefix, len(self.vectors))
        return np.argsort(-(x @ self.vectors.T), axis=1, kind="stable")[:, :k] + self.base


def thinned(found: np.ndarray) -> np.ndarray:
    """Of unit vectors those that aren't CLOSE to an earlier one."""
    free, kept = np.ones(len(found), bool), []
    for i in range(len(found)):
        if free[i]:
            kept.append(i)
            free &= found @ found[i] < CLOSE
    return found[kept]


def choose_pivots(distinct: DataFrame, pivots: int | None, nearest: int | None) -> dict[int, Pivots]:
    """By length, the vectors of the smallest key: a sample of bounded size, the same at every run."""
    out: dict[int, Pivots] = {}
    base = 0
    for n, vectors in distinct.groupBy("n").count().orderBy(F.desc("count"), "n").limit(MOST_PIVOTS // FEWEST).collect():
        wanted = pivots or pivot_count(vectors)
        if vectors < 2 * FEWEST and pivots is None or base + wanted > MOST_PIVOTS:
            continue
        rows = distinct.where(F.col("n") == n).orderBy("key").limit(wanted).select("vector").collect()
        found = np.array([r[0] for r in rows], np.float64)
        found = thinned(found / np.linalg.norm(found, axis=1, keepdims=True))
        if len(found) >= SHARED:
            out[n] = Pivots(base, found, nearest or prefix_length(len(found)))
            base += len(found)
    return out


def _described(distinct: DataFrame, pivots: dict[int, Pivots]) -> DataFrame:
    """``distinct`` with ``near``, the prefix of each vector; empty where its length has no pivots."""
    schema = T.StructType([f for f in distinct.schema if f.name in ("first_id", "copies", "vector", "n")]).add("near", T.ArrayType(T.IntegerType()))
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(lo, 1000) for b in batches for lo in range(0, b.num_rows, 1000)):
            vector, size = b.column("vector"), b.column("n").to_numpy(zero_copy_only=False)
            near: list[np.ndarray] = [np.empty(0, np.int32)] * b.num_rows
            for n, own in pivots.items():
                at = np.flatnonzero(size == n)
                if len(at):
                    for i, row in zip(at, own.nearest(np.array(vector.take(pa.array(at)).to_pylist(), np.float64)), strict=True):
                        near[i] = row.astype(np.int32)
            yield pa.record_batch([*(b.column(c) for c in names), pa.array(near, pa.list_(pa.int32()))], names=schema.names)

    return distinct.select(*names).mapInArrow(run, schema)


def _lists(described: DataFrame, long: frozenset[int]) -> DataFrame:
    """``described``, each vector once for each list it is in, with the list's first and second pivot (-1: none)."""
    names = ["p", "q", "first_id", "copies", "near", "vector"]
    kinds = {f.name: f for f in described.schema}
    schema = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()), *(kinds[c] for c in names[2:])])

    def places(near: list[int], n: int) -> list[tuple[int, int]]:
        if not near:
            return [(-n, -1)]
        own = sorted(near)
        return [x for i, p in enumerate(own) for x in ([(p, q) for q in own[i + 1 :]] if p in long else [(p, -1)])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(lo, 1000) for b in batches for lo in range(0, b.num_rows, 1000)):
            found = [places(*x) for x in zip(b.column("near").to_pylist(), b.column("n").to_pylist(), strict=True)]
            held = b.take(pa.array(np.repeat(np.arange(b.num_rows), [len(f) for f in found])))
            flat = np.array([x for f in found for x in f], np.int32).reshape(-1, 2)
            yield pa.record_batch([pa.array(flat[:, 0]), pa.array(flat[:, 1]), *(held.column(c) for c in names[2:])], names=names)

    return described.mapInArrow(run, schema)


def _first_shared(a: np.ndarray, b: np.ndarray, drift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of prefixes: how many shared pivots count, and the least and second least of them."""
    place = np.arange(a.shape[1])
    counts = ((a[:, :, None] == b[:, None, :]) & (np.abs(place[:, None] - place[None, :]) <= drift)).any(2)
    own = np.sort(np.where(counts, a, np.iinfo(np.int32).max), axis=1)
    return counts.sum(1), own[:, 0], own[:, 1]


def _verify(group: pd.DataFrame, floor: float, drift: int | None) -> pd.DataFrame:
    """Within one list, or one block pair of a long one: links of each vector, and what it is joined to."""
    group = group.sort_values("first_id").reset_index(drop=True)
    p, q = int(group["p"].iat[0]), int(group["q"].iat[0])
    x = np.array(group["vector"].tolist(), np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near, copies, block = np.array(group["near"].tolist(), np.int32), group["copies"].to_numpy(), group["block"].to_numpy()
    drift = near.shape[1] - 2 if drift is None else drift
    links, label = np.zeros(len(x), np.int64), np.arange(len(x))
    across = group["low"].iat[0] != group["high"].iat[0]
    for lo in range(0, len(x), 512):
        a, b = np.nonzero(x[lo : lo + 512] @ x.T >= floor - 1e-6)
        a += lo
        ok = (a < b) & (not across or block[a] != block[b])
        a, b = a[ok], b[ok]
        for at in range(0, len(a), 1 << 16):
            i, j = a[at : at + 65536], b[at : at + 65536]
            if near.shape[1]:
                n, first, second = _first_shared(near[i], near[j], drift)
                mine = (n >= SHARED) & (first == p) & ((q < 0) | (second == q))
                i, j = i[mine], j[mine]
            i, j = (v[np.einsum("nd,nd->n", x[i], x[j]) >= floor] for v in (i, j))
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            unite(label, i, j)
    hit = links > 0
    return pd.DataFrame({"u": group["first_id"][hit], "v": group["first_id"].to_numpy()[label[hit]], "links": links[hit]})


def near_vectors(vectors: DataFrame, floor: float = 0.9, nearest: int | None = None, pivots: int | None = None, block: int = 4096, drift: int | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding, ...)``.

    Vectors of equal length with a cosine of ``floor`` or more, in double precision, are
    linked if the index retrieves the pair. Equal vectors are one class: each counts the
    others. A vector that is null, empty, zero or holds null or non-finite components
    links with nothing and is its own component; so does a row without an id, which no
    component could be named by. ``nearest``, ``pivots`` and ``drift`` default by the
    number of vectors, of pivots, and to all but the longest drift. Equal ids get the
    values of their own vectors. Other columns are ignored; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema["embedding"].dataType.elementType
    v = F.col("embedding") if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False))) & F.exists(v, lambda e: e != 0)
    key = F.concat(F.hex(F.xxhash64(v)), F.hex(F.xxhash64(F.lit(1), v)))
    rows = vectors.select("vec_id", F.coalesce(F.col("vec_id").isNotNull() & v.isNotNull() & fine, F.lit(False)).alias("usable"), key.alias("key"), v.alias("vector"))
    usable = rows.where("usable")
    distinct = usable.groupBy("key").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    distinct = cut(distinct.withColumn("n", F.size("vector")), "vectors")
    described = cut(_described(distinct, choose_pivots(distinct, pivots, nearest)), "described")
    # As many rows as there are pivots.
    long = described.select(F.explode("near").alias("p")).groupBy("p").count().where(F.col("count") > block).collect()
    listed = _lists(described, frozenset(r[0] for r in long))
    sizes = listed.groupBy("p", "q").count().where(F.col("count") > block)
    dealt = listed.join(sizes, ["p", "q"], "left").withColumn("blocks", F.ceil(F.coalesce("count", F.lit(1)) / block).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("first_id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("p", "q", "first_id", "copies", "near", "vector", "block", F.greatest("block", "other").alias("high"), F.least("block", "other").alias("low"))
    of_id = T.StructType([T.StructField(c, vectors.schema["vec_id"].dataType) for c in "uv"]).add("links", "long")
    links = cut(dealt.groupBy("p", "q", "low", "high").applyInPandas(lambda g: _verify(g, floor, drift), of_id), "links")
    # A class goes by its smallest id, so the smallest node of a component is the answer.
    classes = (
        distinct.select("key", "first_id", "copies")
        .join(links.groupBy(F.col("u").alias("first_id")).agg(F.sum("links").alias("others")), "first_id", "left")
        .join(components(links.select("u", "v")).withColumnRenamed("node", "first_id"), "first_id", "left")
        .select("key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "first_id").alias("component_id"))
    )
    linked = usable.select("vec_id", "key").join(classes, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
