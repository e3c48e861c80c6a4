"""Exact repeats of long byte strings, by distributed prefix doubling over content-chosen positions.

Ranking every byte position at every offset would move the text many times over. So
the positions are thinned first, and no repeat is lost: each window of ``length``
bytes belongs to its anchor, the start in it of the 32 bytes of least hash. Equal
windows have equal anchors at equal offsets, so a window is named by its anchor and
its reach to both sides, and neighbouring windows that share an anchor move as one
run. Of the runs,

1. those whose anchor's 32 bytes are unique hold no repeat, and are dropped;
2. those that are equal as a whole are repeated as a whole;
3. the others, one of each kind, are positions for doubling, one to each side of the
   anchor. A position has the rank of its first 8 bytes outwards. In rounds at offsets
   of 8, 16, 32 ... bytes Spark sorts the pairs of its rank and the rank of as many
   bytes at that offset, ranks the pairs anew, and drops the positions that are unique
   at their anchor, until the reach is past what a window can have beside its anchor;
4. windows that don't reach beyond what their two positions share with another are
   compared byte by byte with those of equal rank at the same anchor.

Ranks of 1 to 3 are hashes: 64 bits of the anchor, 64 of a run, 64 of a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.llm.storage import cut, cut_at, ship, sliced
from tidefeed.sources.scratch import remove

GRAM, START = 32, 8
#: Runs at one anchor that a task compares; a longer list goes window by window through a grouped count.
MOST_RUNS = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.default_rng(5).integers(1, 1 << 64, 256, np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _ranks(data: np.ndarray, start: int) -> np.ndarray:
    """Ranks of the strings of ``start`` * 2^k bytes: by doubling, rank pairs at growing offsets, from single bytes on.

    ``start`` of 1 gives bytes; each round pairs every position with the one a reach further on.
    """
    rank, reach, power = _VALUES[data], 1, int(_BASE)
    while reach < start:
        rank = rank[:-reach] * np.uint64(power) + rank[reach:]
        reach, power = 2 * reach, power * power % (1 << 64)
    return rank


def _window_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of each window of ``length`` bytes, from the doubled ranks of its head and its (overlapping) tail."""
    reach = 1
    while reach * 2 <= length:
        reach *= 2
    rank = _ranks(data, reach)
    n = len(data) - length + 1
    return _mixed(rank[:n] * _BASE + _mixed(rank[length - reach :][:n]))


def _window_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """Leftmost position of the minimum of each w neighbours, by doubling."""
    at = np.arange(len(h), dtype=np.int32)
    reach = 1
    while reach * 2 <= w:
        left, right = at[:-reach], at[reach:]
        at = np.where(h[right] < h[left], right, left)
        reach *= 2
    if reach < w:
        n = len(h) - w + 1
        left, right = at[:n], at[w - reach :][:n]
        at = np.where(h[right] < h[left], right, left)
    return at


def runs(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rank of the anchor, rank of the run, first window, windows) of each run of a text, in order."""
    if len(text) < length:
        return (np.empty(0, np.int64),) * 4
    data = np.frombuffer(text, np.uint8)
    gram = _mixed(_ranks(data, GRAM))
    at = _window_minimum(gram, length - GRAM + 1)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    size = np.diff(np.concatenate([first, [len(at)]]))
    anchor = at[first]
    digest = xxhash.xxh3_64_intdigest
    run = np.array([digest(text[p : p + n + length - 1], o) for p, n, o in zip(first.tolist(), size.tolist(), (anchor - first).tolist(), strict=True)], np.uint64)
    return gram[anchor].view(np.int64), run.view(np.int64), first.astype(np.int64), size.astype(np.int64)


#: A text's key: its id, and a hash of it in case an id occurs twice.
_KEY = ("doc_key", "text_key")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))) if whole else F.xxhash64("doc_id")
    return docs.select("doc_id", text.alias("text")).select(key.alias("doc_key"), F.xxhash64("text").alias("text_key"), "doc_id", "text")


def _runs_table(keyed: DataFrame, length: int) -> DataFrame:
    """``(anchor, run, doc_key, text_key, place)``; place: first window and number of windows in one long."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            found = [runs(t, length) for t in part.column(2).to_pylist()]
            who = np.repeat(np.arange(part.num_rows), [len(f[0]) for f in found])
            anchor, run, first, size = (np.concatenate(x) for x in zip(*found, strict=True))
            keys = part.select(list(_KEY)).take(pa.array(who))
            yield pa.record_batch([pa.array(anchor), pa.array(run), keys.column(0), keys.column(1), pa.array(first << 16 | size)], names=["anchor", "run", *_KEY, "place"])

    return keyed.select(*_KEY, "text").mapInArrow(go, "anchor long, run long, doc_key long, text_key long, place long")


def _contexts(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``(anchor, run, at, body)``: the bytes of one witness of each wanted run, and the anchor's place in them."""
    by_doc = wanted.groupBy(*_KEY).agg(F.collect_list(F.struct("anchor", "run", "place")).alias("asked"))  # no more than a text has runs

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 100):
            out: list[tuple[int, int, int, bytes]] = []
            for text, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for x in asked:
                    first, size = x["place"] >> 16, x["place"] & 0xFFFF
                    body = text[first : first + size + length - 1]
                    at = int(_mixed(_ranks(np.frombuffer(body[:length], np.uint8), GRAM)).argmin())
                    out.append((x["anchor"], x["run"], at, body))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["anchor", "run", "at", "body"])

    return keyed.join(by_doc, list(_KEY)).dropDuplicates(list(_KEY)).select("text", "asked").mapInArrow(go, "anchor long, run long, at int, body binary")


def reaches(beside: int) -> list[int]:
    """Reaches of the rounds, from START bytes on, each twice the one before, the last one ``beside``."""
    out = []
    while not out or out[-1] < beside:
        out.append(min(beside, 2 * out[-1] if out else START))
    return out


def _positions(contexts: DataFrame, steps: list[int]) -> DataFrame:
    """``(anchor, run, side, most, b0, b1, ...)``: how many bytes a run has on each side, and the ranks of those between two reaches, null beyond them."""
    bounds = list(zip([0, *steps], steps, strict=False))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in sliced(batches, 2000):
            rows: list[list[int | None]] = []
            most: list[int] = []
            for at, body in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                for beside in (body[:at][::-1], body[at + GRAM :]):
                    rows.append([digest(beside[lo:hi]) if hi <= len(beside) else None for lo, hi in bounds])
                    most.append(len(beside))
            twice = pa.array(np.repeat(np.arange(b.num_rows), 2))
            ranks = [pa.array([r[k] for r in rows], pa.uint64()).view(pa.int64()) for k in range(len(bounds))]
            side = pa.array(np.arange(len(rows)) % 2, pa.int32())
            yield pa.record_batch([b.column(0).take(twice), b.column(1).take(twice), side, pa.array(most, pa.int32()), *ranks], names=["anchor", "run", "side", "most", *(f"b{k}" for k in range(len(bounds)))])

    return contexts.mapInArrow(go, "anchor long, run long, side int, most int, " + ", ".join(f"b{k} long" for k in range(len(bounds))))


def _doubled(contexts: DataFrame, length: int) -> DataFrame:
    """``(anchor, run, left, right)``: to how many bytes at most a run can share both sides of its anchor, where a window fits between them."""
    steps = reaches(length - GRAM)
    known = cut(_positions(contexts, steps), "positions")
    live = known.withColumn("rank", F.col("b0")).where("rank IS NOT NULL")
    shared = known.select("anchor", "run", "side", F.least("most", F.lit(steps[0] - 1)).alias("extent"))
    for k, following in enumerate([*steps[1:], None]):
        again = live.groupBy("anchor", "side", "rank").count().where("count > 1").select("anchor", "side", "rank")
        live = live.join(again, ["anchor", "side", "rank"], "left_semi")
        if following:  # the pair of the rank so far and the rank at an offset of the reach so far
            live = cut(live.withColumn("pair", F.when(F.col(f"b{k + 1}").isNotNull(), F.xxhash64("rank", f"b{k + 1}"))).drop("rank", f"b{k}").withColumnRenamed("pair", "rank"), "live")
            shared = shared.unionByName(live.select("anchor", "run", "side", F.least("most", F.lit(following - 1)).alias("extent")))
            live = live.where("rank IS NOT NULL")
        else:
            shared = shared.unionByName(live.select("anchor", "run", "side", F.col("most").alias("extent")))
    side = lambda k: F.max(F.when(F.col("side") == k, F.col("extent")))
    both = shared.groupBy("anchor", "run").agg(side(0).alias("left"), side(1).alias("right"))
    return both.where(F.col("left") + F.col("right") >= length - GRAM)


def _spans(repeated: np.ndarray) -> list[int]:
    """First and last index of each stretch of True, one after the other."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    edge[1::2] -= 1
    return edge.tolist()


def _windows(at: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, window) of those windows of each run that don't reach beyond what its sides share."""
    low = np.maximum(0, at - left)
    high = np.minimum(n - 1, at - (length - GRAM - right))
    k = np.maximum(0, high - low + 1)
    who = np.repeat(np.arange(len(n)), k)
    return who, np.arange(len(who)) - np.repeat(np.cumsum(k) - k, k) + low[who]


def _repeated_windows(anchors: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, bodies: list[bytes], length: int) -> list[list[int]]:
    """Spans of the windows of each run that another run at the same anchor has too. A window is at one place at most in a run."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    starts = np.cumsum(sizes) - sizes
    who, window = _windows(at, sizes - length + 1, left, right, length)
    if not len(who):
        return [[] for _ in bodies]
    start = window + starts[who]
    rank = _window_ranks(data, length)[start] ^ _mixed(anchors.view(np.uint64))[who]
    order = np.argsort(rank, kind="stable")
    same = rank[order][1:] == rank[order][:-1]
    _same_bytes(data, start[order[1:][same]], start[order[:-1][same]], length)
    repeated = np.zeros(len(who), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    cuts = np.searchsorted(who, np.arange(len(bodies) + 1))
    return [(np.array(_spans(repeated[lo:hi])) + window[lo]).tolist() if hi > lo else [] for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> None:
    """Holds the bytes of windows of equal rank against each other; two strings of one rank end the job, as no result would be right."""
    each = np.lib.stride_tricks.sliding_window_view(data, length)
    for lo in range(0, len(a), 20_000):
        if not np.array_equal(each[a[lo : lo + 20_000]], each[b[lo : lo + 20_000]]):
            raise ArithmeticError("different strings of equal rank")


def _compare(contexts: DataFrame, length: int) -> DataFrame:
    """``(anchor, run, spans)``. The partitions stream in the order of their anchors; a few anchors are held at a time."""
    names = ["anchor", "run", "at", "left", "right", "body"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if sum(r.num_rows for r in rows):
                t = pa.Table.from_batches(rows).combine_chunks()
                numbers = [t.column(c).to_numpy().astype(np.int64) for c in ("at", "left", "right")]
                spans = _repeated_windows(t.column(0).to_numpy(), *numbers, t.column("body").to_pylist(), length)
                yield from t.select(["anchor", "run"]).append_column("spans", pa.array(spans, pa.list_(pa.int64()))).to_batches()

        for part in sliced(batches, 5000):
            anchors = part.column(0).to_numpy()
            last = int(np.searchsorted(anchors, anchors[-1]))  # where the anchor begins that may go on in the next part
            if last or held and held[-1].column(0)[-1].as_py() != anchors[0]:
                yield from done([*held, part.slice(0, last)])
                held = []
            held.append(part.slice(last))
        yield from done(held)

    return contexts.select(names).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(go, "anchor long, run long, spans array<long>")


def _by_window(contexts: DataFrame, length: int) -> DataFrame:
    """As _compare(), for anchors with very many runs: 128-bit digests of the windows are counted and joined by Spark."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for part in sliced(batches, 200):
            at, left, right = (part.column(c).to_numpy().astype(np.int64) for c in ("at", "left", "right"))
            bodies = part.column("body").to_pylist()
            who, window = _windows(at, np.array([len(x) for x in bodies]) - length + 1, left, right, length)
            ranks = [digest(bodies[i][p : p + length]) for i, p in zip(who.tolist(), window.tolist(), strict=True)]
            held = part.take(pa.array(who))
            yield pa.record_batch([held.column(0), held.column(1), pa.array(window), pa.array(ranks, pa.binary())], names=["anchor", "run", "at", "rank"])

    windows = contexts.select("anchor", "run", "at", "left", "right", "body").mapInArrow(go, "anchor long, run long, at long, rank binary")
    again = windows.groupBy("anchor", "rank").count().where("count > 1").select("anchor", "rank")
    return windows.join(again, ["anchor", "rank"]).groupBy("anchor", "run").agg(F.flatten(F.sort_array(F.collect_list(F.array("at", "at")))).alias("spans"))


def repeated_spans(docs: DataFrame, length: int = 200, most_runs: int = MOST_RUNS) -> DataFrame:
    """``(doc_key, text_key, spans)``: for texts with repeats, byte ranges [from, to) whose union is what repeats cover.

    The keys name a row by its id and its text; equal rows have one, and are repeats of each
    other. Other columns are ignored, whatever their names; no rows, no rows.
    """
    ship(docs.sparkSession)
    return _repeated(_keyed(docs), length, most_runs)


def _repeated(keyed: DataFrame, length: int, most_runs: int) -> DataFrame:
    spark = keyed.sparkSession
    found = cut(_runs_table(keyed, length), "runs")
    classes, path = cut_at(
        found.groupBy("anchor", "run").agg(F.count("*").alias("n"), F.min(F.struct(*_KEY, "place")).alias("witness")), "classes"
    )
    whole = cut(classes.where("n > 1").select("anchor", "run"), "whole")
    shared = classes.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1")
    contexts = cut(_contexts(keyed, classes.join(shared, "anchor").select("anchor", "run", "witness.*"), length), "contexts")
    remove(spark, path)
    # What is a repeat as a whole still counts as the other of a run that isn't.
    open_runs = cut(contexts.join(_doubled(contexts, length), ["anchor", "run"]), "open-runs")
    many = cut(open_runs.groupBy("anchor").count().where(F.col("count") > most_runs).select("anchor"), "many")
    partly = _compare(open_runs.join(many, "anchor", "left_anti"), length).unionByName(_by_window(open_runs.join(many, "anchor", "left_semi"), length)).where(F.size("spans") > 0)
    verdicts = partly.join(whole, ["anchor", "run"], "left_anti").unionByName(whole.withColumn("spans", F.lit(None).cast("array<long>")))
    hit = found.join(verdicts, ["anchor", "run"])
    first, size = F.shiftright("place", 16), F.col("place").bitwiseAND(F.lit(0xFFFF))
    spans = F.coalesce("spans", F.array(F.lit(0).cast("long"), size - 1))
    moved = F.transform(spans, lambda x, i: first + x + F.when(i % 2 == 1, F.lit(length)).otherwise(F.lit(0)))
    return hit.select(*_KEY, moved.alias("spans")).groupBy(*_KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _kept(text: bytes, spans: list[int] | None) -> tuple[list[bytes], int]:
    """What is left of a text, in pieces, and the number of maximal removed runs."""
    pieces, at, removed = [], 0, 0
    for lo, hi in sorted(zip((spans or [])[::2], (spans or [])[1::2], strict=True)):
        if lo > at or not removed:
            pieces.append(text[at:lo])
            removed += 1
        at = max(at, hi)
    pieces.append(text[at:])
    return pieces, removed


def remove_repeats(docs: DataFrame, length: int = 200, most_runs: int = MOST_RUNS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for every row of ``docs(doc_id, text, ...)``.

    Removes each byte that lies in a string of ``length`` bytes which also starts
    elsewhere, in this or another row; overlaps count. Null texts are empty; texts
    shorter than ``length`` stay whole; equal rows repeat each other. Ids may be null or
    of any type; other columns are ignored; an empty table gives an empty one.
    """
    ship(docs.sparkSession)
    keyed = _keyed(docs)
    spans = _repeated(keyed, length, most_runs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            kept, cuts, sizes = [], [], []
            for text, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                pieces, n = _kept(text, own)
                kept.append(b"".join(pieces))
                cuts.append(n)
                sizes.append(len(text))
            removed = [a - len(k) for a, k in zip(sizes, kept, strict=True)]
            yield pa.record_batch([b.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, cuts)), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = keyed.join(spans, list(_KEY), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(go, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame, length: int = 200) -> DataFrame:
    """remove_repeats() with the SHA-256 of what is kept in place of it."""
    return remove_repeats(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], length: int) -> list[tuple[int, int, str]]:
    """(bytes removed, runs, SHA-256 of the rest) by counting every window; for tests."""
    count: dict[bytes, int] = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            count[t[p : p + length]] = count.get(t[p : p + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p + 1 : p + length + 1] = True
        kept = bytes(b for b, g in zip(t, gone[1:-1], strict=True) if not g)
        out.append((int(gone.sum()), int((np.diff(gone.astype(np.int8)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out
