"""SimHash near-duplicates, found by anchor-point covering.

The anchors are the words of the binary Golay code of length 23: every 23-bit
string lies within R = 3 bits of exactly one of them. A fingerprint is at home at
the anchor within R of its first 23 bits, and a copy of it goes to each anchor
within R + t. If x and y differ in at most t bits, y has a copy at x's home, so
comparing the residents of an anchor with all of its copies finds every link.

An anchor with more residents than ``hot_anchor`` is refined by the next 23 bits,
whose excess over R counts against the same t. What then still has so many has its
residents dealt over several tasks, each of which sees all copies; so the work is
dealt out and no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.components import components, unite
from tidefeed.llm.storage import apart, cut, ship, sliced

SEED = 42
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a generator of the Golay code.
GOLAY = 0b101011100011
LENGTH, RADIUS = 23, 3
#: Pairs compared at a time.
BLOCK = 1 << 22


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """64 majority bits over the XXH64 of the word shingles, repeats included; 0 without words."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    line, ends = b" ".join(tokens), np.cumsum([len(w) + 1 for w in tokens])
    n = max(1, len(tokens) - words + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[min(words, len(tokens)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65280):
        h = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[at : at + 65280], stops[at : at + 65280], strict=True)])
        bits = np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1)
        # 255 ones fit a byte
        counts += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; fp is a signed long. A null text counts as empty."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            fps = [_signed(fingerprint(t, words)) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


@lru_cache
def _patterns(t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome, the error patterns of weight R + t or less that lead to an anchor: (starts, patterns, excess)."""
    weights = np.bitwise_count(np.arange(1 << LENGTH, dtype=np.uint32))
    found = np.flatnonzero(weights <= RADIUS + t).astype(np.uint32)
    by = _syndrome(found)
    order = np.argsort(by, kind="stable")
    starts = np.searchsorted(by[order], np.arange((1 << 11) + 1))
    found = found[order]
    return starts, found, np.maximum(weights[found].astype(np.int8) - RADIUS, 0)


def _syndrome(x: np.ndarray) -> np.ndarray:
    rest = x.astype(np.uint32)
    for bit in range(LENGTH - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ np.uint32(GOLAY << (bit - 11)), rest)
    return rest


def _copies(bits: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 23-bit strings: (index of the string, anchor, excess) of every copy."""
    starts, patterns, excess = _patterns(t)
    s = _syndrome(bits)
    n = starts[s + 1] - starts[s]
    who = np.repeat(np.arange(len(bits)), n)
    at = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[s], n)
    return who, (bits[who] ^ patterns[at]) >> 11, excess[at]  # the code is systematic: 12 bits name an anchor


def _block(fps: np.ndarray, k: int) -> np.ndarray:
    return (fps >> np.uint64(LENGTH * k) & np.uint64((1 << LENGTH) - 1)).astype(np.uint32)


def _to_anchors(fps: DataFrame, t: int, hot: frozenset[int], parts: dict[int, int] | None = None) -> DataFrame:
    """``(anchor, fp, home)``: every copy, at a refined anchor where the anchor is ``hot``, and at each of the ``parts`` of an anchor."""
    hot_ids = np.array(sorted(hot), np.uint32)
    dealt = np.array(sorted(parts or {}), np.int64)
    numbers = np.array([parts[k] for k in dealt.tolist()] if parts else [], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                fp = b.column(0).slice(lo, 2000).to_numpy(zero_copy_only=False)
                x = fp.view(np.uint64)
                who, anchor, excess = _copies(_block(x, 0), t)
                key, home = anchor.astype(np.int64), excess == 0
                if len(hot_ids):
                    deep = np.isin(anchor, hot_ids)
                    again, second, more = _copies(_block(x, 1)[who[deep]], t)
                    keep = excess[deep][again] + more <= t
                    again, second, more = again[keep], second[keep], more[keep]
                    who = np.concatenate([who[~deep], who[deep][again]])
                    key = np.concatenate([key[~deep], (key[deep][again] + 1 << 12) + second])
                    home = np.concatenate([home[~deep], home[deep][again] & (more == 0)])
                if len(dealt):
                    at = np.minimum(np.searchsorted(dealt, key), len(dealt) - 1)
                    n = np.where(dealt[at] == key, numbers[at], 1)
                    row = np.repeat(np.arange(len(key)), n)
                    part = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    who, key = who[row], key[row] + (part << 32)
                    own = (_spread(x)[who] >> np.uint64(20)).astype(np.int64) % n[row]
                    home = home[row] & (own == part)
                yield pa.record_batch([pa.array(key), pa.array(fp[who]), pa.array(home)], names=["anchor", "fp", "home"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


def _forest(fps: np.ndarray, home: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Residents against all copies at one anchor: each linked fingerprint and the least one it is joined to here."""
    order = np.argsort(fps)
    signed, own = fps[order], np.flatnonzero(home[order])
    x, label = signed.view(np.uint64), np.arange(len(fps))
    step = max(1, BLOCK // len(x))
    for lo in range(0, len(own), step):
        part = own[lo : lo + step]
        near_a, near_b = np.nonzero(np.bitwise_count(x[part, None] ^ x[None, :]) <= t)
        other = part[near_a] != near_b
        unite(label, part[near_a[other]], near_b[other])
    moved = label != np.arange(len(label))
    return signed[moved], signed[label[moved]]


def _compare(copies: DataFrame, t: int) -> DataFrame:
    """Edges ``(u, v)`` from every anchor. The partitions stream in the order of their anchors; one anchor is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def finished(columns: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            anchor, fps, home = columns
            edge = np.flatnonzero(np.diff(anchor)) + 1
            lows, highs = np.concatenate([[0], edge]), np.concatenate([edge, [len(anchor)]])
            residents = np.add.reduceat(home.astype(np.int64), lows)
            for lo, hi in zip(lows[residents > 0].tolist(), highs[residents > 0].tolist(), strict=True):
                if hi - lo > 1:
                    u, v = _forest(fps[lo:hi], home[lo:hi], t)
                    if len(u):
                        yield pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

        for b in batches:
            now = tuple(c.to_numpy(zero_copy_only=False) for c in b.columns)
            if not len(now[0]):
                continue
            cut_at = int(np.searchsorted(now[0], now[0][-1]))
            if held and held[-1][0][-1] != now[0][0] or cut_at:
                held.append(tuple(c[:cut_at] for c in now))
                yield from finished(tuple(map(np.concatenate, zip(*held, strict=True))))
                held = []
            held.append(tuple(c[cut_at:] for c in now))
        if held:
            yield from finished(tuple(map(np.concatenate, zip(*held, strict=True))))

    return copies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3, hot_anchor: int = 20_000) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs(doc_id, text, ...)``.

    Fingerprints that differ in ``bits`` or fewer are linked; component_id is the
    smallest doc_id reachable. Null and empty texts have fingerprint 0, which is
    linked like any other. Equal rows and equal ids get equal results; a null id is
    never the smallest unless its component has no other. Other columns are ignored;
    an empty table gives an empty one.
    """
    prints = cut(fingerprints(docs, words), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    residents = lambda hot: _to_anchors(distinct, 0, hot).groupBy("anchor").count().where(F.col("count") > hot_anchor).collect()
    # At most 4096 anchors, so at most as many rows; refined ones, as many as there are fingerprints over hot_anchor.
    hot = frozenset(r["anchor"] for r in residents(frozenset()))
    parts = {r["anchor"]: -(-r["count"] // hot_anchor) for r in residents(hot)} if hot else {}
    linked = components(_compare(_to_anchors(distinct, bits, hot, parts), bits)).withColumnRenamed("node", "fp")
    members = cut(distinct.join(linked, "fp"), "members")
    low = members.groupBy("root").agg(F.min("first_id").alias("low_id"))
    by_print = distinct.join(members.join(low, "root").select("fp", "low_id"), "fp", "left").select("fp", F.coalesce("low_id", "first_id").alias("component_id"))
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    """The 16 lowercase hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


# Similar texts: longer fingerprints, for similarities that 64 bits can't tell apart.

#: Words of a long fingerprint, and the blocks of LENGTH of its bits that are covered each by the code.
LONG, BLOCKS = 4, 16
#: Bits in which a block of two similar texts may differ to be found there.
BLOCK_BITS = 1
#: Residents of an anchor above which they are dealt over several tasks.
MOST_RESIDENTS = 20_000
#: Texts that are looked at for frequent shingles, the least of them that hold one, and the most shingles taken for frequent. They order shingles, which no result depends on.
LOOKED_AT, OFTEN, MOST_FREQUENT = 10_000, 3, 1 << 16
#: Shingles that the heads of similar sets have in common at least, if the sets do.
HEADS_SHARE = 3
#: Bits of a set's parities, at least and at most: in bytes, powers of two.
PARITY_BYTES = 32, 512
#: Sets that meet at a shingle above which their pairs are dealt over several tasks.
MOST_MEETING = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _spread(h: np.ndarray) -> np.ndarray:
    """Another 64 bits from 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """A hash of each word shingle, repeats included; of the whole sequence if it is shorter; none without words."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    line, ends = b" ".join(tokens), np.cumsum([len(w) + 1 for w in tokens])
    n = max(1, len(tokens) - words + 1)
    stops = (ends[min(words, len(tokens)) - 1 :] - 1).tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(line[a:b]) for a, b in zip([0, *ends[: n - 1].tolist()], stops, strict=True)), np.uint64, n)


def long_fingerprint(every: np.ndarray) -> np.ndarray:
    """LONG words of majority bits over the hashes of word shingles, repeats included; zeros without any."""
    counts, n = np.zeros(64 * LONG, np.int64), len(every)
    for at in range(0, n, 16320):
        h = every[at : at + 16320]
        each = _spread(h[:, None] + _STEP * np.arange(1, LONG + 1, dtype=np.uint64))
        bits = np.unpackbits(each.view(np.uint8), axis=1, bitorder="little")
        counts += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > n, bitorder="little").view(np.uint64)


def bits_apart(similarity: float) -> tuple[int, int]:
    """Of fingerprints of texts with so large a share of common shingles: bits in which hardly any more similar, and hardly any less similar ones differ by more, by fewer.

    In the mean it is their angle's share of a half turn; two deviations are given to each side.
    """
    part = math.acos(2 * similarity / (1 + similarity)) / math.pi
    mean, deviation = 64 * LONG * part, math.sqrt(64 * LONG * part * (1 - part))
    return int(mean - 2 * deviation), int(mean + 2 * deviation)


@lru_cache
def _block_places() -> np.ndarray:
    """For each block the places of its bits: disjoint ones as far as they go, then anew in another order."""
    rng, a_turn = np.random.default_rng(SEED), 64 * LONG // LENGTH
    turns = [rng.permutation(64 * LONG)[: a_turn * LENGTH].reshape(a_turn, LENGTH) for _ in range(-(-BLOCKS // a_turn))]
    return np.concatenate(turns)[:BLOCKS]


def _names(fps: np.ndarray) -> np.ndarray:
    """A number for each long fingerprint, as a signed long."""
    h = np.zeros(len(fps), np.uint64)
    for k in range(LONG):
        h = _spread(h + _STEP + fps[:, k])
    return h.view(np.int64)


_LONG_DDL = ", ".join(f"f{k} long" for k in range(LONG))


def frequent_shingles(docs: DataFrame, words: int, looked_at: int = LOOKED_AT) -> np.ndarray:
    """Hashes of shingles that many of a sample of the texts hold, the rarest first."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            every = [np.unique(shingles(t, words)) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(np.concatenate(every).view(np.int64))], names=["h"])

    one_in = max(1, docs.count() // looked_at)
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0).select(F.col("text").cast("binary").alias("text"))
    held = some.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= OFTEN)
    rows = held.orderBy(F.desc("count"), "h").limit(MOST_FREQUENT).collect()
    return np.array([r["h"] for r in reversed(rows)], np.int64).view(np.uint64)


def least_common(size: int, similarity: float) -> int:
    """Shingles that a set of this size has at least in common with any so similar one."""
    return math.ceil(similarity * size - 1e-9)


def parities(held: np.ndarray) -> bytes:
    """For each of so many buckets of hashes, if an odd number of the set's are in it; 2 to 4 buckets for each, within PARITY_BYTES.

    A hash that only one of two sets holds changes one bit, so in no more bits than in hashes do sets differ.
    """
    least, most = PARITY_BYTES
    bits = 8 * min(most, max(least, 1 << (len(held) // 4).bit_length()))
    counts = np.bincount((held & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def parities_apart(x: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the parities of ``x[a[i]]`` and ``x[b[i]]`` differ, the longer ones folded to the length of the others."""
    size = np.array([len(p) for p in x])
    out = np.zeros(len(a), np.int64)
    for width in np.unique(np.minimum(size[a], size[b])).tolist():
        at = np.flatnonzero(np.minimum(size[a], size[b]) == width)
        used = np.unique(np.concatenate([a[at], b[at]]))
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(x[k], np.uint64).reshape(-1, width // 8), axis=0) for k in used.tolist()])
        for lo in range(0, len(at), 1 << 14):
            some = at[lo : lo + (1 << 14)]
            i, j = np.searchsorted(used, a[some]), np.searchsorted(used, b[some])
            out[some] = np.bitwise_count(folded[i] ^ folded[j]).sum(1, dtype=np.int64)
    return out


def long_fingerprints(docs: DataFrame, words: int = 5, similarity: float = 0.8, frequent: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, text_key, node, print, n, head, parity, f0, f1, ...)`` of every row.

    ``text_key`` names the text and ``node`` its set of shingles, of which there are ``n``; ``print`` names the fingerprint. In one order of all shingles,
    that of their hashes with the ``frequent`` ones last, the ``head`` holds a set's first ones, so many that of
    those it must share with a similar set all but HEADS_SHARE - 1 can't lie in the rest. So the heads of two similar sets have
    HEADS_SHARE shingles in common, or all common ones. ``parity`` has the set's parities(). Both are null where the same task has given them before.
    """
    ship(docs.sparkSession)
    rank = np.arange(0) if frequent is None else np.argsort(frequent)
    known = np.empty(0, np.uint64) if frequent is None else frequent[rank]

    def head_of(held: np.ndarray) -> np.ndarray:
        n = len(held) - least_common(len(held), similarity) + HEADS_SHARE
        if len(known):
            at = np.minimum(np.searchsorted(known, held), len(known) - 1)
            often = known[at] == held
            held = np.concatenate([held[~often], held[often][np.argsort(rank[at[often]])]])
        return held[:n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for b in sliced(batches):
            fps, nodes, sizes, heads, odd = [], [], [], [], []
            for text in b.column(2).to_pylist():
                every = shingles(text, words)
                held = np.unique(every)
                node = xxhash.xxh3_64_intdigest(held.tobytes())
                fps.append(long_fingerprint(every))
                nodes.append(_signed(node))
                sizes.append(len(held))
                heads.append(None if node in given else head_of(held).view(np.int64))
                odd.append(None if node in given else parities(held))
                if len(given) < 1 << 16:
                    given.add(node)
            fps = np.array(fps)
            columns = [b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(_names(fps)), pa.array(sizes, pa.int32()), pa.array(heads, pa.list_(pa.int64())), pa.array(odd, pa.binary()), *(pa.array(fps[:, k].view(np.int64)) for k in range(LONG))]
            yield pa.record_batch(columns, names=["doc_id", "text_key", "node", "print", "n", "head", "parity", *(f"f{k}" for k in range(LONG))])

    source = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, node long, print long, n int, head array<long>, parity binary, {_LONG_DDL}")


def _long_to_anchors(fps: DataFrame, parts: dict[int, int], home_only: bool = False) -> DataFrame:
    """``(place, f0, ...)``: a copy of each fingerprint at each anchor of each block; an even place is where it is resident.

    Residents of an anchor with several ``parts`` are dealt over them, and every copy goes to all.
    """
    many = np.ones(BLOCKS << 12, np.int64)
    for at, n in parts.items():
        many[at] = n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 1000):
            x = np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in b.columns], axis=1)
            bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little")
            mine = (_names(x).view(np.uint64) >> np.uint64(20)).astype(np.int64)
            for k, places in enumerate(_block_places()):
                block = bits[:, places].astype(np.uint32) @ (np.uint32(1) << np.arange(LENGTH, dtype=np.uint32))
                who, anchor, excess = _copies(block, 0 if home_only else BLOCK_BITS)
                at = (k << 12) + anchor.astype(np.int64)
                n = many[at]
                row = np.repeat(np.arange(len(at)), n)
                part = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                resident = (excess[row] == 0) & (mine[who[row]] % n[row] == part)
                place = ((part << 16) + at[row]) * 2 + ~resident
                yield pa.record_batch([pa.array(place), *(pa.array(x[who[row], w].view(np.int64)) for w in range(LONG))], names=["place", *(f"f{w}" for w in range(LONG))])

    return fps.select(*(f"f{k}" for k in range(LONG))).mapInArrow(run, f"place long, {_LONG_DDL}")


def _long_forest(x: np.ndarray, resident: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Residents against all copies at one anchor: a spanning forest ``(u, v, bits)``, by names, of pairs within ``most`` bits, nearer ones first.

    Half of the bits settle most pairs. A pair left out here is lost to whoever finds a pair of the
    forest not similar, so head_pairs() has to follow.
    """
    names = _names(x)
    order = np.argsort(names, kind="stable")
    x, names, own = x[order], names[order], np.flatnonzero(resident[order])
    label = np.arange(len(x))
    out: list[tuple[np.ndarray, ...]] = [(names[:0], names[:0], label[:0])]
    step = max(1, (BLOCK >> 4) // len(x))
    for lo in range(0, len(own), step):
        part = own[lo : lo + step]
        half = sum(np.bitwise_count(x[part, k][:, None] ^ x[None, :, k]) for k in range(LONG // 2))
        a, b = np.nonzero(half <= most)
        a = part[a]
        bits = np.bitwise_count(x[a] ^ x[b]).sum(1, dtype=np.int64)
        near = np.flatnonzero((bits <= most) & (a != b))
        near = near[np.argsort(bits[near], kind="stable")]
        a, b, bits = a[near], b[near], bits[near]
        while len(a):  # of the pairs that join two classes the nearest one each, until none does
            high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
            a, b, bits, high = (v[high != low] for v in (a, b, bits, high))
            _, first = np.unique(high, return_index=True)
            out.append((names[np.minimum(a, b)[first]], names[np.maximum(a, b)[first]], bits[first]))
            unite(label, a[first], b[first])
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def _long_compare(copies: DataFrame, most: int) -> DataFrame:
    """``(u, v, bits)`` between names of fingerprints from every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, x in _by_anchor(batches):
            resident = place % 2 == 0
            if resident.any() and len(x) > 1:
                found = _long_forest(x, resident, most)
                if len(found[0]):
                    yield pa.record_batch(list(map(pa.array, found)), names=["u", "v", "bits"])

    return copies.repartition(F.expr("place div 2")).sortWithinPartitions("place").mapInArrow(run, "u long, v long, bits long")


def _by_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, fingerprints) of one anchor after the other, from rows in the order of their places."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        if not b.num_rows:
            continue
        place = b.column(0).to_numpy(zero_copy_only=False)
        x = np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in b.columns[1:]], axis=1)
        edges = [0, *(np.flatnonzero(np.diff(place // 2)) + 1).tolist(), len(place)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if held and held[-1][0][-1] // 2 != place[lo] // 2:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held = []
            held.append((place[lo:hi], x[lo:hi]))
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def head_pairs(heads: DataFrame, similarity: float, most_meeting: int = MOST_MEETING) -> DataFrame:
    """``(u, v)``: of ``heads(node, root, n, head, parity)`` all pairs of different roots that may be similar; none that is so is missing.

    Similar sets have HEADS_SHARE shingles of their heads in common, or all those that they have to share. From each of these first ones on
    enough must come for what they have to share, but for those before it. Frequent shingles come last, so few sets meet at one;
    and where many meet, as in a group of near copies, most have one root and aren't paired. Sets that are
    near, but not similar, would meet at each of their common shingles: so the few sets that meet another one get their parities, and pairs
    that differ in more bits of these than similar sets can in shingles are left out. Over ``most_meeting`` sets at a shingle are
    divided into blocks, and each two blocks are paired in a cell of their own.
    """
    wanted = similarity / (1 + similarity)

    def common(n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.ceil(wanted * (n[a] + n[b]) - 1e-9).astype(np.int64)

    def meetings(token: np.ndarray, root: np.ndarray, n: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that may be similar, of rows in the order of token and root."""
        own = np.flatnonzero(np.concatenate([(token[1:] != token[:-1]) | (root[1:] != root[:-1]), [True]])) + 1
        run_of = np.flatnonzero(np.concatenate([token[1:] != token[:-1], [True]])) + 1
        i = np.arange(len(token))
        after, stop = own[np.searchsorted(own, i, side="right")], run_of[np.searchsorted(run_of, i, side="right")]
        total = np.cumsum(stop - after)
        lo = 0
        while lo < len(i):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (BLOCK >> 3), side="right")))
            times = (stop - after)[lo:hi]
            a = np.repeat(i[lo:hi], times)
            b = np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times) + after[a]
            lo = hi
            may = np.minimum(n[a] - at[a], n[b] - at[b]) + HEADS_SHARE - 1 >= common(n, a, b)
            yield a[may], b[may]

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_token(batches):
            order = np.lexsort((rows[1], rows[2], rows[0]))
            rows = tuple(c[order] for c in rows)
            new = np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])
            token, node, root, n, at = (c[new] for c in rows)
            meets = np.zeros(len(token), bool)
            for a, b in meetings(token, root, n, at):
                meets[a] = meets[b] = True
            if not meets.any():
                continue
            token, node, root, n, at = (c[meets] for c in (token, node, root, n, at))
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.diff(np.concatenate([first, [len(token)]]))
            blocks = np.repeat(-(-size // most_meeting), size)
            block = (np.arange(len(token)) - np.repeat(first, size)) * blocks // np.repeat(size, size)
            row = np.repeat(np.arange(len(token)), blocks)
            other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            low, high = np.minimum(block[row], other), np.maximum(block[row], other)
            cell = _spread(token[row].view(np.uint64) ^ _spread((low << 32 | high).astype(np.uint64) + _STEP)).view(np.int64)
            side = np.where(low == high, -1, block[row]).astype(np.int32)
            yield pa.record_batch(list(map(pa.array, (cell, node[row], root[row], n[row], at[row], side))), names=["cell", "node", "root", "n", "at", "side"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_token(batches):
            order = np.lexsort((rows[1], rows[2], rows[0]))
            cell, node, root, n, at, side, parity = (c[order] for c in rows)
            for a, b in meetings(cell, root, n, at):
                here = (side[a] < 0) | (side[a] != side[b])
                a, b = a[here], b[here]
                must = common(n, a, b)
                near = parities_apart(parity, a, b) <= n[a] + n[b] - 2 * must
                u, v, share = node[a[near]], node[b[near]], np.minimum(must[near], HEADS_SHARE)
                if len(u):
                    yield pa.record_batch([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(share)], names=["u", "v", "share"])

    given = heads.where("head IS NOT NULL")
    tokens = given.select("node", "root", "n", F.posexplode("head").alias("at", "token")).select("token", "node", "root", "n", "at")
    met = tokens.repartition("token").sortWithinPartitions("token").mapInArrow(meeting, "cell long, node long, root long, n int, at int, side int")
    odd = given.select("node", "parity").dropDuplicates(["node"])
    both = met.join(odd, "node").select("cell", "node", "root", "n", "at", "side", "parity")
    found = both.repartition("cell").sortWithinPartitions("cell").mapInArrow(pairs, "u long, v long, share long")
    return found.groupBy("u", "v", "share").count().where("count >= share").select("u", "v")


def _by_token(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of rows in the order of their first, several values of it at a time and each as a whole; values with a single row are left out."""
    held: list[tuple[np.ndarray, ...]] = []

    def several() -> Iterator[tuple[np.ndarray, ...]]:
        columns = tuple(map(np.concatenate, zip(*held, strict=True)))
        same = columns[0][1:] == columns[0][:-1]
        more = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        if more.any():
            yield tuple(c[more] for c in columns)

    for b in batches:
        if not b.num_rows:
            continue
        now = tuple(c.to_numpy(zero_copy_only=False) for c in b.columns)
        last = int(np.searchsorted(now[0], now[0][-1]))
        if last or held and held[-1][0][-1] != now[0][0]:
            held.append(tuple(c[:last] for c in now))
            yield from several()
            held = []
        held.append(tuple(c[last:] for c in now))
    if held:
        yield from several()


def _verified(docs: DataFrame, prints: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of ``pairs(u, v)`` of nodes whose texts have so large a share of common shingles."""
    asked = pairs.select("u").union(pairs.select("v")).distinct().withColumnRenamed("u", "node")
    witness = prints.join(asked, "node").groupBy("node").agg(F.min("text_key").alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            sets = [np.unique(shingles(t, words)).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"])

    texts = docs.select(F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text")).join(witness, "text_key").dropDuplicates(["node"])
    sets = cut(texts.select("node", "text").mapInArrow(run, "node long, hashes array<long>"), "shingles")
    both = pairs.join(sets.toDF("u", "of_u"), "u").join(sets.toDF("v", "of_v"), "v")
    common = F.size(F.array_intersect("of_u", "of_v"))
    return cut(both.where(common >= similarity * (F.size("of_u") + F.size("of_v") - common) - 1e-9).select("u", "v"), "verified")


def _apart(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """Of ``pairs(u, v, bits)`` the nearest one for any two groups of ``linked(node, root)``."""
    root = lambda c: linked.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    both = pairs.join(root("u"), "u", "left").join(root("v"), "v", "left")
    both = both.withColumns({"root_u": F.coalesce("root_u", "u"), "root_v": F.coalesce("root_v", "v")}).where("root_u != root_v")
    nearest = both.groupBy(F.least("root_u", "root_v"), F.greatest("root_u", "root_v")).agg(F.min(F.struct("bits", "u", "v")).alias("x"))
    return nearest.select("x.u", "x.v")


def _near_pairs(prints: DataFrame, similarity: float, most_residents: int) -> DataFrame:
    """``(u, v, bits)`` of nodes: spanning forests of those whose fingerprints are near, at each anchor, and of those with one fingerprint."""
    distinct = cut(prints.groupBy("print", *(f"f{k}" for k in range(LONG))).agg(F.min("node").alias("first")), "distinct")
    home = _long_to_anchors(distinct, {}, home_only=True)
    # At most 16 * 4096 anchors, so at most as many rows.
    hot = home.groupBy(F.expr("place div 2").alias("at")).count().where(F.col("count") > most_residents).collect()
    parts = {r["at"]: -(-r["count"] // most_residents) for r in hot}
    near = _long_compare(_long_to_anchors(distinct, parts), bits_apart(similarity)[1]).distinct()
    first = lambda c: distinct.select(F.col("print").alias(f"print_{c}"), F.col("first").alias(c))
    near = near.toDF("print_u", "print_v", "bits").join(first("u"), "print_u").join(first("v"), "print_v").select("u", "v", "bits")
    equal = prints.select("print", "node").distinct().join(distinct.select("print", "first"), "print").where("node != first")
    return near.union(equal.select("first", "node", F.lit(0).cast("long")))


def similar(docs: DataFrame, words: int = 5, similarity: float = 0.8, most_residents: int = MOST_RESIDENTS) -> DataFrame:
    """``(doc_id, text_key, node, root)`` for every row of ``docs(doc_id, text, ...)``: the group of similar texts it belongs to.

    Texts are linked if ``similarity`` or more of their shingles of ``words`` words, each counted once, are common
    to both. Most links are found by fingerprints of 256 bits, compared if one of 16 blocks of 23 bits
    differs in BLOCK_BITS or less, and within what texts of that similarity hardly exceed; first those nearest to each text, then
    the nearest between any two groups. What they can't find is found by the heads of the sets of shingles, which loses
    nothing. Each pair is held against its shingles before it links. Groups are what links connect, and a
    root is the smallest of a group's nodes. ``text_key`` is a hash of the text and ``node`` one of its set of shingles; null
    and empty texts have the empty set and are one group. Null
    and equal ids are allowed; other columns are ignored; no rows, no rows.
    """
    prints = cut(long_fingerprints(docs, words, similarity, frequent_shingles(docs, words)), "long-fingerprints")
    pairs = cut(_near_pairs(prints, similarity, most_residents), "pairs")
    ends = pairs.select("u", F.struct("bits", "v").alias("to")).union(pairs.select("v", F.struct("bits", F.col("u").alias("v"))))
    nearest = ends.groupBy("u").agg(F.min("to").alias("to")).select(F.least("u", "to.v").alias("u"), F.greatest("u", "to.v").alias("v")).distinct()
    links = _verified(docs, prints, cut(nearest, "nearest"), words, similarity)
    linked = cut(components(links), "linked")
    links = links.union(_verified(docs, prints, cut(_apart(pairs, linked), "open-pairs"), words, similarity))
    linked = cut(components(links), "linked")
    heads = prints.where("head IS NOT NULL").join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "n", "head", "parity")
    links = links.union(_verified(docs, prints, cut(head_pairs(heads, similarity), "head-pairs"), words, similarity))
    return prints.select("doc_id", "text_key", "node").join(components(links), "node", "left").select("doc_id", "text_key", "node", F.coalesce("root", "node").alias("root"))


def keep_first(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``docs`` for each group of similar(): of its root's texts the one of the smallest doc_id.

    Rows with a null id are kept as they are: they can't be named as copies. An id that
    stands for different texts is a document for each; rows equal in id and text are
    one. Columns stay, whatever their names; no rows, no rows.
    """
    (key,) = apart(docs.columns, "_text_key")
    named = docs.where("doc_id IS NOT NULL")
    roots = similar(named, words, similarity).where("node = root")
    first = roots.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("x")).select("x.doc_id", F.col("x.text_key").alias(key))
    kept = named.withColumn(key, F.xxhash64("text")).join(first, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key]).drop(key)
    return kept.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
