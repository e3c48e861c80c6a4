"""Byte-level BPE as a transducer.

A sequence of tokens is the BPE encoding of its bytes exactly if each two
neighbours are the encoding of theirs. So the encodings of all texts are the paths
of a finite-state transducer: walk the trie of the tokens, and at the end of a token
return to its root if the token may follow the one before. Several paths are open
at a time, but the one that is complete after a given byte is unique.

``Transducer`` determinises that machine while it runs: a state is the set of open
paths, and a step on a byte is worked out once: the next state and the token that is
complete there. An open path starts at most one token's length back; tokens up to
the last border that all open paths share are settled and emitted.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.llm.storage import apart, ship, sliced

#: Determinised steps and cached pieces that one worker keeps; beyond it, it forgets and works them out again.
STEPS, PIECES, LONGEST_PIECE = 500_000, 700_000, 64
#: Bytes of a long piece after which settled tokens are emitted.
CHUNK = 256
#: Texts of which the ids are held at a time.
ROWS = 500


def load_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes to ranks, from the lines of a rank file: base64, space, decimal rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge(data: bytes, ranks: dict[bytes, int], until: int = 1) -> tuple[int, ...]:
    """The definition: merge the leftmost pair of lowest rank until ``until`` parts or no pair is left. For short strings."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > until:
        best = min(((ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return tuple(ranks[p] for p in parts)


class Transducer:
    """Encodes the bytes of one piece of text."""

    START = 0

    def __init__(self, ranks: dict[bytes, int], most: int = STEPS):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the ranks lack single bytes: {missing[:5]}")
        self.ranks, self.most = ranks, most
        self.bytes_of = {r: t for t, r in ranks.items()}
        # trie: children[node] = {byte: node}; token_at[node] = rank or -1
        self.children: list[dict[int, int]] = [{}]
        self.token_at, self.depth = [-1], [0]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                before, node = node, self.children[node].setdefault(b, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token_at.append(-1)
                    self.depth.append(self.depth[before] + 1)
            self.token_at[node] = rank
        self.length = {r: len(t) for t, r in ranks.items()}
        self._reached: dict[int, bool] = {}
        self._split: dict[int, tuple[int, ...] | None] = {}
        self._follows: dict[int, bool] = {}
        self.paths = len(ranks) + 1
        self._forget()

    def _forget(self) -> None:
        # A state is its open paths: trie node * paths + token before the path's start + 1. It is named by a multiple of
        # 256, so that name + byte is the key of a step to (state, token that is complete there or -1).
        self.states: list[tuple[int, ...]] = [(0,)]
        self.number = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge joins in the encoding of the token's own bytes; None of a single byte."""
        known = self._split.get(token, False)
        if known is False:
            parts = merge(self.bytes_of[token], self.ranks, until=2)
            known = self._split[token] = parts if len(parts) == 2 else None
        return known

    def _reachable(self, token: int) -> bool:
        known = self._reached.get(token)
        if known is None:
            known = self._reached[token] = merge(self.bytes_of[token], self.ranks) == (token,)
        return known

    def may_follow(self, before: int, token: int) -> bool:
        """Whether the bytes of both tokens encode as these two.

        They don't if some merge joins across the border before either side's own
        merge takes that end away. The ends are undone latest first; of equal ranks
        the left one merges first.
        """
        if before < 0:
            return self._reachable(token)
        pair = before * self.paths + token
        known = self._follows.get(pair)
        if known is not None:
            return known
        if len(self._follows) > 2 * self.most:
            self._follows.clear()
        fine = self._reachable(token)
        a, b, until = before, token, len(self.ranks) + 1
        while fine:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and across < until:
                fine = False
                break
            left, right = self._halves(a), self._halves(b)
            if left is not None and (right is None or a > b):
                until, a = a, left[1]
            elif right is not None:
                until, b = b + 1, right[0]
            else:
                break
        self._follows[pair] = fine
        return fine

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        after, done = [], -1
        for path in self.states[state >> 8]:
            node, before = divmod(path, self.paths)
            to = self.children[node].get(byte, -1)
            if to < 0:
                continue
            if self.children[to]:
                after.append(path + (to - node) * self.paths)
            token = self.token_at[to]
            if done < 0 <= token and self.may_follow(before - 1, token):
                done = token
        if done >= 0:
            after.append(done + 1)
        key = tuple(after)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states) << 8
            self.states.append(key)
        self.steps[state + byte] = out = (to, done)
        return out

    def _walk(self, state: int, piece: bytes, ends: list[int]) -> int:
        known, push = self.steps.get, ends.append
        for byte in piece:
            state, done = known(state + byte) or self._step(state, byte)
            push(done)
        return state

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece; as the tiktoken library, a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.steps) > self.most:
            self._forget()
        ends: list[int] = []
        if len(piece) <= CHUNK:
            self._walk(self.START, piece, ends)
            return tuple(self._back(ends))
        out: list[int] = []
        state = self.START
        for at in range(0, len(piece), CHUNK):
            state = self._walk(state, piece[at : at + CHUNK], ends)
            settled = self._settled(state, ends)
            out += self._back(ends[:settled])
            ends = ends[settled:]
        return tuple(out + self._back(ends))

    def _settled(self, state: int, ends: list[int]) -> int:
        """The last border of tokens that all open paths have in common."""
        common: set[int] | None = None
        for path in self.states[state >> 8]:
            at = len(ends) - self.depth[path // self.paths]
            borders = {at}
            while at > 0:
                at -= self.length[ends[at - 1]]
                borders.add(at)
            common = borders if common is None else common & borders
        return max(common or {0})

    def _back(self, ends: list[int]) -> list[int]:
        """The path that is complete at the last byte, from the token that ends at each."""
        found, at = [], len(ends)
        while at:
            token = ends[at - 1]
            found.append(token)
            at -= self.length[token]
        return found[::-1]


class Utf8:
    """An incremental decoder of UTF-8: feed bytes in any portions, get the text that is complete so far.

    A malformed byte or a cut sequence becomes U+FFFD, as many as Python's own
    decoder makes. ``need`` continuation bytes are missing; the next one must lie in
    [low, high].
    """

    def __init__(self) -> None:
        self.held, self.need, self.low, self.high = bytearray(), 0, 0x80, 0xBF

    #: first byte -> (continuation bytes, lowest and highest second byte)
    FIRST = {
        **{b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}, **{b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)}, 0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F),
        **{b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}, 0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F),
    }

    def feed(self, data: bytes) -> str:
        if not self.need:
            try:
                return data.decode()  # whole characters only: the machine would stay in its start state
            except UnicodeDecodeError:
                pass
        out: list[str] = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.held.append(b)
                    self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(self.held.decode())
                        self.held.clear()
                    continue
                out.append("�")
                self.held.clear()
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif b in self.FIRST:
                self.need, self.low, self.high = self.FIRST[b]
                self.held.append(b)
            else:
                out.append("�")
        return "".join(out)

    def close(self) -> str:
        cut = bool(self.need)
        self.__init__()
        return "�" if cut else ""


class Pieces(dict):
    """The ids of pieces met so far, in two generations of half of ``most``: as one fills up, the other is forgotten, but for the pieces that came again."""

    def __init__(self, encode: Callable[[bytes], tuple[int, ...]], most: int):
        self.encode, self.old, self.most = encode, {}, most

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece) or self.encode(piece.encode("utf-8", "replace"))
        if len(piece) <= LONGEST_PIECE:
            if len(self) >= self.most // 2:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Texts to ids and back, with the pieces met so far kept in a bounded cache."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, steps: int = STEPS, pieces: int = PIECES):
        self.transducer = Transducer(ranks, steps)
        self.split = regex.compile(pattern).findall
        self.bytes_of = self.transducer.bytes_of
        self.pieces = Pieces(self.transducer.encode, pieces)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text, token by token, as soon as its characters are whole."""
        machine = Utf8()
        for i in ids:
            yield machine.feed(self.bytes_of[i])
        yield machine.close()


_codecs: dict[str, Codec] = {}


def _codec(name: str, rank_file: bytes, pattern: str, steps: int = STEPS, pieces: int = PIECES) -> Codec:
    """This worker's codec, compiled once."""
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(load_ranks(rank_file.splitlines()), pattern, steps, pieces)
    return _codecs[name]


def _uncollected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with the garbage collector off until the last: the caches are millions of small tuples without cycles, which it would walk again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield from batches
    finally:
        gc.freeze()
        if was:
            gc.enable()


def _shared(df: DataFrame, path: str, pattern: str):
    ship(df.sparkSession)
    with open(path, "rb") as f:
        data = f.read()
    return hashlib.sha256(data + pattern.encode()).hexdigest(), df.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, path: str, pattern: str, column: str = "text", output: str = "ids", keep: Sequence[str] | None = None, steps: int = STEPS, pieces: int = PIECES, decoded: str | None = None) -> DataFrame:
    """``docs`` with the array ``output`` of token ids of a string column; ``path``: the driver's rank file.

    ``keep`` names the columns returned beside it (None: all). ``steps`` and ``pieces``
    bound what a worker keeps in memory; the ids don't depend on them. ``decoded`` names a
    column for the SHA-256 of the text that the ids decode to. Null counts as empty: no ids. Bytes that aren't UTF-8 become U+FFFD first. A column named like ``output`` is
    replaced; no rows, no rows.
    """
    name, shared = _shared(docs, path, pattern)
    name += f" {steps} {pieces}"
    kept = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c not in (output, decoded)])
    source = docs.select(*(F.col(f"`{c}`") for c in kept.columns), F.col(column).cast("binary").alias(*apart(docs.columns, "_text")))
    schema = kept.schema.add(output, T.ArrayType(T.IntegerType()))
    schema = schema.add(decoded, "string") if decoded else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, shared.value, pattern, steps, pieces)
        for b in _uncollected(sliced(batches, ROWS)):
            ids = [codec.encode((t or b"").decode("utf-8", "replace")) for t in b.columns[-1].to_pylist()]
            back = [pa.array([_decoded_hash(codec, x) for x in ids], pa.string())] if decoded else []
            yield pa.record_batch([*b.columns[:-1], pa.array(ids, pa.list_(pa.int32())), *back], names=schema.names)

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: each text encoded, and its ids decoded again.

    Decoding runs through the incremental UTF-8 machine; its text's bytes are hashed.
    Texts as in encode().
    """
    name, shared = _shared(docs, path, pattern)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, shared.value, pattern)
        for b in _uncollected(sliced(batches, ROWS)):
            n, ids_hash, text_hash = [], [], []
            for t in b.column(1).to_pylist():
                ids = codec.encode((t or b"").decode("utf-8", "replace"))
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                text_hash.append(_decoded_hash(codec, ids))
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _decoded_hash(codec: Codec, ids: list[int]) -> str:
    machine, digest, token = Utf8(), hashlib.sha256(), codec.bytes_of
    for at in range(0, len(ids), 4096):
        digest.update(machine.feed(b"".join([token[i] for i in ids[at : at + 4096]])).encode())
    digest.update(machine.close().encode())
    return digest.hexdigest()
