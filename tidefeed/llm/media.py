"""Binary payloads as PNG images in a column, and back.

A payload becomes an 8-bit grey image of 64 samples a row. The writer chooses one
of the filters none, sub and up for each row; the reader takes all five, tests
each chunk's CRC and unfilters with numpy. The feature of an image is the sign
pattern of its lowest cosine-transform coefficients.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.storage import apart, ship, sliced

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
#: Side of the image that the cosine transform sees, and of the low-frequency corner that is kept.
SIDE, CORNER = 32, 8


class DamagedMedia(ValueError):
    """The stored form is not a PNG that this reader takes, or a checksum fails."""


def pad(data: bytes) -> bytes:
    """``data`` with bytes 0 up to a positive multiple of 64."""
    return data + bytes(max(WIDTH, -(-len(data) // WIDTH) * WIDTH) - len(data))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, level: int = 1) -> bytes:
    """A grey PNG whose samples are ``payload``, of which the length is a positive multiple of 64."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    tried = np.empty((3, *rows.shape), np.uint8)
    tried[0] = rows
    tried[1] = rows
    tried[1, :, 1:] -= rows[:, :-1]
    tried[2] = rows
    tried[2, 1:] -= rows[:-1]
    cost = np.abs(tried.view(np.int8).astype(np.int16)).sum(2, dtype=np.int32)
    kind = cost.argmin(0)
    lines = np.empty((len(rows), WIDTH + 1), np.uint8)
    lines[:, 0] = kind
    lines[:, 1:] = tried[kind, np.arange(len(rows))]
    header = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def chunks(stored: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, data) of each chunk, with the signature and every CRC tested."""
    if stored[:8] != SIGNATURE:
        raise DamagedMedia("no PNG signature")
    at = 8
    while at < len(stored):
        if at + 12 > len(stored):
            raise DamagedMedia("cut short in a chunk's frame")
        (n,) = struct.unpack_from(">I", stored, at)
        kind, data, crc = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + n], stored[at + 8 + n : at + 12 + n]
        if len(crc) < 4 or struct.unpack(">I", crc)[0] != zlib.crc32(kind + data):
            raise DamagedMedia(f"checksum of {kind!r}")
        yield kind, data
        at += 12 + n
    if at == 8 or kind != b"IEND":
        raise DamagedMedia("no IEND")


def _unfilter(lines: np.ndarray) -> np.ndarray:
    kinds, out = lines[:, 0], lines[:, 1:].copy()
    if kinds.size and kinds.max() > 4:
        raise DamagedMedia("unknown filter")
    edge = np.flatnonzero(np.diff(kinds)) + 1
    for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(kinds)], strict=True):
        kind = kinds[lo]
        if kind == 1:
            np.cumsum(out[lo:hi], axis=1, dtype=np.uint8, out=out[lo:hi])
        elif kind == 2:
            if lo:
                out[lo] += out[lo - 1]
            np.cumsum(out[lo:hi], axis=0, dtype=np.uint8, out=out[lo:hi])
        elif kind >= 3:
            for y in range(lo, hi):
                _sequential(out[y], out[y - 1] if y else np.zeros_like(out[y]), kind)
    return out


def _sequential(row: np.ndarray, above: np.ndarray, kind: int) -> None:
    """The filters average and Paeth, in place; each sample needs the one before it."""
    a = c = 0
    for x, (v, b) in enumerate(zip(row.tolist(), above.tolist(), strict=True)):
        if kind == 3:
            guess = (a + b) // 2
        else:
            pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
        a, c = (v + guess) & 255, b
        row[x] = a


def decode_png(stored: bytes) -> np.ndarray:
    """The samples (height, width) of a grey 8-bit PNG; DamagedMedia if it isn't one or a test fails."""
    header, packed = None, []
    for kind, data in chunks(stored):
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            packed.append(data)
    if header is None or header[2:] != (8, 0, 0, 0, 0):
        raise DamagedMedia("not a grey 8-bit image without interlace")
    try:
        raw = zlib.decompress(b"".join(packed))  # tests the Adler-32 too
    except zlib.error as e:
        raise DamagedMedia(str(e)) from e
    width, height = header[:2]
    if len(raw) != height * (width + 1):
        raise DamagedMedia("wrong number of samples")
    return _unfilter(np.frombuffer(raw, np.uint8).reshape(height, width + 1))


def _basis(n: int, k: int) -> np.ndarray:
    return np.cos(np.pi * (2 * np.arange(n) + 1) * np.arange(k)[:, None] / (2 * n))


_DCT = _basis(SIDE, CORNER)


def cosine_hash(image: np.ndarray) -> str:
    """16 hex digits: which of the 8 x 8 lowest cosine coefficients exceed their median, the mean left out of it."""
    small = image
    for axis in (0, 1):
        n = small.shape[axis]
        at = np.arange(SIDE) * n // SIDE
        to = np.maximum((np.arange(SIDE) + 1) * n // SIDE, at + 1)
        total = np.concatenate([np.zeros_like(small.take([0], axis), np.float64), np.cumsum(small, axis=axis, dtype=np.float64)], axis=axis)
        span = (to - at).reshape((-1, 1) if axis == 0 else (1, -1))
        small = (total.take(to, axis) - total.take(at, axis)) / span
    low = np.round(_DCT @ small @ _DCT.T, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def to_media(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` and ``media``, the PNG of the padded bytes of a string or binary column.

    Null counts as empty: one row of zeros. A column of ``docs`` named like a new one
    is replaced. No rows, no rows.
    """
    ship(docs.sparkSession)
    payload = F.coalesce(F.col(column).cast("binary"), F.lit(b""))
    kept = docs.drop("n_bytes", "media")
    plain = docs.withColumn(*apart(docs.columns, "_payload"), payload).drop("n_bytes", "media")
    schema = kept.schema.add("n_bytes", "long").add("media", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            data = b.columns[-1].to_pylist()
            new = [pa.array([len(x) for x in data], pa.int64()), pa.array([encode_png(pad(x)) for x in data], pa.binary())]
            yield pa.record_batch([*b.columns[:-1], *new], names=schema.names)

    return plain.mapInArrow(run, schema)


def digests(media: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, payload_bytes, ..., feature)`` read back from the column ``media`` of to_media().

    A row for each row, equal ones for equal ones; null ids are allowed, other columns
    ignored; a null or damaged image raises DamagedMedia; no rows, no rows.
    """
    kind = media.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = []
            for stored in b.column(2).to_pylist():
                image = decode_png(stored or b"")
                payload = image.tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(stored), hashlib.sha256(stored).hexdigest(), cosine_hash(image)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.record_batch([b.column(0), b.column(1), *map(pa.array, columns, kinds)], names=names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
