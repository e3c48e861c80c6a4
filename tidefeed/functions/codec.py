"""Fixed-layout binary records: packed and zoned decimals, EBCDIC text, dates, entry, block and receiver headers.

A record is a slice of bytes for each field, so a batch of records is a matrix of
bytes: each field's slice is decoded as one numpy or Arrow array. A record that can't
be read has null fields and the reason; the others of its batch are not touched.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, time
from decimal import Decimal
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.sources.scratch import fresh_path
from tidefeed.sources.shipping import ship

# Python codecs of code pages, and pages given by where they differ from page 37.
PAGES = {37: "cp037", 273: "cp273", 500: "cp500", 1140: "cp1140", 1208: "utf-8", 13488: "utf-16-be", 1200: "utf-16-be"}
_BRITISH = {0x4A: "$", 0x5B: "£", 0xA1: "¯", 0xB0: "¢", 0xB1: "[", 0xBA: "^", 0xBC: "~"}
DIFFERENT = {285: _BRITISH, 1146: _BRITISH | {0x9F: "€"}, 1047: {0x5F: "^", 0xAD: "[", 0xB0: "¬", 0xBA: "Ý", 0xBB: "¨", 0xBD: "]"}}
DEFAULT_PAGE = 37


class UnknownPage(ValueError):
    """No code page of this number is known."""


class UnknownType(ValueError):
    """No decoder for a column type."""


@lru_cache
def _table(ccsid: int) -> str | None:
    """The 256 characters of a single-byte page; None of a wider one."""
    if ccsid in DIFFERENT:
        known = list(bytes(range(256)).decode("cp037"))
        for at, c in DIFFERENT[ccsid].items():
            known[at] = c
        return "".join(known)
    if ccsid not in PAGES:
        raise UnknownPage(f"code page {ccsid}")
    # Python has page 273's macron as an overline.
    return None if PAGES[ccsid].startswith("utf") else bytes(range(256)).decode(PAGES[ccsid]).replace("‾", "¯")


@lru_cache
def _places(ccsid: int) -> dict[str, int]:
    return {c: i for i, c in enumerate(_table(ccsid) or "")}


def effective(ccsid: int, override: tuple[int, int] | None = None) -> int:
    """A column's page: none (-1) is the default one; ``override`` replaces one declared page by another."""
    ccsid = DEFAULT_PAGE if ccsid == -1 else ccsid
    return override[1] if override and ccsid == override[0] else ccsid


def decode_text(data: bytes, ccsid: int, override: tuple[int, int] | None = None) -> str:
    ccsid = effective(ccsid, override)
    table = _table(ccsid)
    return data.decode(PAGES[ccsid]) if table is None else data.decode("latin1").translate(table)


def encode_text(text: str, ccsid: int) -> bytes:
    ccsid = effective(ccsid)
    if _table(ccsid) is None:
        return text.encode(PAGES[ccsid])
    try:
        return bytes(map(_places(ccsid).__getitem__, text))
    except KeyError as e:
        raise ValueError(f"{e.args[0]!r} isn't in code page {ccsid}") from e


# Widths of the types that have one; text forms of dates and times.
WIDTHS = {"smallint": 2, "integer": 4, "bigint": 8, "real": 4, "double": 8, "date": 10, "time": 8, "timestamp": 26, "xml": 44, "clob": 44}
_FORMS = {"date": "%Y-%m-%d", "time": "%H.%M.%S", "timestamp": "%Y-%m-%d-%H.%M.%S.%f"}
_VARIABLE = ("varchar", "varbinary")


@dataclass(frozen=True)
class Field:
    """``length``: digits, characters or bytes; ``wide``: bytes of a character."""

    name: str
    kind: str
    length: int = 0
    scale: int = 0
    ccsid: int = DEFAULT_PAGE
    wide: int = 0

    @property
    def bytes_per_char(self) -> int:
        return self.wide or (2 if self.kind in ("char", "varchar") and self.ccsid in (13488, 1200) else 1)

    @property
    def size(self) -> int:
        if self.kind == "packed":
            return self.length // 2 + 1
        return WIDTHS.get(self.kind) or self.length * self.bytes_per_char + 2 * (self.kind in _VARIABLE)

    @property
    def arrow(self) -> pa.DataType:
        fixed = {
            "smallint": pa.int16(), "integer": pa.int32(), "bigint": pa.int64(), "real": pa.float32(), "double": pa.float64(), "date": pa.date32(), "time": pa.string(), "timestamp": pa.timestamp("us"),
            "binary": pa.binary(), "varbinary": pa.binary(),
        }
        return pa.decimal128(self.length, self.scale) if self.kind in ("packed", "zoned") else fixed.get(self.kind, pa.string())

    @property
    def ddl(self) -> str:
        spark = {"smallint": "smallint", "integer": "int", "bigint": "bigint", "real": "float", "double": "double", "date": "date", "timestamp": "timestamp_ntz", "binary": "binary", "varbinary": "binary"}
        kind = f"decimal({self.length},{self.scale})" if self.kind in ("packed", "zoned") else spark.get(self.kind, "string")
        return f"`{self.name}` {kind}"


# Column types of the source, by the field kinds above.
KINDS = {
    "DECIMAL": "packed", "NUMERIC": "zoned", "SMALLINT": "smallint", "INTEGER": "integer", "BIGINT": "bigint", "REAL": "real", "DOUBLE": "double", "CHAR": "char", "NCHAR": "char", "GRAPHIC": "char",
    "VARCHAR": "varchar", "NVARCHAR": "varchar", "VGRAPH": "varchar", "VARGRAPHIC": "varchar", "BINARY": "binary", "VARBINARY": "varbinary", "DATE": "date", "TIME": "time", "TIMESTAMP": "timestamp", "XML": "xml", "CLOB": "clob",
}
_BITS = re.compile(r"(VAR)?CHAR \((\d*)\) FOR BIT DATA")
_WIDE = ("NCHAR", "NVARCHAR", "VGRAPH", "GRAPHIC", "VARGRAPHIC", "VARCHAR")


def field_of(name: str, type_name: str, length: int, scale: int = 0, ccsid: int | None = None, octets: int | None = None) -> Field:
    """The field of a catalogue column; UnknownType of a type without a decoder. Bit data is bytes, of the length in its name or else the column's."""
    if bits := _BITS.fullmatch(type_name):
        return Field(name, "varbinary" if bits[1] else "binary", int(bits[2] or length))
    if type_name not in KINDS:
        raise UnknownType(f"unsupported type {type_name} of column {name}")
    wide = max(1, (octets or 0) // length) if type_name in _WIDE and length and octets else 0
    return Field(name, KINDS[type_name], length, scale, DEFAULT_PAGE if ccsid in (None, -1) else ccsid, wide)


# --- one value ----------------------------------------------------------------


def decode_field(f: Field, data: bytes, override: tuple[int, int] | None = None) -> Any:
    if f.kind in ("smallint", "integer", "bigint"):
        return int.from_bytes(data, "big", signed=True)
    if f.kind in ("real", "double"):
        return struct.unpack(">f" if f.kind == "real" else ">d", data)[0]
    if f.kind == "packed":
        digits = data.hex()
        return Decimal(int(digits[:-1])).scaleb(-f.scale) * (-1 if digits[-1] in "bd" else 1)
    if f.kind == "zoned":
        digits = "".join(f"{b & 15:x}" for b in data)
        return Decimal(int(digits)).scaleb(-f.scale) * (-1 if data[-1] >> 4 in (0xB, 0xD) else 1)
    if f.kind in _VARIABLE:
        n = int.from_bytes(data[:2], "big")
        if n > f.length:
            raise ValueError(f"{n} of {f.length}")
        body = data[2 : 2 + n * f.bytes_per_char]
        return body if f.kind == "varbinary" else decode_text(body, f.ccsid, override)
    if f.kind == "char":
        return decode_text(data, f.ccsid, override)
    if f.kind in _FORMS:
        at = datetime.strptime(decode_text(data, DEFAULT_PAGE), _FORMS[f.kind])
        return at.date() if f.kind == "date" else at.time().isoformat() if f.kind == "time" else at
    if f.kind in ("xml", "clob"):
        return ""  # not journaled: a place holder
    if f.kind == "binary":
        return data
    raise UnknownType(f.kind)


def encode_field(f: Field, value: Any) -> bytes:
    if f.kind in ("smallint", "integer", "bigint"):
        return value.to_bytes(f.size, "big", signed=True)
    if f.kind in ("real", "double"):
        return struct.pack(">f" if f.kind == "real" else ">d", value)
    if f.kind in ("packed", "zoned"):
        whole = int(abs(Decimal(value)).scaleb(f.scale))
        sign = "d" if value < 0 else "f"
        if f.kind == "packed":
            return bytes.fromhex((str(whole) + sign).rjust(2 * f.size, "0"))
        digits = str(whole).rjust(f.length, "0")
        return bytes(0xF0 | int(d) for d in digits[:-1]) + bytes([int(sign, 16) << 4 | int(digits[-1])])
    if f.kind == "varchar":
        return (len(value).to_bytes(2, "big") + encode_text(value, f.ccsid)).ljust(f.size, b"\0")
    if f.kind == "varbinary":
        return (len(value).to_bytes(2, "big") + value).ljust(f.size, b"\0")
    if f.kind == "char":
        return encode_text(value.ljust(f.length), f.ccsid)
    if f.kind in _FORMS:
        text = value if isinstance(value, str) else value.strftime(_FORMS[f.kind])
        if not isinstance(value, str) and f.kind != "time":
            text = f"{value.year:04}{text[text.index('-') :]}"  # strftime doesn't fill years
        return encode_text(text.replace(":", "."), DEFAULT_PAGE).ljust(f.size, b"\x40")
    return (b"" if f.kind in ("xml", "clob") else value).ljust(f.size, b"\0")


def decode_record(fields: list[Field], data: bytes, nulls: bytes = b"", override: tuple[int, int] | None = None) -> dict[str, Any]:
    """A row; ``nulls`` has a byte for each field, whose low digit 1 says null."""
    at, out = 0, {}
    for i, f in enumerate(fields):
        out[f.name] = None if i < len(nulls) and nulls[i] & 15 == 1 else decode_field(f, data[at : at + f.size], override)
        at += f.size
    return out


def encode_record(fields: list[Field], row: dict[str, Any]) -> bytes:
    return b"".join(encode_field(f, row[f.name]) for f in fields)


def null_indicators(data: bytes, at: int) -> bytes:
    """The indicators of an entry: a count, then a byte for each field."""
    (n,) = struct.unpack_from(">I", data, at)
    return data[at + 4 : at + 4 + n]


# --- a batch of records ---------------------------------------------------------


def _decimals(value: np.ndarray, f: Field) -> pa.Array:
    """Whole numbers of up to 18 digits as decimals, without a detour over Python objects."""
    parts = np.empty((len(value), 2), np.int64)
    parts[:, 0], parts[:, 1] = value, value >> 63
    return pa.Array.from_buffers(f.arrow, len(value), [None, pa.py_buffer(parts.tobytes())])


def _numbers(f: Field, m: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    high, low = (m >> 4).astype(np.int64), (m & 15).astype(np.int64)
    if f.kind == "packed":
        digits = np.empty((len(m), 2 * m.shape[1] - 1), np.int64)
        digits[:, ::2], digits[:, 1::2] = high, low[:, :-1]
        sign, bad = low[:, -1], (digits > 9).any(1) | (low[:, -1] < 10)
    else:
        digits, sign = low, high[:, -1]
        bad = (digits > 9).any(1) | (sign < 10)
    value = np.where(bad[:, None], 0, digits) @ (10 ** np.arange(digits.shape[1] - 1, -1, -1, dtype=np.int64))
    return _decimals(np.where(np.isin(sign, (0xB, 0xD)), -value, value), f), bad


def _moments(f: Field, m: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Dates, times and timestamps by their digits."""
    digit, is_digit = (m & 15).astype(np.int64), m >= 0xF0
    number = lambda lo, hi: digit[:, lo:hi] @ (10 ** np.arange(hi - lo - 1, -1, -1))
    marks = [i for i, c in enumerate({"date": "0000-00-00", "time": "00.00.00", "timestamp": "0000-00-00-00.00.00.000000"}[f.kind]) if c != "0"]
    where = np.ones(m.shape[1], bool)
    where[marks] = False
    bad = ~is_digit[:, where].all(1) | (digit[:, where] > 9).any(1)
    clock = 0 if f.kind == "time" else 11
    if f.kind != "date":
        hour, minute, second = (number(clock + k, clock + k + 2) for k in (0, 3, 6))
        bad |= (hour > 24) | (minute > 59) | (second > 59)
    if f.kind == "time":
        return pa.array([f"{a:02}:{b:02}:{c:02}" for a, b, c in zip(hour.tolist(), minute.tolist(), second.tolist(), strict=True)], pa.string()), bad
    year, month, day = number(0, 4), number(5, 7), number(8, 10)
    bad |= (month < 1) | (month > 12) | (day < 1) | (year < 1)
    first = (np.where(bad, 1970, year) - 1970).astype("datetime64[Y]").astype("datetime64[M]") + np.where(bad, 0, month - 1)
    days = first.astype("datetime64[D]") + np.where(bad, 0, day - 1)
    bad |= days.astype("datetime64[M]") != first
    if f.kind == "date":
        return pa.array(days), bad
    moment = ((hour * 60 + minute) * 60 + second) * 1_000_000 + number(20, 26)
    return pa.array(days.astype("datetime64[us]") + np.where(bad, 0, moment).astype("timedelta64[us]")), bad


def _texts(f: Field, m: np.ndarray, override: tuple[int, int] | None) -> tuple[pa.Array, np.ndarray]:
    """Characters of fixed or variable fields. A single-byte page decodes all rows as one string."""
    bad = np.zeros(len(m), bool)
    sizes = [f.length] * len(m)
    if f.kind == "varchar":
        given = m[:, 0].astype(np.int64) * 256 + m[:, 1]
        bad, m = given > f.length, m[:, 2:]
        sizes = np.where(bad, 0, given).tolist()
    table, width = _table(effective(f.ccsid, override)), f.length
    if table is not None and f.bytes_per_char == 1:
        whole = np.ascontiguousarray(m).tobytes().decode("latin1").translate(table)
        return pa.array([whole[i * width : i * width + n] for i, n in enumerate(sizes)], pa.string()), bad
    out: list[str | None] = []
    for i, n in enumerate(sizes):
        try:
            out.append(decode_text(m[i, : n * f.bytes_per_char].tobytes(), f.ccsid, override))
        except UnicodeDecodeError:
            out.append(None)
            bad[i] = True
    return pa.array(out, pa.string()), bad


def _column(f: Field, m: np.ndarray, override: tuple[int, int] | None) -> tuple[pa.Array, np.ndarray]:
    """(values, which rows can't be read) of one field, from its bytes of all rows."""
    fine = np.zeros(len(m), bool)
    plain = {"smallint": ">i2", "integer": ">i4", "bigint": ">i8", "real": ">f4", "double": ">f8"}
    if f.kind in plain:
        value = np.ascontiguousarray(m).view(plain[f.kind]).ravel()
        return pa.array(value.astype(plain[f.kind][1:])), fine
    if f.kind in ("packed", "zoned") and f.length <= 18:
        return _numbers(f, m)
    if f.kind in _FORMS:
        return _moments(f, m)
    if f.kind in ("char", "varchar"):
        return _texts(f, m, override)
    if f.kind in ("xml", "clob"):
        return pa.array([""] * len(m), pa.string()), fine
    out: list[Any] = []
    for i, row in enumerate(m):
        try:
            out.append(decode_field(f, row.tobytes(), override))
        except (ValueError, ArithmeticError):
            out.append(None)
            fine[i] = True
    return pa.array(out, f.arrow), fine


def decode_batch(fields: list[Field], records: Sequence[bytes | None], nulls: Sequence[bytes | None] | None = None, override: tuple[int, int] | None = None) -> tuple[list[pa.Array], pa.Array]:
    """(a column for each field, reasons): the reason is null of a record that was read, else its row is null and the reason names the field.

    A field without a known page or type fails every record; one that an indicator calls null is not looked at.
    """
    size = sum(f.size for f in fields)
    reason = np.array([None if r is not None and len(r) == size else "length" for r in records], object)
    m = np.frombuffer(b"".join(r if why is None else bytes(size) for r, why in zip(records, reason, strict=True)), np.uint8).reshape(len(records), size)
    absent = np.zeros((len(records), len(fields)), bool)
    for i, x in enumerate(nulls or ()):
        own = np.frombuffer((x or b"")[: len(fields)], np.uint8)
        absent[i, : len(own)] = own & 15 == 1
    at, columns = 0, []
    for k, f in enumerate(fields):
        try:
            values, bad = _column(f, m[:, at : at + f.size], override)
        except (UnknownPage, UnknownType) as e:
            values, bad = pa.nulls(len(records), f.arrow), np.ones(len(records), bool)
            reason[(reason == None) & ~absent[:, k]] = str(e)  # noqa: E711
        else:
            reason[bad & ~absent[:, k] & (reason == None)] = f.name  # noqa: E711
        columns.append(values)
        at += f.size
    failed = reason != None  # noqa: E711
    columns = [pa.nulls(0, f.arrow) if not len(c) else pa.compute.if_else(pa.array(failed | absent[:, k]), pa.scalar(None, f.arrow), c.cast(f.arrow)) for k, (f, c) in enumerate(zip(fields, columns, strict=True))]
    return columns, pa.array(reason.tolist(), pa.string())


def decode_records(records: DataFrame, fields: list[Field], column: str = "record", nulls: str | None = None, override: tuple[int, int] | None = None) -> DataFrame:
    """``records`` with a typed column for each field in place of the bytes, and ``decode_error``."""
    ship(records.sparkSession)
    kept = [c for c in records.columns if c not in (column, nulls)]
    source = records.select(*kept, column, *([nulls] if nulls else []))
    schema = records.select(*kept).schema
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), *(f.ddl for f in fields), "decode_error string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, why = decode_batch(fields, b.column(len(kept)).to_pylist(), b.column(len(kept) + 1).to_pylist() if nulls else None, override)
            yield pa.record_batch([*b.columns[: len(kept)], *values, why], names=[*kept, *(f.name for f in fields), "decode_error"])

    return source.mapInArrow(run, ddl)


def with_dead_letters(decoded: DataFrame, key: list[str], path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that were read, ``(key, error)`` of the others), the latter written aside first, so that none is lost if the feed stops."""
    spark = decoded.sparkSession
    path = path or fresh_path(spark, "dead-letters")
    bad = decoded.where("decode_error IS NOT NULL").select(*key, F.col("decode_error").alias("error"))
    bad.write.mode("append").parquet(path)
    return decoded.where("decode_error IS NULL").drop("decode_error"), spark.read.schema(bad.schema).parquet(path)


# --- blocks of entries ------------------------------------------------------------

# Layout of a journal entry's header: names and struct codes, then text fields with their lengths.
ENTRY_NUMBERS = [
    ("next_entry", "I"), ("null_indicators", "I"), ("entry_data", "I"), ("transaction_id", "I"), ("unit_of_work", "I"), ("receiver", "I"), ("sequence", "Q"), ("timestamp", "Q"), ("thread", "Q"),
    ("system_sequence", "Q"), ("count_rrn", "Q"), ("commit_cycle", "Q"), ("pointer_handle", "I"), ("remote_port", "H"), ("arm_number", "H"), ("asp", "H"),
]
ENTRY_TEXTS = [
    ("remote_address", 16), ("journal_code", 1), ("entry_type", 2), ("job", 10), ("user", 10), ("job_number", 6), ("program", 10), ("program_library", 10), ("asp_device", 10), ("object", 30),
    ("user_profile", 10), ("journal_id", 10), ("address_family", 1), ("system", 8), ("indicator", 1), ("object_name_indicator", 1),
]
_NUMBERS = struct.Struct(">" + "".join(c for _, c in ENTRY_NUMBERS))
ENTRY_SIZE = _NUMBERS.size + sum(n for _, n in ENTRY_TEXTS) + 1
_FIRST = struct.Struct(">iii1s10s10s20s")
#: What names the segment of an entry, where its header says so.
_RECEIVER = struct.Struct(">10s10s10sh")
# Layouts of the list of receivers: key header, and one receiver.
_KEY = struct.Struct(">iiiii")
RECEIVER_TEXTS = [("name", 10), ("library", 10), ("number", 5), ("attached", 13), ("status", 1), ("saved", 13), ("local_system", 8), ("source_system", 8)]
RECEIVER_SIZE = sum(n for _, n in RECEIVER_TEXTS) + 4


def _text(x: bytes) -> str:
    return x.decode("cp037").strip()


def _fill(text: str, n: int) -> bytes:
    return text.encode("cp037").ljust(n, b"\x40")[:n]


def encode_entry(numbers: dict[str, int], texts: dict[str, str], receiver: tuple[str, str] | None = None) -> bytes:
    numbers = numbers | ({"receiver": ENTRY_SIZE} if receiver else {})
    head = _NUMBERS.pack(*(numbers.get(n, 0) for n, _ in ENTRY_NUMBERS)) + b"".join(_fill(texts.get(n, ""), size) for n, size in ENTRY_TEXTS) + b"\0"
    return head + (_RECEIVER.pack(*(_fill(x, 10) for x in (*receiver, "*SYSBAS")), 1) if receiver else b"")


def decode_entry(data: bytes) -> dict[str, Any]:
    out: dict[str, Any] = dict(zip((n for n, _ in ENTRY_NUMBERS), _NUMBERS.unpack_from(data), strict=True))
    at = _NUMBERS.size
    for name, size in ENTRY_TEXTS:
        out[name] = data[at : at + size].decode("cp037").rstrip()
        at += size
    return out | {"flags": data[at], "segment": decode_receiver_name(data, out["receiver"])}


def decode_receiver_name(data: bytes, at: int) -> tuple[str, str] | None:
    """(receiver, library) of an entry whose header has a place for it."""
    return tuple(map(_text, _RECEIVER.unpack_from(data, at)[:2])) if at > 0 else None


def encode_block(entries: list[bytes], more: bool, receiver: str, library: str, sequence: int) -> bytes:
    """A block: first header, then entries chained by their distance, 0 at the last."""
    body = b"".join(struct.pack(">I", 0 if i + 1 == len(entries) else len(e)) + e[4:] for i, e in enumerate(entries))
    text = [x.encode("cp037") for x in ("1" if more else "0", receiver.ljust(10), library.ljust(10), str(sequence).rjust(20, "0"))]
    return _FIRST.pack(_FIRST.size + len(body), _FIRST.size, len(entries), *text) + body


def decode_first(data: bytes) -> dict[str, Any]:
    total, first, count, more, receiver, library, sequence = _FIRST.unpack_from(data)
    return {"total_bytes": total, "first_entry": first, "entries": count, "more": _text(more) == "1", "receiver": _text(receiver), "library": _text(library), "sequence": int(_text(sequence) or 0)}


def entry_places(data: bytes) -> list[int]:
    """Where the entries of a block begin, along its chain."""
    head = decode_first(data)
    at, out = head["first_entry"], []
    for _ in range(head["entries"]):
        out.append(at)
        (step,) = struct.unpack_from(">I", data, at)
        if not step:
            break
        at += step
    return out


def decode_block(data: bytes) -> Iterator[dict[str, Any]]:
    """The entries of a block."""
    for at in entry_places(data):
        yield decode_entry(data[at : at + ENTRY_SIZE + _RECEIVER.size])


def encode_receivers(rows: list[dict[str, Any]]) -> bytes:
    """The list of receivers: key header, then a receiver each."""
    return _KEY.pack(1, _KEY.size, 0, len(rows), RECEIVER_SIZE) + b"".join(b"".join(_fill(str(r.get(n, "")), size) for n, size in RECEIVER_TEXTS) + struct.pack(">i", r.get("size", 0)) for r in rows)


def decode_receivers(data: bytes) -> Iterator[dict[str, Any]]:
    """Name, library, chain, time of attachment (None if it isn't one) and status (None if unknown) of each receiver."""
    _, first, head, n, width = _KEY.unpack_from(data)
    for k in range(n):
        at, own = first + head + k * width, {}
        for name, size in RECEIVER_TEXTS:
            own[name] = _text(data[at : at + size])
            at += size
        number, status, moment = own["number"], own["status"], own["attached"]
        try:
            attached = datetime.strptime(f"{19 + int(moment[:1])}{moment[1:]}", "%Y%m%d%H%M%S")
        except ValueError:
            attached = None
        yield {"name": own["name"], "library": own["library"], "attached": attached, "status": int(status) if status in set("123456") else None, "chain": int(number[:2]) if len(number) == 5 and number[:2].isdigit() else None}


_LATIN = np.frombuffer(bytes(range(256)).decode("cp037").encode("latin1"), np.uint8)


def _entry_column(m: np.ndarray, name: str) -> pa.Array:
    """A header field of all entries, from the matrix of their bytes."""
    at = 0
    for n, code in ENTRY_NUMBERS:
        size = struct.calcsize(code)
        if n == name:
            return pa.array(np.ascontiguousarray(m[:, at : at + size]).view(f">u{size}").ravel().astype(np.int64))
        at += size
    for n, size in ENTRY_TEXTS:
        if n == name:
            whole = _LATIN[np.ascontiguousarray(m[:, at : at + size])].tobytes().decode("latin1")
            return pa.array([whole[i : i + size].rstrip() for i in range(0, len(whole), size)], pa.string())
        at += size
    raise KeyError(name)


def explode_blocks(blocks: DataFrame, column: str = "block") -> DataFrame:
    """Entries of every block of a binary column; ``receiver`` and ``library`` where an entry names them."""
    ship(blocks.sparkSession)
    names = ["sequence", "commit_cycle", "code", "object", "job", "user", "receiver", "library"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in (x for b in batches for x in b.column(0).to_pylist() if x is not None):
            whole, places = np.frombuffer(data, np.uint8), np.array(entry_places(data), np.int64)
            for lo in range(0, len(places), 20_000):
                own = places[lo : lo + 20_000]
                m = whole[own[:, None] + np.arange(ENTRY_SIZE)]
                get = {n: _entry_column(m, n) for n in ("sequence", "commit_cycle", "journal_code", "entry_type", "object", "job", "user", "receiver")}
                named = [decode_receiver_name(data[p:], r) if r else None for p, r in zip(own.tolist(), get["receiver"].to_pylist(), strict=True)]
                code = pa.compute.binary_join_element_wise(get["journal_code"], get["entry_type"], ".")
                segment = [pa.array([x and x[k] for x in named], pa.string()) for k in (0, 1)]
                yield pa.record_batch([get["sequence"], get["commit_cycle"], code, get["object"], get["job"], get["user"], *segment], names=names)

    return blocks.select(column).mapInArrow(run, "sequence long, commit_cycle long, code string, object string, job string, user string, receiver string, library string")


def explode_receivers(lists: DataFrame, column: str = "receivers") -> DataFrame:
    """Receivers of every list of a binary column."""
    ship(lists.sparkSession)
    schema = pa.schema([("name", pa.string()), ("library", pa.string()), ("attached", pa.timestamp("us")), ("status", pa.int32()), ("chain", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in (x for b in batches for x in b.column(0).to_pylist() if x is not None):
            yield pa.RecordBatch.from_pylist(list(decode_receivers(data)), schema=schema)

    return lists.select(column).mapInArrow(run, "name string, library string, attached timestamp_ntz, status int, chain int")


def dump(data: bytes, width: int = 80) -> list[str]:
    """Lines of ``width`` bytes: place, hex, and the text in ASCII and EBCDIC, a dot for what can't be shown."""
    shown = lambda text: "".join(c if c.isprintable() else "." for c in text)
    return [f"{at:08x} {data[at : at + width].hex()} {shown(data[at : at + width].decode('latin1'))} {shown(data[at : at + width].decode('cp037'))}" for at in range(0, len(data), width)]


def as_row(value: Any) -> Any:
    """A decoded value as tests and dumps show it."""
    return value.isoformat() if isinstance(value, (date, time, datetime)) else value
