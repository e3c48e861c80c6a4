from datetime import date, datetime, time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidefeed.functions import codec
from tidefeed.functions import columns as fn


def values(spark, make, given):
    return [r[0] for r in spark.createDataFrame([(x,) for x in given], "x string").select(make(F.col("x"))).collect()]


def test_text(spark):
    assert values(spark, lambda x: fn.pad_right(x, 4), ["12345", "12"]) == ["1234", "12  "]
    assert values(spark, lambda x: fn.pad_left(x, 4), ["12345", "12"]) == ["1234", "  12"]
    assert values(spark, fn.camel, ["abcdef", "ABCDEF_GHI", "_abc", "abcdef_", "a", "_", None]) == ["Abcdef", "AbcdefGhi", "Abc", "Abcdef", "A", "_", None]
    assert values(spark, lambda x: fn.topic_of_table(x, "my"), ["FOO.BAR.TOPIC", "TOPIC", "TOPIC."]) == ["my.topic", "my.topic", "my."]
    assert values(spark, lambda x: fn.schema_name(x, "p"), ["a.b.TABLE.Key", "x"]) == ["p.TableKey", "x"]
    assert values(spark, fn.clean_text, ["\ta\x00b ", None]) == ["?a?b", None]
    assert values(spark, lambda x: fn.attach_time(x).cast("string"), ["1180220083847", "x"]) == ["2018-02-20 08:38:47", None]


def test_codec_round_trip():
    fields = [codec.Field("a", "packed", 7, 2), codec.Field("b", "zoned", 5, 1), codec.Field("c", "varchar", 9, ccsid=500), codec.Field("d", "bigint"), codec.Field("e", "char", 4), codec.Field("f", "varbinary", 3)]
    row = {"a": Decimal("-123.45"), "b": Decimal("99.5"), "c": "héllo", "d": -5, "e": "ab  ", "f": b"\x01\x02"}
    data = codec.encode_record(fields, row)
    assert codec.decode_record(fields, data) == row
    assert codec.decode_record(fields, data, nulls=b"\x01\x00\x09")["a"] is None
    assert codec.decode_record(fields, data, nulls=b"\x01\x00\x09")["c"] == "héllo"
    assert codec.ENTRY_SIZE == 219


def test_block_chain():
    entries = [codec.encode_entry({"sequence": i}, {"journal_code": "R", "entry_type": "PT"}) for i in range(3)]
    block = codec.encode_block(entries, True, "RCV1", "LIB", 7)
    assert codec.decode_first(block)["more"] and codec.decode_first(block)["sequence"] == 7
    assert [e["sequence"] for e in codec.decode_block(block)] == [0, 1, 2]


def test_pages():
    text = "£$[^~?¢"
    assert codec.encode_text(text, 37) != codec.encode_text(text, 285)
    for ccsid in (37, 273, 285, 500, 1047, 1140, 1146, 1208, 13488):
        assert codec.decode_text(codec.encode_text("$[]Aa0 ", ccsid), ccsid) == "$[]Aa0 "
    assert codec.decode_text(codec.encode_text(text, 285), 285) == codec.decode_text(codec.encode_text(text, 37), 37) == text
    stored = codec.encode_text("£$[^~?¢¯€123", 1146)
    assert codec.decode_text(stored, 37, (37, 1146)) == "£$[^~?¢¯€123" and codec.decode_text(stored, 37) == "$¢£[¯?^~¤123"
    with pytest.raises(codec.UnknownPage):
        codec.decode_text(b"a", 99)
    with pytest.raises(ValueError):
        codec.encode_text("€", 37)


def test_pages_are_those_of_the_jvm(spark):
    raw = bytes(b for b in range(256) if b not in (0x15, 0x25))  # new lines differ by convention
    for ccsid, name in ((37, "IBM037"), (273, "IBM273"), (285, "IBM285"), (500, "IBM500"), (1047, "IBM1047"), (1140, "IBM01140"), (1146, "IBM01146")):
        assert codec.decode_text(raw, ccsid) == str(spark.sparkContext._jvm.java.lang.String(raw, name))


def test_types():
    f = lambda kind, length=10, **k: codec.field_of("c", kind, length, **k)
    assert (f("CHAR () FOR BIT DATA").kind, f("CHAR () FOR BIT DATA").size) == ("binary", 10)
    assert (f("CHAR (20) FOR BIT DATA").kind, f("CHAR (20) FOR BIT DATA").size) == ("binary", 20)
    assert (f("VARCHAR () FOR BIT DATA").kind, f("VARCHAR (20) FOR BIT DATA").size) == ("varbinary", 22)
    assert f("NCHAR", ccsid=13488, octets=20).size == 20 and f("VGRAPH", ccsid=13488, octets=20).size == 22 and codec.Field("x", "char", 10, ccsid=13488).size == 20
    assert [f(k).size for k in ("DATE", "TIME", "TIMESTAMP", "XML", "SMALLINT", "DOUBLE")] == [10, 8, 26, 44, 2, 8]
    with pytest.raises(codec.UnknownType):
        f("DATALINK")


FIELDS = [
    codec.Field("a", "packed", 7, 2), codec.Field("b", "zoned", 5, 1), codec.Field("c", "varchar", 9, ccsid=285), codec.Field("d", "bigint"), codec.Field("e", "char", 4, ccsid=13488), codec.Field("f", "varbinary", 3),
    codec.Field("g", "date"), codec.Field("h", "time"), codec.Field("i", "timestamp"), codec.Field("j", "xml"), codec.Field("k", "real"), codec.Field("l", "packed", 25, 3), codec.Field("m", "smallint"), codec.Field("n", "varchar", 6, ccsid=1208),
]


def record(**given):
    at = datetime(2020, 2, 29, 23, 59, 58, 7)
    row = {"a": Decimal("-123.45"), "b": Decimal("99.5"), "c": "h£llo", "d": -5, "e": "Maſʒ", "f": b"\x01\x02", "g": at.date(), "h": at.time().replace(microsecond=0), "i": at, "j": "", "k": 1.5, "l": Decimal("-1234567890123456789012.345"), "m": -2, "n": "äö"}
    return codec.encode_record(FIELDS, row | given), row | given


def test_batches_are_single_records():
    datas = [record(), record(a=Decimal("0.00"), c="", n="", f=b"", d=2**62, h=time(0, 0, 0)), record(i=datetime(1, 1, 1), g=date(9999, 12, 31))]
    # The slot of a UTF-8 field counts bytes.
    datas = [(codec.encode_record(FIELDS[:-1], r) + (len(r["n"].encode()).to_bytes(2, "big") + r["n"].encode()).ljust(8, b"\0"), r) for _, r in datas]
    columns, why = codec.decode_batch(FIELDS, [d for d, _ in datas])
    assert why.to_pylist() == [None] * 3
    for i, (_, row) in enumerate(datas):
        got = {f.name: c[i].as_py() for f, c in zip(FIELDS, columns, strict=True)}
        assert got == row | {"h": row["h"].isoformat()}


def test_one_bad_record_stays_alone():
    good, row = record(n="")
    broken = lambda at, x: good[:at] + x + good[at + len(x) :]
    where, at = {}, 0
    for f in FIELDS:
        where[f.name] = at
        at += f.size
    cases = {"a": broken(where["a"], b"\xaa"), "b": broken(where["b"], b"\xfe"), "c": broken(where["c"], b"\x7f\xff"), "g": broken(where["g"], codec.encode_text("2021-02-30", 37)), "h": broken(where["h"], codec.encode_text("99.00.00", 37)), "i": broken(where["i"], b"\0"), "l": broken(where["l"], b"\xee"), "n": broken(where["n"], b"\x00\x01\xff"), "length": good[:-1]}
    columns, why = codec.decode_batch(FIELDS, [good, *cases.values(), None, good])
    assert why.to_pylist() == [None, *cases, "length", None]
    assert all(c[k].as_py() is None for c in columns for k in range(1, len(cases) + 1))
    assert columns[0][0].as_py() == columns[0][len(cases) + 2].as_py() == row["a"]
    # What an indicator calls null isn't looked at.
    columns, why = codec.decode_batch(FIELDS, [cases["a"]], [b"\x01\x00\x09"])
    assert why.to_pylist() == [None] and columns[0][0].as_py() is None and columns[2][0].as_py() == row["c"]
    columns, why = codec.decode_batch([codec.Field("x", "char", 2, ccsid=99), codec.Field("y", "integer")], [b"\0" * 6] * 2)
    assert why.to_pylist() == ["code page 99"] * 2
    assert codec.decode_batch(FIELDS, [])[1].to_pylist() == [] and codec.null_indicators(b"..\0\0\0\x02\x01\x00..", 2) == b"\x01\x00"


def test_receiver_blocks():
    rows = [{"name": "RCV1", "library": "LIB", "number": "12345", "attached": "1180220083847", "status": 1, "size": 3}, {"name": "RCV2", "library": "LIB", "number": "1", "attached": "x", "status": "9"}]
    first, second = codec.decode_receivers(codec.encode_receivers(rows))
    assert first == {"name": "RCV1", "library": "LIB", "attached": datetime(2018, 2, 20, 8, 38, 47), "status": 1, "chain": 12}
    assert second == {"name": "RCV2", "library": "LIB", "attached": None, "status": None, "chain": None}
    entries = [codec.encode_entry({"sequence": 1}, {"journal_code": "R", "entry_type": "PT"}, ("RCV1", "LIB")), codec.encode_entry({"sequence": 2}, {"journal_code": "R", "entry_type": "DL"})]
    assert [(e["sequence"], e["segment"]) for e in codec.decode_block(codec.encode_block(entries, False, "RCV1", "LIB", 2))] == [(1, ("RCV1", "LIB")), (2, None)]
    assert codec.dump(codec.encode_text("Ab", 37))[0].endswith(" Ab")
