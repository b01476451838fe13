"""Golden edges: slices, special floats, sentinels, temporal extremes, unicode, widths, units, lists, foreign forms."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.ipc as ipc
import pytest
from fixtures import collected, drawn, expected, put, supported
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brindle


def _read(spark, path, **o):
    return brindle.read_arrow(spark, str(path), row_index=True, **o)


@pytest.mark.parametrize("shift", [1, 7, 8, 63])
def test_slices(spark, tmp_path, shift):
    """Columns whose buffers begin within a byte, or a word, of their bitmaps."""
    rng = random.Random(f"slices {shift}")
    base = pa.table({f"c{i}": drawn(rng, t, 200, 0.4) for i, t in enumerate(supported())})
    part = base.slice(shift, 129)
    got = collected(_read(spark, put(tmp_path / "x.arrow", part), nanos="long", time="int_ms"), part.column_names)
    assert got == [expected(part.column(c)) for c in part.column_names]


def test_special_floats(spark, tmp_path):
    v = [float("inf"), float("-inf"), -0.0, float("nan"), 1.5, None]
    path = put(tmp_path / "x.arrow", pa.table({"f": pa.array(v, pa.float64()), "e": pa.array(v, pa.float32())}))
    for got in collected(_read(spark, path), ["f", "e"]):
        assert got == [float("inf"), float("-inf"), 0.0, None, 1.5, None] and str(got[2]) == "-0.0"
    native = collected(_read(spark, path, nulls="native"), ["f"])[0]
    assert native[3] != native[3] and native[5] is None


def test_sentinels(spark, tmp_path):
    cols = {n: pa.array([-(2**b), -(2**b) + 1, 0], t) for n, b, t in (("j", 63, pa.int64()), ("i", 31, pa.int32()), ("h", 15, pa.int16()))}
    path = put(tmp_path / "x.arrow", pa.table(cols))
    assert collected(_read(spark, path), ["j", "i", "h"]) == [[None, -(2**63) + 1, 0], [None, -(2**31) + 1, 0], [None, -(2**15) + 1, 0]]
    assert collected(_read(spark, path, nulls="native"), ["i"]) == [[-(2**31), -(2**31) + 1, 0]]


def test_temporal_extremes(spark, tmp_path):
    ns = [-5_364_662_400_000_000_000, 7_258_118_400_000_000_000, None]
    t = pa.table({"p": pa.array(ns, pa.timestamp("ns")), "u": pa.array([x and x // 1000 for x in ns], pa.timestamp("us")), "d": pa.array([-25_567, 47_482, None], pa.int32()).view(pa.date32())})
    p, u, d = collected(_read(spark, put(tmp_path / "x.arrow", t)), ["p", "u", "d"])
    assert p == u == [dt.datetime(1800, 1, 1), dt.datetime(2200, 1, 1), None]
    assert d == [dt.date(1900, 1, 1), dt.date(2100, 1, 1), None]


def test_strings_of_all_lengths_of_utf8(spark, tmp_path):
    """Code points at both ends of each length in bytes, and lengths around powers of two."""
    points = [c for lo, hi in ((1, 0x7F), (0x80, 0x7FF), (0x800, 0xD7FF), (0xE000, 0xFFFD), (0x10000, 0x10FFFD)) for c in (lo, hi)]
    s = [chr(c) * n for c in points for n in (1, 2, 127, 128, 129)] + [""]
    for t in (pa.string(), pa.large_string()):
        path = put(tmp_path / f"{t}.arrow", pa.table({"s": pa.array(s, t), "d": pa.array(s[::-1], t).dictionary_encode()}), 4)
        assert collected(_read(spark, path), ["s", "d"]) == [s, s[::-1]]


def test_dictionary_over_batches_null_entries_and_deltas(spark, tmp_path):
    colours = [["teal", "ochre", None, "rust", ""][i * i % 5] for i in range(333)]
    t = pa.table({"d": pa.array(colours).dictionary_encode()})
    assert collected(_read(spark, put(tmp_path / "x.arrow", t, 7)), ["d"]) == [[c or "" for c in colours]]
    null_entry = pa.table({"d": pa.DictionaryArray.from_arrays(pa.array([0, 1, 0], pa.int32()), pa.array(["x", None]))})
    assert collected(_read(spark, put(tmp_path / "n.arrow", null_entry)), ["d"]) == [["x", "", "x"]]
    parts = [pa.record_batch({"d": pa.DictionaryArray.from_arrays(pa.array(ix, pa.int32()), pa.array(words))}) for ix, words in (([0, 1], ["a", "b"]), ([2, 0], ["a", "b", "c"]))]
    with ipc.new_file(str(tmp_path / "delta.arrow"), parts[0].schema, options=ipc.IpcWriteOptions(emit_dictionary_deltas=True)) as w:
        for b in parts:
            w.write_batch(b)
    assert collected(_read(spark, tmp_path / "delta.arrow"), ["d"]) == [["a", "b", "c", "a"]]


def test_time_units(spark, tmp_path):
    t = pa.table({"s": pa.array([0, 3661, None], pa.time32("s")), "ms": pa.array([0, 3_661_001, None], pa.time32("ms"))})
    path = put(tmp_path / "x.arrow", t, 2)
    assert collected(_read(spark, path, time="int_ms"), ["s", "ms"]) == [[0, 3_661_000, None], [0, 3_661_001, None]]
    assert collected(_read(spark, path), ["s"]) == [[dt.time(0), dt.time(1, 1, 1), None]]


def test_time_outside_a_day(spark, tmp_path):
    a = pa.array([90_000_000, -5], pa.int32()).view(pa.time32("ms"))
    path = put(tmp_path / "x.arrow", pa.table({"t": a}))
    assert collected(_read(spark, path, time="int_ms"), ["t"]) == [[90_000_000, -5]]
    with pytest.raises(Exception, match="batch parse failed"):
        _read(spark, path).collect()


@pytest.mark.parametrize("unit,per", [("s", 10**9), ("ms", 10**6), ("us", 10**3), ("ns", 1)])
def test_durations_and_timestamps_of_every_unit(spark, tmp_path, unit, per):
    v = [1, -1, None, 0]
    path = put(tmp_path / "x.arrow", pa.table({"k": pa.array(v, pa.duration(unit)), "p": pa.array(v, pa.timestamp(unit)), "z": pa.array(v, pa.timestamp(unit, "Europe/Paris"))}))
    want = [None if x is None else x * per for x in v]
    assert collected(_read(spark, path, nanos="long"), ["k", "p", "z"]) == [want] * 3
    if unit != "ns":
        k, p, z = collected(_read(spark, path), ["k", "p", "z"])
        assert p == z == [None if x is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=x // 1000) for x in want]
        assert k == [None if x is None else dt.timedelta(microseconds=x // 1000) for x in want]


def test_nanosecond_policies(spark, tmp_path):
    path = put(tmp_path / "x.arrow", pa.table({"p": pa.array([1_500, -1, 2_000], pa.timestamp("ns"))}))
    with pytest.raises(Exception, match="digits below a microsecond"):
        _read(spark, path).collect()
    epoch, us = dt.datetime(1970, 1, 1), lambda n: dt.timedelta(microseconds=n)
    assert collected(_read(spark, path, nanos="truncate"), ["p"]) == [[epoch + us(1), epoch - us(1), epoch + us(2)]]


def test_overflow_is_an_error(spark, tmp_path):
    path = put(tmp_path / "x.arrow", pa.table({"p": pa.array([2**62], pa.timestamp("s"))}))
    for nanos in ("error", "long"):
        with pytest.raises(Exception, match="batch parse failed"):
            _read(spark, path, nanos=nanos).collect()


def test_zoned_timestamps_natively(spark, tmp_path):
    path = put(tmp_path / "x.arrow", pa.table({"z": pa.array([0], pa.timestamp("us", "UTC"))}))
    assert isinstance(brindle.read_arrow(spark, path, nulls="native").schema["z"].dataType, T.TimestampType)
    assert isinstance(brindle.read_arrow(spark, path).schema["z"].dataType, T.TimestampNTZType)


def test_lists(spark, tmp_path):
    t = pa.table({"l": pa.array([[1, None], None, [], [3]], pa.list_(pa.int32())), "f": pa.array([[1.5], [], None, [2.5, 3.5]], pa.list_(pa.float64())), "p": pa.array([[0], [10**6], [], None], pa.list_(pa.timestamp("us"))), "b": pa.array([[True, None], [], None, [False]], pa.list_(pa.bool_()))})
    e = dt.datetime(1970, 1, 1)
    want = [[[1, None], [], [], [3]], [[1.5], [], [], [2.5, 3.5]], [[e], [e + dt.timedelta(seconds=1)], [], []], [[True, None], [], [], [False]]]
    for batches in (1, 3):
        assert collected(_read(spark, put(tmp_path / f"{batches}.arrow", t, batches)), ["l", "f", "p", "b"]) == want
    assert collected(_read(spark, tmp_path / "1.arrow", nulls="native"), ["l"]) == [[[1, None], None, [], [3]]]


def test_unsigned_bytes_survive(spark, tmp_path):
    path = put(tmp_path / "x.arrow", pa.table({"u": pa.array([0, 255, None], pa.uint8())}))
    df = _read(spark, path)
    assert collected(df, ["u"]) == [[0, 255, 0]]
    brindle.write_arrow(df.select("u"), str(tmp_path / "y.arrow"))
    assert brindle.arrow_schema(str(tmp_path / "y.arrow")).field("u").type == pa.uint8()
    with pytest.raises(Exception, match="batch parse failed"):
        brindle.write_arrow(brindle.as_uint8(spark.range(1).select(F.lit(300).alias("u")), "u"), str(tmp_path / "z"))


def test_empty_table_is_a_file_without_batches(spark, tmp_path):
    path = put(tmp_path / "x.arrow", pa.table({"a": pa.array([], pa.int64()), "s": pa.array([], pa.string())}))
    df = brindle.read_arrow(spark, path)
    assert df.count() == 0 and df.schema.simpleString() == "struct<a:bigint,s:string>"


def test_wide_table(spark, tmp_path):
    t = pa.table({f"c{i}": pa.array([i, i + 1, i + 2], pa.int32()) for i in range(10_000)})
    path = put(tmp_path / "x.arrow", t)
    got = brindle.read_arrow(spark, path, columns=["c0", "c9999"]).collect()
    assert [tuple(r) for r in got] == [(0, 9999), (1, 10_000), (2, 10_001)]
    brindle.write_arrow(brindle.read_arrow(spark, path, nulls="native"), str(tmp_path / "y.arrow"), nulls="native")
    assert ipc.open_file(str(tmp_path / "y.arrow")).read_all().equals(t)


def test_feather_files_and_colons(spark, tmp_path):
    import pyarrow.feather as feather

    path = str(tmp_path / "x.feather")
    feather.write_feather(pa.table({"a": [1, 2]}), path, compression="uncompressed")
    assert brindle.read_arrow(spark, ":" + path).count() == 2


def test_non_strict_reads_what_spark_can_hold(spark, tmp_path):
    t = pa.table({"i8": pa.array([-1], pa.int8()), "u16": pa.array([65_535], pa.uint16()), "u32": pa.array([2**32 - 1], pa.uint32()), "u64": pa.array([2**64 - 1], pa.uint64()), "f16": pa.array([1.5], pa.float32()).cast(pa.float16()), "d64": pa.array([86_400_000], pa.date64()), "dec": pa.array([1], pa.decimal128(10, 2)), "b": pa.array([b"x"]), "ls": pa.array([["a"]]), "st": pa.array([{"k": 1}])})
    path = put(tmp_path / "x.arrow", t)
    row = brindle.read_arrow(spark, path, strict=False).first()
    assert (row.i8, row.u16, row.u32, int(row.u64), row.f16, row.d64, row.b, row.ls, row.st.k) == (-1, 65_535, 2**32 - 1, 2**64 - 1, 1.5, dt.date(1970, 1, 2), b"x", ["a"], 1)
    put(tmp_path / "z.arrow", pa.table({"a": [1]}), compression="zstd")
    assert brindle.read_arrow(spark, str(tmp_path / "z.arrow"), strict=False).count() == 1


def test_partitions_hold_ranges_of_batches(spark, tmp_path):
    t = pa.table({"v": pa.array(range(10_000), pa.int64())})
    path = put(tmp_path / "x.arrow", t, 100)
    infos = brindle.arrow_batches(path)
    assert [b.rows for b in infos] == [100] * 100 and infos[7].row_offset == 700
    few, many = (brindle.read_arrow(spark, path, row_index=True, target_bytes=b) for b in (1 << 30, 2000))
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() > 20
    assert collected(many, ["v"]) == collected(few, ["v"]) == [list(range(10_000))]


def test_conditions_in_the_reader(spark, tmp_path):
    """The same rows as a filter gives; and fewer leave the reader."""
    from brindle.sources.arrow_ipc import Options, Range, decoded

    t = pa.table({"i": pa.array([1, None, 3, 4, 5, -(2**31)], pa.int32()), "s": ["a", "b", None, "a", "é", ""], "f": [1.0, float("nan"), None, 2.0, 3.0, 0.5], "d": pa.array([0, 1, 2, None, 4, 5], pa.int32()).view(pa.date32()), "b": [True, None, False, True, False, None]})
    path = put(tmp_path / "x.arrow", t, 2)
    cases = [("i", ">", 2), ("i", "<", 3), ("i", "in", [1, 4, 99]), ("s", "=", "a"), ("s", "=", ""), ("s", ">=", "b"), ("s", "in", ["é", ""]), ("f", ">", 1.5), ("f", "<=", 2.0), ("d", ">=", dt.date(1970, 1, 3)), ("b", "=", False)]
    for nulls in ("compat", "native"):
        whole = brindle.read_arrow(spark, path, nulls=nulls).cache()
        for where in [[c] for c in cases] + [[("i", ">", 2), ("s", "=", "a")], cases[:1] + cases[-1:]]:
            want = whole
            for n, op, v in where:
                want = want.where(F.col(n).isin(v) if op == "in" else F.expr(f"{n} {op} {v!r}" if n != "d" else f"d {op} date'{v}'"))
            got = brindle.read_arrow(spark, path, nulls=nulls, where=where)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), (nulls, where)
    left = lambda w: sum(b.num_rows for b in decoded(Range(path, 0, 2, 0), Options(where=w)))
    assert [left("[]"), left('[["i", ">", 2]]'), left('[["s", "in", ["a"]]]'), left('[["d", "=", "1970-01-03"]]'), left('[["f", ">", 9]]')] == [6, 4, 3, 2, 6]
    for bad in ([("i", "like", 1)], [("nowhere", "=", 1)], [("i", "=")]):
        with pytest.raises(brindle.BadArgument):
            brindle.read_arrow(spark, path, where=bad)


def test_an_earlier_filter_has_no_say(spark, tmp_path):
    df = brindle.read_arrow(spark, put(tmp_path / "x.arrow", pa.table({"i": [1, 2, 3]})), nulls="native")
    assert [df.where("i > 2").count(), df.count(), df.where("i = 1 or i = 2").count()] == [1, 3, 2]


def test_a_folder_is_one_table(spark, tmp_path):
    for i in range(3):
        put(tmp_path / f"p{i}.arrow", pa.table({"v": pa.array([i * 2, i * 2 + 1])}))
    assert collected(_read(spark, tmp_path), ["v"]) == [list(range(6))]
    put(tmp_path / "p9.arrow", pa.table({"v": pa.array([1]), "w": pa.array([1])}))
    with pytest.raises(Exception, match="columns differ"):
        brindle.read_arrow(spark, str(tmp_path)).collect()
