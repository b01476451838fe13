"""Bounded-memory copies, the column folder, and the stream source."""

import datetime as dt
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from fixtures import collected, drawn, expected, put, put_cut, supported
from pyspark.sql import functions as F

import brindle
from brindle.errors import BatchParseError, OpenError, UnsupportedColumn
from brindle.sources import splay


def _table():
    """Every type that a column folder can hold."""
    rng = random.Random("splay")
    return pa.table({f"c {i}": pa.concat_arrays([drawn(rng, k, 431, 0.3)] * 3) if not pa.types.is_dictionary(k) else drawn(rng, k, 1293, 0.3) for i, k in enumerate(supported())})


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    return put_cut(tmp_path_factory.mktemp("s") / "x.arrow", _table(), [7, 500, 1292])


def test_to_parquet(spark, source, tmp_path):
    assert brindle.stream_arrow(spark, source, str(tmp_path / "pq"), nanos="truncate") == 1293
    back, want = spark.read.parquet(str(tmp_path / "pq")), _table()
    assert back.columns == want.column_names
    at = [n for n in want.column_names if pa.types.is_integer(want.column(n).type) and want.column(n).type != pa.uint8()]
    assert len(at) == 3 and [back.agg(F.sum(F.col(f"`{n}`").cast("decimal(38,0)"))).first()[0] for n in at] == [sum(x for x in expected(want.column(n)) if x is not None) for n in at]


def test_to_splay_and_back(spark, source, tmp_path):
    t, to = _table(), str(tmp_path / "db")
    assert brindle.stream_arrow(spark, source, to, format="splay") == 1293
    ticks = lambda cols: [[((v.hour * 60 + v.minute) * 60 + v.second) * 1000 + v.microsecond // 1000 if isinstance(v, dt.time) else v for v in c] for c in cols]
    got = collected(brindle.read_splay(spark, to, nanos="long", row_index=True), t.column_names)
    assert ticks(got) == [expected(t.column(n)) for n in t.column_names]
    brindle.write_arrow(brindle.read_splay(spark, to, nanos="long", row_index=True).orderBy("__row_index").drop("__row_index"), str(tmp_path / "y.arrow"))
    again = collected(brindle.read_arrow(spark, str(tmp_path / "y.arrow"), nanos="long", row_index=True), t.column_names)
    assert again == got


def test_splay_bytes(spark, tmp_path):
    t = pa.table({"b": pa.array([True, None]), "g": pa.array([7, 255], pa.uint8()), "i": pa.array([1, None], pa.int32()), "f": pa.array([1.5, None]), "s": pa.array(["a", None]), "d": pa.array([10_958, None], pa.int32()).view(pa.date32()), "t": pa.array([5, None], pa.time32("ms")), "p": pa.array([946_684_800_000_000_001, None], pa.timestamp("ns")), "n": pa.array([3, None], pa.duration("ns"))})
    to = tmp_path / "db"
    brindle.stream_arrow(spark, put(tmp_path / "x.arrow", t), str(to), format="splay")
    fixed = lambda code, raw: struct.pack("<ihhq16x", 0, code, 0, 2) + raw
    want = {
        "b": fixed(1, b"\1\0"), "g": fixed(4, b"\x07\xff"), "i": fixed(6, struct.pack("<ii", 1, -(2**31))), "f": fixed(9, struct.pack("<d", 1.5) + np.array([np.nan]).tobytes()), "s": b"\xff\x01" + struct.pack("<hi", 11, 2) + b"a\0\0",
        "d": fixed(14, struct.pack("<ii", 1, -(2**31))), "t": fixed(19, struct.pack("<ii", 5, -(2**31))), "p": fixed(12, struct.pack("<qq", 1, -(2**63))), "n": fixed(16, struct.pack("<qq", 3, -(2**63))), ".d": b"\xff\x01" + struct.pack("<hi", 11, 9) + b"b\0g\0i\0f\0s\0d\0t\0p\0n\0",
    }
    assert {p.name: p.read_bytes() for p in to.iterdir() if not p.name.endswith(".crc")} == want


def test_batches_without_rows_between_others(spark, tmp_path):
    path = put_cut(tmp_path / "x.arrow", pa.table({"w": ["α", "", "γ γ"], "k": pa.array([None, -1, 5], pa.int16())}), [0, 1, 1, 1, 3])
    assert brindle.stream_arrow(spark, path, str(tmp_path / "db"), format="splay") == 3
    assert collected(brindle.read_splay(spark, str(tmp_path / "db"), row_index=True), ["w", "k"]) == [["α", "", "γ γ"], [None, -1, 5]]


def test_splay_appends_and_leaves_other_files_alone(spark, tmp_path):
    to = tmp_path / "db"
    one = spark.createDataFrame([(1, "a", 0.5), (2, None, None)], "i int, s string, x double").coalesce(1)
    brindle.write_splay(one, str(to), mode="append")
    (to / "notes.txt").write_text("keep me")
    two = spark.createDataFrame([(3, "c", 1.5)], one.schema).coalesce(1)
    two.write.format("splay").mode("append").save(str(to))
    rows = lambda: collected(brindle.read_splay(spark, str(to), row_index=True), ["i", "s", "x"])
    assert rows() == [[1, 2, 3], ["a", "", "c"], [0.5, None, 1.5]]
    with pytest.raises(Exception, match="other columns"):
        brindle.write_splay(spark.range(3), str(to), mode="append")
    assert len(rows()[0]) == 3
    brindle.write_splay(spark.range(2).coalesce(1), str(to))
    assert collected(brindle.read_splay(spark, str(to), row_index=True), ["id"]) == [[0, 1]]
    assert sorted(p.name for p in to.iterdir() if not p.name.endswith(".crc")) == [".d", "id", "notes.txt"] and (to / "notes.txt").read_text() == "keep me"


def test_splay_partitions_at_string_ends(spark, tmp_path, monkeypatch):
    rows = [(i, "x" * (i % 7)) for i in range(1000)]
    brindle.write_splay(spark.createDataFrame(rows, "i int, s string").coalesce(1), str(tmp_path / "db"))
    monkeypatch.setattr(splay, "ROWS", 100)
    reader = splay.SplayReader(str(tmp_path / "db"), "error", False)
    parts = reader.partitions()
    got = [r for p in parts for b in reader.read(p) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert len(parts) == 10 and got == rows


def test_rejected_before_anything_is_written(spark, tmp_path):
    path = put(tmp_path / "x.arrow", pa.table({"l": pa.array([[1]])}))
    with pytest.raises(UnsupportedColumn):
        brindle.stream_arrow(spark, path, str(tmp_path / "db"), format="splay")
    with pytest.raises(UnsupportedColumn):
        brindle.stream_arrow(spark, path, str(tmp_path / "pq"))
    assert not (tmp_path / "db").exists() and not (tmp_path / "pq").exists()


def test_damaged_folders(spark, tmp_path):
    brindle.write_splay(spark.range(10).coalesce(1), str(tmp_path / "db"))
    (tmp_path / "db" / "id").write_bytes((tmp_path / "db" / "id").read_bytes()[:50])
    with pytest.raises(Exception, match="shorter than its count"):
        brindle.read_splay(spark, str(tmp_path / "db")).collect()
    (tmp_path / "db" / ".d").write_bytes(b"nothing here")
    with pytest.raises(OpenError):
        brindle.read_splay(spark, str(tmp_path / "db"))
    with pytest.raises(BatchParseError):
        splay.payload(pa.array(["a\0b"]), splay.SYMBOL, "x")


@pytest.fixture
def streamed(spark, tmp_path):
    """(the folder, a run until nothing is left that returns the sorted values so far)"""
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    folder.mkdir()
    put(folder / "m.arrow", pa.table({"v": pa.array(range(1000))}), 10)

    def run():
        q = brindle.read_arrow_stream(spark, str(folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(r.v for r in spark.read.schema("v long").parquet(out).collect())

    return folder, run


def test_stream_source_takes_every_file_once_whatever_its_name(streamed):
    folder, run = streamed
    assert run() == list(range(1000))
    put(folder / "a.arrow", pa.table({"v": pa.array(range(1000, 1400))}), 2)  # before the first by name
    put(folder / "z.arrow", pa.table({"v": pa.array(range(1400, 1500))}), 2)
    assert run() == list(range(1500)) == run()
    (folder / "m.arrow").unlink()  # read, so it may go
    put(folder / "c.arrow", pa.table({"v": pa.array([1500])}))
    assert run() == list(range(1501))


def test_stream_source_of_a_folder_that_is_appended_to(spark, streamed):
    folder, run = streamed
    upto = 1000
    for n in (40, 3, 700):
        brindle.write_arrow(spark.range(upto, upto + n, 1, 3).select(F.col("id").alias("v")), str(folder), mode="append")
        upto += n
        assert run() == list(range(upto))


def test_copy_of_very_many_files_is_checked_in_tasks(spark, tmp_path, monkeypatch):
    from brindle.operators import interchange

    monkeypatch.setattr(interchange, "MANY", 3)
    for i in range(8):
        put(tmp_path / f"in{i}.arrow", pa.table({"v": pa.array([i, i + 1])}))
    assert brindle.stream_arrow(spark, str(tmp_path), f"{tmp_path}-out") == 16
    put(tmp_path / "in3.arrow", pa.table({"v": pa.array([[1]])}))
    with pytest.raises(UnsupportedColumn):
        brindle.stream_arrow(spark, str(tmp_path), f"{tmp_path}-never")
