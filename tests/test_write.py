"""Tables that begin in Spark: every type, nulls of every width, empties, and what writing puts into a file."""

import datetime as dt

import pyarrow as pa
import pyarrow.ipc as ipc
import pytest
from fixtures import collected
from pyspark.sql import functions as F

import brindle

#: for each Spark type of the map: the Arrow type it is written as, and values of which some are at its limits
WRITTEN = {
    "tinyint": ("int16", [-128, 127, 3]),
    "boolean": ("bool", [True, False]),
    "smallint": ("int16", [-(2**15) + 1, 2**15 - 1, -1]),
    "int": ("int32", [-(2**31) + 1, 2**31 - 1, 40]),
    "bigint": ("int64", [-(2**63) + 1, 2**63 - 1, 10**15]),
    "float": ("float", [0.5, -3.0e38, 1e-45]),
    "double": ("double", [1 / 3, -1.7e308, 5e-324]),
    "string": ("string", ["", "Zürich – 東京", "\U0001f30d\n\t", "x" * 70_000]),
    "date": ("date32[day]", [dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(1969, 12, 31)]),
    "time(3)": ("time32[ms]", [dt.time(0), dt.time(23, 59, 59, 999_000)]),
    "timestamp_ntz": ("timestamp[ns]", [dt.datetime(1678, 1, 1), dt.datetime(2262, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999_999)]),
    "timestamp": ("timestamp[ns, tz=UTC]", [dt.datetime(1700, 2, 28, tzinfo=dt.timezone.utc), dt.datetime(2038, 1, 19, 3, 14, 8, tzinfo=dt.timezone.utc)]),
    "interval day to second": ("duration[ns]", [dt.timedelta(days=-90_000, microseconds=1), dt.timedelta(days=106_000)]),
}
FORMS = {"uint8": ("smallint", [0, 255, 128]), "time32": ("int", [-5, 10**9]), "timestamp[ns]": ("bigint", [1, -(2**62)]), "duration[ns]": ("bigint", [7, 2**62])}


def _every_type(spark, pattern: str):
    """A column for every type, and for every form of one; a letter of the pattern is a row: v for a value, - for a null."""
    kinds = [(k, v, None) for k, (_, v) in WRITTEN.items()] + [(k, v, f) for f, (k, v) in FORMS.items()]
    rows = [tuple(v[(i + at) % len(v)] if p == "v" else None for at, (_, v, _) in enumerate(kinds)) for i, p in enumerate(pattern)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} {k}" for i, (k, _, _) in enumerate(kinds))).coalesce(1)
    return df.select(*[F.col(f"c{i}").alias(f"c{i}", metadata={"arrow": f} if f else {}) for i, (_, _, f) in enumerate(kinds)])


def test_the_type_of_every_column(spark, tmp_path):
    path = brindle.write_arrow(_every_type(spark, "vvv"), str(tmp_path / "x.arrow"))
    schema = brindle.arrow_schema(path)
    assert [str(f.type) for f in schema] == [a for a, _ in WRITTEN.values()] + [f.replace("time32", "time32[ms]") for f in FORMS]
    assert all(f.nullable for f in schema)


@pytest.mark.parametrize("pattern", ["v", "-", "v-vv--vv", "-" * 9, "vv-" * 43, ""])
def test_values_and_nulls_of_every_type(spark, tmp_path, pattern):
    """Back as they went in, one batch or many; and as many nulls in the file as there are."""
    df = _every_type(spark, pattern)
    want = [tuple(r) for r in df.collect()]
    for batch_rows in (1000, 5):
        path = brindle.write_arrow(df, str(tmp_path / f"{batch_rows}.arrow"), batch_rows=batch_rows, nulls="native")
        assert [b.rows for b in brindle.arrow_batches(path)] == [min(batch_rows, len(pattern) - lo) for lo in range(0, len(pattern), batch_rows)]
        read = ipc.open_file(path).read_all()
        assert {c.null_count for c in read.columns} == {pattern.count("-")}
        times = [i for i, k in enumerate([*WRITTEN, *FORMS]) if k in ("time32", "timestamp[ns]", "duration[ns]")]
        plain = brindle.read_arrow(spark, path, nulls="native", row_index=True, columns=[f"c{i}" for i in range(len(want[0]) if want else 17) if i not in times])
        got = [tuple(r)[:-1] for r in plain.orderBy("__row_index").collect()]
        assert got == [tuple(v for i, v in enumerate(r) if i not in times) for r in want]
        ticks = ipc.open_file(path).read_all().select(times)
        assert [c.cast(pa.int32() if pa.types.is_time32(c.type) else pa.int64()).to_pylist() for c in ticks.columns] == [[r[i] for r in want] for i in times]


def test_nan_and_least_are_written_as_null(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"), -(2**31)), (1.0, -(2**31) + 1)], "f double, i int")
    got = ipc.open_file(brindle.write_arrow(df, str(tmp_path / "c.arrow"))).read_all().to_pydict()
    assert got == {"f": [None, 1.0], "i": [None, -(2**31) + 1]}
    native = ipc.open_file(brindle.write_arrow(df, str(tmp_path / "n.arrow"), nulls="native")).read_all().to_pydict()
    assert native["i"] == [-(2**31), -(2**31) + 1] and native["f"][0] != native["f"][0]


def test_no_validity_without_nulls_and_no_compression(spark, tmp_path):
    path = brindle.write_arrow(spark.range(10), str(tmp_path / "x.arrow"))
    batch = ipc.open_file(path).get_batch(0)
    assert batch.column(0).buffers()[0] is None
    assert len(brindle.arrow_batches(path)) == 1


def test_single_file_overwrites_and_folder_appends(spark, tmp_path):
    path = str(tmp_path / "x.arrow")
    brindle.write_arrow(spark.range(10), path)
    brindle.write_arrow(spark.range(3), path)
    assert brindle.read_arrow(spark, path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["x.arrow"]
    folder = str(tmp_path / "parts")
    brindle.write_arrow(spark.range(10), folder)
    brindle.write_arrow(spark.range(5), folder, mode="append")
    assert brindle.read_arrow(spark, folder).count() == 15
    brindle.write_arrow(spark.range(4), folder)
    assert brindle.read_arrow(spark, folder).count() == 4


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        brindle.write_arrow(bad, str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("*"))


def test_datetimes_one_way(spark, tmp_path):
    df = spark.createDataFrame([(-0.25,), (float("nan"),), (366 + 1 / 24 / 60,)], "z double")
    df = df.select(brindle.timestamp_of_days(F.col("z")).alias("p"))
    got = [r.p for r in brindle.read_arrow(spark, brindle.write_arrow(df, str(tmp_path / "x.arrow")), row_index=True).orderBy("__row_index").collect()]
    assert got == [dt.datetime(1999, 12, 31, 18), None, dt.datetime(2001, 1, 1, 0, 1)]


def test_own_types_are_restored(spark, tmp_path):
    df = spark.range(3).select(F.col("id").cast("byte").alias("y"), F.timestamp_micros("id").alias("z"))
    back = brindle.read_arrow(spark, brindle.write_arrow(df, str(tmp_path / "x.arrow")))
    assert back.schema.simpleString() == df.schema.simpleString() and back.exceptAll(df).isEmpty()


def test_many_rows_in_many_parts(spark, tmp_path):
    n = 700_000
    df = spark.range(0, n, 1, 6).select("id", F.crc32(F.col("id").cast("string")).alias("c"), F.hex("id").alias("h"))
    path = brindle.write_arrow(df, str(tmp_path / "x"))
    back = brindle.read_arrow(spark, path)
    assert back.where(F.crc32(F.col("id").cast("string")) == F.col("c")).where(F.hex("id") == F.col("h")).agg(F.count("*"), F.sum("id")).first()[:] == (n, n * (n - 1) // 2)


def test_row_order_is_kept(spark, tmp_path):
    path = brindle.write_arrow(spark.range(0, 5000, 1, 7).orderBy("id"), str(tmp_path / "x.arrow"), batch_rows=77)
    assert collected(brindle.read_arrow(spark, path, row_index=True, target_bytes=1000), ["id"]) == [list(range(5000))]


def test_scratch_is_swept(spark):
    from brindle.functions.paths import data_files, scratch, scratch_root

    path = scratch(spark, "x")
    assert path.startswith(scratch_root(spark))
    brindle.write_arrow(spark.range(3), path)
    assert data_files(path, "x")
    brindle.sweep(spark)
    with pytest.raises(brindle.OpenError):
        data_files(path, "x")
