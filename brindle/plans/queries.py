"""Registered queries: each really writes columnar files and reads them back; SQL says what must come out."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.ipc as ipc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ArrowIpcError
from ..functions.paths import resolve, scratch
from ..functions.times import micros_of, ntz_of_micros
from ..operators.interchange import arrow_batches, as_uint8, read_arrow, read_splay, stream_arrow, timestamp_of_days, write_arrow, write_splay
from ..streaming.batches import read_arrow_stream

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def round_trip(df: DataFrame, batch_rows: int = 20_000, strict: bool = True, **read) -> DataFrame:
    """df through a folder of multi-batch IPC files."""
    path = scratch(df.sparkSession, "ipc")
    write_arrow(df, path, batch_rows=batch_rows, strict=strict)
    return read_arrow(df.sparkSession, path, strict=strict, **read)


def foreign(df: DataFrame, shape: Callable[[pa.Table], pa.Table], batch_rows: int = 20_000) -> str:
    """A folder of IPC files as other programs write them: `shape` gives the columns their foreign form."""
    path = scratch(df.sparkSession, "foreign")
    fs, p = resolve(path, "arrow_write")
    fs.create_dir(p, recursive=True)

    def run(batches):
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if held:
            fs, p = resolve(path, "arrow_write")
            # one dictionary for the whole file
            made = shape(pa.Table.from_batches(held)).unify_dictionaries()
            with fs.open_output_stream(f"{p}/part-{TaskContext.get().partitionId():06d}.arrow") as out, ipc.new_file(out, made.schema) as sink:
                sink.write_table(made, max_chunksize=batch_rows)
        yield pa.RecordBatch.from_arrays([pa.array([sum(b.num_rows for b in held)], pa.int64())], names=["n"])

    df.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return path


def _cast(**types: pa.DataType) -> Callable[[pa.Table], pa.Table]:
    def shape(t: pa.Table) -> pa.Table:
        for n, to in types.items():
            i = t.schema.get_field_index(n)
            c = t.column(i)
            if pa.types.is_duration(to) and pa.types.is_int64(c.type):
                c = c.cast(to)
            elif pa.types.is_time32(to):
                c = c.cast(pa.int32()).cast(to)
            else:
                c = c.cast(to)
            t = t.set_column(i, n, c)
        return t

    return shape


def _plain(name: str):
    return lambda spark, d: round_trip(table(spark, d, name))


def rt_bool_null(spark, d):
    return round_trip(table(spark, d, "events").select("event_id", F.nullif(F.col("value") > 50, F.lit(True)).alias("b")))


def rt_utf8_null(spark, d):
    return round_trip(table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("s")))


def day_micros() -> Column:
    return F.pmod(micros_of(F.col("ts")), F.lit(86_400_000_000))


def rt_embeddings(spark, d):
    return round_trip(table(spark, d, "embeddings"), strict=False).select("vec_id", "label", F.posexplode("embedding").alias("i", "v")).select("vec_id", "label", F.col("i").cast("long").alias("i"), F.col("v").cast("double").alias("v"))


def _told(df: DataFrame, *names: str) -> DataFrame:
    """Nulls of integer columns as a flag and a 0, so that no comparison has to agree on a type for them."""
    return df.select(*[c for n in df.columns for c in ([F.col(n).isNull().alias(f"{n}_null"), F.coalesce(n, F.lit(0)).cast("long").alias(n)] if n in names else [F.col(n)])])


def rt_int_nulls(spark, d):
    return _told(round_trip(table(spark, d, "lineitem").select("l_orderkey", F.nullif("l_linenumber", F.lit(1)).cast("short").alias("h"), F.nullif("l_linenumber", F.lit(2)).alias("i"), F.nullif("l_partkey", F.lit(3)).alias("j"))), "h", "i", "j")


def rt_int_sentinel(spark, d):
    c = F.col("l_linenumber")
    least = F.lit(-(2**31)).cast("int")
    return _told(round_trip(table(spark, d, "lineitem").select("l_orderkey", c, F.when(c == 1, least).when(c == 2, least + 1).otherwise(c).alias("i"))), "i")


def rt_float_special(spark, d):
    k = F.col("event_id") % 5
    x = F.when(k == 0, F.lit(float("inf"))).when(k == 1, F.lit(float("-inf"))).when(k == 2, F.lit(float("nan"))).otherwise(F.col("value"))
    return round_trip(table(spark, d, "events").select("event_id", x.alias("f")))


def rt_f32(spark, d):
    return round_trip(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("float").alias("e")))


def rt_u8(spark, d):
    return round_trip(as_uint8(table(spark, d, "lineitem").select("l_orderkey", (F.col("l_orderkey") % 256).cast("short").alias("g")), "g"))


def rt_date(spark, d):
    return round_trip(table(spark, d, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("d")))


def rt_time_ms(spark, d):
    ms = F.floor(day_micros() / 1000).cast("int")
    df = table(spark, d, "events").select("event_id", ms.alias("t", metadata={"arrow": "time32"}))
    return round_trip(df, time="int_ms")


def rt_time_s_scaled(spark, d):
    df = table(spark, d, "events").select("event_id", F.floor(day_micros() / 1_000_000).cast("int").alias("t"))
    return read_arrow(spark, foreign(df, _cast(t=pa.time32("s"))), time="int_ms")


def _ts(unit: str, per: int):
    def run(spark, d):
        p = ntz_of_micros(F.floor(micros_of(F.col("ts")) / per).cast("long") * per)
        df = table(spark, d, "events").select("event_id", p.alias("p"))
        return read_arrow(spark, foreign(df, _cast(p=pa.timestamp(unit))))

    return run


def _duration(unit: str, per: int):
    def run(spark, d):
        df = table(spark, d, "events").select("event_id", F.floor(day_micros() / per).cast("long").alias("n"))
        if unit == "ns":
            df = df.select("event_id", (F.col("n") * 1000).alias("n"))
        return read_arrow(spark, foreign(df, _cast(n=pa.duration(unit))), nanos="long")

    return run


def rt_datetime_oneway(spark, d):
    days = F.datediff(F.col("ts").cast("date"), F.lit("2000-01-01").cast("date")).cast("double")
    return round_trip(table(spark, d, "events").select("event_id", timestamp_of_days(days).alias("p")))


def read_dictionary(spark, d):
    to = pa.dictionary(pa.int32(), pa.string())
    return read_arrow(spark, foreign(table(spark, d, "events").select("event_id", "event_type"), _cast(event_type=to)))


def read_large_utf8(spark, d):
    return read_arrow(spark, foreign(table(spark, d, "documents").select("doc_id", "text"), _cast(text=pa.large_string())))


def read_list(spark, d):
    df = table(spark, d, "embeddings").select("embedding", "vec_id")  # a list in the first column
    out = read_arrow(spark, foreign(df, lambda t: t, batch_rows=100))
    return out.select("vec_id", F.posexplode("embedding").alias("i", "v")).select("vec_id", F.col("i").cast("long").alias("i"), F.col("v").cast("double").alias("v"))


def read_sliced(spark, d):
    """Batches cut out of larger ones at an odd row, so no buffer begins where the file's does."""
    df = table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("s"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("f"))

    def shape(t: pa.Table) -> pa.Table:
        return pa.concat_tables([t.slice(0, 9), t.slice(9, 31), t.slice(40)])

    return read_arrow(spark, foreign(df, shape))


def read_empty(spark, d):
    return round_trip(table(spark, d, "orders").where("false"))


def read_columns(spark, d):
    return round_trip(table(spark, d, "lineitem"), columns=["l_shipdate", "l_orderkey"])


def read_row_index(spark, d):
    """Rows of one file keep their order: each is numbered, and the numbers follow the keys they were written in."""
    path = scratch(spark, "ordered", ".arrow")
    write_arrow(table(spark, d, "orders").orderBy("o_orderkey"), path, batch_rows=999)
    return read_arrow(spark, path, row_index=True, target_bytes=100_000).select("o_orderkey", F.col("__row_index").alias("row_index"))


def batch_rows(spark, d):
    path = scratch(spark, "ipc")
    write_arrow(table(spark, d, "lineitem"), path, batch_rows=10_000)
    return spark.createDataFrame([(sum(b.rows for b in arrow_batches(path)),)], "n long")


def _ipc_of(spark, d, name="lineitem"):
    path = scratch(spark, "ipc")
    write_arrow(table(spark, d, name), path, batch_rows=20_000)
    return path


def stream_rows(spark, d):
    return spark.createDataFrame([(stream_arrow(spark, _ipc_of(spark, d), scratch(spark, "streamed")),)], "n long")


def stream_readback(spark, d):
    to = scratch(spark, "streamed")
    stream_arrow(spark, _ipc_of(spark, d), to)
    return spark.read.parquet(to)


def splay_readback(spark, d):
    to = scratch(spark, "splay")
    stream_arrow(spark, _ipc_of(spark, d), to, format="splay")
    return read_splay(spark, to)


def splay_to_arrow(spark, d):
    to = scratch(spark, "splay")
    stream_arrow(spark, _ipc_of(spark, d, "events"), to, format="splay")
    return round_trip(read_splay(spark, to))


def stream_source(spark, d):
    """A folder through Structured Streaming that is appended to between triggers, its new files standing before and after the old ones by name."""
    orders, path = table(spark, d, "orders"), scratch(spark, "ipc")
    out, mark = scratch(spark, "sink"), scratch(spark, "mark")
    third = F.pmod(F.col("o_orderkey"), F.lit(3))
    for i in range(3):
        write_arrow(orders.where(third == i).repartition(3), path, batch_rows=5_000, mode="append")
        rows = read_arrow_stream(spark, path)
        run = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def splay_append(spark, d):
    """A column folder written in two goes."""
    events, to = table(spark, d, "events"), scratch(spark, "splay")
    for i in range(2):
        write_splay(events.where(F.pmod(F.col("event_id"), F.lit(2)) == i), to, mode="append")
    return read_splay(spark, to)


def read_filtered(spark, d):
    """Conditions that the reader evaluates, on a whole number and a string, and one on a fraction that it leaves to Spark."""
    df = table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("s"), "value")
    return round_trip(df, where=[("event_id", ">", 100), ("s", "in", ["", "view"]), ("value", "<", 90.0)])


def high_cardinality(spark, d):
    """Strings that are nearly all different, counted after a round trip."""
    df = table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("s"))
    return round_trip(df).agg(F.count("*").alias("n"), F.countDistinct("s").alias("n_strings"))


# --- errors ---


def _bad_files(spark: SparkSession) -> dict[str, str]:
    """Files that must be refused, by the name of the case."""
    folder = scratch(spark, "bad")
    fs, p = resolve(folder, "arrow_write")
    fs.create_dir(p, recursive=True)

    def put(name: str, data: bytes) -> None:
        with fs.open_output_stream(f"{p}/{name}.arrow") as out:
            out.write(data)

    def file_of(t: pa.Table, compression: str | None = None) -> bytes:
        sink = pa.BufferOutputStream()
        with ipc.new_file(sink, t.schema, options=ipc.IpcWriteOptions(compression=compression)) as w:
            w.write_table(t)
        return sink.getvalue().to_pybytes()

    good = file_of(pa.table({"a": pa.array(range(2000)), "s": [f"s{i % 50}" for i in range(2000)]}))
    one = lambda a, t: pa.table({"x": pa.array(a, t)})
    unsupported = {
        "date64": one([0, 86_400_000], pa.date64()), "time64": one([0, 1], pa.time64("us")), "decimal": one([1, 2], pa.decimal128(10, 2)), "int8": one([1], pa.int8()), "uint16": one([1], pa.uint16()), "uint32": one([1], pa.uint32()), "uint64": one([1], pa.uint64()),
        "binary": one([b"x"], pa.binary()), "null": one([None], pa.null()), "struct": one([{"a": 1}], pa.struct([("a", pa.int64())])), "map": one([[("a", 1)]], pa.map_(pa.string(), pa.int64())), "list_of_strings": one([["a"]], pa.list_(pa.string())), "large_list": one([[1]], pa.large_list(pa.int64())), "fixed_list": one([[1, 2]], pa.list_(pa.int64(), 2)),
        "dictionary_int8": pa.table({"x": pa.DictionaryArray.from_arrays(pa.array([0, 1], pa.int8()), pa.array(["x", "y"]))}), "dictionary_of_ints": pa.table({"x": pa.array([10, 20], pa.int64()).dictionary_encode()}), "float16": pa.table({"x": pa.array([1.0], pa.float32()).cast(pa.float16())}), "string_view": one(["a"], pa.string_view()),
    }
    for name, t in unsupported.items():
        put(name, file_of(t))
    put("zero_columns", file_of(pa.table({})))
    for codec in ("zstd", "lz4"):
        put(codec, file_of(pa.table({"x": list(range(1000))}), codec))
    put("empty_file", b"")
    put("only_magic", b"ARROW1\0\0ARROW1")
    put("all_zero", bytes(4096))
    put("double_magic", b"ARROW1\0\0" + good)
    put("truncated", good[: len(good) // 2])
    put("leading_magic", b"X" + good[1:])
    put("tail_magic", good[:-1] + b"X")
    for name, n in (("footer_zero", 0), ("footer_negative", -1), ("footer_huge", 2**31 - 1), ("footer_too_long", len(good))):
        put(name, good[:-10] + n.to_bytes(4, "little", signed=True) + good[-6:])
    return {f.base_name.removesuffix(".arrow"): f"{folder}/{f.base_name}" for f in fs.get_file_info(_selector(p))} | {"missing_file": f"{folder}/none.arrow"}


def _selector(p: str):
    from pyarrow import fs as pafs

    return pafs.FileSelector(p)


def _ipc_file(spark: SparkSession, df: DataFrame) -> str:
    return write_arrow(df, scratch(spark, "file", ".arrow"))


def errors(spark, d):
    """What each bad input, type and argument raises, when read, copied or written."""

    def raised(f) -> str:
        try:
            f()
        except ArrowIpcError as e:
            return type(e).__name__
        return "none"

    rows = []
    for name, path in sorted(_bad_files(spark).items()):
        rows.append(("read", name, raised(lambda path=path: read_arrow(spark, path))))
        rows.append(("stream", name, raised(lambda path=path: stream_arrow(spark, path, scratch(spark, "never")))))
    few = spark.range(2)
    for name, c in (("array", F.array("id")), ("binary", F.lit(b"x")), ("map", F.create_map("id", "id")), ("struct", F.struct("id")), ("decimal", F.col("id").cast("decimal(10,2)"))):
        rows.append(("write", name, raised(lambda c=c: write_arrow(few.select(c.alias("x")), scratch(spark, "never")))))
    rows.append(("write", "not_a_table", raised(lambda: write_arrow([1], "x"))))
    rows.append(("write", "not_a_path", raised(lambda: write_arrow(few, 7))))
    rows.append(("read", "not_a_path", raised(lambda: read_arrow(spark, None))))
    rows.append(("stream", "not_a_path", raised(lambda: stream_arrow(spark, 1, 2))))
    # a file stands where a folder has to be made
    at = _ipc_file(spark, few)
    for name, f in (("write", lambda: write_arrow(few, f"{at}/x.arrow")), ("write_folder", lambda: write_arrow(few, f"{at}/x")), ("stream", lambda: stream_arrow(spark, at, f"{at}/x", format="splay"))):
        rows.append((name.split("_")[0], "folder_of_a_file" if "_" in name else "in_a_file", raised(f)))
    return spark.createDataFrame(rows, "operation string, case string, error string")


_UNSUPPORTED = "date64 time64 decimal int8 uint16 uint32 uint64 binary null struct map list_of_strings large_list fixed_list dictionary_int8 dictionary_of_ints float16 string_view".split()
_NOT_OPENED = "zero_columns empty_file only_magic all_zero truncated leading_magic tail_magic footer_zero footer_negative footer_huge footer_too_long missing_file".split()


def _errors_sql() -> str:
    rows = [(o, c, e) for o in ("read", "stream") for cases, e in ((_UNSUPPORTED, "UnsupportedColumn"), (_NOT_OPENED, "OpenError"), (["zstd", "lz4"], "CompressedBody"), (["double_magic"], "BatchParseError"), (["not_a_path"], "BadArgument")) for c in cases]
    rows += [("write", "in_a_file", "CreateError"), ("write", "folder_of_a_file", "CreateError"), ("stream", "in_a_file", "CreateError")]
    rows += [("write", c, "UnsupportedColumn") for c in ("array", "binary", "map", "struct", "decimal")] + [("write", c, "BadArgument") for c in ("not_a_table", "not_a_path")]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{o}', '{c}', '{e}')" for o, c, e in rows) + ') AS t(operation, "case", error)'


UNITS = {"s": ("second", 1_000_000), "ms": ("millisecond", 1000), "us": ("microsecond", 1), "ns": ("microsecond", 1)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: dict = {f"rt_{t}": _plain(t) for t in TABLES}
    found |= {
        "rt_embeddings": rt_embeddings,
        **{f.__name__: f for f in (rt_bool_null, rt_utf8_null, rt_int_nulls, rt_int_sentinel, rt_float_special, rt_f32, rt_u8, rt_date, rt_time_ms, rt_time_s_scaled, rt_datetime_oneway)},
        **{f"rt_ts_{u}": _ts(u, per) for u, (_, per) in UNITS.items()},
        **{f"rt_duration_{u}": _duration(u, per) for u, (_, per) in UNITS.items()},
        **{f.__name__: f for f in (read_dictionary, read_large_utf8, read_list, read_sliced, read_empty, read_columns, read_row_index, batch_rows, stream_rows, stream_readback, splay_readback, splay_to_arrow, splay_append, stream_source, read_filtered, high_cardinality, errors)},
    }
    return found


def oracle_sql() -> dict[str, str]:
    day = "(epoch_us(ts) % 86400000000)"
    found = {f"rt_{t}": f"SELECT * FROM {t}" for t in TABLES}
    found |= {
        "rt_embeddings": "SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings",
        "rt_bool_null": "SELECT event_id, coalesce(nullif(value > 50, true), false) AS b FROM events",
        "rt_utf8_null": "SELECT event_id, coalesce(nullif(event_type, 'click'), '') AS s FROM events",
        "rt_int_nulls": "SELECT l_orderkey, l_linenumber = 1 AS h_null, CAST(coalesce(nullif(l_linenumber, 1), 0) AS BIGINT) AS h, l_linenumber = 2 AS i_null, CAST(coalesce(nullif(l_linenumber, 2), 0) AS BIGINT) AS i, l_partkey = 3 AS j_null, coalesce(nullif(l_partkey, 3), 0) AS j FROM lineitem",
        "rt_int_sentinel": "SELECT l_orderkey, l_linenumber, l_linenumber = 1 AS i_null, CAST(CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN -2147483647 ELSE l_linenumber END AS BIGINT) AS i FROM lineitem",
        "rt_float_special": "SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST('inf' AS DOUBLE) WHEN 1 THEN CAST('-inf' AS DOUBLE) WHEN 2 THEN NULL ELSE value END AS f FROM events",
        "rt_f32": "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS FLOAT) AS e FROM lineitem",
        "rt_u8": "SELECT l_orderkey, CAST(l_orderkey % 256 AS SMALLINT) AS g FROM lineitem",
        "rt_date": "SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d FROM lineitem",
        "rt_time_ms": f"SELECT event_id, CAST({day} // 1000 AS INTEGER) AS t FROM events",
        "rt_time_s_scaled": f"SELECT event_id, CAST({day} // 1000000 * 1000 AS INTEGER) AS t FROM events",
        "rt_datetime_oneway": "SELECT event_id, date_trunc('day', ts) AS p FROM events",
        **{f"rt_ts_{u}": f"SELECT event_id, date_trunc('{word}', ts) AS p FROM events" for u, (word, _) in UNITS.items()},
        **{f"rt_duration_{u}": f"SELECT event_id, {day} // {per} * {per * 1000} AS n FROM events" for u, (_, per) in UNITS.items()},
        "read_dictionary": "SELECT event_id, event_type FROM events",
        "read_large_utf8": "SELECT doc_id, text FROM documents",
        "read_list": "SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings",
        "read_sliced": "SELECT event_id, coalesce(nullif(event_type, 'click'), '') AS s, CASE WHEN event_id % 5 <> 0 THEN value END AS f FROM events",
        "read_empty": "SELECT * FROM orders WHERE false",
        "read_columns": "SELECT l_shipdate, l_orderkey FROM lineitem",
        "read_row_index": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders",
        "batch_rows": "SELECT count(*) AS n FROM lineitem",
        "stream_rows": "SELECT count(*) AS n FROM lineitem",
        "stream_readback": "SELECT * FROM lineitem",
        "splay_readback": "SELECT * FROM lineitem",
        "splay_to_arrow": "SELECT * FROM events",
        "stream_source": "SELECT * FROM orders",
        "splay_append": "SELECT * FROM events",
        "read_filtered": "SELECT event_id, coalesce(nullif(event_type, 'click'), '') AS s, value FROM events WHERE event_id > 100 AND coalesce(nullif(event_type, 'click'), '') IN ('', 'view') AND value < 90",
        "high_cardinality": "SELECT count(*) AS n, count(DISTINCT l_orderkey || '-' || l_linenumber) AS n_strings FROM lineitem",
        "errors": _errors_sql(),
    }
    return found
