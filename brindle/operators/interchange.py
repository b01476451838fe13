"""Reading, writing and materialising columnar files: the functions a user calls.

    register(spark)
    df = read_arrow(spark, "in.arrow")
    write_arrow(df, "out.arrow")
    n = stream_arrow(spark, "in.arrow", "folder", format="splay")
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


from ..errors import ArrowIpcError, BadArgument, CreateError
from ..functions import nulls as null_forms
from ..functions.metadata import BatchInfo, OpenedFile
from ..functions.paths import SUFFIXES, data_files, open_file, plain, qualified, resolve
from ..functions.times import ntz_of_micros
from ..functions.types import spark_to_arrow
from ..sources.arrow_ipc import BATCH_BYTES, BATCH_ROWS, CONDITIONS, MANY, ROW_INDEX, ArrowIpcDataSource, Options, columns_of
from ..sources.splay import SplayDataSource, code_of, layout


def register(spark: SparkSession) -> None:
    """Makes the formats "arrow_ipc" and "splay" known, and lets times be cast and written."""
    spark.dataSource.register(ArrowIpcDataSource)
    spark.dataSource.register(SplayDataSource)
    spark.conf.set("spark.sql.timeType.enabled", "true")


def _nulls(mode: str, operation: str) -> bool:
    if mode not in null_forms.MODES:
        raise BadArgument(operation, f"nulls is one of {null_forms.MODES}")
    return mode == "compat"


def read_arrow(spark: SparkSession, path: str, *, nulls: str = "compat", strict: bool = True, nanos: str = "error", time: str = "time", columns: Sequence[str] | None = None, row_index: bool = False, target_bytes: int | None = None, where: Sequence[tuple] = (), operation: str = "arrow_read") -> DataFrame:
    """An Arrow IPC file, or a folder of them, as a DataFrame.

    Files that aren't valid, unsupported column types and compressed bodies raise here, before any
    task runs; data that can't be decoded raises in the task that meets it. nulls: "compat" or
    "native" (see functions.nulls). nanos: what becomes of digits below a microsecond ("error",
    "truncate", or "long": exact nanoseconds since 1970). time: "time" or "int_ms" (milliseconds, any
    value). columns: the only ones decoded. row_index: adds the row's number as __row_index. where:
    conditions (column, "=", "<", "<=", ">", ">=" or "in", value) that all must hold; rows that can't meet
    those on whole numbers, dates, booleans and strings don't leave the reader.
    """
    path, compat = qualified(spark, plain(path, operation)), _nulls(nulls, operation)
    options = {"strict": strict, "nanos": nanos, "time": time, "tz": "utc" if compat else "zoned", "row_index": row_index, "operation": operation}
    if columns:
        if isinstance(columns, str) or any("," in c for c in columns):
            raise BadArgument(operation, "columns is a list of names without commas")
        options["columns"] = ",".join(columns)
    if target_bytes:
        options["target_bytes"] = target_bytes
    if any(len(c) != 3 or c[1] not in CONDITIONS for c in where):
        raise BadArgument(operation, f"where is a list of (column, condition, value), a condition one of {CONDITIONS}")
    if where:
        options["where"] = json.dumps([list(c) for c in where], default=str)
    o = Options.of({k: str(v) for k, v in options.items()}, operation)
    files = data_files(path, operation)
    with OpenedFile(files[0], operation) as f:
        names = {c.name for c in columns_of(f.schema, o)}
        if strange := [c[0] for c in where if c[0] not in names]:
            raise BadArgument(operation, f"no column that is read is named {strange[0]!r}")
        f.batches(strict)
    register(spark)
    df = spark.read.format("arrow_ipc").options(**{k: str(v) for k, v in options.items()}).load(path)
    df = null_forms.apply(df, lambda f: None if f.name == ROW_INDEX else null_forms.on_read(f)) if compat else df
    # what the reader lets through may still fail: it knows no null forms, and leaves some types alone
    for name, op, value in where:
        c = F.col(f"`{name}`")
        df = df.where(c.isin(list(value)) if op == "in" else {"=": c == value, "<": c < value, "<=": c <= value, ">": c > value, ">=": c >= value}[op])
    return df


def _make(folder: str, operation: str) -> None:
    """The folder, before any task runs."""
    fs, p = resolve(folder, operation)
    try:
        fs.create_dir(p, recursive=True)
    except OSError as e:
        raise CreateError(operation, str(e)) from e


def write_arrow(df: DataFrame, path: str, *, single_file: bool | None = None, batch_rows: int | None = None, nulls: str = "compat", strict: bool = True, mode: str = "overwrite") -> str:
    """Writes df and returns the path.

    single_file (the default for a path that ends in .arrow, .feather or .ipc) gives one file: one
    task joins the parts that all tasks have written. Otherwise the parts stay, in a folder. A list column needs strict=False.
    In compat form NaN and the least integers are written as nulls.
    """
    operation = "arrow_write"
    if not isinstance(df, DataFrame):
        raise BadArgument(operation, "a DataFrame and a path are expected")
    told, compat = plain(path, operation), _nulls(nulls, operation)
    path = qualified(df.sparkSession, told)
    for f in df.schema:
        spark_to_arrow(f, strict=strict, operation=operation)
    register(df.sparkSession)
    df = null_forms.apply(df, null_forms.on_write) if compat else df
    single = path.lower().endswith(SUFFIXES) if single_file is None else single_file
    options = {"strict": str(strict)} | ({"batch_rows": str(batch_rows)} if batch_rows else {})
    if not single:
        _make(path, operation)
        df.write.format("arrow_ipc").options(**options).mode(mode).save(path)
        return told
    if mode != "overwrite":
        raise BadArgument(operation, "a single file can only be overwritten")
    fs, p = resolve(path, operation)
    folder = f"{path}.{uuid.uuid4().hex[:8]}"
    _, q = resolve(folder, operation)
    try:
        if fs.get_file_info(p).type == pafs.FileType.Directory:
            raise CreateError(operation, f"{path} is a folder")
        _make(folder, operation)
        df.write.format("arrow_ipc").options(**options).mode("append").save(folder)
        made = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(q)) if f.base_name.startswith("part-"))
        if len(made) == 1:
            fs.move(f"{q}/{made[0]}", p)
        elif made:
            _joined(df.sparkSession, folder, made, batch_rows or BATCH_ROWS)
            fs.move(f"{q}/{WHOLE}", p)
        else:  # no task, no rows
            schema = pa.schema([spark_to_arrow(f, strict=strict) for f in df.schema])
            with fs.open_output_stream(p) as out, pa.ipc.new_file(out, schema):
                pass
    except OSError as e:
        raise CreateError(operation, str(e)) from e
    finally:
        if fs.get_file_info(q).type == pafs.FileType.Directory:
            fs.delete_dir(q)
    return told


WHOLE = "_whole.arrow"


def _joined(spark: SparkSession, folder: str, parts: list[str], batch_rows: int) -> None:
    """The folder's parts, in order, as one file of batches of batch_rows: one task moves their buffers, a batch at a time, without decoding them."""

    def run(batches):
        for _ in batches:
            fs, p = resolve(folder, "arrow_write")
            held, n, size, rows, sink = [], 0, 0, 0, None
            with fs.open_output_stream(f"{p}/{WHOLE}") as out:

                def flush(sink, held):
                    for b in pa.Table.from_batches(held).combine_chunks().to_batches():
                        sink.write_batch(b)

                for name in parts:
                    with open_file(f"{folder}/{name}", "arrow_write") as source:
                        reader = pa.ipc.open_file(source)
                        sink = sink or pa.ipc.new_file(out, reader.schema)
                        for i in range(reader.num_record_batches):
                            b = reader.get_batch(i)
                            rows += b.num_rows
                            while b.num_rows:
                                some = b.slice(0, batch_rows - n)
                                if held and size + some.nbytes > BATCH_BYTES:
                                    flush(sink, held)
                                    held, n, size = [], 0, 0
                                    continue
                                held.append(some)
                                n, size, b = n + some.num_rows, size + some.nbytes, b.slice(some.num_rows)
                                if n == batch_rows:
                                    flush(sink, held)
                                    held, n, size = [], 0, 0
                        if held:  # what goes on in the next part must outlive this one's map
                            held = pa.Table.from_batches(held).combine_chunks().to_batches()
                            held = [pa.record_batch([pa.concat_arrays([c, c.slice(0, 0)]) for c in b.columns], schema=b.schema) for b in held]
                if held:
                    flush(sink, held)
                sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], names=["rows"])

    spark.range(0, 1, 1, 1).mapInArrow(run, "rows long").collect()


def stream_arrow(spark: SparkSession, src: str, dst: str, *, format: str = "parquet", nulls: str = "compat", nanos: str | None = None) -> int:
    """Copies an Arrow file into a folder with memory for one batch in each task; returns the rows written.

    format: "parquet", or "splay" for the byte-compatible column folder (there times keep all their
    nanoseconds). Columns of lists are rejected before anything is written.
    """
    operation = "arrow_stream"
    if not isinstance(src, str) or not isinstance(dst, str):
        raise BadArgument(operation, "two paths are expected")
    if format not in ("parquet", "splay"):
        raise BadArgument(operation, f"format={format!r}")
    nanos = nanos or ("long" if format == "splay" else "error")
    time = "int_ms" if format == "splay" else "time"
    o = Options(nanos=nanos, time=time, operation=operation)
    src, dst = qualified(spark, plain(src, operation)), qualified(spark, plain(dst, operation))
    files = data_files(src, operation)

    def checked(path: str) -> int:
        with OpenedFile(path, operation) as f:
            for c in columns_of(f.schema, o):
                code_of(c.struct_field(), operation)
            return sum(b.rows for b in f.batches())

    rows = sum(map(checked, files)) if len(files) <= MANY else _everywhere(spark, files, checked)
    df = read_arrow(spark, src, nulls=nulls, nanos=nanos, time=time, operation=operation)
    if format == "splay":
        _make(dst, operation)
        # tasks are numbered in row order, which the sink keeps
        df.write.format("splay").option("operation", operation).mode("overwrite").save(dst)
        return layout(dst)[0][2]
    df.write.mode("overwrite").parquet(dst)
    return rows


def _everywhere(spark: SparkSession, files: list[str], check) -> int:
    """The sum of check over very many files, in tasks; an error of one of them is raised as it is."""

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                try:
                    rows, error = check(path), None
                except ArrowIpcError as e:
                    rows, error = 0, cloudpickle.dumps(e)
                yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([error], pa.binary())], names=["rows", "error"])

    got = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, len(files) // 64)).mapInArrow(run, "rows long, error binary")
    total, error = got.agg(F.sum("rows"), F.min("error")).first()
    if error is not None:
        raise cloudpickle.loads(error)
    return total


def read_splay(spark: SparkSession, path: str, *, nanos: str = "error", row_index: bool = False) -> DataFrame:
    register(spark)
    path = qualified(spark, plain(path, "splay_read"))
    layout(path)
    return spark.read.format("splay").option("nanos", nanos).option("row_index", str(row_index)).load(path)


def write_splay(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """A column folder of df. mode "append" adds rows to one that has the same columns."""
    register(df.sparkSession)
    for f in df.schema:
        code_of(f, "splay_write")
    to = qualified(df.sparkSession, plain(path, "splay_write"))
    _make(to, "splay_write")
    df.write.format("splay").option("operation", "splay_write").mode(mode).save(to)
    return path


def arrow_schema(path: str, operation: str = "arrow_read") -> pa.Schema:
    with OpenedFile(data_files(plain(path, operation), operation)[0], operation) as f:
        return f.schema


def arrow_batches(path: str, *, strict: bool = True, operation: str = "arrow_read") -> list[BatchInfo]:
    """(batch, rows, row_offset, body_bytes) of each record batch, from metadata alone."""
    out, upto, n = [], 0, 0
    for p in data_files(plain(path, operation), operation):
        with OpenedFile(p, operation) as f:
            own = f.batches(strict)
        out += [BatchInfo(n + b.batch, b.rows, upto + b.row_offset, b.body_bytes) for b in own]
        n, upto = len(out), upto + sum(b.rows for b in own)
    return out


def timestamp_of_days(days: Column) -> Column:
    """Fractional days since 2000 as a timestamp, to the microsecond; NaN is null."""
    micros = F.round((F.nanvl(days, F.lit(0.0)) + F.lit(10_957)) * F.lit(86_400_000_000.0)).cast("long")
    return F.when(~F.isnan(days), ntz_of_micros(micros))


def as_uint8(df: DataFrame, *names: str) -> DataFrame:
    """Marks short columns as unsigned bytes; values outside 0 to 255 fail when written."""
    return df.select(*[F.col(f"`{f.name}`").cast("short").alias(f.name, metadata={"arrow": "uint8"}) if f.name in names else F.col(f"`{f.name}`") for f in df.schema])


__all__ = ["ArrowIpcError", "arrow_batches", "arrow_schema", "as_uint8", "read_arrow", "read_splay", "register", "stream_arrow", "timestamp_of_days", "write_arrow", "write_splay"]
