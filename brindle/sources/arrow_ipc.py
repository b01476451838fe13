"""Data source "arrow_ipc": Arrow IPC files as a batch source, a stream source, and a sink.

Reading: one input partition holds a range of record batches (small ones together, up to
``target_bytes``), so a task maps the file and decodes only its own batches. With more than ``MANY``
files, and no row index wanted, each file is one partition and the driver opens only the first. The conditions of the option ``where`` are
evaluated on the decoded batch, so rows that can't match aren't sent to the JVM. (Spark 4.1's own filter
pushdown for Python sources isn't used: it leaves a query's filters in force for later queries over the same
DataFrame, which then lose rows.)

Streaming: an offset is the list of the folder's files with their sizes and times, and a trigger reads the
files that its start doesn't have. Only those are opened. An offset is as long as the folder's list, so
files that are no longer wanted should be moved away.

Writing: each task writes one part file under a temporary name; the driver's commit gives the parts
their names, and an abort removes them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc as ipc
from pyarrow import fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

from ..errors import BadArgument, BatchParseError, CreateError, OpenError, UnsupportedColumn
from ..functions.metadata import OpenedFile
from ..functions.paths import data_files, plain, resolve, stamps
from ..functions.types import Column, arrow_to_spark, encode, spark_to_arrow

ROW_INDEX = "__row_index"
MANY = 256
TARGET_BYTES = 64 << 20
BATCH_ROWS = 131_072
BATCH_BYTES = 1 << 30  # string offsets of a batch stay within 32 bits


@dataclass
class Options:
    strict: bool = True
    nanos: str = "error"
    time: str = "time"
    tz: str = "utc"
    row_index: bool = False
    columns: tuple | None = None
    target_bytes: int = TARGET_BYTES
    operation: str = "arrow_read"
    where: str = "[]"

    @staticmethod
    def of(options: dict, operation: str = "arrow_read") -> Options:
        low = {k.lower(): v for k, v in options.items()}
        truth = lambda k, d: str(low.get(k, d)).lower() == "true"
        names = low.get("columns")
        try:
            target = int(low.get("target_bytes", TARGET_BYTES))
        except ValueError as e:
            raise BadArgument(operation, f"target_bytes={low['target_bytes']!r}") from e
        return Options(truth("strict", True), low.get("nanos", "error"), low.get("time", "time"), low.get("tz", "utc"), truth("row_index", False), tuple(n.strip() for n in names.split(",")) if names else None, target, low.get("operation", operation), low.get("where", "[]"))


def columns_of(schema: pa.Schema, o: Options) -> list[Column]:
    if o.columns:
        for n in o.columns:
            if len(schema.get_all_field_indices(n)) != 1:
                raise BadArgument(o.operation, f"no single column is named {n!r}")
        fields = [schema.field(n) for n in o.columns]
    else:
        fields = list(schema)
    return [arrow_to_spark(f, strict=o.strict, nanos=o.nanos, time=o.time, tz=o.tz, operation=o.operation) for f in fields]


def spark_schema(columns: list[Column], o: Options) -> T.StructType:
    return T.StructType([c.struct_field() for c in columns] + ([T.StructField(ROW_INDEX, T.LongType(), True)] if o.row_index else []))


@dataclass
class Range(InputPartition):
    path: str
    first: int
    last: int | None  # None: to the end, all batches being this task's
    row_offset: int

    def __init__(self, path, first, last, row_offset):
        super().__init__((path, first))
        self.path, self.first, self.last, self.row_offset = path, first, last, row_offset


def ranges(paths: list[str], o: Options, within: bool = False) -> list[Range]:
    """Input partitions in row order; rows are numbered through all files, or within each."""
    if len(paths) > MANY and (within or not o.row_index):
        return [Range(p, 0, None, 0) for p in paths]
    out, upto = [], 0
    for p in paths:
        with OpenedFile(p, o.operation) as f:
            first, size, rows, at = 0, 0, 0, upto
            for b in f.batches(o.strict):
                if size and size + b.body_bytes > o.target_bytes:
                    out.append(Range(p, first, b.batch, at))
                    first, size, at = b.batch, 0, upto + b.row_offset
                size += b.body_bytes
                rows = b.row_offset + b.rows
            out.append(Range(p, first, f.reader.num_record_batches, at))
            upto += 0 if within else rows
    return out


COMPARED = {"=": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal}
CONDITIONS = (*COMPARED, "in")


def mask(a: pa.Array, op: str, value) -> pa.Array | None:
    """Rows for which a condition may hold, as whole numbers, dates, booleans and strings are the same in Arrow; nulls may, as the null forms come later."""
    t = a.type
    if not (pa.types.is_integer(t) or pa.types.is_date32(t) or pa.types.is_boolean(t) or pa.types.is_string(t)):
        return None
    if op == "in":
        return pc.or_(a.is_null(), pc.is_in(a, _values(value, t)))
    return pc.fill_null(COMPARED[op](a, _values([value], t)[0]), True)


def _values(values: list, t: pa.DataType) -> pa.Array:
    return pa.array([dt.date.fromisoformat(v) for v in values] if pa.types.is_date32(t) else values, t)


def decoded(part: Range, o: Options, wanted: T.StructType | None = None):
    """The record batches of a partition as Spark wants them, without rows that the conditions exclude. The file is opened once."""
    with OpenedFile(part.path, o.operation) as f:
        columns = columns_of(f.schema, o)
        if wanted is not None and [(c.name, c.dataType) for c in spark_schema(columns, o)] != [(c.name, c.dataType) for c in wanted]:
            raise BatchParseError(o.operation, f"{part.path}: its columns differ from the first file's")
        if part.last is None:
            f.batches(o.strict)
        reader = f.reader
        if o.columns:
            where = [f.schema.get_field_index(c.name) for c in columns]
            reader = ipc.open_file(f.source, options=ipc.IpcReadOptions(included_fields=where))
        if part.last is None:
            part = Range(part.path, 0, reader.num_record_batches, 0)
        at = part.row_offset
        for i in range(part.first, part.last):
            try:
                batch = reader.get_batch(i)
                batch.validate()
                # offsets, indices and text could be wrong inside; of fixed widths every value is one
                for a in batch.columns:
                    if not pa.types.is_primitive(a.type):
                        a.validate(full=True)
                arrays = [batch.column(batch.schema.get_field_index(c.name)) for c in columns] if o.columns else batch.columns
                out = [c.decode(a) for c, a in zip(columns, arrays, strict=True)]
                for c, a in zip(columns, out, strict=True):
                    if a.type != c.arrow:
                        raise pa.ArrowInvalid(f"{c.name} is {a.type}, not {c.arrow}")
                names = [c.name for c in columns]
                if o.row_index:
                    out.append(pa.array(np.arange(at, at + batch.num_rows)))
                    names.append(ROW_INDEX)
                at += batch.num_rows
                made = pa.RecordBatch.from_arrays(out, names=names)
                for name, op, value in json.loads(o.where):
                    keeps = mask(made.column(names.index(name)), op, value)
                    made = made if keeps is None else made.filter(keeps)
            except (OSError, pa.ArrowException, ValueError, IndexError) as e:
                raise BatchParseError(o.operation, f"{part.path}, batch {i}: {e}") from e
            if made.num_rows:
                yield made


class ArrowReader(DataSourceReader):
    def __init__(self, paths: list[str], schema: T.StructType, o: Options):
        self.paths, self.o, self.wanted = paths, o, schema

    def partitions(self):
        return ranges(self.paths, self.o)

    def read(self, partition):
        yield from decoded(partition, self.o, self.wanted)


class ArrowStream(DataSourceStreamReader):
    """A stream over the files of a folder: an offset holds each file's name, size and time."""

    def __init__(self, path: str, schema: T.StructType, o: Options):
        self.path, self.o, self.wanted = path, o, schema

    def initialOffset(self):
        return {"files": {}}

    def latestOffset(self):
        return {"files": stamps(self.path, self.o.operation)}

    def partitions(self, start, end):
        new = {n: s for n, s in end["files"].items() if start["files"].get(n) != s}
        now = stamps(self.path, self.o.operation)
        lost = [n for n, s in new.items() if now.get(n) != s]
        if lost:
            raise OpenError(self.o.operation, f"{self.path}: {lost[0]} went or changed before it was read")
        in_order = sorted(new, key=lambda n: (int(new[n].split("@")[1]), n))
        return ranges([n if n == self.path else f"{self.path.rstrip('/')}/{n}" for n in in_order], self.o, within=True)

    def commit(self, end):
        pass

    def read(self, partition):
        yield from decoded(partition, self.o, self.wanted)


@dataclass
class Written(WriterCommitMessage):
    part: str
    rows: int
    size: int
    partition: int


class ArrowWriter(DataSourceArrowWriter):
    """Tasks write parts under temporary names; commit renames, abort deletes."""

    def __init__(self, path: str, schema: T.StructType, overwrite: bool, options: dict):
        low = {k.lower(): v for k, v in options.items()}
        self.operation = low.get("operation", "arrow_write")
        self.path = plain(path, self.operation)
        strict = str(low.get("strict", "true")).lower() == "true"
        if not schema.fields:
            raise UnsupportedColumn(self.operation, "a table without columns")
        self.schema = pa.schema([spark_to_arrow(f, strict=strict, operation=self.operation) for f in schema])
        self.batch_rows = int(low.get("batch_rows", BATCH_ROWS))
        if self.batch_rows < 1:
            raise BadArgument(self.operation, "batch_rows is at least 1")
        self.overwrite, self.run = overwrite, uuid.uuid4().hex[:12]
        try:
            fs, p = resolve(self.path, self.operation)
            fs.create_dir(p, recursive=True)
        except OSError as e:
            raise CreateError(self.operation, str(e)) from e

    def _temporary(self, partition: int, attempt: int) -> str:
        return f"_{self.run}-{partition:06d}-{attempt}.part"

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        partition, attempt = context.partitionId(), context.taskAttemptId()
        fs, p = resolve(self.path, self.operation)
        name, rows = self._temporary(partition, attempt), 0
        try:
            with fs.open_output_stream(f"{p}/{name}") as out, ipc.new_file(out, self.schema) as sink:
                held, n, size = [], 0, 0
                for b in iterator:
                    for lo in range(0, b.num_rows, self.batch_rows):
                        some = b.slice(lo, self.batch_rows)
                        own = some.nbytes
                        if held and (n + some.num_rows > self.batch_rows or size + own > BATCH_BYTES):
                            rows += self._flush(sink, held)
                            held, n, size = [], 0, 0
                        held.append(self._encoded(some))
                        n, size = n + some.num_rows, size + own
                if held:
                    rows += self._flush(sink, held)
            size = fs.get_file_info(f"{p}/{name}").size
        except OSError as e:
            raise CreateError(self.operation, str(e)) from e
        return Written(name, rows, size, partition)

    def _encoded(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([encode(a, f.type, self.operation) for a, f in zip(batch.columns, self.schema, strict=True)], schema=self.schema)

    def _flush(self, sink, held: list) -> int:
        batch = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        sink.write_batch(batch)
        return batch.num_rows

    def commit(self, messages):
        fs, p = resolve(self.path, self.operation)
        written = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        new = [f"part-{m.partition:06d}-{self.run}.arrow" for m in written]
        for m, name in zip(written, new, strict=True):
            fs.move(f"{p}/{m.part}", f"{p}/{name}")
        for f in fs.get_file_info(pafs.FileSelector(p)):
            stray = f.base_name.startswith(f"_{self.run}")  # of attempts that were not the ones committed
            if stray or self.overwrite and f.type == pafs.FileType.File and f.base_name not in new:
                fs.delete_file(f.path)

    def abort(self, messages):
        fs, p = resolve(self.path, self.operation)
        for f in fs.get_file_info(pafs.FileSelector(p, allow_not_found=True)):
            if f.base_name.startswith(f"_{self.run}"):
                fs.delete_file(f.path)


class ArrowIpcDataSource(DataSource):
    """spark.read.format("arrow_ipc"): options strict, nanos, time, tz, columns, row_index, target_bytes, where (a JSON list of [column, condition, value])."""

    @classmethod
    def name(cls):
        return "arrow_ipc"

    def _path(self, operation: str) -> str:
        return plain(self.options.get("path"), operation)

    def schema(self):
        o = Options.of(self.options)
        with OpenedFile(data_files(self._path(o.operation), o.operation)[0], o.operation) as f:
            return spark_schema(columns_of(f.schema, o), o)

    def reader(self, schema):
        o = Options.of(self.options)
        return ArrowReader(data_files(self._path(o.operation), o.operation), schema, o)

    def streamReader(self, schema):
        o = Options.of(self.options)
        return ArrowStream(self._path(o.operation), schema, o)

    def writer(self, schema, overwrite):
        return ArrowWriter(self._path("arrow_write"), schema, overwrite, self.options)
