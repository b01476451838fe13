"""Data source "splay": a folder with one binary file for each column and a manifest of their names.

The layout is byte for byte that of the compatible column store (little-endian):

    fixed width      4 bytes 0, int16 type at 4, 2 bytes 0, int64 count at 8, 16 bytes 0, then the values
    symbols, ``.d``  0xFF 0x01, int16 11, int32 count at 4, then NUL-terminated strings

Values count from 2000-01-01 and have nulls in band. Row order is file order: tasks write chunks of
each column, and the commit appends them in partition order, a buffer at a time. Overwriting removes the
columns that the manifest names and nothing else; appending copies them in front of the new rows, and needs
the same columns.
"""

from __future__ import annotations

import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..errors import BadArgument, BatchParseError, CreateError, OpenError, UnsupportedColumn
from ..functions.paths import open_file, plain, resolve

#: fixed values: type codes of columns, and where the epoch of 2000 lies in that of 1970
BOOL, BYTE, SHORT, INT, LONG, REAL, FLOAT, SYMBOL, TIMESTAMP, DATE, DATETIME, TIMESPAN, TIME = 1, 4, 5, 6, 7, 8, 9, 11, 12, 14, 15, 16, 19
EPOCH_DAYS, EPOCH_NS = 10_957, 946_684_800_000_000_000
FORMS = {BOOL: "<u1", BYTE: "<u1", SHORT: "<i2", INT: "<i4", LONG: "<i8", REAL: "<f4", FLOAT: "<f8", TIMESTAMP: "<i8", DATE: "<i4", DATETIME: "<f8", TIMESPAN: "<i8", TIME: "<i4"}
HEADER, SYMBOL_HEADER, SYMBOL_MAGIC = 32, 8, b"\xff\x01"

MANIFEST = ".d"
CHUNK = 16 << 20
ROWS = 1_000_000  # of a partition when read


def code_of(f: T.StructField, operation: str) -> int:
    t, form = f.dataType, (f.metadata or {}).get("arrow", "")
    if isinstance(t, T.ShortType):
        return BYTE if form == "uint8" else SHORT
    if isinstance(t, T.IntegerType):
        return TIME if form == "time32" else INT
    if isinstance(t, T.LongType):
        return {"timestamp[ns]": TIMESTAMP, "duration[ns]": TIMESPAN}.get(form, LONG)
    for kind, code in ((T.BooleanType, BOOL), (T.FloatType, REAL), (T.DoubleType, FLOAT), (T.StringType, SYMBOL), (T.DateType, DATE), (T.TimestampNTZType, TIMESTAMP), (T.TimestampType, TIMESTAMP), (T.DayTimeIntervalType, TIMESPAN), (T.TimeType, TIME)):
        if isinstance(t, kind):
            return code
    raise UnsupportedColumn(operation, f"{f.name}: {t.simpleString()}")


def header(code: int, count: int) -> bytes:
    if code == SYMBOL:
        return SYMBOL_MAGIC + struct.pack("<hi", SYMBOL, count)
    return struct.pack("<ihhq16x", 0, code, 0, count)


def payload(a: pa.Array, code: int, operation: str) -> bytes:
    """A column's values as they stand in its file."""
    if code == SYMBOL:
        words = a.fill_null("").to_pylist()
        if any("\0" in w for w in words):
            raise BatchParseError(operation, "a string with a NUL can't be a symbol")
        return b"".join(w.encode("utf-8") + b"\0" for w in words)
    empty = a.is_null().to_numpy(zero_copy_only=False)
    if code in (REAL, FLOAT):
        x = a.to_numpy(zero_copy_only=False).astype(FORMS[code])
        x[empty] = np.nan
        return x.tobytes()
    if code == BOOL:
        return a.fill_null(False).to_numpy(zero_copy_only=False).astype("<u1").tobytes()
    width = pa.int32() if pa.types.is_date32(a.type) or pa.types.is_time32(a.type) else pa.int64()
    raw = (a.view(width) if pa.types.is_temporal(a.type) else a).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if pa.types.is_time64(a.type):
        raw = raw // (1_000_000 if a.type.unit == "ns" else 1_000)
    elif pa.types.is_timestamp(a.type) or pa.types.is_duration(a.type):
        per = {"s": 10**9, "ms": 10**6, "us": 1000, "ns": 1}[a.type.unit]
        if len(raw) and np.abs(raw.astype(object) * per).max() > 2**63 - 1:
            raise BatchParseError(operation, "a time that nanoseconds can't hold")
        raw = raw * per
    if code == DATE:
        raw = raw - EPOCH_DAYS
    elif code == TIMESTAMP:
        raw = raw - EPOCH_NS
    x = raw.astype(FORMS[code])
    if code != BYTE:
        x[empty] = np.iinfo(x.dtype).min
    return x.tobytes()


@dataclass
class Chunk(WriterCommitMessage):
    prefix: str
    partition: int
    rows: int


class SplayWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, options: dict):
        low = {k.lower(): v for k, v in options.items()}
        self.operation = low.get("operation", "arrow_stream")
        self.path, self.run = plain(path, self.operation), uuid.uuid4().hex[:12]
        self.names = [f.name for f in schema]
        if not self.names or any("/" in n or "\0" in n or n in ("", MANIFEST) for n in self.names):
            raise UnsupportedColumn(self.operation, "a column's name can't name a file")
        self.codes = [code_of(f, self.operation) for f in schema]
        try:
            fs, p = resolve(self.path, self.operation)
            fs.create_dir(p, recursive=True)
            there = fs.get_file_info(f"{p}/{MANIFEST}").type == pafs.FileType.File
        except OSError as e:
            raise CreateError(self.operation, str(e)) from e
        self.old = layout(self.path) if there else []
        self.append = bool(there and not overwrite)
        if self.append and [(n, c) for n, c, _ in self.old] != list(zip(self.names, self.codes, strict=True)):
            raise BadArgument(self.operation, f"{self.path} has other columns: {', '.join(n for n, _, _ in self.old)}")

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        prefix = f"_{self.run}-{context.partitionId():06d}-{context.taskAttemptId()}"
        fs, p = resolve(self.path, self.operation)
        rows = 0
        try:
            outs = [fs.open_output_stream(f"{p}/{prefix}-{i}") for i in range(len(self.names))]
            try:
                for b in iterator:
                    rows += b.num_rows
                    for out, a, code in zip(outs, b.columns, self.codes, strict=True):
                        out.write(payload(a, code, self.operation))
            finally:
                for out in outs:
                    out.close()
        except (OSError, pa.ArrowException) as e:
            raise CreateError(self.operation, str(e)) from e
        return Chunk(prefix, context.partitionId(), rows)

    def commit(self, messages):
        fs, p = resolve(self.path, self.operation)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        rows = sum(m.rows for m in parts) + (self.old[0][2] if self.append else 0)
        if rows > 2**31 - 1 and SYMBOL in self.codes:
            raise BatchParseError(self.operation, "more rows than a column of symbols can count")
        for i, (name, code) in enumerate(zip(self.names, self.codes, strict=True)):
            with fs.open_output_stream(f"{p}/_{self.run}-whole-{i}") as out:
                out.write(header(code, rows))
                if self.append:
                    with fs.open_input_file(f"{p}/{name}") as had:
                        had.seek(SYMBOL_HEADER if code == SYMBOL else HEADER)
                        while some := had.read(CHUNK):
                            out.write(some)
                for m in parts:
                    with fs.open_input_stream(f"{p}/{m.prefix}-{i}") as part:
                        while some := part.read(CHUNK):
                            out.write(some)
        with fs.open_output_stream(f"{p}/_{self.run}-whole-d") as out:
            out.write(header(SYMBOL, len(self.names)) + b"".join(n.encode("utf-8") + b"\0" for n in self.names))
        for name, _, _ in self.old:
            fs.delete_file(f"{p}/{name}")
        for i, name in enumerate(self.names):
            fs.move(f"{p}/_{self.run}-whole-{i}", f"{p}/{name}")
        if self.old:
            fs.delete_file(f"{p}/{MANIFEST}")
        fs.move(f"{p}/_{self.run}-whole-d", f"{p}/{MANIFEST}")
        self._clean()

    def abort(self, messages):
        self._clean()

    def _clean(self):
        """Removes this run's chunks."""
        fs, p = resolve(self.path, self.operation)
        for f in fs.get_file_info(pafs.FileSelector(p, allow_not_found=True)):
            if f.type == pafs.FileType.File and f.base_name.startswith(f"_{self.run}"):
                fs.delete_file(f.path)


# --- reading ---


def _column(code: int, raw: np.ndarray, nanos: str) -> pa.Array:
    if code == BOOL:
        return pa.array(raw != 0)
    if code == BYTE:
        return pa.array(raw.astype(np.int16))
    if code in (REAL, FLOAT, DATETIME):
        x = np.array(raw)
        if code != DATETIME:
            return pa.array(x, mask=np.isnan(x))
        empty = np.isnan(x)
        return pa.array(np.rint((np.where(empty, 0, x) + EPOCH_DAYS) * 86_400e6).astype(np.int64), pa.int64(), mask=empty).view(pa.timestamp("us"))
    empty = raw == np.iinfo(raw.dtype).min
    x = np.where(empty, 0, raw)
    if code == DATE:
        return pa.array(np.where(empty, 0, x + EPOCH_DAYS).astype(np.int32), mask=empty).view(pa.date32())
    if code == TIME:
        return pa.array(x.astype(np.int64) * 1_000_000, mask=empty).view(pa.time64("ns"))
    if code in (TIMESTAMP, TIMESPAN):
        x = x + (EPOCH_NS if code == TIMESTAMP else 0)
        if nanos == "long":
            return pa.array(x, mask=empty)
        if nanos == "error" and (x[~empty] % 1000).any():
            raise BatchParseError("splay_read", "digits below a microsecond; read with nanos='truncate' or nanos='long'")
        return pa.array(np.floor_divide(x, 1000), mask=empty).view(pa.timestamp("us") if code == TIMESTAMP else pa.duration("us"))
    return pa.array(x, mask=empty)


def spark_field(name: str, code: int, nanos: str) -> T.StructField:
    if code in (TIMESTAMP, TIMESPAN) and nanos == "long":
        return T.StructField(name, T.LongType(), True, {"arrow": "timestamp[ns]" if code == TIMESTAMP else "duration[ns]"})
    kinds = {BOOL: T.BooleanType(), BYTE: T.ShortType(), SHORT: T.ShortType(), INT: T.IntegerType(), LONG: T.LongType(), REAL: T.FloatType(), FLOAT: T.DoubleType(), SYMBOL: T.StringType(), TIMESTAMP: T.TimestampNTZType(), DATE: T.DateType(), DATETIME: T.TimestampNTZType(), TIMESPAN: T.DayTimeIntervalType(), TIME: T.TimeType(3)}
    return T.StructField(name, kinds[code], True, {"arrow": "uint8"} if code == BYTE else {})


@dataclass
class Part(InputPartition):
    first: int
    rows: int
    places: tuple  # where each column's part begins in its file

    def __init__(self, first, rows, places):
        super().__init__(first)
        self.first, self.rows, self.places = first, rows, places


class SplayReader(DataSourceReader):
    def __init__(self, path: str, nanos: str, row_index: bool):
        self.path, self.nanos, self.row_index = path, nanos, row_index
        self.columns = layout(path)

    def partitions(self):
        """Ranges of rows; the strings' places are found by counting their ends, a chunk at a time."""
        total = self.columns[0][2]
        starts = list(range(0, total, ROWS)) or [0]
        places = []
        for name, code, _ in self.columns:
            if code != SYMBOL:
                places.append([HEADER + s * np.dtype(FORMS[code]).itemsize for s in starts])
                continue
            found, seen, wanted = [SYMBOL_HEADER], 0, starts[1:]
            with open_file(f"{self.path}/{name}", "splay_read") as f:
                at = SYMBOL_HEADER
                while wanted and (some := f.read_at(CHUNK, at)):
                    ends = np.flatnonzero(np.frombuffer(some, np.uint8) == 0)
                    while wanted and wanted[0] <= seen + len(ends):
                        found.append(at + int(ends[wanted.pop(0) - seen - 1]) + 1)
                    seen, at = seen + len(ends), at + len(some)
            if wanted:
                raise BatchParseError("splay_read", f"{name} has fewer strings than its count")
            places.append(found)
        return [Part(s, min(ROWS, total - s), tuple(p[i] for p in places)) for i, s in enumerate(starts)]

    def read(self, part):
        arrays = []
        for (name, code, _), at in zip(self.columns, part.places, strict=True):
            with open_file(f"{self.path}/{name}", "splay_read") as f:
                if code == SYMBOL:
                    arrays.append(_strings(f, at, part.rows, name))
                    continue
                form = np.dtype(FORMS[code])
                raw = f.read_at(part.rows * form.itemsize, at)
                if len(raw) != part.rows * form.itemsize:
                    raise BatchParseError("splay_read", f"{name} is shorter than its count")
                arrays.append(_column(code, np.frombuffer(raw, form), self.nanos))
        names = [c[0] for c in self.columns]
        if self.row_index:
            arrays.append(pa.array(np.arange(part.first, part.first + part.rows)))
            names.append("__row_index")
        if part.rows:
            yield from pa.Table.from_arrays(arrays, names=names).to_batches(100_000)


def _strings(f, at: int, rows: int, name: str) -> pa.Array:
    held, need = [], rows
    while need:
        some = f.read_at(CHUNK, at)
        if not some:
            raise BatchParseError("splay_read", f"{name} has fewer strings than its count")
        ends = some.count(b"\0")
        if ends >= need:
            cut = np.flatnonzero(np.frombuffer(some, np.uint8) == 0)[need - 1] + 1
            some, ends = some[:cut], need
        held.append(some)
        at, need = at + len(some), need - ends
    return pa.array([w.decode("utf-8") for w in b"".join(held).split(b"\0")[:-1]], pa.string())


def layout(path: str) -> list[tuple[str, int, int]]:
    """(name, type code, count) of each column in order."""
    out = []
    with open_file(f"{path}/{MANIFEST}", "splay_read") as f:
        raw = f.read()
    if raw[:2] != SYMBOL_MAGIC or len(raw) < SYMBOL_HEADER:
        raise OpenError("splay_read", f"{path}/{MANIFEST} is no manifest")
    names = [n.decode("utf-8") for n in raw[SYMBOL_HEADER:].split(b"\0")[:-1]]
    if len(names) != struct.unpack_from("<i", raw, 4)[0] or not names:
        raise OpenError("splay_read", f"{path}/{MANIFEST} is damaged")
    for n in names:
        with open_file(f"{path}/{n}", "splay_read") as f:
            head = f.read_at(HEADER, 0)
        if head[:2] == SYMBOL_MAGIC and len(head) >= SYMBOL_HEADER:
            out.append((n, SYMBOL, struct.unpack_from("<i", head, 4)[0]))
        elif len(head) == HEADER and struct.unpack_from("<h", head, 4)[0] in FORMS:
            out.append((n, *struct.unpack_from("<h2xq", head, 4)))
        else:
            raise OpenError("splay_read", f"{path}/{n} is no column")
    if len({c for _, _, c in out}) != 1:
        raise OpenError("splay_read", f"{path} has columns of different lengths")
    return out


class SplayDataSource(DataSource):
    """spark.read.format("splay"): options nanos, row_index."""

    @classmethod
    def name(cls):
        return "splay"

    def _options(self):
        nanos = self.options.get("nanos", "error")
        if nanos not in ("error", "truncate", "long"):
            raise BadArgument("splay_read", f"nanos={nanos!r}")
        return plain(self.options.get("path"), "splay_read"), nanos, str(self.options.get("row_index", "false")).lower() == "true"

    def schema(self):
        path, nanos, index = self._options()
        return T.StructType([spark_field(n, c, nanos) for n, c, _ in layout(path)] + ([T.StructField("__row_index", T.LongType())] if index else []))

    def reader(self, schema):
        return SplayReader(*self._options())

    def writer(self, schema, overwrite):
        return SplayWriter(self.options.get("path"), schema, overwrite, self.options)
