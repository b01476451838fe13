"""Types of Arrow files and of Spark, in both directions, and the decoding and encoding between them.

``strict`` accepts exactly the types of the compatible type map; without it, whatever Spark can hold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from ..errors import BadArgument, BatchParseError, UnsupportedColumn

NANOS = ("error", "truncate", "long")
TIMES = ("time", "int_ms")
PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}
#: metadata of an Arrow field by which a file written here is read back with its own Spark type
SPARK_TYPE = b"spark.type"


@dataclass(frozen=True)
class Column:
    """How one column of a file becomes a Spark column."""

    name: str
    spark: T.DataType
    arrow: pa.DataType  # what Spark's reader wants for it
    decode: Callable[[pa.Array], pa.Array] = field(repr=False)
    metadata: dict = field(default_factory=dict)

    def struct_field(self) -> T.StructField:
        return T.StructField(self.name, self.spark, True, self.metadata)


def _cast(to: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    return lambda a: a if a.type == to else pc.cast(a, to)


def _ticks(a: pa.Array) -> pa.Array:
    return a.view(pa.int64())


def _scaled(unit: str, to: str, nanos: str, out: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    """Ticks of one unit as ticks of another; a value that doesn't fit, or (unless truncated) would lose digits, is an error."""
    up, down = PER_SECOND[to] // PER_SECOND[unit], PER_SECOND[unit] // PER_SECOND[to]

    def run(a: pa.Array) -> pa.Array:
        x = _ticks(a)
        if up > 1:
            x = pc.multiply_checked(x, up)
        elif down > 1:
            values = x.fill_null(0).to_numpy(zero_copy_only=False)
            whole, rest = np.divmod(values, down)  # rounds down, before 1970 as well
            if nanos == "error" and rest.any():
                raise pa.ArrowInvalid(f"{rest.astype(bool).sum()} values have digits below a microsecond; read with nanos='truncate' or nanos='long'")
            x = pa.array(whole, pa.int64(), mask=x.is_null().to_numpy(zero_copy_only=False))
        return x if out == pa.int64() else x.view(out)

    return run


def _time_ms(a: pa.Array) -> pa.Array:
    """time32 in seconds or milliseconds as whole milliseconds."""
    x = a.view(pa.int32())
    return pc.multiply_checked(x, pa.scalar(1000, pa.int32())) if a.type.unit == "s" else x


def _time_ns(a: pa.Array) -> pa.Array:
    ms = _time_ms(a)
    if len(ms) > ms.null_count and not (pc.min(ms).as_py() >= 0 and pc.max(ms).as_py() < 86_400_000):
        raise pa.ArrowInvalid("a time outside a day; read with time='int_ms'")
    return pc.multiply(pc.cast(ms, pa.int64()), 1_000_000).view(pa.time64("ns"))


def arrow_to_spark(f: pa.Field, *, strict: bool = True, nanos: str = "error", time: str = "time", tz: str = "utc", operation: str = "arrow_read") -> Column:
    """How an Arrow field is read. tz: 'utc' reads zoned timestamps as plain ones in UTC, 'zoned' as Spark timestamps."""
    if nanos not in NANOS or time not in TIMES:
        raise BadArgument(operation, f"nanos is one of {NANOS}, time one of {TIMES}")
    t, name, p = f.type, f.name, pa.types
    told = (f.metadata or {}).get(SPARK_TYPE, b"").decode()

    def column(spark: T.DataType, to: pa.DataType | None = None, decode=None, form: str | None = None) -> Column:
        to = to or t
        return Column(name, spark, to, decode or _cast(to), {"arrow": form} if form else {})

    if told == "tinyint" and p.is_int16(t):
        return column(T.ByteType(), pa.int8())
    if p.is_boolean(t):
        return column(T.BooleanType())
    if p.is_uint8(t):
        return column(T.ShortType(), pa.int16(), form="uint8")
    for check, spark in ((p.is_int16, T.ShortType()), (p.is_int32, T.IntegerType()), (p.is_int64, T.LongType()), (p.is_float32, T.FloatType()), (p.is_float64, T.DoubleType())):
        if check(t):
            return column(spark)
    if p.is_string(t) or p.is_large_string(t):
        return column(T.StringType(), pa.string())
    if p.is_date32(t):
        return column(T.DateType())
    if p.is_time32(t):
        if time == "int_ms":
            return column(T.IntegerType(), pa.int32(), _time_ms, form="time32")
        return column(T.TimeType(3), pa.time64("ns"), _time_ns)
    if p.is_timestamp(t):
        if nanos == "long":
            return column(T.LongType(), pa.int64(), _scaled(t.unit, "ns", nanos, pa.int64()), form="timestamp[ns]")
        zoned = t.tz is not None and (tz == "zoned" or told == "timestamp")
        to = pa.timestamp("us", "UTC" if zoned else None)
        return column(T.TimestampType() if zoned else T.TimestampNTZType(), to, _scaled(t.unit, "us", nanos, to))
    if p.is_duration(t):
        if nanos == "long":
            return column(T.LongType(), pa.int64(), _scaled(t.unit, "ns", nanos, pa.int64()), form="duration[ns]")
        return column(T.DayTimeIntervalType(), pa.duration("us"), _scaled(t.unit, "us", nanos, pa.duration("us")))
    if p.is_dictionary(t):
        if strict and not (p.is_int32(t.index_type) and (p.is_string(t.value_type) or p.is_large_string(t.value_type))):
            raise UnsupportedColumn(operation, f"{name}: {t}")
        inner = arrow_to_spark(pa.field(name, t.value_type), strict=strict, nanos=nanos, time=time, tz=tz, operation=operation)
        return column(inner.spark, inner.arrow, lambda a: inner.decode(a.dictionary_decode()))
    if p.is_list(t) or not strict and (p.is_large_list(t) or p.is_fixed_size_list(t)):
        inner = arrow_to_spark(pa.field("element", t.value_type), strict=strict, nanos=nanos, time=time, tz=tz, operation=operation)
        if strict and not (p.is_primitive(t.value_type)):
            raise UnsupportedColumn(operation, f"{name}: {t}")
        to = pa.list_(inner.arrow)

        def lists(a: pa.Array) -> pa.Array:
            if not p.is_list(a.type):
                a = pc.cast(a, pa.list_(a.type.value_type))
            # the child's slice that this array covers, decoded; offsets begin anew
            offsets = a.offsets.to_numpy()
            child = inner.decode(a.values.slice(offsets[0], offsets[-1] - offsets[0]))
            mask = a.is_null() if a.null_count else None
            return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), child, mask=mask).cast(to)

        return column(T.ArrayType(inner.spark), to, lists)
    if strict:
        raise UnsupportedColumn(operation, f"{name}: {t}")
    wider = {pa.int8(): (T.ByteType(), pa.int8()), pa.uint16(): (T.IntegerType(), pa.int32()), pa.uint32(): (T.LongType(), pa.int64()), pa.uint64(): (T.DecimalType(20, 0), pa.decimal128(20, 0)), pa.float16(): (T.FloatType(), pa.float32()), pa.date64(): (T.DateType(), pa.date32()), pa.string_view(): (T.StringType(), pa.string()), pa.large_binary(): (T.BinaryType(), pa.binary()), pa.null(): (T.NullType(), pa.null())}
    if t in wider:
        return column(*wider[t])
    if p.is_time64(t):
        return column(T.TimeType(6), pa.time64("ns"))
    try:
        spark = from_arrow_type(t)
        return column(spark, to_arrow_type(spark))
    except Exception as e:
        raise UnsupportedColumn(operation, f"{name}: {t}") from e


def spark_to_arrow(f: T.StructField, *, strict: bool = True, operation: str = "arrow_write") -> pa.Field:
    """The Arrow field under which a Spark column is written; always nullable."""
    t, told = f.dataType, None
    plain = {T.BooleanType: pa.bool_(), T.ShortType: pa.int16(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.FloatType: pa.float32(), T.DoubleType: pa.float64(), T.DateType: pa.date32(), T.TimeType: pa.time32("ms"), T.TimestampNTZType: pa.timestamp("ns"), T.DayTimeIntervalType: pa.duration("ns")}
    form = (f.metadata or {}).get("arrow", "")
    if isinstance(t, T.ShortType) and form == "uint8":
        arrow = pa.uint8()
    elif isinstance(t, T.IntegerType) and form == "time32":
        arrow = pa.time32("ms")
    elif isinstance(t, T.LongType) and form == "timestamp[ns]":
        arrow = pa.timestamp("ns")
    elif isinstance(t, T.LongType) and form == "duration[ns]":
        arrow = pa.duration("ns")
    elif isinstance(t, T.ByteType):
        arrow, told = pa.int16(), "tinyint"
    elif isinstance(t, T.TimestampType):
        arrow, told = pa.timestamp("ns", "UTC"), "timestamp"
    elif type(t) is T.StringType:
        arrow = pa.string()
    elif type(t) in plain:
        arrow = plain[type(t)]
    elif strict:
        raise UnsupportedColumn(operation, f"{f.name}: {t.simpleString()}")
    else:
        try:
            arrow = to_arrow_type(t)
        except Exception as e:
            raise UnsupportedColumn(operation, f"{f.name}: {t.simpleString()}") from e
    return pa.field(f.name, arrow, nullable=True, metadata={SPARK_TYPE: told.encode()} if told else None)


def encode(a: pa.Array, to: pa.DataType, operation: str = "arrow_write") -> pa.Array:
    """A column as Spark hands it out, in the type of the file; what the file's type can't hold is an error."""
    if a.type == to:
        return a
    try:
        if pa.types.is_time32(to) and pa.types.is_int32(a.type) or pa.types.is_int64(a.type) and (pa.types.is_timestamp(to) or pa.types.is_duration(to)):
            return a.view(to)
        return pc.cast(a, to)
    except (pa.ArrowException, ValueError) as e:
        raise BatchParseError(operation, str(e)) from e
