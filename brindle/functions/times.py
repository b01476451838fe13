"""Microseconds of plain timestamps, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def micros_of(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    past = ts - _epoch()
    whole = (F.extract(F.lit("DAY"), past) * 24 + F.extract(F.lit("HOUR"), past)) * 60 + F.extract(F.lit("MINUTE"), past)
    return whole.cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), past) * 1_000_000).cast("long")


def ntz_of_micros(n: Column) -> Column:
    """The timestamp without zone of so many microseconds since 1970."""
    return _epoch() + F.make_dt_interval(secs=(n.cast("decimal(38,6)") / 1_000_000).cast("decimal(18,6)"))
