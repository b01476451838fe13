"""The two forms of nulls, as DataFrame expressions.

``compat`` gives what a round trip through in-band nulls gives: null strings are empty, null booleans
false, null unsigned bytes 0, null lists empty; the least integer of a width and NaN are null.
``native`` leaves Spark's nulls and NaN as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("compat", "native")
#: fixed values: the integers that stand for null in band
LEAST = {T.ShortType: -(2**15), T.IntegerType: -(2**31), T.LongType: -(2**63)}


def on_read(f: T.StructField) -> Column | None:
    """The column in compat form, or None if it is that already."""
    c, t = F.col(f"`{f.name.replace('`', '``')}`"), f.dataType
    if isinstance(t, T.StringType):
        return F.coalesce(c, F.lit(""))
    if isinstance(t, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(t, T.ArrayType):
        return F.coalesce(c, F.array().cast(t))
    form = (f.metadata or {}).get("arrow")
    if form == "uint8":
        return F.coalesce(c, F.lit(0).cast("short"))
    return on_write(f)


def on_write(f: T.StructField) -> Column | None:
    """NaN and the least integer as nulls, or None where there is neither."""
    c, t = F.col(f"`{f.name.replace('`', '``')}`"), f.dataType
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    if type(t) in LEAST and (f.metadata or {}).get("arrow") != "uint8":
        return F.nullif(c, F.lit(LEAST[type(t)]).cast(t))
    return None


def apply(df: DataFrame, rule) -> DataFrame:
    """df with a rule's columns in place; columns that need nothing are passed as they are, and all keep their metadata."""
    made = {f.name: rule(f) for f in df.schema}
    if not any(c is not None for c in made.values()):
        return df
    return df.select(*[F.col(f"`{f.name.replace('`', '``')}`") if made[f.name] is None else made[f.name].alias(f.name, metadata=f.metadata or {}) for f in df.schema])
