"""What the operators share: scratch tables, path of a table, Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import scratch_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/brindle/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value):
    """A broadcast whose value, instances of this package's classes too, opened() gives back in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shared):
    return cloudpickle.loads(shared.value)


def with_columns(batch: pa.RecordBatch, **cols: pa.Array) -> pa.RecordBatch:
    """batch with columns replaced or appended."""
    names = [n for n in batch.schema.names if n not in cols]
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays(arrays + list(cols.values()), names=names + list(cols))


def texts(column: pa.Array, step: int = 256) -> Iterator[list]:
    """Slices of a string column as Python values, few at a time, so that long texts don't add up."""
    for at in range(0, len(column), step):
        yield column.slice(at, step).to_pylist()


def text_keys(text: Column) -> tuple[Column, Column]:
    """128 bits that name a text, as two longs k1 and k2; a null text has its own."""
    return F.xxhash64(F.lit(1), text, text.isNull()).alias("k1"), F.xxhash64(F.lit(2), text, text.isNull()).alias("k2")


def bounded(df: DataFrame, limit: int) -> bool:
    """Whether df has at most limit rows. Meant for written tables, whose rows are counted without reading a column."""
    return df.count() <= limit


SMALL = 1_000_000  # up to so many rows of keys and small values are broadcast
HOT_KEYS = 10_000  # keys that may be hot, at most


def join_unique(left: DataFrame, right: DataFrame, on: list[str], total: int) -> DataFrame:
    """left with right's columns (left join). right, a written table, has one row for each key, and in n the number of left's rows that have it.

    A right of up to SMALL rows is broadcast. Otherwise keys with more than 1 / HOT_KEYS of left's rows
    (total), of which there can't be more than HOT_KEYS, are broadcast, and only the others are shuffled.
    """
    if bounded(right, SMALL):
        return left.join(F.broadcast(right.drop("n")), on, "left")
    limit = total // HOT_KEYS
    hot, rest = right.where(F.col("n") > limit).drop("n"), right.where(F.col("n") <= limit).drop("n")
    hot = F.broadcast(keep(hot, "hot_keys"))
    cold = left.join(hot.select(*on), on, "left_anti")
    return left.join(hot, on).unionByName(cold.join(rest, on, "left"))


class Forest:
    """Union-find over integers, smallest member as root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, a: int) -> int:
        up = self.up
        r = a
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(a, a)) != r:
            up[a] = r
            a = p
        return r

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True

    def stars(self) -> tuple[list[int], list[int]]:
        """Each member that isn't a root, with its root."""
        members = [a for a in self.up if self.up[a] != a]
        return members, [self.root(a) for a in members]


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate(([0], cut))
    return starts, np.diff(np.concatenate((starts, [len(keys)])))


def numbered(docs: DataFrame, *keep_names: str) -> tuple[DataFrame, list]:
    """docs with all columns but those named renamed by position, so that added columns can't clash; and the columns that name them back."""
    to = [n if n in keep_names else f"c{i}_" for i, n in enumerate(docs.columns)]
    return docs.select(*[F.col(f"`{n}`").alias(t) for n, t in zip(docs.columns, to, strict=True)]), [F.col(t).alias(n) for n, t in zip(docs.columns, to, strict=True)]
