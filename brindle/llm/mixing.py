"""1. Mixing sources to target weights, with DataFrame operations only.

Every source gets a share of all words by its weight, at most ``MOST`` times what it has; what a full
source can't use goes to the others by weight. A target of 2.3 times a source takes each of its
documents twice and 0.3 of its words once more. Which documents those are is decided by a hash of the
row: words are summed by source and hash bucket, the running sums give the buckets that fit whole, and
only the bucket on the boundary is looked at again, at a finer grain. Documents below the threshold
are in; nothing is sorted.

Nulls: a null text has no words; null source is a source of its own, last in order. Rows that agree in
all columns used (doc_id, text, source) are numbered, and each number has a hash of its own, so of
equal rows as many are taken as their source needs; which of them is open, as nothing tells them apart.
A source without words has target 0. An empty table gives an empty table. Extra columns are carried
along by ``mix``.

Sources, not documents, pass through one task, to be ranked by name and by how full they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, keep

WEIGHTS = (1, 2, 3)  # by rank of the source's name in code point order, repeating
MOST = 3  # times that a document may be taken
BITS = 10  # of hash that each level of the histogram looks at
LEVELS = 3
SEED = 20_240_601
SOURCES = 200_000  # up to so many rows the table of thresholds is broadcast
REPEATED = 1_000_000  # up to so many hashes of repeated rows are broadcast

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """63 bits, alike on every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 1)


def _repeated(light: DataFrame) -> DataFrame:
    """(source, h) of rows that stand more than once."""
    return keep(light.groupBy("source", "h").agg(F.count("*").alias("n")).where("n > 1").select(F.col("source").alias("again_source"), F.col("h").alias("again_h")), "repeated")


def _of(again: DataFrame):
    few = F.broadcast(again) if bounded(again, REPEATED) else again
    return few, F.col("source").eqNullSafe(F.col("again_source")) & (F.col("h") == F.col("again_h"))


def _own_hashes(rows: DataFrame) -> DataFrame:
    """rows(source, h, part, id, ...), a written table of repeated rows: h of each now depends on its number among its equals.

    Rows are numbered within the partition they were written in, after those of the partitions before, so
    a row that makes up a third of the table is numbered in many tasks.
    """
    key = ("source", "h", "part")
    parts = rows.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.partitionBy("source", "h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("s"), F.col("h").alias("g"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inner = rows.withColumn("number", F.row_number().over(Window.partitionBy(*key).orderBy("id")))
    inner = inner.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("g")) & (F.col("part") == F.col("p")))
    return inner.withColumn("h", F.shiftrightunsigned(F.xxhash64("h", F.col("before") + F.col("number")), 1)).select(*rows.columns)


def _place() -> list[Column]:
    return [F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")]


def _light(docs: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """((names, source, size, h), written, h being each row's own; (source, h) of rows that stand more than once)"""
    light = keep(docs.select(*names, "source", words(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("h"), *_place()), "sizes")
    again = _repeated(light)
    if again.isEmpty():
        return light, again
    few, same = _of(again)
    own = _own_hashes(light.join(few, same, "left_semi"))
    return keep(light.join(few, same, "left_anti").unionAll(own), "own_hashes"), again


def targets(sizes: DataFrame) -> DataFrame:
    """sizes(source, source_size) -> also target: shares by weight, none above MOST times its size.

    One row for each source passes through one sort: source s is full if its limit over its weight is
    below the level at which the unfilled ones share what the full ones leave.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * F.lit(float(MOST)))
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    # the first source that stays below its limit sets the level for all after it
    rows = rows.withColumn("open", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "level"))).over(everything))
    return rows.select("source", "source_size", F.least("most", F.coalesce(F.col("open.level") * F.col("weight"), F.col("most"))).alias("target"))


def thresholds(light: DataFrame) -> DataFrame:
    """light(source, size, h) -> (source, source_size, target, whole, below): take each row `whole` times, and once more if h < below."""
    shift = 63 - BITS
    histogram = keep(light.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size")), "histogram")
    sizes = histogram.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    goal = goal.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("below", F.lit(0).cast("long"))
    goal = keep(goal, "targets")
    few = bounded(goal, SOURCES)
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])

    for level in range(LEVELS):
        running = Window.partitionBy("source").orderBy("bucket")
        inner = histogram.join(small(goal.select(F.col("source").alias("s"), "budget")), F.col("source").eqNullSafe(F.col("s")))
        inner = inner.withColumn("upto", F.sum("size").over(running)).where(F.col("upto") > F.col("budget"))
        edge = inner.groupBy("source").agg(F.min(F.struct("bucket", F.expr("upto - size").alias("used"), "upto", "budget")).alias("edge"))
        at = F.col("edge.bucket")
        if level == LEVELS - 1:  # the last bucket is in if that comes nearer to the target
            at += F.when(F.col("edge.upto") - F.col("edge.budget") < F.col("edge.budget") - F.col("edge.used"), 1).otherwise(0)
        edge = edge.select(F.col("source").alias("s"), at.alias("bucket"), F.col("edge.used").alias("used"))
        # no bucket passes the budget: everything below the end of this level's range is taken
        joined = goal.join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
        top = F.lit((1 << 63) - 1)
        end = top if level == 0 else F.coalesce(F.try_add("below", F.lit(1 << (shift + BITS))), top)
        start = F.when(F.col("bucket") < F.lit(1 << (63 - shift)), F.shiftleft("bucket", shift)).otherwise(top)
        goal = keep(joined.select("source", "source_size", "target", "whole", F.expr("budget - coalesce(used, 0)").alias("budget"), F.when(F.col("bucket").isNull(), end).otherwise(start).alias("below"), F.col("bucket").alias("edge")), f"edge{level}")
        if level == LEVELS - 1:
            break
        # only rows of the boundary bucket are counted again, by the next bits of their hash
        open_ = goal.where("edge is not null").select(F.col("source").alias("s"), F.col("edge").alias("e"))
        deeper = light.join(small(open_), light["source"].eqNullSafe(F.col("s")) & (F.shiftright("h", shift) == F.col("e")))
        shift -= BITS
        histogram = keep(deeper.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size")), f"histogram{level + 1}")
    return goal.select("source", "source_size", "target", "whole", "below")


def _times(df: DataFrame, marks: DataFrame) -> DataFrame:
    marks = marks.withColumnRenamed("source", "mix_source")
    marks = F.broadcast(marks) if bounded(marks, SOURCES) else marks
    return df.join(marks, df["source"].eqNullSafe(F.col("mix_source")), "left").withColumn("times", F.col("whole") + F.when(F.col("mix_hash") < F.col("below"), 1).otherwise(0)).drop("mix_source")


def plan_mix(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken, source, times."""
    light, _ = _light(docs, "doc_id")
    out = _times(light.select("doc_id", "source", "size", F.col("h").alias("mix_hash")), thresholds(light))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).cast("long").alias("taken"), "source", F.col("times").cast("int").alias("times"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken, with docs' columns."""
    names = docs.columns
    light, again = _light(docs)
    marks = thresholds(light)
    inner = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col("source"), row_hash(F.col("doc_id"), F.col("text")).alias("h"))
    if not again.isEmpty():
        few, same = _of(again)
        # repeated rows are numbered anew here: equal numbers have equal hashes, so as many are taken
        own = _own_hashes(keep(inner.join(few, same, "left_semi").select("*", *_place()), "repeated_rows"))
        inner = inner.join(few, same, "left_anti").unionAll(own.select(*inner.columns))
    out = _times(inner.withColumnRenamed("h", "mix_hash"), marks).where("times > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(*[F.col("row").getField(n).alias(n) for n in names])
