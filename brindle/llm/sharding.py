"""4. Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups are equal texts. A group above a grain (``GRAINS`` to a shard, in bytes or in rows) is an item of
its own. All others are sorted into size classes, ``STEPS`` to a doubling, and a class is cut by a hash
of the text into bundles of about a grain, so at most GRAINS + 64 * STEPS bundles for each shard reach the
driver, whatever the table's size. Items are packed in the order of their groups' sizes, largest first,
each into the bin with the least room that still holds it; the bins' room is kept in a balanced search
tree (a treap), and the capacity is the smallest, found by bisection, for which the bins suffice. A group
larger than a shard's even share can't be indivisible; it alone is cut into pieces.

Inside a shard rows are numbered cell by cell, in parallel. A large group has many cells, dealt by a
hash of doc_id, so a text that a third of the rows share is no hot key. Where rows agree in doc_id as
well, or have none, a cell stays large all the same: its rows are numbered in the partitions they are
written in, and the numbers cut it into pieces.

Nulls: null text is a group of its own, with 0 bytes (size 1, crc 0); null doc_id is a value like any
other. Repeated rows each get a slot. An empty table gives an empty table. Extra columns pass through
``shard``; its new columns replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL, bounded, keep, numbered, text_keys

SHARDS = 16
GRAINS = 256  # of a shard's even share
STEPS = 8  # size classes to a doubling of the size


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


class Rooms:
    """A treap of (room left, bin): least room that holds a size, in logarithmic time."""

    def __init__(self):
        self.root = None  # (key, priority, left, right)

    def _split(self, t, key):
        if t is None:
            return None, None
        if t[0] < key:
            low, high = self._split(t[3], key)
            return (t[0], t[1], t[2], low), high
        low, high = self._split(t[2], key)
        return low, (t[0], t[1], high, t[3])

    def _merge(self, low, high):
        if low is None or high is None:
            return high if low is None else low
        if low[1] > high[1]:
            return low[0], low[1], low[2], self._merge(low[3], high)
        return high[0], high[1], self._merge(low, high[2]), high[3]

    def add(self, room: int, to: int) -> None:
        key = (room, to)
        low, high = self._split(self.root, key)
        priority = (room * 0x9E3779B97F4A7C15 + to * 0xD6E8FEB86659FD93) * 0xFF51AFD7ED558CCD >> 32 & 0xFFFFFFFF
        self.root = self._merge(self._merge(low, (key, priority, None, None)), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the tightest that holds size."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            return None
        first, path = high, []
        while first[2] is not None:
            path.append(first)
            first = first[2]
        rest = first[3]
        for t in reversed(path):
            rest = (t[0], t[1], rest, t[3])
        self.root = self._merge(low, rest)
        return first[0]


def best_fit(items: Iterable[tuple[int, int]], capacity: int, most: int | None = None) -> dict[int, int] | None:
    """items (size, id), in the order they are to be packed -> id: bin by best fit; None if `most` bins don't suffice."""
    rooms, opened, where = Rooms(), 0, {}
    for size, item in items:
        found = rooms.take(size)
        if found is None:
            if most is not None and opened == most or size > capacity:
                return None
            found = capacity, opened
            opened += 1
        where[item] = found[1]
        rooms.add(found[0] - size, found[1])
    return where


def pack(items: list[tuple[int, int]], bins: int) -> dict[int, int]:
    """items in packing order into `bins` bins of about the smallest capacity (to a millionth) for which best fit suffices."""
    total, largest = sum(x[0] for x in items), max((x[0] for x in items), default=0)
    low = max(-(-total // bins), largest)
    step = least = max(1, low // 1_000_000)
    high = low
    while (best := best_fit(items, high, bins)) is None:
        low, high, step = high + 1, high + step, step * 4
    while high - low > least:
        mid = (low + high) // 2
        found = best_fit(items, mid, bins)
        if found is None:
            low = mid + 1
        else:
            high, best = mid, found
    return best


def size_class(size: Column) -> Column:
    return F.floor(F.log2(size.cast("double")) * STEPS).cast("int")


def _numbers(rows: DataFrame) -> DataFrame:
    """rows(cell, part, id, ...), a written table -> also number, from 0 in each cell: counted in the partition a row was written in, after those before."""
    parts = rows.groupBy("cell", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("cell").alias("in_cell"), F.col("part").alias("in_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("cell", "part").orderBy("id"))
    inner = rows.withColumn("own", own).join(parts, (F.col("cell") == F.col("in_cell")) & (F.col("part") == F.col("in_part")))
    return inner.withColumn("number", F.col("before") + F.col("own") - 1).drop("own", "in_cell", "in_part", "before")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs with size, text_crc32, shard and slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    inner, back = numbered(docs, "doc_id", "text")
    back = [c for n, c in zip(docs.columns, back, strict=True) if n not in ("size", "text_crc32", "shard", "slot")]
    key = ["k1", "k2"]
    rows = keep(docs.select("doc_id", size_of(F.col("text")).alias("size"), *text_keys(F.col("text"))), "sizes")
    total, count = (x or 0 for x in rows.agg(F.sum("size"), F.count("*")).first())
    grain, row_grain = max(1, total // (GRAINS * shards)), max(1, count // (GRAINS * shards))
    groups = keep(rows.groupBy(*key).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).withColumn("class", size_class(F.col("bytes"))), "groups")
    is_large = (F.col("bytes") > grain) | (F.col("n") > row_grain)
    # how each class of small groups is cut: about a grain to a bundle
    classes, base = [], 0
    for r in sorted(groups.where(~is_large).groupBy("class").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect(), key=lambda r: -r["class"]):
        n = max(-(-r["bytes"] // grain), -(-r["n"] // row_grain))
        classes.append((r["class"], base, n))
        base += n
    order = {c: k for k, b, n in classes for c in range(b, b + n)}
    parts = []
    for r in sorted(groups.where(is_large).collect(), key=lambda r: (-r["bytes"], r["k1"], r["k2"])):  # at most 2 * GRAINS * shards
        n = max(1, min(r["n"], max(-(-r["bytes"] // (4 * grain)), -(-r["n"] // (4 * row_grain)))))
        parts.append((r["k1"], r["k2"], base, n))
        base += n
    small = F.broadcast(spark.createDataFrame(classes or [(0, 0, 1)], "class int, class_base long, bundles long"))
    big = F.broadcast(spark.createDataFrame(parts or [(0, 0, 0, 0)], "k1 long, k2 long, big_base long, cells long").where("cells > 0"))
    again = keep(groups.where((F.col("n") > 1) & ~is_large).select(*key, F.col("class").alias("group_class")), "repeated")
    again = F.broadcast(again) if bounded(again, SMALL) else again

    def with_cell(df: DataFrame) -> DataFrame:
        """Of a large group, rows go to its cells by doc_id; any other group goes to a bundle of its class by its key."""
        df = df.join(big, key, "left").join(again, key, "left").withColumn("class", F.coalesce("group_class", size_class(F.col("size"))))
        df = df.join(small, "class", "left")
        of_large = F.col("big_base") + F.pmod(F.xxhash64("doc_id"), F.col("cells"))
        of_small = F.col("class_base") + F.pmod(F.xxhash64(F.lit(3), "k1"), F.col("bundles"))
        return df.withColumn("cell", F.coalesce(of_large, of_small)).drop("big_base", "cells", "group_class", "class", "class_base", "bundles")

    cells = {r["cell"]: (r["bytes"], r["n"]) for r in with_cell(rows).groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    whole = -(-total // shards)
    pieces: dict[int, list[tuple[int, int]]] = {}  # of each cell: (bytes, rows)
    steps = []
    for c, (own, n) in cells.items():
        pieces[c] = [(own, n)]
        if c not in order and n > 1 and max(own / grain, n / row_grain) > 16:  # all of one text and size
            step = max(1, min(4 * row_grain, 4 * grain // (own // n)))
            pieces[c] = [(own // n * k, k) for k in (min(step, n - lo) for lo in range(0, n, step))]
            steps.append((c, step))
    items, members = [], []
    for _, _, at, n in parts:
        own = [(c, i) for c in range(at, at + n) if c in cells for i in range(len(pieces[c]))]
        sums = [pieces[c][i][0] for c, i in own]
        # larger than a shard: its pieces are packed one by one
        for members_, size in [(own, sum(sums))] if sum(sums) <= whole else [([m], s) for m, s in zip(own, sums, strict=True)]:
            items.append((size, sum(sums), len(members)))
            members.append(members_)
    for c in sorted(c for c in cells if c in order):
        items.append((cells[c][0], 2 ** ((order[c] + 1) / STEPS), len(members)))
        members.append([(c, 0)])
    where = pack([(size, i) for size, _, i in sorted(items, key=lambda x: (-x[1], -x[0], x[2]))], shards)
    upto, places = [0] * shards, []
    for i, own in enumerate(members):
        for c, j in own:
            places.append((c, j, where[i], upto[where[i]]))
            upto[where[i]] += pieces[c][j][1]
    places = F.broadcast(spark.createDataFrame(places or [(0, 0, 0, 0)], "cell long, piece long, shard int, base_slot long"))
    out = with_cell(inner.select("*", size_of(F.col("text")).alias("size"), F.coalesce(F.crc32("text"), F.lit(0)).alias("text_crc32"), *text_keys(F.col("text"))))
    hot = F.broadcast(spark.createDataFrame(steps or [(0, 0)], "cell long, step long").where("step > 0"))
    own = Window.partitionBy("cell").orderBy("doc_id", "size", "text_crc32")
    plain = out.join(hot, "cell", "left_anti") if steps else out
    plain = plain.join(places.where("piece = 0").drop("piece"), "cell").withColumn("slot", F.col("base_slot") + F.row_number().over(own) - 1)
    last = [*back, "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")]
    if not steps:
        return plain.select(*last)
    rest = keep(out.join(hot, "cell").withColumns({"part": F.spark_partition_id(), "id": F.monotonically_increasing_id()}), "hot_cells")
    rest = _numbers(rest).withColumn("piece", F.floor(F.col("number") / F.col("step"))).join(places, ["cell", "piece"])
    return plain.select(*last).unionAll(rest.withColumn("slot", F.col("base_slot") + F.col("number") % F.col("step")).select(*last))


def op4(docs: DataFrame) -> DataFrame:
    out = shard(docs.select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
