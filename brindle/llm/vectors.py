"""8. Embedding near-dedup by sorted projection passes.

Equal vectors become one node with a count. In each pass a vector's key is the concatenation of
``BITS`` random hashes (signs of random projections); the nodes are sorted by key across the cluster,
and each is compared with its next ``WINDOW`` neighbours by cosine in double precision. Near vectors
share long beginnings of some pass's key, so they stand close to each other there. How many passes that
takes grows with the number of vectors (``passes_for``). Each task emits a spanning forest of the pairs
it has verified, and the rows at its two ends, which are compared once more over the tasks' borders; the
forests of all passes are united to components.

Links are then counted exactly within each component, without emitting pairs. A large component is
first seen from its centre: members within half the angle of the threshold are all linked with each
other (angles add up at most), so they are counted, not compared. Only members outside that core are
compared, with all others, in blocks of ``BLOCK``: n of them, of a component that has no core at all, are
dealt out n / BLOCK times.

No link is missed inside a component; a component could fall apart only if no pass brought two of its
halves together. For a pair alone at the threshold that happens with a probability of at most about
1 - ``RECALL``, at any number of vectors, if these spread evenly over the keys; where very many lie
closer together than others, single pairs among them are lost more often. Tests measure recall against
brute force.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing: n_links 0,
component_id their own vec_id. Vectors of different lengths don't link. A null vec_id is no component's
id unless all are null. Repeated rows count as vectors of their own. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Forest, bounded, keep, runs
from .components import components

THRESHOLD = 0.9
PASSES = 16  # at least
RECALL = 0.95  # chance that a pair at the threshold meets in some pass
BITS = 48
WINDOW = 24
CORE = 256  # members above which a component is first seen from its centre
BLOCK = 4096  # members that are compared at once with as many others
CHUNK = 256  # rows of that comparison
CENTRES = 50_000  # up to so many centres of large components are broadcast
SEED = 7


def passes_for(n: int) -> int:
    """Passes after which a pair at the threshold has met with a chance of RECALL, among n vectors.

    About WINDOW of n vectors share log2(n / WINDOW) bits of a key, and two at the threshold share a bit
    with the chance that a random plane doesn't part them.
    """
    together = (1 - np.arccos(THRESHOLD) / np.pi) ** np.log2(max(2, n / WINDOW))
    return max(PASSES, int(np.ceil(np.log(1 - RECALL) / np.log1p(-together))))


def comparable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce((F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) for each length that occurs."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        x = flat[starts[rows][:, None] + np.arange(d)]
        out.append((rows, unit(x)))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares then neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(passes: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            vectors = b.column(1)
            for rows, x in _matrix(vectors):
                d = x.shape[1]
                if d not in planes:
                    planes[d] = np.random.default_rng(SEED + d).standard_normal((d, passes * BITS))
                at = pa.array(rows)
                node, own = b.column(0).take(at), vectors.take(at)
                signs = (x @ planes[d] > 0).reshape(len(rows), passes, BITS)
                for p in range(passes):
                    key = (signs[:, p].astype(np.uint64) * weights).sum(1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), d * passes + p, np.int64)), pa.array(key), node, own], names=["pass", "key", "node", "vector"])

    return run


def _windows(batches):
    """Sorted rows -> a spanning forest of the links between each row and its next WINDOW neighbours, and the first and last WINDOW rows."""
    forest, tail = Forest(), None
    first, last, n_first = [], None, 0
    for b in batches:
        if not b.num_rows:
            continue
        if n_first < WINDOW:
            first.append(pa.Table.from_batches([b.slice(0, WINDOW - n_first)]))
        rest = pa.Table.from_batches([b.slice(max(0, WINDOW - n_first))])
        n_first = min(WINDOW, n_first + b.num_rows)
        last = rest if last is None else pa.concat_tables([last, rest])
        last = last.slice(max(0, len(last) - WINDOW)).combine_chunks()
        group, node = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        for rows, x in _matrix(b.column(3)):
            g, n = group[rows], node[rows]
            if tail is not None and tail[2].shape[1] == x.shape[1]:
                g, n, x = (np.concatenate(p) for p in zip(tail, (g, n, x), strict=True))
            for s in range(1, min(WINDOW, len(g) - 1) + 1):
                good = (np.einsum("ij,ij->i", x[s:], x[:-s]) >= THRESHOLD) & (g[s:] == g[:-s])
                for a, c in zip(n[s:][good].tolist(), n[:-s][good].tolist(), strict=True):
                    forest.join(a, c)
            tail = g[-WINDOW:], n[-WINDOW:], x[-WINDOW:]
    a, c = forest.stars()
    for t in [*first, last] if first else []:
        for b in t.to_batches():
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *b.columns], names=["a", "b", *b.schema.names])
            kinds = b.schema.types
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64()), *[pa.nulls(len(a), k) for k in kinds]], names=["a", "b", "pass", "key", "node", "vector"])


def _links(keyed: DataFrame) -> DataFrame:
    """Links of all passes: within the tasks that sort them, then over their borders, a pass in one task."""
    kind = keyed.schema["vector"].dataType.simpleString()
    shape = f"a long, b long, pass long, key long, node long, vector {kind}"
    order = ("pass", "key", "node")
    got = keep(keyed.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order).mapInArrow(_windows, shape), "vector_links")
    # between two rows at most WINDOW apart none is missing here, as only the middles of the tasks are left out
    edges = got.where("node is not null").select(*order, "vector")
    over = keep(edges.repartition("pass").sortWithinPartitions(*order).mapInArrow(_windows, shape), "vector_borders")
    return got.unionAll(over).where("a is not null").select("a", "b")


def _sums(batches):
    """Sums of unit vectors by root, for a task."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        root = b.column(0).to_numpy(zero_copy_only=False)
        for rows, x in _matrix(b.column(1)) if b.num_rows else []:
            for r in np.unique(root[rows]):
                own = x[root[rows] == r].sum(0)
                sums[r] = sums[r] + own if r in sums else own
    for r, s in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), r)), pa.array(np.arange(len(s)), pa.int32()), pa.array(s)], names=["root", "i", "s"])


def _angles(batches):
    """root, node, vector, copies, centre -> whether the member is outside the core."""
    half = np.arccos(THRESHOLD) / 2 - 1e-6
    for b in batches:
        out = np.zeros(b.num_rows, bool)
        if b.num_rows:
            x, c = _matrix(b.column(2)), dict()
            for rows, m in _matrix(b.column(4)):
                c |= {int(r): v for r, v in zip(rows, m, strict=True)}
            for rows, m in x:
                centre = np.array([c[int(r)] for r in rows])
                out[rows] = np.arccos(np.clip((m * centre).sum(1), -1, 1)) > half
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(out)], names=["root", "node", "vector", "copies", "fringe"])


def _count(batches):
    """Rows of a key stand together: side 0 against side 1 (or side 0 against itself) -> copies linked, by node."""

    def compare(parts):
        node, copies, side = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
        x = np.concatenate([p[3] for p in parts])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right)
        other = left if alone else right
        found = np.zeros(len(node), np.int64)
        for lo in range(0, len(left), CHUNK):
            own = left[lo : lo + CHUNK]
            hit = x[own] @ x[other].T >= THRESHOLD
            if alone:
                hit[np.arange(len(own)), lo + np.arange(len(own))] = False
            found[own] += hit @ copies[other]
            if not alone:
                found[other] += copies[own] @ hit
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(found)], names=["node", "linked"])

    parts, at = [], None
    for b in batches:
        if not b.num_rows:
            continue
        key, node, copies, side = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3))
        (rows, x), *more = _matrix(b.column(4))
        assert len(rows) == b.num_rows or more
        whole = np.zeros((b.num_rows, max([x.shape[1], *(m.shape[1] for _, m in more)])))
        for r, m in [(rows, x), *more]:
            whole[r, : m.shape[1]] = m
        for s, n in zip(*runs(key), strict=True):
            if at is not None and key[s] != at:
                yield compare(parts)
                parts = []
            at = key[s]
            parts.append((node[s : s + n], copies[s : s + n], side[s : s + n], whole[s : s + n]))
    if parts:
        yield compare(parts)


def _linked(members: DataFrame) -> DataFrame:
    """members(root, node, vector, copies) -> (node, linked): copies of other nodes that a node links with, exactly."""
    size = members.groupBy("root").agg(F.count("*").alias("n"))
    large = keep(size.where(F.col("n") > CORE), "large")
    kind = members.schema["vector"].dataType.simpleString()
    small_side = F.broadcast if bounded(large, CENTRES) else (lambda df: df)
    if large.isEmpty():
        marked = members.withColumn("fringe", F.lit(True))
        core = None
    else:
        big = small_side(large.select("root"))
        mine = members.join(big, "root").select("root", "vector")
        sums = mine.mapInArrow(_sums, "root long, i int, s double").groupBy("root", "i").agg(F.sum("s").alias("s"))
        centre = sums.groupBy("root").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda t: t["s"]).alias("centre"))
        seen = members.join(small_side(keep(centre, "centres")), "root").select("root", "node", "vector", "copies", "centre")
        seen = seen.mapInArrow(_angles, f"root long, node long, vector {kind}, copies long, fringe boolean")
        marked = keep(members.join(big, "root", "left_anti").select("root", "node", "vector", "copies", F.lit(True).alias("fringe")).unionAll(seen), "marked")
        core = marked.where("not fringe").groupBy("root").agg(F.sum("copies").alias("core"), F.count("*").alias("n_core"))
    outside = marked.where("fringe").groupBy("root").agg(F.count("*").alias("n_fringe"))
    shape = outside.join(core, "root", "left") if core is not None else outside.withColumn("n_core", F.lit(0))
    blocks = lambda n: F.ceil(F.coalesce(F.col(n), F.lit(0)) / BLOCK).cast("int")
    # only components in more than one block need to be told about it
    shape = keep(shape.select("root", blocks("n_fringe").alias("fb"), blocks("n_core").alias("cb")).where("fb + cb > 1"), "shape")
    rows = marked.join(small_side(shape) if bounded(shape, CENTRES) else shape, "root", "left").withColumns({"fb": F.coalesce("fb", F.when(F.col("fringe"), 1).otherwise(0)), "cb": F.coalesce("cb", F.lit(0))})
    own = F.when(F.col("fringe"), F.pmod(F.xxhash64("node"), F.greatest("fb", F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), F.greatest("cb", F.lit(1)))).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    spot = lambda a, kind, b, side: F.struct(a.cast("int").alias("i"), F.lit(kind).alias("with"), b.cast("int").alias("j"), F.lit(side).alias("side"))
    fringe = F.concat(
        F.transform(upto("fb"), lambda j: F.when(j == own, spot(own, 0, own, 0)).when(own < j, spot(own, 0, j, 0)).otherwise(spot(j, 0, own, 1))),
        F.transform(upto("cb"), lambda j: spot(own, 1, j, 0)),
    )
    inner = F.transform(upto("fb"), lambda i: spot(i, 1, own, 1))
    rows = rows.withColumn("at", F.explode(F.when(F.col("fringe"), fringe).otherwise(inner)))
    rows = rows.select(F.xxhash64("root", "at.i", "at.with", "at.j").alias("key"), "node", "copies", F.col("at.side").alias("side"), "vector")
    counted = rows.repartition("key").sortWithinPartitions("key", "side").mapInArrow(_count, "node long, linked long")
    if core is not None:
        inside = marked.where("not fringe").join(small_side(core) if bounded(core, CENTRES) else core, "root").select("node", (F.col("core") - F.col("copies")).alias("linked"))
        counted = counted.unionAll(inside)
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def near_vectors(rows: DataFrame, passes: int | None = None) -> DataFrame:
    """rows(vec_id, embedding) -> vec_id, n_links, component_id, kept."""
    keys = (F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(11), "embedding").alias("k2"))
    good = comparable(F.col("embedding"))
    nodes = rows.where(good).groupBy(F.col("embedding").alias("vector")).agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    nodes = keep(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    kind = nodes.schema["vector"].dataType.simpleString()
    passes = passes or passes_for(nodes.count())
    keyed = nodes.select("node", "vector").mapInArrow(_keys(passes), f"pass long, key long, node long, vector {kind}")
    found = components(_links(keyed))
    roots = found.select("node", "root")
    members = keep(nodes.join(roots, "node").select("root", "node", "vector", "copies", "id"), "members")
    linked = _linked(members.select("root", "node", "vector", "copies"))
    ids = members.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = members.select("node", "root").join(ids, "root").join(linked, "node", "left").select("node", "component_id", "linked")
    # vectors that stand for themselves alone need no row
    told = nodes.where("copies > 1").select("node").union(members.select("node")).distinct()
    facts = nodes.join(told, "node").join(classes, "node", "left")
    facts = keep(facts.select(F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(11), "vector").alias("k2"), F.coalesce("component_id", "id").alias("component"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n")), "facts")
    each = rows.select("vec_id", *(F.when(good, k).alias(n) for k, n in zip(keys, ("k1", "k2"), strict=True)))
    out = each.join(facts, ["k1", "k2"], "left").select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
