import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import vectors as V
from brindle.llm.common import Forest

SCHEMA = "vec_id long, embedding array<float>"


def _unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _brute(rows):
    x = [np.array(v, np.float32).astype(np.float64) if v and None not in v else None for _, v in rows]
    ok = [i for i, v in enumerate(x) if v is not None and np.isfinite(v).all() and v.any()]
    f, n = Forest(), [0] * len(rows)
    for i in ok:
        for j in ok:
            if i < j and len(x[i]) == len(x[j]) and _unit(x[i]) @ _unit(x[j]) >= V.THRESHOLD:
                n[i] += 1
                n[j] += 1
                f.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = f.root(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return sorted(((d, n[i], least[f.root(i)], d == least[f.root(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def _rows(rng, groups, alone, d=24):
    out = []
    for size, spread in groups:
        centre = _unit(rng.standard_normal(d))
        out += [_unit(centre + spread * rng.standard_normal(d) / np.sqrt(d)) * rng.uniform(0.1, 9) for _ in range(size)]
    out += list(rng.standard_normal((alone, d)))
    return [np.float32(v).tolist() for v in out]


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vs = _rows(rng, [(5, 0.2), (40, 0.25), (2, 0.1)], 150)
    vs += [vs[0]] * 4 + [None, [], [0.0] * 24, [1.0] + [None] * 23, [float("nan")] * 24, [float("inf")] * 24, [1e-30] * 24, [2e-30] * 24, [3e30] * 24, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v) for i, v in enumerate(vs)] + [(None, vs[3]), (7, vs[7])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, V.near_vectors(df).collect()), key=repr) == _brute(rows)


@pytest.mark.parametrize("spread", [0.2, 0.48])
def test_large_groups_by_their_core(spark, monkeypatch, spread):
    """More members than a block: the core is counted, the fringe compared."""
    monkeypatch.setattr(V, "BLOCK", 32)
    monkeypatch.setattr(V, "CORE", 32)
    rng = np.random.default_rng(2)
    rows = list(enumerate(_rows(rng, [(150, spread), (70, 0.3)], 60)))
    got = sorted(map(tuple, V.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = _brute(rows)
    assert sum(w[1] for w in want) > 3000
    assert got == want


def test_recall_at_the_threshold(spark):
    """Pairs just above cosine 0.9, the hardest ones, among other vectors."""
    rng = np.random.default_rng(3)
    d, pairs = 64, 150
    a = _unit(rng.standard_normal((pairs, d)))
    o = rng.standard_normal((pairs, d))
    o = _unit(o - (o * a).sum(1, keepdims=True) * a)
    cos = rng.uniform(0.905, 0.95, (pairs, 1))
    b = cos * a + np.sqrt(1 - cos**2) * o
    vs = np.concatenate([a, b, rng.standard_normal((3000, d))]).astype(np.float32)
    got = {r.vec_id: r.n_links for r in V.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vs)], SCHEMA)).collect()}
    assert sum(got[i] >= 1 for i in range(pairs)) / pairs >= 0.9


def test_empty_and_doubles(spark):
    assert V.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1e-3])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in V.near_vectors(df).orderBy("vec_id").collect()] == [(1, 1, 1, True), (2, 1, 1, False)]
    assert V.near_vectors(df.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"))).where("n_links = 0 and kept").count() == 2


@pytest.mark.parametrize("n", [100, 3_300, 100_000, 1_000_000, 100_000_000, 10**10])
def test_passes_grow_with_the_vectors(n):
    bit = 1 - np.arccos(V.THRESHOLD) / np.pi
    missed = (1 - bit ** max(1.0, np.log2(n / V.WINDOW))) ** V.passes_for(n)
    assert V.passes_for(n) >= V.PASSES and missed <= 1 - V.RECALL + 1e-9


def test_windows_go_over_the_borders_of_tasks(spark):
    """One group, sorted once, over several tasks."""
    rows = list(enumerate(_rows(np.random.default_rng(4), [(300, 0.2)], 0)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = V.near_vectors(spark.createDataFrame(rows, SCHEMA), passes=1).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.component_id for r in got} == {0}
