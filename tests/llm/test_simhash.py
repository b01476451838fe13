import random

import numpy as np
import pytest
import xxhash

from brindle.llm import simhash as S
from brindle.llm.common import Forest
from brindle.llm.components import components


def _brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    n = min(3, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _brute(rows):
    """(doc_id, fingerprint, smallest doc_id reachable) of (doc_id, fp)."""
    f, n = Forest(), len(rows)
    fps = np.array([x for _, x in rows], np.uint64)
    for i in range(n):
        f.join(i, i)
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[i + 1 :]) <= 3):
            f.join(i, i + 1 + int(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        r = f.root(i)
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
    return sorted(((d, f"{x:016x}", least.get(f.root(i))) for i, (d, x) in enumerate(rows)), key=repr)


def test_fingerprints_and_components(spark, docs):
    rows = [(r.doc_id, _brute_fp(r.text)) for r in docs.collect()]
    assert sorted(map(tuple, S.op6(docs).collect()), key=repr) == _brute(rows)


@pytest.fixture(scope="module")
def cloud():
    """Random fingerprints, chains of near ones, and a dense group that shares most bits."""
    rng = random.Random(9)
    out = {rng.getrandbits(64) for _ in range(1500)}
    for start in rng.sample(sorted(out), 60):
        for _ in range(rng.randint(1, 6)):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                start ^= 1 << b
            out.add(start)
    base = rng.getrandbits(64)
    loose = rng.sample(range(64), 16)
    for _ in range(900):
        x = base
        for b in rng.sample(loose, rng.randint(0, 16)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("hot", [4096, 60])
def test_links_against_all_pairs(spark, cloud, hot, monkeypatch):
    monkeypatch.setattr(S, "HOT", hot)  # 60: hot values go through further levels
    got = {r.node: r.root for r in components(S.links(S.signed(spark, cloud))).collect()}
    ids = {x: x - (1 << 64) if x >> 63 else x for x in cloud}
    want = _brute([(i, x) for i, x in enumerate(cloud)])
    mine = {}
    for i, x in enumerate(cloud):
        mine.setdefault(got.get(ids[x], ids[x]), []).append(i)
    least = {i: min(g) for g in mine.values() for i in g}
    assert sorted(((i, f"{x:016x}", least[i]) for i, x in enumerate(cloud)), key=repr) == want


def test_thresholds_meet_the_pigeonhole(spark, cloud):
    used = S.plan(S.signed(spark, cloud))
    assert sum(bin(m).count("1") for m, _ in used) <= 64 and all(a & b == 0 for i, (a, _) in enumerate(used) for b, _ in used[i + 1 :])
    cost, ts = S.allocate([{-1: 0.0, 0: 1.0, 1: 5.0}, {-1: 0.0, 0: 9.0, 1: 90.0}, {-1: 0.0, 0: 1.0, 1: 2.0}], 1)
    assert sum(ts) == 1 and ts == [1, -1, 1] and cost == 7.0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(500)] + [(5, 5), (2000, 2001), (2000, 2001), (2001, 2000)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(500)} | {2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset([()])


def _near_groups(rows):
    """Groups of places of rows (doc_id, text, ...) by similarity of sets, all pairs."""
    f, sets = Forest(), [_shingles(r[1]) for r in rows]
    by = {}
    for i, s in enumerate(sets):
        f.join(i, by.setdefault(s, i))
    own = sorted(by.items(), key=lambda x: len(x[0]))
    for i, (a, x) in enumerate(own):
        for b, y in own[i + 1 :]:
            if len(a) < 0.8 * len(b):
                break
            both = len(a & b)
            if both >= 0.8 * (len(a) + len(b) - both):
                f.join(x, y)
    out = {}
    for i in range(len(rows)):
        out.setdefault(f.root(i), []).append(i)
    return list(out.values())


def _survivors(rows):
    """(doc_id, texts it may have) of the row of each group."""
    out = []
    for g in _near_groups(rows):
        least = min((rows[i][0] is None, rows[i][0] or 0) for i in g)
        out.append((None if least[0] else least[1], {rows[i][1] for i in g if (rows[i][0] is None, rows[i][0] or 0) == least}))
    return out


def _same(got, want):
    """Every row that stayed belongs to one of the wanted ones, one to one."""
    want = sorted(want, key=lambda x: (len(x[1]), repr(x)))
    got = list(got)
    for d, texts in want:
        at = [i for i, (e, t) in enumerate(got) if e == d and t in texts]
        assert at, (d, texts)
        got.pop(at[0])
    assert not got


def test_dedup_against_all_pairs(docs, clashing, empty):
    out = S.dedup(clashing)
    assert out.columns == clashing.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _same([(r.doc_id, r.text) for r in out.collect()], _survivors(rows))
    assert S.op6(empty).count() == 0 and S.dedup(empty).count() == 0


def test_dedup_loses_no_document_under_a_repeated_or_missing_doc_id(spark):
    one, two, three, four = (" ".join(f"{w}{i}" for i in range(60)) for w in "abcd")
    near = one.replace("a30", "x")
    rows = [(5, one), (5, two), (7, one), (5, two), (2, two), (3, three), (None, one), (None, four), (None, four), (None, three.upper()), (8, near), (9, None), (9, ""), (10, " ")]
    got = [(r.doc_id, r.text) for r in S.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert len(got) == 5
    _same(got, [(5, {one}), (2, {two}), (3, {three}), (None, {four}), (9, {None, ""})])


def test_dedup_of_rows_alike_but_for_other_columns(spark):
    df = spark.createDataFrame([(1, "a b c", x) for x in ("u", "v", "w", "v")], "doc_id long, text string, source string")
    a, b = (S.dedup(d).collect() for d in (df, df.repartition(4)))
    assert len(a) == 1 and a == b


@pytest.mark.parametrize("block,centres", [(2048, 2000), (16, 2000), (16, 0)])
def test_verified_links_against_all_pairs(spark, monkeypatch, block, centres):
    """Sets around several centres, chains of them, and strangers, under one root each."""
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "CENTRES", centres)
    rng, rows = random.Random(6), []
    for root in range(3):
        for _ in range(3):
            base = rng.sample(range(10**6), 100)
            for _ in range(25):
                base = base if rng.random() < 0.7 else [x if rng.random() > 0.08 else rng.randrange(10**6) for x in base]
                rows.append((root, len(rows), sorted({x if rng.random() > 0.05 else rng.randrange(10**6) for x in base})))
    rows.append((9, len(rows), [1, 2]))
    got = {r.node: r.root for r in components(S.verified(spark.createDataFrame(rows, "root long, node long, words array<long>"))).collect()}
    f = Forest()
    for i, (r, a, x) in enumerate(rows):
        for q, b, y in rows[:i]:
            both = len(set(x) & set(y))
            if r == q and both >= 0.8 * (len(x) + len(y) - both):
                f.join(a, b)
    want = {n: f.root(n) for _, n, _ in rows}
    assert {n: got.get(n, n) for n in want} == want and len(set(want.values())) > 6


def test_recall_of_near_copies(spark):
    """Texts at a similarity just above 0.8, the hardest ones, of various lengths."""
    rng = random.Random(12)
    words = [f"w{rng.randrange(10**7)}" for _ in range(5000)]
    weights = [1 / (i + 3) for i in range(5000)]  # as words of a language go
    rows = []
    for i in range(250):
        n = rng.choice([60, 120, 300, 900])
        base = rng.choices(words, weights, k=n)
        other = list(base)
        for at in rng.sample(range(n), max(1, n // 47)):
            other[at] = rng.choice(words)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    want = len(_near_groups(rows))
    assert want < 320
    got = S.dedup(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert 500 - got >= 0.9 * (500 - want)
