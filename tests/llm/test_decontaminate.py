import hashlib
import re

from brindle.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def _words(t):
    return WORD.findall((t or "").translate(LOW))


def _brute(docs, items):
    windows = {}
    for item, t in items:
        w = _words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for d, t in docs:
        w, hit, named = _words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    named |= windows[k]
        ids = sorted(str(x) for x in named if x is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def _case(spark, docs, tables):
    base = [(r.item_id, r.text) for r in tables("benchmark").collect()]
    long = " ".join(f"u{i}" for i in range(30))
    items = base + [(500, "Short item"), (501, None), (502, "..."), (None, "nameless item of some words that stands in a text ok"), (503, long), (503, long), (504, long), (505, "one"), (506, " ".join(["ha"] * 14))]
    own = [(r.doc_id, r.text) for r in docs.collect()]
    own += [(8000, f"xx {long} yy {base[0][1]}"), (8001, "SHORT-item!short item"), (8002, "nameless item of some words that stands in a text ok"), (8003, " ".join(f"u{i}" for i in range(3, 13))), (8004, "ha " * 40), (8005, " ".join(f"u{i}" for i in range(21, 30))), (8006, "one"), (8006, "one")]
    return own, items


def test_against_brute_force(spark, docs, tables):
    own, items = _case(spark, docs, tables)
    df, bench = spark.createDataFrame(own, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = _brute(own, items)
    assert sorted(map(tuple, D.op5(df, bench).collect()), key=repr) == want
    assert any(w[5] for w in want) and not all(w[5] for w in want)


def test_by_joins_against_a_block(spark, docs, tables, monkeypatch):
    """Beyond a block's windows joins on the prefix find the same, also with a bitmap that lets much pass."""
    own, items = _case(spark, docs, tables)
    df, bench = spark.createDataFrame(own, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    kinds = lambda rows: sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), tuple(r.spans)) for r in rows), key=repr)
    want = kinds(D.decontaminate(df, bench).collect())
    monkeypatch.setattr(D, "BLOCK_BYTES", 1000)
    assert kinds(D.decontaminate(df, bench).collect()) == want and any(w[2] for w in want)
    monkeypatch.setattr(D, "MOST_BITS", 10)
    assert kinds(D.decontaminate(df.select("text", "doc_id"), bench, block_windows=40).collect()) == want


def test_rarest_shingle_is_the_prefix():
    b = D.Block([(1, D.split_words("a b c d e f g h i j"))])
    import numpy as np

    counts = {5: np.zeros(len(b.keys[5]), int)}
    h = D._chain(b.ids(D.split_words("a b c d e f g h i j")), 5)
    for k, n in zip(h, (9, 9, 9, 1, 9, 9), strict=True):
        counts[5][np.searchsorted(b.keys[5], k)] = n
    b.order(counts)
    assert list(b.prefix[5].values()) == [[(0, 3)]] and b.hits(D.split_words("x a b c d e f g h i j")) == [(1, 0)]


def test_clean_and_empty(docs, clashing, tables, empty):
    bench = tables("benchmark")
    bad = {r.doc_id for r in D.op5(docs, bench).where("contaminated").collect()}
    kept = D.clean(clashing, bench)
    assert bad and kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad
    assert D.op5(empty, bench).count() == 0
    assert D.op5(docs, bench.where("false")).where("contaminated").count() == 0 and D.clean(docs, bench.where("false")).count() == docs.count()
