import math
import random
from collections import Counter, defaultdict

import pytest

from brindle.llm import quality as Q


def _symbols(text):
    """Every character as one letter of its own, or as two."""
    out = ""
    for c in text:
        n = ord(c)
        out += c if n < Q.PLAIN else chr(0x100000 + (n >> 10)) + chr(0x100800 + (n & 1023))
    return out


def _kn(train, order=5, vocabulary=Q.VOCABULARY):
    """Probability of a symbol after a context, straight from the definition."""
    pad, train = "\x01" * (order - 1), [_symbols(t) for t in train]
    c = {order: Counter((pad + t)[i : i + order] for t in train for i in range(len(t)))}
    for k in range(order - 1, 0, -1):
        c[k] = Counter(g[1:] for g in c[k + 1])
    disc, ctx = {}, {}
    for k, t in c.items():
        n = Counter(t.values())
        n1, n2, n3, n4 = (n[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        disc[k] = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
        ctx[k] = defaultdict(list)
        for g, v in t.items():
            ctx[k][g[:-1]].append(v)
    cut = lambda k, v: disc[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / vocabulary
        q, own = p(g[1:]), ctx[k].get(g[:-1])
        if not own:
            return q
        v = c[k].get(g, 0)
        return (v - cut(k, v) if v else 0) / sum(own) + sum(cut(k, x) for x in own) / sum(own) * q

    return lambda text: math.exp(-sum(math.log(p((pad + _symbols(text))[i : i + order])) for i in range(len(_symbols(text)))) / len(text))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    syllables = ["an", "er", "th", "on", "re", "ti", "é", "日"]
    make = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 40)))
    rows = [(i, make(), "en" if i % 2 else "fr") for i in range(300)] + [(300 + i, make().upper() + "!! $$$", "en") for i in range(20)]
    labels = [(i, 1, 0) for i in range(200)] + [(300 + i, 0, 0) for i in range(20)]
    return rows, labels, spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("head", [Q.HEAD, 60, 0])
def test_perplexity_against_the_definition(corpus, monkeypatch, head):
    """All grams broadcast, some (what each document has of over a thousand others is joined), or none."""
    monkeypatch.setattr(Q, "HEAD", head)
    rows, labels, docs, marks = corpus
    got = {r.doc_id: r for r in Q.perplexities(docs, marks).collect()}
    assert 20 < sum(r.aside for r in got.values()) < 80
    want = _kn([t for i, t, _ in rows if i < 200 and not got[i].aside])
    for i, t, _ in rows:
        assert got[i].perplexity == pytest.approx(want(t), rel=1e-4) and got[i].size == len(t) and got[i].trusted == (i < 200) and (i < 200 or not got[i].aside)


def test_no_two_characters_are_mistaken():
    import numpy as np

    for c in (np.arange(0x4E00, 0x4E00 + 3000), np.arange(0, 0x110000, 7)):
        out, size = Q.symbols(c.astype(np.int64))
        assert out.min() >= 0 and out.max() < Q.VOCABULARY
        at = np.cumsum(size) - size
        assert len({tuple(out[a : a + n].tolist()) for a, n in zip(at.tolist(), size.tolist(), strict=True)}) == len(c)


def test_characters_of_chinese_count_one_by_one(spark):
    """Trained on some characters, the model tells them from others of the same script."""
    rng = random.Random(2)
    known, others = ([chr(n) for n in rng.sample(range(0x4E00, 0x9000), 300)] for _ in range(2))
    make = lambda pool: "".join(rng.choice(pool) for _ in range(80))
    rows = [(i, make(known), "zh") for i in range(200)] + [(1000 + i, make(others), "zh") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.perplexity for r in Q.perplexities(docs, marks).collect()}
    assert max(got[i] for i in range(200)) < min(got[1000 + i] for i in range(20))


def test_junk_goes_and_clean_stays(corpus):
    _, _, docs, marks = corpus
    got = {r.doc_id: r.kept for r in Q.op9(docs, marks).collect()}
    assert not any(got[300 + i] for i in range(20)) and sum(got[i] for i in range(300)) / 300 > 0.9


def test_odd_rows_empty_and_untrusted(docs, tables, empty):
    marks = tables("labels")
    own = docs.select("doc_id", "lang", "text")
    out = Q.op9(own, marks).collect()
    assert len(out) == docs.count() and all(r.kept is not None and (r.perplexity is None) == (r.size == 0) for r in out)
    assert Q.op9(empty, marks).count() == 0
    none = Q.op9(own, marks.where("false")).collect()
    assert len(none) == docs.count() and all(r.kept for r in none if r.size)


def test_pieces_and_codes():
    import pyarrow as pa

    column = pa.array(["", None, "ab\U0001f680", "c", "x" * 25])
    whole = [Q.codes(p) for p in Q.pieces(column)]
    small = [Q.codes(p) for p in Q.pieces(column, 7)]
    assert len(whole) == 1 and len(small) > 3
    g, own = whole[0]
    assert own.tolist() == [2] * 4 + [3] + [4] * 25 and (g >= 0).all() and (g < 1 << 60).all()
    for i in (0, 1):
        assert [x for w in small for x in w[i].tolist()] == whole[0][i].tolist()
