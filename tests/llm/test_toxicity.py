import random

import pytest

from brindle.llm import toxicity as T


def _distance(a, b):
    """Edits with swaps of neighbours as one."""
    d = {(-1, -1): 0}
    for i in range(len(a)):
        d[i, -1] = i + 1
    for j in range(len(b)):
        d[-1, j] = j + 1
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_against_edit_distance():
    rng = random.Random(3)
    terms = {(w, False): float(i + 1) for i, w in enumerate({"".join(rng.choice("abc") for _ in range(rng.randint(4, 10))) for _ in range(25)})}
    terms |= {("bca", True): 50.0}
    m = T.Matcher(terms)
    for _ in range(4000):
        w = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
        near = [x for (t, stem), x in terms.items() if not stem and _distance(w, t) <= (2 if len(t) >= T.LONG else 1)]
        want = max([50.0] * w.startswith("bca") + near, default=None)
        got = m.find(w)
        assert (got and got[0]) == want, w


def test_kinds_and_context():
    c = T._Cache(T.Matcher({("idiot", False): 5.0, ("lowe", True): 4.0}))
    assert c["idiot"] == (5.0, 0) and c["idoit"] == (5.0, 1) and c["idi0t"] == (5.0, 1) and c["loweshaft"] == (4.0, 2) and c["harmless"] is None
    used, quoted, none = (T.features(t, c) for t in ("you idiot", 'he wrote "idiot" there', "a fine day"))
    assert used[1] > 0 and used[5] == 0 and quoted[1] == 0 and quoted[5] > 0
    assert (T.features(None, c) == none).all() and (T.features("", c) == none).all()


def test_shared_beginnings_replace_words():
    rows = [("lowea", False, 10, 0, 3.0), ("loweb", False, 12, 0, 3.1), ("lowe", True, 40, 0, 4.0), ("idiot", False, 30, 0, 5.0), ("idio", True, 31, 0, 5.0)]
    assert T.chosen(rows) == {("lowe", True): 4.0, ("idiot", False): 5.0}


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice(["an", "er", "th", "on", "re", "ti"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(1200):
        text = [rng.choice(words) for _ in range(60)]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(["stupid", "worthless", "moron"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(planted):
    docs, labels = planted
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = [r for r in T.op3(docs, labels).collect() if r.held_out]
    assert len(got) > 200 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in got) / len(got) > 0.99


def test_held_out_labels_are_never_used(planted):
    docs, labels = planted
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in T.op3(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_misspelled_and_planted_documents(spark, planted):
    docs, labels = planted
    more = docs.unionAll(spark.createDataFrame([(90_001, "this st0pid mor0n is wortless indeed " + "an er th " * 20), (90_002, "an er th on re " * 20)], docs.schema))
    got = {r.doc_id: r.predicted for r in T.op3(more, labels).where("doc_id > 90000").collect()}
    assert got == {90_001: 1, 90_002: 0}


def test_terms_of_any_length_are_tried(spark):
    """Words of one letter, and of sixty, that only toxic documents hold."""
    long = "q" + "ab" * 30
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(9)) + (f" {long}" if i % 4 == 0 else " ж" if i % 4 == 1 else "")) for i in range(400)]
    sample = spark.createDataFrame([(t, int(i % 4 < 2)) for i, t in rows], "text string, toxic int")
    terms = T.lexicon(sample)
    assert (long, False) in terms and ("ж", False) in terms
    m = T.Matcher(terms)
    assert m.find(long[:30] + "x" + long[31:])[1] == 1


def test_evidence_counts_what_could_meet_it():
    """Terms in too few documents are no trials; one more document each may make them so."""
    import statistics

    need = T.evidence({1: 10**6, 2: 10**5, 8: 1000, 20: 100}, 500, 5000)
    inv = statistics.NormalDist().inv_cdf
    assert need == pytest.approx(inv(1 - T.CHANCE / 1100 / 2) ** 2)
    assert T.evidence({1: 50}, 5, 5) == float("inf")
    n = [T._g2(a, b, 40, 160) for a, b in ((8, 32), (20, 0), (0, 20))]
    assert n[0] == pytest.approx(0) and n[1] > 60 and n[2] > 5


def test_forgetting_changes_nothing(monkeypatch):
    terms = {("idiot", False): 5.0, ("lowe", True): 4.0, ("worthless", False): 3.0}
    words = ["idiot", "idoit", "loweshaft", "worthles", "wrthlss", "fine", "x" * 300] * 5
    want = [T._Cache(T.Matcher(terms))[w] for w in words]
    monkeypatch.setattr(T, "HELD", 3)
    monkeypatch.setattr(T, "CACHED", 2)
    c = T._Cache(T.Matcher(terms))
    assert [c[w] for w in words] == want


def test_odd_rows_and_no_labels(spark, docs, clashing, tables, empty):
    labels = tables("labels")
    out = T.op3(docs, labels).collect()
    assert len(out) == docs.count() and all(r.score is not None and r.held_out is not None for r in out)
    kept = T.clean(clashing, labels)
    assert kept.columns == clashing.columns and 0 < kept.count() <= docs.count()
    assert T.op3(empty, labels).count() == 0
    none = labels.where("false")
    assert {r.score for r in T.op3(docs, none).collect()} == {0.0} and T.clean(docs, none).count() == docs.count()
    nulls = spark.createDataFrame([(None, None, None), (1, None, None), (2, 1, 1), (2, 1, 0)], labels.schema)
    assert T.op3(docs, nulls).count() == docs.count()
