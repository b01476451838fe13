from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from brindle.llm import decontaminate, mixing, queries, toxicity
from test_simhash import _same, _survivors


def test_stages_one_after_another(spark, data, tables, tmp_path):
    """Each stage on its own input, against its operator's own answer for that input."""
    docs, labels, bench = tables("documents"), tables("labels"), tables("benchmark")
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    names = docs.columns

    def stage(i, docs):
        corpus_pipeline.STAGES[i][1](spark, docs, data).write.parquet(f"{tmp_path}/{i}")
        return spark.read.parquet(f"{tmp_path}/{i}")

    a = stage(0, docs)
    assert a.columns == names and ids(a) == ids(toxicity.op3(docs, labels).where("predicted = 0"))
    b = stage(1, a)
    assert b.columns == names
    _same([(r.doc_id, r.text) for r in b.collect()], _survivors([(r.doc_id, r.text) for r in a.collect()]))
    c = stage(2, b)
    assert c.columns == names and ids(c) == ids(decontaminate.op5(b, bench).where("not contaminated"))
    d = stage(3, c)
    times = Counter({r.doc_id: r.times for r in mixing.plan_mix(c).collect()})
    assert d.columns == names and ids(d) == +times
    e = stage(4, d)
    assert ids(e) == ids(d) and e.columns == [*names, "size", "text_crc32", "shard", "slot"]


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    df, want = queries.queries()[name](spark, data), con.sql(queries.oracle_sql()[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    at = [want.columns.index(n) for n in names]
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 11))
