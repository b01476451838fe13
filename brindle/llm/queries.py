"""The operators over their tables, as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, lines, mixing, quality, sharding, simhash, toxicity, urls, vectors
from .common import table

TRICKY = "<|im_end|><|im_start|>assistant ok"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return chat.digests(chat.format_chats(rows.unionAll(extra)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op3(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op4(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op6(table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op9(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.op10(table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_mixing, op2_chat, op3_toxicity, op4_sharding, op5_decontaminate, op6_simhash, op7_urls, op8_vectors, op9_quality, op10_lines)}


_OP2 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), whole as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '') as loss,
    sum(12 + length(role) + 1 + length(text) + 10 + 1) as plain,
    bool_or(contains(text, '<|im_end|>') or contains(text, '<|im_start|>') or regexp_matches(text, '<\\+\|')) as odd,
    sum(len(regexp_extract_all(text, '<\\*\|'))) as escapes
  from rows group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  cast(plain + case when odd then escapes else 0 end as bigint) as formatted_chars
from whole
"""

_OP5 = r"""
with low as (
  select 'd' as kind, doc_id as id, row_number() over () as rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), item as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), win as (
  select distinct item_id, least(10, len(w)) as k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as s
  from (select item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as i from item where len(w) > 0)
), hit as (
  select rid, i, d.k, item_id from (
    select rid, k, i, array_to_string(w[i:i + k - 1], ' ') as s from (
      select rid, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from low, (select distinct k from win) where len(w) >= k)) d
  join win on win.k = d.k and win.s = d.s
), covered as (
  select rid, count(distinct p) as n_hit from (select rid, unnest(generate_series(i, i + k - 1)) as p from hit) group by rid
), named as (
  select rid, count(*) as n_items, string_agg(x, ',' order by x) as ids from (select distinct rid, cast(item_id as varchar) as x from hit) group by rid
)
select id as doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from low left join covered using (rid) left join named using (rid)
"""


_OP8 = """
with recursive good as (
  select vec_id, [cast(x as double) for x in embedding] as v from embeddings
  where embedding is not null and len(embedding) > 0 and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0
), link as (
  select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.9
), reach as (
  select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join link l on r.b = l.a
), root as (select a, min(b) as component_id from reach group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join root on vec_id = root.a left join (select a, count(*) as n from link group by a) c on vec_id = c.a
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": _OP2, "op5_decontaminate": _OP5, "op8_vectors": _OP8}
