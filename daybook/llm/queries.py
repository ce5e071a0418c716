"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import (decontaminate, exact_dedup, jaccard, nearest, packing, periodic_runs, private,
                         quality, secrets, shards, target_resampling, toxicity, url_rules)
from daybook.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the URL query.
URL_RULES = [url_rules.split_rule("net/", url_rules.BLOCK),
             url_rules.split_rule("example.net/en/", url_rules.ALLOW),
             url_rules.split_rule("example.com/de/", url_rules.BLOCK),
             url_rules.split_rule("org/fr/", url_rules.ALLOW)]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(read_table(spark, sf_dir, "documents"))


def op2_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = private.plain(read_table(spark, sf_dir, "documents"))
    return private.digest(private.private_spans(docs))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"),
                                       read_table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"),
                             read_table(spark, sf_dir, "labels"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read_table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "labels"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return periodic_runs.digest(periodic_runs.runs(docs, read=periodic_runs.words_with_planted_repeat))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.digest(target_resampling.resample(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read_table(spark, sf_dir, "documents"), keep=exact_dedup.LARGEST)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_private_data, op3_jaccard_join, op4_decontaminate, op5_toxicity,
    op6_url_rules, op7_packing, op8_nearest, op9_quality, op10_shards, op11_periodic_runs, op12_target_resampling,
    op13_exact_dedup)}

ORACLE: dict[str, str] = {
    "op6_url_rules": r"""
with u as (
  select page_id, case when strpos(coalesce(url, ''), '://') > 0
    then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
p as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from u),
r(h, q, rule, verdict) as (values
  ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
  ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
m as (
  select p.page_id, p.host, p.path, r.rule, r.verdict,
    row_number() over (partition by p.page_id, p.host, p.path
                       order by length(r.h) desc nulls last, length(r.q) desc) as n
  from p left join r on (p.host = r.h or ends_with(p.host, '.' || r.h)) and starts_with(p.path, r.q))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where n = 1
""",
    "op13_exact_dedup": """
with t as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from t group by text)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.text) as text_sha256,
  md5(t.text) as content_hash
from t join g on t.text = g.text
""",
}
