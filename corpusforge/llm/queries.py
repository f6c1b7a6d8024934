"""One query per operator, with production parameters, and its DuckDB SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (block_ann, length_buckets, license_align, line_dedup, periodic_runs, quality_llr, simhash_bits, sorted_passes, temperature_mix,
               token_counts, token_windows, url_rules, weak_toxicity)
from .common import table


# The rules of the URL filter's contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_llr.judge(docs, quality_llr.fit(docs, trusted))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), by_word=True)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mix.sequence(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_toxicity.score(docs, weak_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_align.scan(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.pack(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bits.near_duplicates(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.find_runs(table(spark, sf_dir, "documents"), rewrite=periodic_runs.planted))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as files
    return token_windows.align_tokens(table(spark, sf_dir, "documents"), files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model"), files.PATTERN)


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_passes.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_nearest_neighbours, op2_token_counts, op3_source_mixing, op4_simhash_near_dedup, op5_toxicity,
    op6_packing, op7_url_filters, op8_license_scans, op9_quality_rules, op10_line_dedup,
    op11_periodic_runs, op12_token_alignment, op13_embedding_near_dedup)}

OP7_SQL = r"""
with p as (select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
r as (select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) v(rh, rp, act)),
u as (select distinct host, path from p),
m as (select host, path, arg_max(rh || rp, length(rh) + length(rp)) as rule, arg_max(act, length(rh) + length(rp)) as act
      from u join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by host, path)
select page_id, p.host as host, p.path as path, rule, coalesce(act, 'allow') as verdict
from p left join m on p.host = m.host and p.path = m.path
"""

OP10_SQL = r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
k as (select doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
r as (select key, max(doc_id) as keeper from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
j as (select k.doc_id as doc_id, i, line, coalesce(keeper <> k.doc_id, false) as lost from k left join r on k.key = r.key)
select doc_id, count(*) as n_lines, sum(lost::int)::bigint as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not lost), '')) as kept_sha256
from j group by doc_id
"""

OP1_SQL = r"""
with v as (select vec_id, list_transform(embedding, lambda x: x::double) as x from embeddings
           where vec_id is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
             and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
p as (select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.x, c.x) as score
      from v q join v c on len(q.x) = len(c.x) and q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""

ORACLE_SQL = {"op1_nearest_neighbours": OP1_SQL, "op10_line_dedup": OP10_SQL, "op7_url_filters": OP7_SQL}
