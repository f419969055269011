"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm import (
    ann_scan,
    bpe_codec,
    hard_negatives,
    jaccard_join,
    kd_shards,
    language_cnn,
    line_runs,
    pack_bfd,
    pack_nnls,
    quality_rules,
    simhash_pivots,
    suffix_dedup,
    token_alignment,
)

QUERIES: dict = {}
ORACLE: dict = {}

ENGLISH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_bfd_pack(spark, sf):
    return pack_bfd.pack(documents(spark, sf), ENGLISH, PATTERN)


@query
def op5_byte_bpe(spark, sf):
    return bpe_codec.digests(documents(spark, sf), MULTI, PATTERN)


@query
def op9_nnls_pack(spark, sf):
    return pack_nnls.digests(pack_nnls.pack(documents(spark, sf), ENGLISH, PATTERN))


@query
def op2_quality_rules(spark, sf):
    docs = documents(spark, sf)
    rules = quality_rules.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "rule")


@query
def op10_byte_cnn_language(spark, sf):
    return language_cnn.classify(documents(spark, sf))


@query
def op3_adaptive_scan(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return ann_scan.search(rows, rows.where("vec_id % 20 = 0"))


@query
def op4_kd_shards(spark, sf):
    return kd_shards.shard(documents(spark, sf), shards=16)


@query
def op6_suffix_dedup(spark, sf):
    return suffix_dedup.digests(documents(spark, sf))


@query
def op7_line_runs(spark, sf):
    done = line_runs.dedup(documents(spark, sf))
    return done.select("doc_id", "text", "line_runs.*")


@query
def op8_jaccard_join(spark, sf):
    return jaccard_join.near_classes(documents(spark, sf))


@query
def op13_token_alignment(spark, sf):
    return token_alignment.digests(documents(spark, sf), ENGLISH, PIECES, PATTERN)


def mined_rows(rows: DataFrame) -> DataFrame:
    """Embeddings with the labels that op11 mines by."""
    moved = (F.col("label") + 1) % 10
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label")))


@query
def op11_hard_negatives(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return hard_negatives.mine(mined_rows(rows), F.col("vec_id") % 50 == 0)


@query
def op12_simhash_pivots(spark, sf):
    return simhash_pivots.near_classes(documents(spark, sf))


ORACLE["op7_line_runs"] = r"""
with split as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents),
worded as (
  select *, row_number() over (partition by doc_id order by pos) - 1 as nth from split
  where regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs as (
  select doc_id, nth, line, lead(line) over (partition by doc_id order by nth) as following from worded),
firsts as (
  select doc_id, nth, first_value(doc_id) over w as first_doc, first_value(nth) over w as first_at
  from pairs where following is not null
  window w as (partition by line, following order by doc_id, nth)),
gone as (
  select distinct doc_id, nth + k as nth from firsts, (values (0), (1)) v(k)
  where doc_id <> first_doc or nth >= first_at + 2),
runs as (
  select doc_id, count(*) as n_removed, count(*) filter (where nth - 1 <> before or before is null) as n_runs
  from (select *, lag(nth) over (partition by doc_id order by nth) as before from gone) group by 1),
kept as (
  select s.doc_id, string_agg(s.line, chr(10) order by s.pos) as text
  from split s left join worded w using (doc_id, pos) left join gone g on g.doc_id = w.doc_id and g.nth = w.nth
  where g.nth is null group by 1),
counts as (select doc_id, count(*) as n_lines from worded group by 1)
select d.doc_id, case when d.text is not null then coalesce(k.text, '') end as text,
  coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, coalesce(n_runs, 0) as n_runs
from documents d left join kept k using (doc_id) left join counts using (doc_id) left join runs using (doc_id)
"""
