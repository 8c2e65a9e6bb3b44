"""One registered query per operator, in production settings over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.llm import (
    alignment, decontaminate, embeddings, hard_negatives, language, licenses, packing, pii, quality, scoring, secret_scan,
    simhash, suffixes,
)
from navloom.llm.common import held_out, id_text, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_text(table(spark, sf_dir, "documents"))


@query("op1_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))


@query("op2_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.expr("lower(lpad(hex(fp), 16, '0'))").alias("fingerprint"), "component_id")


@query("op3_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without bytes of strings that start earlier."""
    return suffixes.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_secret_scan")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, counted by kind and as spans."""
    found = secret_scan.find_secrets(documents(spark, sf_dir))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(secret_scan.joined(secret_scan.BASE_KINDS), 256).alias("base_sha256"),
                        secret_scan.joined(secret_scan.KINDS).alias("spans"))


@query("op5_license_scan", licenses.oracle_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences stated by every document."""
    return licenses.per_document(documents(spark, sf_dir), licenses.known_licenses(spark))


OP6_SQL = r"""
with upper_letters as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' u, 'abcdefghijklmnopqrstuvwxyz' l),
dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
       from documents, upper_letters),
bw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
       from benchmark, upper_letters),
items as (select distinct item_id, least(13, len(w)) width, w[i:i + least(13, len(w)) - 1] win
          from (select item_id, w, unnest(range(1, greatest(2, len(w) - 11))) i from bw where len(w) > 0)),
widths as (select distinct width from items),
doc_wins as (select doc_id, i, width, w[i:i + width - 1] win
             from (select doc_id, w, width, unnest(range(1, len(w) - width + 2)) i from dw, widths where len(w) >= width)),
found as (select d.doc_id, d.i, d.width, t.item_id from doc_wins d join items t on d.win = t.win and d.width = t.width),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + width)) p from found) group by 1),
named as (select doc_id, count(*) n_items, sha256(string_agg(s, ',' order by s)) items_sha256
          from (select distinct doc_id, cast(item_id as varchar) s from found) group by 1)
select dw.doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       coalesce(items_sha256, sha256('')) items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from dw left join hit using (doc_id) left join named using (doc_id)
"""


@query("op6_benchmark_decontamination", OP6_SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hits and matching test items of every document."""
    marked = decontaminate.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", F.coalesce("n_words", F.lit(0)).alias("n_words"), decontaminate.hit_count().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


@query("op7_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, counted by kind and as spans."""
    found = pii.find_pii(documents(spark, sf_dir))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.joined_spans(pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.joined_spans(pii.KINDS).alias("spans"))


@query("op8_quality_classifier")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled rows outside the held-out third."""
    docs = documents(spark, sf_dir)
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, weights).select(
        "doc_id", held_out().alias("held_out"), "score", F.expr("cast(score >= 0.5 as int)").alias("predicted"))


@query("op9_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the held-out third."""
    model = language.train(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return language.predict(documents(spark, sf_dir), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token pieces placed in sequences of 1024."""
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op12_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the n-gram model and under plain word counts."""
    return scoring.score_documents(documents(spark, sf_dir))


@query("op13_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers."""
    return alignment.align_documents(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


OP11_SQL = """
with base as (select vec_id id, if(vec_id % 7 = 0, (label + 1) % 10, label) label,
                     list_transform(embedding, lambda x: floor(256 * cast(x as double))) v
              from embeddings
              where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
anchors as (select * from base where id % 100 = 0),
scored as (select a.id anchor_id, b.id, a.label = b.label same, cast(list_dot_product(a.v, b.v) as bigint) score
           from anchors a join base b on a.id <> b.id and len(a.v) = len(b.v)),
positives as (select anchor_id, id positive_id, score positive_score from scored where same
              qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over w as integer) "rank", id negative_id, positive_score, score negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, id)
qualify row_number() over w <= 10
"""


@query("op11_hard_negatives", OP11_SQL)
def hard_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector and each of its positives."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))
