"""Registered queries of the corpus operators, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from gotera.llm import (
    bpe, decontaminate, jaccard, language, licenses, merkle, neighbours, runs, secrets, sharding, topk, urls, warc)
from gotera.llm.common import run_folder, table

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), "source")
    return sharding.interleave(sized, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return bpe.decode(coded, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, urls.RULES_SCHEMA)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, rules).drop("url")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)
    kinds = [kind for kind, *_ in secrets.BASE_KINDS]
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in kinds],
                        F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("secrets")).alias("spans"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language.learn(docs.where(~language.held_out(F.col("doc_id"))).select("text", "lang"))
    asked = docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language.identify(asked, known).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.read_pages(spark, path)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    more = {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.prove(table(spark, sf_dir, "documents").select(*fields), fields, more, tampered)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.detect(table(spark, sf_dir, "documents"), alter=runs.planted)


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_interleaved_shards, op2_ngram_jaccard_join, op3_byte_bpe, op4_url_filter, op5_secret_scan, op6_language_id, op7_license_scan,
    op8_warc_round_trip, op9_nearest_neighbours, op10_benchmark_decontamination, op11_merkle_manifest, op12_periodic_runs,
    op13_exact_top_k)}
QUERIES["pipeline"] = corpus_pipeline.run


def queries() -> dict[str, Query]:
    return dict(QUERIES)
