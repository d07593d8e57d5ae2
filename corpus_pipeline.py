"""From raw documents to training tokens: five stages, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gotera.llm import bpe, decontaminate, jaccard, language, secrets
from gotera.llm.common import run_folder, stored, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    known = language.learn(docs.where(~language.held_out(F.col("doc_id"))).select("text", "lang"))
    return language.identify(docs, known).where("not rejected").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return jaccard.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    found = secrets.find_secrets(docs, out="found_secrets")
    text = secrets.redact(F.col("text"), F.col("found_secrets"))
    changed = found.withColumn("text", text).withColumn("n_chars", F.when(
        F.size("found_secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with the digest of the text that they decode to."""
    # stored in between, so that a task runs one Python worker at a time
    coded = stored(bpe.encode(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", "lang", "source", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "ids"), "coded")
    back = bpe.decode(coded, RANKS, public_tokenizers.PATTERN)
    return back.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                       (F.sha2("decoded", 256) == F.col("text_sha256")).alias("intact"))


STAGES = [
    ("language identification", identify_languages),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("byte-level BPE", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = run_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
