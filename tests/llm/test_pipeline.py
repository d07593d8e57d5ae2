import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gotera.llm import registry, sql

SF = "/root/testdata/sf0.001"


def test_names_and_oracles():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(sql.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(set(sql.oracle_sql()) - {"op1_interleaved_shards"}))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    made = registry.queries()[name](spark, SF)
    result = con.execute(sql.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(made.columns)
    assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r)) for r in made.select(*columns).collect())


def test_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    base = docs.orderBy(F.length("text").desc()).first()["text"]
    extra = [(90_001, None), (90_002, ""), (90_003, "123 456"), (90_004, base + " and one more"), (90_005, "The text of " + item * 2),
             (90_006, "This one holds password=abcdef123456 and the usual words after it, with more of the others.")]
    more = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in extra], docs.schema)
    kept = docs.unionByName(more)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, before, SF).cache()
        seen[name] = {r["doc_id"] for r in kept.select("doc_id").collect()}
        if name != "byte-level BPE":
            assert kept.columns == docs.columns
        if name == "secrets":
            row = kept.where("doc_id = 90006").first()
            assert "password" not in row["text"] and row["n_chars"] == len(row["text"])
    assert not {90_001, 90_002, 90_003} & seen["language identification"]
    assert 90_004 in seen["language identification"] and 90_004 not in seen["near copies"]
    assert 90_005 in seen["near copies"] and 90_005 not in seen["benchmark decontamination"]
    assert 90_006 in seen["byte-level BPE"] and kept.where("not intact").count() == 0
    assert len(seen["language identification"]) > 0.97 * docs.count()


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    columns = ["doc_id", "n_chars", "n_tokens", "ids"]
    assert sorted(map(repr, docs.select(*columns).collect())) == sorted(
        map(repr, corpus_pipeline.run(spark, SF).select(*columns).collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


