import random

from pyspark.sql import functions as F

from gotera.llm import sharding, urls


def sharded(spark, rows, n=4, **given):
    df = spark.createDataFrame(rows, "doc_id long, source string, shard string, layer int")
    return [r.asDict() for r in sharding.interleave(df, n, **given).collect()]


def test_shards_are_even_gapless_and_mixed(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), "x", None) for i in range(1001)]
    got = sharded(spark, rows, rows_per_bucket=100)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert sorted(r["doc_id"] for r in got) == list(range(1001)) and set(by) == {0, 1, 2, 3}
    assert {len(v) for v in by.values()} <= {250, 251}
    for rows_of in by.values():
        assert sorted(r["slot"] for r in rows_of) == list(range(len(rows_of)))
    for source in ("a", "b", "c", None):
        counts = [sum(r["source"] == source for r in v) for v in by.values()]
        assert max(counts) - min(counts) <= 2
    again = sharded(spark, rows[::-1], rows_per_bucket=1000)
    key = lambda r: (r["doc_id"], r["shard"], r["slot"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_shards_of_nulls_repeats_and_nothing(spark):
    got = sharded(spark, [(None, None, None, 1), (1, "a", None, 1), (1, "a", None, 1), (None, "a", "y", None)], n=3)
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0)] and "layer" in got[0]
    assert sharded(spark, []) == []


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/a/", "allow"),
         ("Example.org", "/es/a/b", "block"), ("com", "/de/", "block"), ("com", "/de/", "allow"), (None, "/", "block")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h), len(p), a, h.lower() + p) for h, p, a in RULES if h
           and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[2] if best else "allow"


def test_urls_match_brute_force(spark):
    rng = random.Random(5)
    paths = ["", "/", "/es/", "/es", "/es/a/", "/es/a/x", "/es/a/b", "/es/a/bc", "/de/", "/en/1", "/es/ü", "/es/a\u00ff"]
    given = [None, "", "no scheme", "http://", "x://xorg/", "http://ORG/", "http://a..org/es/", "https://Example.ORG?q=/es/"]
    given += [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'www.', 'a.b.'])}{rng.choice(['example.org', 'x.com', 'com', 'notexample.org', 'é.net'])}"
              f"{rng.choice(paths)}{rng.choice(['', '?a://b', '#t'])}" for _ in range(400)]
    given += ["https://www.example.org/es/a/" + "x" * 50_000, "http://" + "." * 5_000 + "org/"] + ["http://x.com/de/1"] * 300
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("best", F.lit(1)).withColumn(
        "verdict", F.lit("old"))
    got = urls.judge_urls(df, spark.createDataFrame(RULES, urls.RULES_SCHEMA)).collect()
    assert len(got) == len(given) and got[0]["best"] == 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(given[r["page_id"]]), given[r["page_id"]]


def test_urls_without_rules_or_rows(spark):
    none = spark.createDataFrame([], urls.RULES_SCHEMA)
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    row = urls.judge_urls(pages, none, default="block").first()
    assert row["verdict"] == "block" and row["rule"] is None
    assert urls.judge_urls(pages.limit(0), spark.createDataFrame(RULES, urls.RULES_SCHEMA)).count() == 0
