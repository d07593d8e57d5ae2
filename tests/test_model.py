import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from gotera import catalog
from gotera.operators import encoders, report, sampling, selection, skew
from gotera.plans import model as modelling, runs
from gotera.schemas import INTERIM
from gotera.sources import fixtures, interim


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_smoothed_target_encoding(spark):
    df = frame(spark, [("a", 1), ("a", 0), ("a", 1), ("b", 0), ("b", 0), ("b", 0)], "c string, target int")
    fitted = encoders.MeanEncoder(cols=["c"], weight=50.0).fit(df)
    new = frame(spark, [("a",), ("b",), ("z",), (None,)], "c string")
    assert [r[0] for r in fitted.transform(new).collect()] == pytest.approx([0.352201, 0.314465, 1 / 3, 1 / 3], abs=1e-6)


def test_dummies_keep_fit_time_columns(spark):
    fitted = encoders.DummyEncoder(cols=["c"]).fit(frame(spark, [("b",), ("a",), (None,)], "c string"))
    out = fitted.transform(frame(spark, [("a",), ("z",), (None,)], "c string"))
    assert out.columns == ["dummy_c_a", "dummy_c_b"] and [tuple(r) for r in out.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_rare_categories(spark):
    df = frame(spark, [("a",), ("a",), ("b",), (None,)], "c string")
    shares = {r["value"]: r["share"] for r in encoders.category_shares(df, "c").collect()}
    assert shares == pytest.approx({"a": 2 / 3, "b": 1 / 3})
    out = encoders.RareReducer(cols=["c"], threshold=0.4).fit(df).transform(df)
    assert [r[0] for r in out.collect()] == ["a", "a", "otros", "otros"]


def test_encoders_survive_saving(spark, tmp_path):
    df = frame(spark, [("a", "x", "s", 1), ("b", "y", "s", 0)], "categoria string, localidad string, "
               "subcategoria_estrato string, target int")
    fitted = encoders.preprocessing_pipeline(1).fit(df)
    fitted.write().overwrite().save(f"{tmp_path}/m")
    loaded = PipelineModel.load(f"{tmp_path}/m")
    assert loaded.transform(df).collect() == fitted.transform(df).collect()
    with pytest.raises(ValueError):
        encoders.preprocessor(7)
    assert Pipeline(stages=encoders.preprocessor(-1)).fit(df).transform(df).columns == df.columns


def numbered(spark, positives, total):
    return spark.range(total).select(
        F.col("id").cast("string").alias("k"), (F.col("id") < positives).cast("int").alias("target"))


@pytest.mark.parametrize("method, expected", [("over", (93, 46)), ("under", (14, 7)), ("none", (93, 7))])
def test_resampling_hits_the_exact_ratio(spark, method, expected):
    out = sampling.resample(numbered(spark, 7, 100), ["k"], method, 0.5)
    assert sampling.class_sizes(out) == expected
    per_row = out.where("target = 1").groupBy("k").count().agg(F.min("count"), F.max("count")).head()
    assert per_row[1] - per_row[0] <= 1


def test_resampling_refuses_a_ratio_already_exceeded(spark):
    for method in ("over", "under"):
        with pytest.raises(ValueError):
            sampling.resample(numbered(spark, 60, 100), ["k"], method, 0.5)


@pytest.mark.parametrize("method", ["over", "under"])
def test_training_rows_beyond_the_ratio_stay_as_they_are(spark, method):
    rows = numbered(spark, 60, 100)
    assert sampling.class_sizes(sampling.rebalance(rows, ["k"], method, 0.5)) == (40, 60)
    assert sampling.class_sizes(sampling.rebalance(numbered(spark, 7, 100), ["k"], method, 0.5)) == (
        {"over": (93, 46), "under": (14, 7)}[method])
    inputs = rows.withColumn("a", F.col("k").cast("double"))
    settings = modelling.TrainingSettings(
        features=["a"], keys=["k"], preprocessor=-1, sampling=method, params={"n_estimators": 2, "max_depth": 2})
    scored = modelling.score(modelling.train_model(inputs, settings), inputs)
    assert scored.where("score between 0 and 1").count() == 100


def test_split_is_stable_and_about_one_fifth(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    share = sampling.with_split(df, ["k"]).agg(F.avg(F.col("is_train").cast("int"))).head()[0]
    assert 0.77 < share < 0.83
    again = sampling.with_split(df.repartition(7), ["k"])
    assert again.exceptAll(sampling.with_split(df, ["k"])).count() == 0


def test_hash_rank_matches_brute_force(spark):
    df = spark.range(3000).withColumn("h", skew.stable_hash("id"))
    got = [r["h"] for r in skew.with_hash_rank(df, "h").orderBy("rank").collect()]
    ranks = [r["rank"] for r in skew.with_hash_rank(df, "h").orderBy("rank").collect()]
    assert got == sorted(r["h"] for r in df.collect()) and ranks == list(range(1, 3001))


def test_smallest_per_group_matches_brute_force(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("g"), skew.stable_hash("id").alias("h"))
    got = {(r["g"], r["h"]) for r in skew.smallest_per_group(df, ["g"], "h", 9).collect()}
    rows = [tuple(r) for r in df.collect()]
    assert got == {(g, h) for g in ("hot", "cold") for h in sorted(h for k, h in rows if k == g)[:9]}


def test_key_list_beyond_the_broadcast_bound(spark):
    df, keys = spark.range(100), spark.range(0, 100, 3)
    small, large = skew.keep_keys(df, keys, ["id"]), skew.keep_keys(df, keys, ["id"], max_rows=5)
    assert sorted(small.collect()) == sorted(large.collect()) and large.count() == 34


def test_reports(spark):
    df = frame(spark, [(0.0, 0), (0.5, 1), (1.0, 1), (0.0, 0)], "score double, target int")
    assert {tuple(r) for r in report.score_histogram(df).collect()} == {(1, 2), (26, 1), (50, 1)}
    assert report.zero_scores(df).head()[0] == 2 and report.target_mean(df).head()[0] == 0.5
    assert report.score_histogram(df.where("score = 1")).collect()[0]["rows"] == 1
    assert report.ranking_quality(df) == {"auc": 1.0, "average_precision": 1.0}
    uneven = frame(spark, [(0.8, 1), (0.7, 0), (0.4, 0), (0.35, 1), (0.1, 1)], "score double, target int")
    assert report.ranking_quality(uneven)["average_precision"] == pytest.approx(0.7)
    ties = frame(spark, [(0.5, i % 3 == 0) for i in range(30)], "score double, target boolean").withColumn("target", F.col("target").cast("int"))
    assert report.average_precision(ties) == pytest.approx(1 / 3)


def test_average_precision_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(400) / 400, int(rng.random() < 0.3)) for _ in range(2000)]
    found, seen, expected = 0, 0, 0.0
    positives = sum(t for _, t in rows)
    for score in sorted({s for s, _ in rows}, reverse=True):
        here = [t for s, t in rows if s == score]
        found, seen = found + sum(here), seen + len(here)
        expected += sum(here) / positives * found / seen
    assert report.average_precision(frame(spark, rows, "score double, target int")) == pytest.approx(expected)


def test_dummy_names_never_collide(spark):
    df = frame(spark, [("Residencial",), ("RESIDENCIAL",), ("A.B",), ("A`B",), ("a b",)], "categoria string")
    fitted = encoders.DummyEncoder(cols=["categoria"]).fit(df)
    out = fitted.transform(df.withColumn("k", F.col("categoria")))
    names = [c for c in out.columns if c != "k"]
    assert len({n.lower() for n in names}) == 5 and all(n.replace("_", "").isalnum() for n in names)
    assert all(sum(r[n] for n in names) == 1 for r in out.collect())
    with pytest.raises(ValueError):
        encoders.RareReducer(cols=["categoria"], threshold=0.0).fit(df)


def test_correlations_skip_missing_values_per_pair(spark):
    rng = random.Random(5)
    rows = [[rng.gauss(1e6, 1), rng.gauss(0, 1), rng.random()] for _ in range(300)]
    for i, r in enumerate(rows):
        r[1] += r[0] - 1e6
        if i % 7 == 0:
            r[0] = float("nan")
        if i % 5 == 0:
            r[1] = None
    df = frame(spark, [tuple(r) + (1.0,) for r in rows], "a double, b double, c double, flat double")
    table = df.toPandas()
    for method in ("pearson", "spearman"):
        got = selection.correlations(df, ["a", "b", "c"], method)
        expected = table[["a", "b", "c"]].corr(method)
        for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
            assert got[x, y] == pytest.approx(expected.loc[x, y], abs=1e-9)
    assert math.isnan(selection.correlations(df, ["a", "flat"])["a", "flat"])


def test_undefined_target_correlation_drops_nothing(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).cast("double").alias("b"), F.lit(1).alias("target"))
    assert selection.select_by_correlation(df, ["a", "b"]) == ["a", "b"]


def test_selection(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2 + F.col("id") % 5).cast("double").alias("b"),
        (F.col("id") % 7).cast("double").alias("c"), F.lit(1.0).alias("one"), F.lit(None).cast("double").alias("nothing"),
        (F.col("id") > 100).cast("int").alias("target"), F.col("id").cast("string").alias("k"))
    kept = selection.select_by_correlation(df, ["a", "b", "c"])
    pdf = df.select("a", "b", "target").toPandas().corr()
    weaker = "a" if abs(pdf.loc["a", "target"]) < abs(pdf.loc["b", "target"]) else "b"
    assert set(kept) == {"a", "b", "c"} - {weaker}
    holes = df.withColumn("a", F.when(F.col("id") % 3 > 0, F.col("a"))) if "id" in df.columns else df.withColumn(
        "a", F.when(F.col("c") > 0, F.col("a")))
    expected = holes.select("a", "b").toPandas().corr().loc["a", "b"]
    assert selection.correlations(holes, ["a", "b"])["a", "b"] == pytest.approx(expected)
    assert selection.select_by_constancy(df, ["a", "one", "nothing"]) == ["a", "nothing"]
    votes = selection.forest_votes(df, ["a", "c"], ["k"], runs=2, trees=5, depth=3)
    assert votes["a"] == 2


def test_training_and_scoring_end_to_end(spark, sf_dir, tmp_path):
    rows = fixtures.consumption(spark, sf_dir).withColumns({"year": F.year("date"), "month": F.month("date")})
    label = fixtures.inspections(spark, sf_dir)
    # plant a signal: contracts with an even id carry fraud
    even = F.right("contrato", F.lit(1)).cast("int") % 2 == 0
    label = label.withColumn("is_fraud", even.cast("int"))
    rows = rows.withColumn("consumo", F.when(even, F.lit(1.0)).otherwise(F.col("consumo")))
    interim.write_interim(rows.select(*INTERIM["consumo"].names), f"{tmp_path}/i", "consumo")
    interim.write_interim(label.select(*INTERIM["inspecciones"].names), f"{tmp_path}/i", "inspecciones")
    features = ["mean_12", "std_cons12", "max_cons12", "cant_null", *modelling.ENCODED]
    settings = modelling.TrainingSettings(
        features=features, sampling="none", params={"n_estimators": 5, "max_bin": 32, "max_depth": 3, "min_child_samples": 2})
    runs.run_training(spark, f"{tmp_path}/i", f"{tmp_path}/p", f"{tmp_path}/m", "1999-06-01", settings=settings,
                      max_negatives=None)
    scores = runs.run_inference(
        spark, f"{tmp_path}/i", f"{tmp_path}/p", f"{tmp_path}/m", f"{tmp_path}/s", "1999-07-01")
    judged = scores.withColumn("target", even.cast("int"))
    assert report.ranking_quality(judged)["auc"] > 0.9
    some = runs.run_inference(spark, f"{tmp_path}/i", f"{tmp_path}/p", f"{tmp_path}/m", f"{tmp_path}/s2", "1999-07-01",
                              contracts=["000000011"])
    assert {r["contrato"] for r in some.collect()} <= {"000000011"}
    with pytest.raises(ValueError, match="not all loaded"):
        runs.run_inference(spark, f"{tmp_path}/i", f"{tmp_path}/p", f"{tmp_path}/m", f"{tmp_path}/s", "2003-01-01")


def test_search_space():
    draws = modelling.draw_params()
    assert len(draws) == 60 and draws == modelling.draw_params()
    assert all(5 <= d["max_depth"] < 20 and 0.01 <= d["learning_rate"] <= 0.11 for d in draws)


def test_best_round_has_patience():
    assert modelling.best_round([0.5, 0.6, 0.6, 0.59, 0.58], 3) == (2, True)
    assert modelling.best_round([0.5, 0.6, 0.6, 0.61], 3) == (4, False)
    assert modelling.best_round([float("nan")] * 4, 2) == (4, False)


def test_slow_learning_keeps_many_trees(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        x = [rng.gauss(0, 1) for _ in range(4)]
        rows.append((str(i), *x, int(x[0] + x[1] * x[2] + rng.gauss(0, 0.7) > 0)))
    df = frame(spark, rows, "k string, a double, b double, c double, d double, target int")
    settings = modelling.TrainingSettings(features=["a", "b", "c", "d"], keys=["k"], preprocessor=-1, sampling="none",
                                          params={"learning_rate": 0.05, "n_estimators": 60, "max_depth": 3, "min_child_samples": 10})
    model = modelling.train_model(df, settings)
    assert model.stages[-1].getNumTrees > 15
    _, held = modelling.held_apart(df, settings)
    scored = modelling.score(model, held)
    assert report.ranking_quality(scored)["auc"] > 0.8
    vectors = model.transform(held).select("features", F.col("target").cast("double").alias("target"))
    last = list(modelling.round_aucs(model.stages[-1], vectors))[-1]
    assert last == pytest.approx(report.ranking_quality(scored)["auc"], abs=0.01)
    with pytest.raises(ValueError):
        modelling.boosted_trees({"max_depth": 31})


def test_samples_are_cut_by_hash_without_moving_the_majority(spark, monkeypatch):
    """The first rows in hash order, also with buckets of many rows, ties of equal keys and every possible size."""
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    keys = [f"k{i}" for i in range(200)] + ["same"] * 30
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int")
    hashes = sorted(r["h"] for r in df.select(sampling.stable_hash("key", seed=7).alias("h")).collect())
    for k in (0, 1, 17, 100, 229, 230, 400):
        first, others = sampling.split_by_hash(df, ["key"], k, 7)
        got = sorted(r["h"] for r in first.select(sampling.stable_hash("key", seed=7).alias("h")).collect())
        assert got == hashes[:k] and others.count() == len(keys) - len(got)
    rows = spark.createDataFrame([(f"a{i}", 0) for i in range(400)] + [(f"b{i}", 1) for i in range(60)], "key string, target int")
    monkeypatch.undo()
    for made in (sampling.oversample(rows, ["key"], 0.5), sampling.undersample(rows, ["key"], 0.5)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        # only rows at the bound are numbered
        assert plan.count("Exchange") == plan.count("Window [row_number")
    counts = {r["target"]: r["count"] for r in sampling.oversample(rows, ["key"], 0.5).groupBy("target").count().collect()}
    assert counts == {0: 400, 1: 200}


def test_quality_of_nothing_is_zero(spark):
    none = spark.createDataFrame([], "score double, target int")
    nulls = spark.createDataFrame([(None, 1), (None, 0)], "score double, target int")
    for rows in (none, nulls):
        assert report.ranking_quality(rows) == {"auc": 0.0, "average_precision": 0.0}


def test_shadows_are_shuffled_against_each_other(spark):
    """Two equal features have shadows that agree no more often than by chance, each with the feature's own values."""
    rows = spark.range(500).select(F.col("id").alias("_rank"), F.hash("id").cast("double").alias("a"), F.hash("id").cast("double").alias("b"))
    made = selection.with_shadows(rows, ["a", "b"], 500, 0).collect()
    for f in "ab":
        assert sorted(r[f"shadow_{f}"] for r in made) == sorted(r[f] for r in made)
        assert sum(r[f"shadow_{f}"] == r[f] for r in made) == 0
    assert sum(r["shadow_a"] == r["shadow_b"] for r in made) == 0
    other = {r["_rank"]: r["shadow_a"] for r in selection.with_shadows(rows, ["a", "b"], 500, 1).collect()}
    assert sum(other[r["_rank"]] == r["shadow_a"] for r in made) == 0


def test_preprocessing_fits_on_stored_rows(spark, sf_dir):
    """The fits read the rows about ten times; the joins behind them run once."""
    made = catalog.queries()["model_preprocessing"](spark, sf_dir)
    assert made.inputFiles() and not any("lineitem" in f for f in made.inputFiles())


def test_population_ratios_find_their_cutoffs_once(spark, sf_dir, monkeypatch):
    calls, plain = [], catalog.months
    monkeypatch.setattr(catalog, "months", lambda *a: calls.append(a) or plain(*a))
    catalog.queries()["population_ratios"](spark, sf_dir)
    assert len(calls) == 1


def test_random_search_asks_for_the_whole_search(spark, sf_dir, monkeypatch):
    """Every draw, fold and round that the library searches by default; the query cuts none of them."""
    asked = []
    monkeypatch.setattr(catalog, "model_rows", lambda *a: None)
    monkeypatch.setattr(modelling, "search_params", lambda rows, settings, **cuts: asked.append((settings.params, cuts)) or (
        0.5, {**settings.params, **modelling.draw_params()[-1]}))
    assert [tuple(r) for r in catalog.queries()["random_search"](spark, sf_dir).collect()] == [(True, True)]
    (params, cuts), = asked
    assert params["n_estimators"] == modelling.ROUNDS == 1000 and not cuts
    assert (modelling.SEARCH_DRAWS, modelling.SEARCH_FOLDS, modelling.PATIENCE) == (60, 3, 30)


def test_rank_correlations_rank_distinct_values(spark, monkeypatch):
    """Ties, signed zeros, infinities and constants as in Spark's ranks, with looked-up and with joined ranks; rows are not ranked."""
    rng = random.Random(9)
    rows = [(rng.gauss(0, 1) * 1e3, float(rng.randrange(4)), rng.choice([0.0, -0.0, 1.5, float("inf"), float("-inf")]), 7.0, i // 3)
            for i in range(900)]
    df = frame(spark, rows + rows[:200], "a double, b double, `c d` double, flat double, g int").repartition(5)
    columns = ["a", "b", "c d", "flat", "g"]
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    expected = selection._matrix(numbers, columns, "spearman")
    matrix = selection._matrix
    monkeypatch.setattr(selection, "_matrix", lambda *a: pytest.fail("rows were ranked"))
    for most in (selection.LOOKUP_VALUES, 8, 0):
        monkeypatch.setattr(selection, "LOOKUP_VALUES", most)
        got = selection.correlations(df, columns, "spearman")
        for pair, value in expected.items():
            assert got[pair] == pytest.approx(value, abs=1e-9, nan_ok=True)
    assert math.isnan(got["a", "flat"]) and got["g", "a"] == got["a", "g"]
    monkeypatch.setattr(selection, "_matrix", matrix)
    monkeypatch.setattr(selection, "JOINED_RANKS", 4)
    assert selection.correlations(df, columns, "spearman")["a", "b"] == pytest.approx(expected["a", "b"], abs=1e-9)


def boosting_rows(spark, n=600):
    rng = random.Random(12)
    x = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(n)]
    return frame(spark, [(str(i), *v, int(v[0] + v[1] * v[2] + rng.gauss(0, 0.7) > 0)) for i, v in enumerate(x)],
                 "k string, a double, b double, c double, target int")


def test_first_rounds_are_the_fit_of_fewer_rounds(spark, tmp_path):
    vectors = Pipeline(stages=modelling.vector_stages(["a", "b", "c"])).fit(boosting_rows(spark)).transform(boosting_rows(spark))
    rows = vectors.select("features", F.col("target").cast("double"), F.lit(1.0).alias("weight")).cache()
    params = {"max_depth": 3, "min_child_samples": 10, "subsample": 0.7, "colsample_bytree": 0.6}
    cut = modelling.first_rounds(modelling.boosted_trees({**params, "n_estimators": 9}).fit(rows), 4)
    fewer = modelling.boosted_trees({**params, "n_estimators": 4}).fit(rows)
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in fewer.trees]
    assert cut.treeWeights == fewer.treeWeights and cut.getMaxIter() == 4 and cut.numFeatures == fewer.numFeatures
    scores = lambda model: [r[0] for r in model.transform(rows).select("probability").collect()]
    cut.write().save(f"{tmp_path}/cut")
    assert scores(cut) == scores(fewer) == scores(type(cut).load(f"{tmp_path}/cut"))


def test_a_search_fits_every_candidate_once_a_fold(spark, monkeypatch):
    """The best round's trees are taken from the fit that found them, and every candidate is judged on every fold."""
    fits, plain = [], modelling.boosted_trees
    monkeypatch.setattr(modelling, "boosted_trees", lambda params: fits.append(params) or plain(params))
    settings = modelling.TrainingSettings(features=["a", "b", "c"], keys=["k"], preprocessor=-1, sampling="none", params={"n_estimators": 4})
    best, params = modelling.search_params(boosting_rows(spark, 6_000), settings, draws=2, folds=3)
    assert len(fits) == 6 and 0.5 < best <= 1 and params in [{"n_estimators": 4, **p} for p in modelling.draw_params(2)]
