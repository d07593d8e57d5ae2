import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from gotera.operators import forest, selection


def signal(spark, rows):
    made = spark.range(rows, numPartitions=2).select(
        (F.col("id") + 1).alias("_rank"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.floor(F.rand(3) * 5).cast("double").alias("c"))
    return made.withColumn("target", (F.col("a") + F.col("c") * 0.3 + F.rand(5) * 0.5 > 1).cast("int")).cache()


def test_importances_equal_those_of_sparks_forest(spark):
    rows = signal(spark, 40_000)
    one = rows.where("target = 1").count()
    weights = [40_000 / (2 * (40_000 - one)), 40_000 / (2 * one)]
    shifts = [[selection.shadow_shift(f, 40_000, 0) for f in "abc"]]
    got = forest.importances_beside_shadows(rows, list("abc"), "target", (40_000 - one, one), weights, shifts, 10, 6)[0]
    beside = selection.with_shadows(rows, list("abc"), 40_000, 0).withColumns({
        "noise": F.rand(7), "weight": F.when(F.col("target") == 1, weights[1]).otherwise(weights[0])})
    inputs = ["a", "b", "c", "noise", "shadow_a", "shadow_b", "shadow_c"]
    vectors = VectorAssembler(inputCols=inputs, outputCol="v").transform(beside)
    fitted = RandomForestClassifier(featuresCol="v", labelCol="target", weightCol="weight", maxDepth=6, numTrees=10, seed=1).fit(vectors)
    assert got.sum() == pytest.approx(1)
    assert np.abs(got - fitted.featureImportances.toArray()).max() < 0.08


@pytest.mark.parametrize("block_rows", [64, 100, 4096])
def test_block_shadows_are_the_shadows(spark, monkeypatch, block_rows):
    monkeypatch.setattr(forest, "BLOCK_ROWS", block_rows)
    rows = signal(spark, 500).withColumns({"_bin_0": F.col("_rank") % 7, "_bin_1": F.col("_rank") % 31})
    shifts = [[selection.shadow_shift(f, 500, run) for f in ("_bin_0", "_bin_1")] for run in range(2)]
    tables = forest.with_shifted(forest.blocks(rows, 2, "target", 500), 2, 500, shifts).collect()
    for run in range(2):
        got = np.hstack([np.frombuffer(r["cells"], np.uint8).reshape(5, -1) for r in sorted(tables, key=lambda r: r["block"]) if r["run"] == run])
        wanted = selection.with_shadows(rows, ["_bin_0", "_bin_1"], 500, run).orderBy(F.col("_rank") % 500).select(
            "target", "_bin_0", "_bin_1", "shadow__bin_0", "shadow__bin_1").collect()
        assert got.T.tolist() == [list(r) for r in wanted]


def test_more_runs_are_no_more_jobs(spark):
    """All forests grow together; before, each run was a join, a checkpoint and a forest of its own."""
    rows = signal(spark, 300)

    def jobs(runs):
        spark.sparkContext.setJobGroup(f"runs{runs}", "")
        votes = selection.forest_votes(rows, ["a", "b"], ["_rank"], runs=runs, trees=2, depth=2)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return votes, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"runs{runs}"))

    (few, jobs_few), (many, jobs_many) = jobs(1), jobs(6)
    assert few["a"] == 1 and many["a"] == 6 and jobs_many <= jobs_few + 3


def test_odd_columns(spark):
    """A constant feature and one of few values never stop the run; a missing target does."""
    rows = signal(spark, 200).withColumns({"flat": F.lit(3.0), "holes": F.when(F.col("_rank") % 3 > 0, F.col("c"))})
    votes = selection.forest_votes(rows, ["a", "flat", "holes"], ["_rank"], runs=2, trees=3, depth=3)
    assert votes["flat"] == 0 and votes["a"] == 2
    with pytest.raises(ValueError, match="target"):
        selection.forest_votes(rows.withColumn("target", F.when(F.col("a") > 0.5, 1)), ["a"], ["_rank"], runs=1, trees=1)


def test_split_points():
    assert forest.split_points([1, 2, 2, 3]) == [2, 3]
    assert forest.split_points([4.0]) == [] and forest.split_points([]) == []
    wide = forest.split_points(list(range(1000)))
    assert 30 <= len(wide) <= 32 and max(np.diff(wide)) < 40
    assert len(forest.split_points([0] * 970 + list(range(1, 41)))) >= 30
