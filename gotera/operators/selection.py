"""Feature selection: by correlation, by near-constancy, and by repeated forest rankings."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window, functions as F

from gotera.operators import forest
from gotera.operators.durable import settle, stored
from gotera.operators.sampling import class_sizes
from gotera.operators.skew import stable_hash, with_hash_rank

METHODS = ("pearson", "spearman")
# Distinct values whose ranks are broadcast, over all columns; a column beyond that is joined by value.
LOOKUP_VALUES = 500_000
# Ranks of more columns than this are left to Spark, which shuffles single values; a join by value moves whole rows.
JOINED_RANKS = 16


def _missing(df: DataFrame, columns: Sequence[str]) -> set[str]:
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(columns)]).head()
    return {c for i, c in enumerate(columns) if row[f"m{i}"]}


def _matrix(numbers: DataFrame, columns: Sequence[str], method: str) -> dict[tuple[str, str], float]:
    """Columns without missing values, over assembled vectors."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(numbers).select("_v")
    matrix = Correlation.corr(vectors, "_v", method).head()[0]
    return {(a, b): float(matrix[i, j]) for (i, a), (j, b) in combinations(enumerate(columns), 2)}


def _pairwise_pearson(numbers: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], float]:
    """Each pair over the rows that have both values, all pairs in one pass.

    The sums of a pair (counts, values, squares, products over the common rows) are entries of the Gram matrix of the
    centred values, their squares and the presence flags.
    """
    size = len(columns)
    means = numbers.agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(columns)]).head()
    centred = [F.col(f"`{c}`") - F.lit(means[f"m{i}"] or 0.0) for i, c in enumerate(columns)]
    parts = [F.coalesce(x, F.lit(0.0)) for x in centred] + [F.coalesce(x * x, F.lit(0.0)) for x in centred] + [
        x.isNotNull().cast("double") for x in centred]
    vectors = numbers.select(array_to_vector(F.array(*parts)).alias("_v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "_v")).computeGramianMatrix().toArray()
    out = {}
    for (i, a), (j, b) in combinations(enumerate(columns), 2):
        n = gram[2 * size + i, 2 * size + j]
        sum_a, sum_b = gram[i, 2 * size + j], gram[j, 2 * size + i]
        var_a = gram[size + i, 2 * size + j] - sum_a * sum_a / n if n else 0.0
        var_b = gram[size + j, 2 * size + i] - sum_b * sum_b / n if n else 0.0
        scale = math.sqrt(var_a * var_b) if var_a > 0 and var_b > 0 else 0.0
        out[a, b] = (gram[i, j] - sum_a * sum_b / n) / scale if n > 1 and scale > 0 else float("nan")
    return out


def _centred_ranks(numbers: DataFrame, columns: int) -> DataFrame:
    """(number, value, centred): of each column ``v<number>`` the distinct values with their mean rank, less that of all rows.

    Values are counted first, dealt to ranges of (number, value) and summed up inside them; the sums of the ranges below
    (one row per range) are broadcast.
    """
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("number"), F.col(f"v{i}").alias("value")) for i in range(columns)]))
    counted = numbers.select(entries.alias("e")).select("e.*").groupBy("number", "value").agg(F.count("*").alias("n"))
    ranged = stored(counted.repartitionByRange("number", "value").withColumn("part", F.spark_partition_id()))
    lower = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("number", "part").agg(F.sum("n").alias("rows")).select(
        "number", "part", F.coalesce(F.sum("rows").over(lower), F.lit(0)).alias("start"),
        F.sum("rows").over(Window.partitionBy("number")).alias("total"))
    inside = Window.partitionBy("number", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return ranged.join(F.broadcast(starts), ["number", "part"]).select(
        "number", "value", (before + (F.col("n") - F.col("total")) / 2).alias("centred"))


def _rank_matrix(numbers: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], float]:
    """Spearman correlations of columns without missing values; equal values share their mean rank.

    The distinct values are ranked, not the rows. The ranks of a column with few values are looked up; only a column with
    many values costs a shuffle of the rows. The sums of products of all pairs are one pass.
    """
    size = len(columns)
    if size > JOINED_RANKS or len(numbers.head(2)) < 2:
        return _matrix(numbers, columns, "spearman")
    rows = numbers.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])
    ranks = stored(_centred_ranks(rows, size))
    held = 0
    for r in sorted(ranks.groupBy("number").count().collect(), key=lambda r: (r["count"], r["number"])):
        i = r["number"]
        held += r["count"]
        lookup = ranks.where(F.col("number") == i).select(F.col("value").alias(f"v{i}"), F.col("centred").alias(f"r{i}"))
        rows = rows.join(F.broadcast(lookup) if held <= LOOKUP_VALUES else lookup, f"v{i}").drop(f"v{i}")
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = rows.agg(*[F.sum(F.col(f"r{i}") * F.col(f"r{j}")).alias(f"s{i}_{j}") for i, j in pairs]).head()
    scale = [math.sqrt(found[f"s{i}_{i}"]) for i in range(size)]
    return {(a, b): found[f"s{i}_{j}"] / (scale[i] * scale[j]) if scale[i] and scale[j] else float("nan")
            for (i, a), (j, b) in combinations(enumerate(columns), 2)}


def correlations(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> dict[tuple[str, str], float]:
    """Correlation of every pair of columns (features squared numbers, whatever the row count); nan where undefined.

    Nulls and nan are missing, and a pair is correlated over the rows that have both. For ranks that means ranking those
    rows anew, so each pair with a column that has missing values is a job of its own.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    columns = list(columns)
    numbers = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    missing = _missing(numbers, columns)
    if not missing:
        out = _matrix(numbers, columns, method) if method == "pearson" else _rank_matrix(numbers, columns)
    elif method == "pearson":
        out = _pairwise_pearson(numbers, columns)
    else:
        numbers = settle(numbers)
        whole = [c for c in columns if c not in missing]
        out = _rank_matrix(numbers, whole) if len(whole) > 1 else {}
        for a, b in combinations(columns, 2):
            if (a, b) not in out:
                both = numbers.select(F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b")).dropna()
                out[a, b] = _rank_matrix(both, ["a", "b"])["a", "b"] if len(both.head(2)) == 2 else float("nan")
    return out | {(b, a): value for (a, b), value in out.items()}


def correlation_table(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """The correlation matrix in long form, each pair once."""
    matrix = correlations(df, columns, method)
    rows = [(a, b, matrix[a, b]) for a, b in combinations(list(columns), 2)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, correlation double")


def select_by_correlation(
    df: DataFrame, features: Sequence[str], target: str = "target", threshold: float = 0.9, method: str = "pearson"
) -> list[str]:
    """Of every strongly correlated pair, drop the feature less correlated with the target; ties keep both."""
    matrix = correlations(df, [*features, target], method)
    dropped = set()
    for a, b in combinations(features, 2):
        if abs(matrix[a, b]) > threshold:
            left, right = abs(matrix[a, target]), abs(matrix[b, target])
            # an undefined strength (nan) is neither weaker nor stronger
            if left < right:
                dropped.add(a)
            elif right < left:
                dropped.add(b)
    return [f for f in features if f not in dropped]


def top_shares(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Share of all rows the most frequent non-null value of each feature has (0 for an all-null feature)."""
    total = df.count()
    entries = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("string").alias("value")) for f in features])
    counts = df.select(F.explode(entries).alias("e")).select("e.*").groupBy("feature", "value").agg(
        F.count("value").alias("rows"))
    share = F.max("rows") / F.lit(max(total, 1))
    return counts.groupBy("feature").agg(share.alias("top_share"))


def select_by_constancy(df: DataFrame, features: Sequence[str], threshold: float = 0.99) -> list[str]:
    """Drop features whose most frequent value covers more than ``threshold`` of the rows."""
    shares = {r["feature"]: r["top_share"] for r in top_shares(df, features).collect()}
    return [f for f in features if shares.get(f, 0.0) <= threshold]


def shadow_shift(feature: str, rows: int, run: int) -> int:
    """How many places of the hash order a feature's shadow lies further on: another number for each feature and run."""
    drawn = hashlib.md5(f"shadow{run}|{feature}".encode(), usedforsecurity=False).hexdigest()
    return 1 + int(drawn, 16) % max(rows - 1, 1)


def with_shadows(ranked: DataFrame, features: Sequence[str], rows: int, run: int) -> DataFrame:
    """Add ``shadow_<f>``: each feature's values of the rows that lie a shift of its own further in one fixed hash order.

    Features get different shifts, so their shadows are shuffled against each other too, not only against the rows. All
    values travel in one shuffle, by the place that they go to. ``forest_votes`` shifts whole blocks of bins instead.
    """
    size = F.lit(max(rows, 1))
    moved = F.explode(F.array(*[
        F.struct(F.pmod(F.col("_rank") + shadow_shift(f, rows, run), size).alias("_at"), F.lit(i).alias("number"),
                 F.col(f"`{f}`").alias("value"))
        for i, f in enumerate(features)]))
    other = ranked.select(moved.alias("m")).groupBy(F.col("m._at").alias("_at")).agg(*[
        F.max(F.when(F.col("m.number") == i, F.col("m.value"))).alias(f"shadow_{f}") for i, f in enumerate(features)])
    return ranked.withColumn("_at", F.pmod(F.col("_rank"), size)).join(other, "_at").drop("_at")


def forest_votes(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    target: str = "target",
    runs: int = 10,
    trees: int = 20,
    depth: int = 8,
) -> dict[str, int]:
    """In how many of the runs a feature outranks a random column and every shuffled copy, in a class-balanced forest.

    Missing values are filled with the feature's median. The filled table is ranked once in hash order; each run shifts
    the features along that order, and the forests of all runs grow together (``forest.importances``).
    """
    features = list(features)
    total = df.count()
    zero, one = class_sizes(df, target)
    if zero + one != total or not total:
        raise ValueError("every row needs a target of 0 or 1, and there must be rows")
    weights = [total / (2 * max(zero, 1)), total / (2 * max(one, 1))]
    numbers = df.select(*keys, F.col(target), *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    filled = Imputer(strategy="median", inputCols=features, outputCols=[f"_filled_{f}" for f in features]).fit(numbers)
    ready = filled.transform(numbers).select(
        F.col(target).cast("int").alias(target), stable_hash(*keys, seed="shadow").alias("_h"),
        *[F.coalesce(f"`_filled_{f}`", F.lit(0.0)).alias(f) for f in features])
    ranked = settle(with_hash_rank(ready, "_h", "_rank").drop("_h"))
    shifts = [[shadow_shift(f, total, run) for f in features] for run in range(runs)]
    found = forest.importances_beside_shadows(ranked, features, target, (zero, one), weights, shifts, trees, depth)
    won = (found[:, :len(features)] > found[:, len(features):].max(axis=1, keepdims=True)).sum(axis=0)
    return {f: int(votes) for f, votes in zip(features, won)}


def select_by_forest(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], target: str = "target", runs: int = 10, **options
) -> list[str]:
    """Features that win in at least half of the runs."""
    votes = forest_votes(df, features, keys, target, runs, **options)
    return [f for f in features if votes[f] >= runs // 2]
