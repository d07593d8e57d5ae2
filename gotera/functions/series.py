"""Features of one contract's monthly series (array of doubles, oldest month first, no nulls).

Every function returns a column expression, so they all run inside one projection and add no shuffle.
``add_series_features`` stages the shared intermediates (slices, means, deviations) as columns of their own, so that
they are evaluated once per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gotera.functions import arrays as A

# Fixed values: (base months, evaluated months, threshold in percent) of the trend-drop flags.
TREND_DROPS = [
    (1, 4, 90), (1, 3, 90), (2, 3, 90), (1, 6, 90), (3, 3, 90),
    (6, 5, 10), (6, 6, 10), (6, 4, 10), (6, 1, 10), (5, 5, 10),
]
# Run lengths of the constant-consumption flags, and the months they look at.
CONSTANT_RUNS = [8, 9, 10, 3, 4, 5]
CONSTANT_MONTHS = 12
# The windows of the moment features.
MOMENT_WINDOWS = [3, 6, 12]
TREND_EPS = 1e-6
FLAT = 1e-14


def fill_gaps(raw: Column, n: int) -> Column:
    """Nearest older value, or the nearest newer one where nothing older exists."""
    def filled(i: int) -> Column:
        older = [F.get(raw, j) for j in range(i, -1, -1)]
        newer = [F.get(raw, j) for j in range(i + 1, n)]
        return F.coalesce(*older, *newer)

    return F.array(*[filled(i) for i in range(n)])


def null_count(raw: Column) -> Column:
    return A.count_where(raw, lambda x: x.isNull())


def mean_present(raw: Column) -> Column:
    """Mean of the non-null elements, null when there is none."""
    present = F.filter(raw, lambda x: x.isNotNull())
    return F.try_divide(A.total(present), F.size(present))


def trend_percentage(serie: Column, n: int, base: int, evaluated: int) -> Column:
    """100 times the mean of the last ``evaluated`` months over the mean of the ``base`` months before them."""
    recent = A.total(A.tail(serie, n, evaluated)) / evaluated
    before = A.total(F.slice(serie, n - evaluated - base + 1, base)) / base
    return recent * 100 / (before + TREND_EPS)


def trend_drop(percentage: Column, threshold: float) -> Column:
    return F.coalesce((F.lit(100.0) - percentage > threshold).cast("int"), F.lit(0))


def longest_constant_run(serie: Column) -> Column:
    return A.longest_run(serie, lambda a, b: a == b, lambda x: F.lit(True))


def longest_zero_run(serie: Column) -> Column:
    """Length of the longest run of at least two zeros, else 0."""
    run = A.longest_run(serie, lambda a, b: a == b, lambda x: x == 0)
    return F.when(run >= 2, run).otherwise(F.lit(0))


def zero_count(serie: Column) -> Column:
    return A.count_where(serie, lambda x: x == 0)


def sample_skewness(m: int, d2: Column, d3: Column) -> Column:
    """Bias-corrected skewness from the second and third central sums; 0 for a flat series."""
    factor = m * math.sqrt(m - 1) / (m - 2)
    return F.when(d2 < FLAT, F.lit(0.0)).otherwise(factor * d3 / F.pow(d2, F.lit(1.5)))


def sample_kurtosis(m: int, d2: Column, d4: Column) -> Column:
    """Bias-corrected excess kurtosis from the second and fourth central sums; 0 for a flat series."""
    lead = m * (m + 1) * (m - 1) / ((m - 2) * (m - 3))
    shift = 3 * (m - 1) ** 2 / ((m - 2) * (m - 3))
    return F.when(d2 < FLAT, F.lit(0.0)).otherwise(lead * d4 / (d2 * d2) - shift)


def row_minmax(serie: Column) -> Column:
    """Scale a row to [0, 1]; a constant row becomes zeros."""
    low, high = F.array_min(serie), F.array_max(serie)
    return F.transform(serie, lambda x: F.when(high == low, F.lit(0.0)).otherwise((x - low) / (high - low)))


def add_trend_drops(df: DataFrame, n: int, serie: str = "serie", drops: Sequence[tuple] = TREND_DROPS) -> DataFrame:
    cols = {
        f"trend_perc_{base}_{evaluated}": trend_drop(trend_percentage(F.col(serie), n, base, evaluated), threshold)
        for base, evaluated, threshold in drops
    }
    return df.withColumns(cols)


def add_constant_runs(df: DataFrame, n: int, serie: str = "serie", runs: Sequence[int] = CONSTANT_RUNS) -> DataFrame:
    """All flags come from one pass over the last twelve months."""
    if n < CONSTANT_MONTHS:
        raise ValueError(f"constant-run flags need at least {CONSTANT_MONTHS} months, got {n}")
    longest = longest_constant_run(A.tail(F.col(serie), n, CONSTANT_MONTHS))
    return (
        df.withColumn("_longest", longest)
        .withColumns({f"constant_{r}": (F.col("_longest") >= r).cast("int") for r in runs})
        .drop("_longest")
    )


def add_moments(df: DataFrame, n: int, serie: str = "serie", windows: Sequence[int] = MOMENT_WINDOWS) -> DataFrame:
    """Level, spread, shape, slope and zero features of the last m months for each window m."""
    if n < max(windows):
        raise ValueError(f"the moment windows need at least {max(windows)} months, got {n}")
    part = {m: F.col(f"_w{m}") for m in windows}
    df = df.withColumns({f"_w{m}": A.tail(F.col(serie), n, m) for m in windows})
    df = df.withColumns({f"mean_{m}": A.summed(f"_w{m}", m, "{x}") / m for m in windows})
    df = df.withColumns({
        f"_d{m}": A.shifted(part[m], F.col(f"mean_{m}")) for m in windows})
    sums = {}
    for m in windows:
        dev = f"_d{m}"
        for order in range(2, 5 if m > 3 else 4):
            sums[f"_d{order}_{m}"] = A.summed(dev, m, " * ".join(["{x}"] * order))
    df = df.withColumns(sums)
    out = {}
    for m in windows:
        d2 = F.col(f"_d2_{m}")
        out[f"cant_ceros_{m}"] = zero_count(part[m])
        out[f"max_cant_ceros_seg_{m}"] = longest_zero_run(part[m])
        out[f"slope_{m}"] = A.ls_slope(f"_w{m}", range(m))
        out[f"min_cons{m}"] = F.array_min(part[m])
        out[f"max_cons{m}"] = F.array_max(part[m])
        out[f"std_cons{m}"] = F.sqrt(d2 / (m - 1))
        out[f"var_cons{m}"] = d2 / (m - 1)
        out[f"skew_cons{m}"] = sample_skewness(m, d2, F.col(f"_d3_{m}"))
        if m > 3:
            out[f"kurt_cons{m}"] = sample_kurtosis(m, d2, F.col(f"_d4_{m}"))
    temps = [f"_w{m}" for m in windows] + [f"_d{m}" for m in windows] + list(sums)
    return df.withColumns(out).drop(*temps)


def moment_columns(windows: Sequence[int] = MOMENT_WINDOWS) -> list[str]:
    names = []
    for m in windows:
        names += [f"mean_{m}", f"cant_ceros_{m}", f"max_cant_ceros_seg_{m}", f"slope_{m}", f"min_cons{m}",
                  f"max_cons{m}", f"std_cons{m}", f"var_cons{m}", f"skew_cons{m}"]
        if m > 3:
            names.append(f"kurt_cons{m}")
    return names


def trend_columns(drops: Sequence[tuple] = TREND_DROPS) -> list[str]:
    return [f"trend_perc_{b}_{e}" for b, e, _ in drops]


def constant_columns(runs: Sequence[int] = CONSTANT_RUNS) -> list[str]:
    return [f"constant_{r}" for r in runs]
