"""Small array building blocks used by the series features."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def total(values: Column, term: Callable[[Column], Column] | None = None) -> Column:
    """Sum of ``term(x)`` over an array of doubles."""
    step = (lambda acc, x: acc + x) if term is None else (lambda acc, x: acc + term(x))
    return F.aggregate(values, F.lit(0.0), step)


def count_where(values: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(values, test))


def shifted(values: Column, origin: Column) -> Column:
    """Deviations from ``origin``."""
    return F.transform(values, lambda x: x - origin)


def constants(values: Sequence[float]) -> Column:
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def summed(array: str, n: int, term: str) -> Column:
    """Sum of a SQL term over the n elements of an array column, written out.

    ``{x}`` stands for the element and ``{i}`` for its place. The written-out sum is plain generated code, without the
    boxed values of a lambda.
    """
    return F.expr(" + ".join(f"({term.format(x=f'get(`{array}`, {i})', i=i)})" for i in range(n)))


def dot(array: str, weights: Sequence[float]) -> Column:
    """Inner product of an array column with fixed weights of the same length; zero weights are left out."""
    used = [(i, float(w)) for i, w in enumerate(weights) if abs(w) > 1e-15]
    if not used:
        return F.lit(0.0)
    return F.expr(" + ".join(f"get(`{array}`, {i}) * {w!r}D" for i, w in used))


def tail(values: Column, n: int, m: int) -> Column:
    """Last ``m`` of ``n`` elements."""
    return values if m == n else F.slice(values, n - m + 1, m)


def pairwise(values: Column, n: int, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine(x_i, x_{i+1})`` for neighbouring elements; length n-1."""
    return F.zip_with(F.slice(values, 1, n - 1), F.slice(values, 2, n - 1), combine)


def differences(values: Column, n: int) -> Column:
    return pairwise(values, n, lambda a, b: b - a)


def median_sorted(ordered: Column, n: int) -> Column:
    """Median of an already sorted array of known length."""
    if n % 2:
        return F.get(ordered, n // 2)
    return (F.get(ordered, n // 2 - 1) + F.get(ordered, n // 2)) / 2


def quantile_sorted(ordered: Column, n: int, q: float) -> Column:
    """Linear-interpolated quantile of a sorted array of known length."""
    at = q * (n - 1)
    low = math.floor(at)
    high = min(low + 1, n - 1)
    weight = at - low
    return F.get(ordered, low) + (F.get(ordered, high) - F.get(ordered, low)) * weight


def ls_slope(array: str, points: Sequence[float]) -> Column:
    """Least-squares slope of the values on fixed points; exactly 0 on a constant row of integers."""
    centre = sum(points) / len(points)
    gaps = [p - centre for p in points]
    return dot(array, gaps) / sum(g * g for g in gaps)


def longest_run(values: Column, same: Callable[[Column, Column], Column], counts: Callable[[Column], Column]) -> Column:
    """Length of the longest run of neighbouring elements for which ``same`` holds and ``counts`` accepts the element."""
    start = F.struct(
        F.lit(None).cast("double").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        run = (
            F.when(~counts(x), F.lit(0))
            .when(acc["prev"].isNotNull() & same(acc["prev"], x), acc["run"] + 1)
            .otherwise(F.lit(1))
        )
        return F.struct(x.alias("prev"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(values, start, step, lambda acc: acc["best"])
