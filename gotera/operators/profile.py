"""Contract profile inside a window: monthly means, distinct values, change counts and latest attributes.

Rows of one contract are ordered by (date, file month, pos). The order-dependent parts are worked out in two steps, so
that no task ever sees all rows of a hot contract:

1. *pieces*: rows are shuffled by (contrato, date, file month, run of pos). A piece is a run of consecutive rows of at
   most ``2**chunk_bits`` positions; inside it the changes are counted and the first and last values kept.
2. the pieces (usually one per contract and month) are placed by contrato; each learns the value before it, and every
   later step runs on that placement without another shuffle. For many cutoffs the pieces become one row per month, and
   each month hands out the windows in which it is the newest month, with frames over the n rows up to it: no row is
   repeated per window, and nothing is sorted again.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gotera.operators.cutoffs import month_number, opened_months, slice_windows, within_reach
from gotera.operators.skew import broadcast_if_small
from gotera.schemas import DEFAULT_PERIODS, STATIC, TRACKED, period_columns

CHUNK_BITS = 20
PIECE_KEYS = ["contrato", "date", "file_month", "chunk"]


def _last_before(value: Column, window) -> Column:
    return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))


def _differs(value: Column, before: Column) -> Column:
    """1 when both are known and differ."""
    return F.coalesce((value != before).cast("int"), F.lit(0))


def pieces(rows: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Step 1: one row per run of consecutive rows of a contract, month and file."""
    columns = ["contrato", "date", "file_month", "pos", "consumo", *dict.fromkeys(TRACKED + STATIC)]
    # one sort serves the turns and the grouping; left to themselves, the sets and firsts are sorted on both sides of the shuffle
    rows = rows.select(*columns).withColumn("chunk", F.shiftright("pos", chunk_bits)).repartition(
        *PIECE_KEYS).sortWithinPartitions(*PIECE_KEYS, "pos")
    order = Window.partitionBy(*PIECE_KEYS).orderBy("pos")
    rows = rows.withColumns({f"_turn_{a}": _differs(F.col(a), _last_before(F.col(a), order)) for a in TRACKED})
    aggs = [
        F.sum("consumo").alias("consumo"),
        F.count("consumo").alias("readings"),
        F.min_by(F.struct(*STATIC), "pos").alias("static"),
    ]
    for a in TRACKED:
        known = F.when(F.col(a).isNotNull(), F.col("pos"))
        aggs += [
            F.collect_set(a).alias(f"values_{a}"),
            F.min_by(a, known).alias(f"first_{a}"),
            F.max_by(a, known).alias(f"last_{a}"),
            F.sum(f"_turn_{a}").alias(f"turns_{a}"),
        ]
    return rows.groupBy(*PIECE_KEYS).agg(*aggs)


def placed_pieces(rows: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Step 2: pieces placed by contrato; ``enters_a`` is 1 where a piece starts with another value than the one before.

    The first piece with a value counts as entered; a window subtracts the entry of its own first piece, so what lies
    before the window does not matter.
    """
    order = Window.partitionBy("contrato").orderBy("date", "file_month", "chunk")
    # sorted here, so that what follows aggregates and slides in this order whether or not the entries are asked for
    placed = pieces(rows, chunk_bits).repartition("contrato").sortWithinPartitions(
        "contrato", "date", "file_month", "chunk")
    enters = {}
    for a in TRACKED:
        first, before = F.col(f"first_{a}"), _last_before(F.col(f"last_{a}"), order)
        enters[f"enters_{a}"] = F.when(first.isNull(), F.lit(0)).when(before.isNull(), F.lit(1)).otherwise(
            _differs(first, before))
    return placed.withColumns(enters)


def change_count(attribute: str, at: Column) -> Column:
    """Changes of an attribute over the pieces of a window, -1 when it has no value at all."""
    enters = F.col(f"enters_{attribute}")
    known = F.when(F.col(f"first_{attribute}").isNotNull(), at)
    moves = F.sum(F.col(f"turns_{attribute}") + enters) - F.min_by(enters, known)
    return F.coalesce(moves, F.lit(-1)).cast("bigint")


def distinct_count(attribute: str) -> Column:
    return F.size(F.array_distinct(F.flatten(F.collect_list(f"values_{attribute}")))).cast("bigint")


def month_mean(k: int) -> Column:
    """Mean of all readings k months before the cutoff, null without readings."""
    total = F.sum(F.when(F.col("k") == k, F.col("consumo")))
    readings = F.sum(F.when(F.col("k") == k, F.col("readings")))
    return F.try_divide(total, readings)


def window_aggregates(n: int = DEFAULT_PERIODS) -> dict[str, Column]:
    """Everything a window profile holds, as aggregates over its pieces; unused ones are pruned by the optimizer."""
    at = F.struct("date", "file_month", "chunk")
    newest_first_piece = F.struct(F.col("date"), -F.col("file_month"), -F.col("chunk"))
    out = {name: month_mean(k) for name, k in zip(period_columns(n), range(n, 0, -1))}
    out["static"] = F.max_by("static", newest_first_piece)
    for a in TRACKED:
        out[f"cant_{a}"] = distinct_count(a)
        out[f"cambios_{a}"] = change_count(a, at)
    return out


def _finish(profile: DataFrame, keys: Sequence[str], extra: Sequence[str], n: int, keep_empty: bool) -> DataFrame:
    months = period_columns(n)
    if not keep_empty:
        profile = profile.where(F.coalesce(*[F.col(f"`{m}`") for m in months]).isNotNull())
    counts = [f"cant_{a}" for a in TRACKED] + [f"cambios_{a}" for a in TRACKED]
    return profile.select(
        *keys,
        F.array(*[F.col(f"`{m}`") for m in months]).alias("serie_raw"),
        *counts,
        *[F.col(f"static.{c}").alias(c) for c in STATIC],
        *extra,
    )


def month_rows(placed: DataFrame) -> DataFrame:
    """One row per contract and month, of placed pieces: grouped in the order that they already have.

    A window over many cutoffs holds whole months, so dates that are no month start are in none.
    """
    at = F.struct("file_month", "chunk")
    aggs = [
        F.try_divide(F.sum("consumo"), F.sum("readings")).alias("mean"),
        F.max_by("static", F.struct(-F.col("file_month"), -F.col("chunk"))).alias("static"),
    ]
    for a in TRACKED:
        enters = F.col(f"enters_{a}")
        known = F.when(F.col(f"first_{a}").isNotNull(), at)
        aggs += [
            F.array_distinct(F.flatten(F.collect_list(f"values_{a}"))).alias(f"values_{a}"),
            F.sum(F.col(f"turns_{a}") + enters).alias(f"moves_{a}"),
            F.min_by(enters, known).alias(f"entry_{a}"),
        ]
    return placed.where(F.col("date") == F.trunc("date", "MM")).groupBy("contrato", "date").agg(*aggs)


def sliding_profiles(months: DataFrame, cutoffs: Sequence[dt.date], n: int, keep_empty: bool) -> DataFrame:
    """Profiles of many cutoffs: each month opens the windows in which it is the newest (``opened_months``).

    A month row sees the n - 1 rows before it; a window takes those of its own months. The means stand in plain columns,
    the rest in frames; they are separate columns, so that unused ones are pruned.
    """
    along = Window.partitionBy("contrato").orderBy("date")
    frame = along.rowsBetween(-(n - 1), 0)
    number = month_number(F.col("date")).alias("number")
    months = months.withColumn("_number_0", number).withColumnRenamed("mean", "_mean_0")
    frames = {}
    for j in range(1, n):
        frames[f"_number_{j}"] = F.lag("_number_0", j).over(along)
        frames[f"_mean_{j}"] = F.lag("_mean_0", j).over(along)
    for a in TRACKED:
        frames[f"_values_{a}"] = F.collect_list(F.struct(number, F.col(f"values_{a}").alias("values"))).over(frame)
        frames[f"_moves_{a}"] = F.collect_list(
            F.struct(number, F.col(f"moves_{a}").alias("moves"), F.col(f"entry_{a}").alias("entry"))).over(frame)
    opened = months.withColumns({"_opened": opened_months(["contrato"], n), **frames})
    wanted = F.filter("_opened", lambda c: c.isin(list(cutoffs)))
    windows = opened.select(
        "contrato", F.explode(wanted).alias("cutoff"), "static", "_number_0", "_mean_0", *frames
    ).withColumn("_end", month_number(F.col("cutoff")))
    end = F.col("_end")

    def inside(name: str, test=lambda x: F.lit(True)) -> Column:
        return F.filter(name, lambda x: (x["number"] >= end - n) & test(x))

    def mean_before(k: int) -> Column:
        """The mean k months before the cutoff: at least j months lie between the j-th row back and the newest one."""
        return F.coalesce(*[F.when(F.col(f"_number_{j}") == end - k, F.col(f"_mean_{j}")) for j in range(k)])

    if not keep_empty:
        read = [(F.col(f"_number_{j}") >= end - n) & F.col(f"_mean_{j}").isNotNull() for j in range(n)]
        windows = windows.where(functools.reduce(Column.__or__, read))
    counts = {}
    for a in TRACKED:
        values = F.flatten(F.transform(inside(f"_values_{a}"), lambda x: x["values"]))
        counts[f"cant_{a}"] = F.size(F.array_distinct(values)).cast("bigint")
    for a in TRACKED:
        moves = F.aggregate(inside(f"_moves_{a}"), F.lit(0).cast("bigint"), lambda total, x: total + x["moves"])
        entry = F.get(inside(f"_moves_{a}", lambda x: x["entry"].isNotNull()), F.lit(0))["entry"]
        counts[f"cambios_{a}"] = F.coalesce(moves - entry, F.lit(-1)).cast("bigint")
    return windows.select(
        "contrato", "cutoff",
        F.array(*[mean_before(k) for k in range(n, 0, -1)]).alias("serie_raw"),
        *[col.alias(name) for name, col in counts.items()],
        *[F.col(f"static.{c}").alias(c) for c in STATIC],
    )


def window_profiles(
    rows: DataFrame,
    cutoffs: Sequence[dt.date],
    n: int = DEFAULT_PERIODS,
    keep_empty: bool = False,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """One row per (contrato, cutoff) for every contract of each window.

    Contracts without any reading in the window are left out unless ``keep_empty``.
    """
    placed = placed_pieces(within_reach(rows, cutoffs, n), chunk_bits)
    if len(cutoffs) > 1:
        return sliding_profiles(month_rows(placed), cutoffs, n, keep_empty)
    sliced = slice_windows(placed, cutoffs, n)
    aggs = [col.alias(name) for name, col in window_aggregates(n).items()]
    return _finish(sliced.groupBy("contrato", "cutoff").agg(*aggs), ["contrato", "cutoff"], [], n, keep_empty)


def target_profiles(
    rows: DataFrame,
    targets: DataFrame,
    cutoffs: Sequence[dt.date],
    n: int = DEFAULT_PERIODS,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """One row per target ``(contrato, cutoff, label)`` with readings in its window; ``label`` is carried along.

    The targets of a contract (at most one per cutoff) meet its placed pieces on contrato alone, so the pieces are not
    shuffled again, and only pieces inside a target's window go on. Rows in no target's window are left out before they are
    sorted and shuffled: a window counts changes from its own first piece on, so what lies outside does not matter.
    """
    per_contract = targets.groupBy("contrato").agg(F.collect_list(F.struct("cutoff", "label")).alias("targets"))

    def covers(target: Column) -> Column:
        return (F.col("date") < target["cutoff"]) & (F.col("date") >= F.add_months(target["cutoff"], -n))

    asked = broadcast_if_small(per_contract.select("contrato", F.col("targets.cutoff").alias("_asked")))
    inside = F.exists("_asked", lambda c: (F.col("date") < c) & (F.col("date") >= F.add_months(c, -n)))
    wanted = within_reach(rows, cutoffs, n).join(asked, "contrato").where(inside).drop("_asked")
    joined = placed_pieces(wanted, chunk_bits).join(per_contract, "contrato")

    sliced = joined.withColumn("target", F.explode(F.filter("targets", covers))).drop("targets")
    sliced = sliced.withColumns({
        "cutoff": F.col("target.cutoff"),
        "k": (F.year("target.cutoff") - F.year("date")) * 12 + F.month("target.cutoff") - F.month("date"),
    })
    aggs = [col.alias(name) for name, col in window_aggregates(n).items()]
    profile = sliced.groupBy("contrato", "cutoff").agg(*aggs, F.any_value("target.label").alias("label"))
    return _finish(profile, ["contrato", "cutoff"], ["label"], n, keep_empty=False)
