import datetime as dt
import random

import pytest
from helpers import as_set, rows, sorted_rows
from pyspark.sql import functions as F

from gotera import catalog
from gotera.operators import cutoffs as windows, profile, wide
from gotera.operators.population import contract_sums, population_stats
from gotera.session import configure

JAN = dt.date(2024, 1, 1)


def one(spark, data, **options):
    made = profile.window_profiles(rows(spark, data), [JAN], **options)
    return {r["contrato"]: r.asDict(recursive=True) for r in made.collect()}


def test_window_is_half_open_and_duplicates_are_averaged(spark):
    out = one(spark, [
        {"contrato": "a", "date": "2022-12-01", "consumo": 99.0}, {"contrato": "a", "date": "2023-01-01", "consumo": 7.0},
        {"contrato": "a", "date": "2023-12-01", "consumo": 1.0}, {"contrato": "a", "date": "2023-12-01", "consumo": 3.0},
        {"contrato": "a", "date": "2023-12-01", "consumo": None}, {"contrato": "a", "date": "2024-01-01", "consumo": 99.0}])
    assert out["a"]["serie_raw"] == [7.0, *[None] * 10, 2.0]


def test_contract_without_readings_counts_in_population_only(spark):
    data = [{"contrato": "a", "date": "2023-10-01", "consumo": 4.0, "categoria": "X"},
            {"contrato": "b", "date": "2023-10-01", "consumo": None, "categoria": "X"},
            {"contrato": "c", "date": "2023-10-01", "consumo": 9.0, "categoria": None}]
    assert set(one(spark, data)) == {"a", "c"}
    assert set(one(spark, data, keep_empty=True)) == {"a", "b", "c"}
    stats = population_stats(rows(spark, data), [JAN]).collect()
    assert [(r["categoria"], r["consumo_12m_ts_mean"], r["consumo_12m_ts_max"]) for r in stats] == [("X", 2.0, 4.0)]


@pytest.mark.parametrize("cutoffs", [[JAN], [JAN, dt.date(2024, 2, 1)]])
def test_contract_without_recent_rows_is_absent_not_zero(spark, cutoffs):
    data = [{"contrato": "a", "date": "2023-02-01", "consumo": 10.0, "categoria": "X"},
            {"contrato": "b", "date": "2023-12-01", "consumo": 4.0, "categoria": "X"}]
    row = population_stats(rows(spark, data), cutoffs).where(F.col("cutoff") == JAN).head()
    assert row["consumo_12m_ts_mean"] == 7.0 and row["consumo_3m_ts_mean"] == 4.0 and row["consumo_6m_ts_max"] == 4.0


def test_change_counts(spark):
    states = ["a", None, "a", "b", "a"]
    data = [{"contrato": "m", "date": f"2023-0{i + 1}-01", "consumo": 1.0, "estado": s, "categoria": "k" if i == 2 else None}
            for i, s in enumerate(states)]
    row = one(spark, data)["m"]
    assert row["cambios_estado"] == 2 and row["cambios_categoria"] == 0 and row["cambios_determinacion_consumo"] == -1
    assert row["cant_estado"] == 2 and row["cant_categoria"] == 1 and row["cant_determinacion_consumo"] == 0


def test_order_inside_a_month_is_file_then_position(spark):
    data = [{"contrato": "m", "date": "2023-05-01", "consumo": 1.0, "estado": s, "barrio": s, "pos": p, "file_month": f}
            for s, p, f in [("x", 9, 202305), ("y", 1, 202306), ("y", 3, 202305), ("x", 5, 202305), ("x", 7, 202305)]]
    row = one(spark, data)["m"]
    assert row["cambios_estado"] == 2  # y, x, x, x, then y of the later file
    assert row["barrio"] == "y"        # first row of the latest month


def test_window_start_does_not_see_older_values(spark):
    data = [{"contrato": "m", "date": "2022-12-01", "consumo": 1.0, "estado": "a"},
            {"contrato": "m", "date": "2023-01-01", "consumo": 1.0, "estado": "b"},
            {"contrato": "m", "date": "2023-06-01", "consumo": 1.0, "estado": "c"}]
    made = profile.window_profiles(rows(spark, data), [dt.date(2023, 12, 1), JAN])
    assert {(r["cutoff"], r["cambios_estado"]) for r in made.collect()} == {(dt.date(2023, 12, 1), 2), (JAN, 1)}


def test_pieces_of_any_size_give_the_same_profiles(spark, consumption):
    hot = consumption.withColumns({
        "contrato": F.when(F.col("pos") % 3 == 0, F.lit("hot")).otherwise(F.col("contrato"))})
    hot = hot.withColumn("pos", F.hash("pos", "contrato").cast("bigint") + F.lit(2 ** 31))
    whole = profile.window_profiles(hot, [dt.date(1999, 1, 1)], chunk_bits=62)
    split = profile.window_profiles(hot, [dt.date(1999, 1, 1)], chunk_bits=24)
    assert sorted_rows(whole) == sorted_rows(split)


def brute_change_count(values):
    known = [v for v in values if v is not None]
    return sum(a != b for a, b in zip(known, known[1:])) if known else -1


def test_change_counts_match_brute_force(spark, consumption):
    made = {r["contrato"]: r for r in profile.window_profiles(
        consumption, [dt.date(1999, 1, 1)], keep_empty=True, chunk_bits=45).collect()}
    frame = consumption.where("date >= '1998-01-01' and date < '1999-01-01'").toPandas()
    frame = frame.sort_values(["contrato", "date", "file_month", "pos"])
    for contract, group in frame.groupby("contrato"):
        for a in ("categoria", "estado", "determinacion_consumo"):
            values = [None if v != v else v for v in group[a]]
            assert made[contract][f"cambios_{a}"] == brute_change_count(values)
            assert made[contract][f"cant_{a}"] == len({v for v in values if v is not None})


def test_many_cutoffs_equal_single_runs(spark, consumption, labels):
    cutoffs = ["1999-01-01", "1999-02-01", "1999-03-01"]
    together = wide.train_wide(consumption, labels, cutoffs, 12, 5, 45)
    single = None
    for c in cutoffs:
        part = wide.train_wide(consumption, labels, [c], 12, 5, 45)
        single = part if single is None else single.unionByName(part)
    assert sorted_rows(together) == sorted_rows(single)


def test_rows_from_the_cutoff_on_change_nothing(spark, consumption):
    cut = "1999-01-01"
    later = consumption.where(F.col("date") >= cut).withColumn("consumo", F.lit(1000.0))
    before = consumption.where(F.col("date") < cut)
    assert sorted_rows(wide.inference_wide(before, cut, chunk_bits=45)) == sorted_rows(
        wide.inference_wide(before.unionByName(later), cut, chunk_bits=45))


def test_allow_list_keeps_the_population(spark, consumption):
    allowed = spark.createDataFrame([("000000011",), ("000000012",)], "contrato string")
    some = wide.inference_wide(consumption, "1999-01-01", contracts=allowed, chunk_bits=45)
    every = wide.inference_wide(consumption, "1999-01-01", chunk_bits=45)
    assert sorted_rows(some) == sorted_rows(every.join(allowed, "contrato", "left_semi"))


def test_negatives_are_uninspected_and_limited(spark, consumption, labels):
    months = windows.cutoff_list(["1999-01-01", "1999-02-01"])
    drawn = wide.negative_sample(consumption, labels, months, 7)
    inspected = as_set(labels.select("contrato", F.col("date").alias("cutoff")), "contrato", "cutoff")
    picked = drawn.collect()
    assert len(picked) == 14 and not {(r["contrato"], r["cutoff"]) for r in picked} & inspected


def test_cutoffs():
    assert windows.window_bounds("2025-06-15") == (dt.date(2024, 6, 1), dt.date(2025, 6, 1))
    assert windows.shift_months(dt.date(2025, 3, 1), -12) == dt.date(2024, 3, 1)
    for bad in ("2025-6-1", "20250601", "2025-13-01", "", None):
        with pytest.raises(ValueError):
            windows.month_start(bad)


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date")
    assert tuple(df.select(*wide.calendar_features(F.col("d")).values()).head()) == (12, 4, 1)


def test_the_profile_plan_has_two_data_shuffles_and_no_nested_loop(spark):
    data = rows(spark, [{"contrato": "a", "date": "1998-10-01", "consumo": 4.0}])
    made = profile.window_profiles(data, windows.cutoff_list(["1999-01-01", "1999-02-01"]))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profiles_of_many_cutoffs_repeat_no_row_per_window(spark):
    data = rows(spark, [{"contrato": "a", "date": "1998-10-01", "consumo": 4.0}])
    plan = executed(profile.window_profiles(data, windows.cutoff_list(["1999-01-01", "1999-02-01"])))
    assert "explode(sequence" not in plan and "explode([1" not in plan
    assert plan.count("Sort [") == 2  # one after each shuffle: rows of a piece, pieces of a contract


@pytest.mark.parametrize("keep_empty", [True, False])
def test_sliding_profiles_equal_single_windows(spark, keep_empty):
    """Gaps, nulls everywhere, several files and pieces a month, dates inside a month, null contracts."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        month = rng.choice([1, 2, 3, 14, 15, 20, 21, 22, 23, 24])
        date = dt.date(2021 + (month - 1) // 12, (month - 1) % 12 + 1, 1)
        data.append({
            "contrato": rng.choice(["a", "b", "c", "d", None]), "date": date, "pos": i * 7 % 911,
            "file_month": rng.choice([202201, 202202, None]),
            "consumo": rng.choice([None, 0.0, 1.0, 2.5]) if month % 5 else None,
            "estado": rng.choice(["x", "y", None]), "categoria": rng.choice(["k", None]) if month > 20 else None,
            "barrio": rng.choice(["n", "s", None])})
    data.append({"contrato": "e", "date": "2021-01-01", "consumo": 3.0})
    data.append({"contrato": "f", "date": "2021-03-01", "consumo": None, "estado": "x"})
    df = rows(spark, data).where("not (contrato <=> 'd' and month(date) > 2)")
    cutoffs = windows.cutoff_list([dt.date(2021 + m // 12, m % 12 + 1, 1) for m in range(2, 40)])
    together = profile.window_profiles(df, cutoffs, 12, keep_empty, chunk_bits=6)
    for c in cutoffs[::3]:
        alone = profile.window_profiles(df, [c], 12, keep_empty, chunk_bits=6)
        assert sorted_rows(together.where(F.col("cutoff") == c)) == sorted_rows(alone), c


def test_dates_inside_a_month_are_in_no_window_of_many(spark):
    data = [{"contrato": "a", "date": "1998-10-01", "consumo": 4.0}, {"contrato": "a", "date": "1998-10-09", "consumo": 8.0}]
    made = profile.window_profiles(rows(spark, data), windows.cutoff_list(["1998-11-01", "1998-12-01"]))
    assert {(r["cutoff"].month, tuple(x for x in r["serie_raw"] if x)) for r in made.collect()} == {(11, (4.0,)), (12, (4.0,))}


def test_population_and_negatives_slice_without_another_contract_shuffle(spark):
    data = rows(spark, [{"contrato": "a", "date": "1998-10-01", "consumo": 4.0, "categoria": "x"}])
    months = windows.cutoff_list(["1999-01-01", "1999-02-01"])
    label = spark.createDataFrame([("a", dt.date(1999, 1, 1))], "contrato string, date date")

    def shuffles(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        return plan.count("Exchange hashpartitioning")

    assert shuffles(population_stats(data, months)) == 3       # months, contrato, category results
    assert shuffles(population_stats(data, months[:1])) == 2
    assert shuffles(wide.negative_sample(data, label, months, 5)) == 5  # two of them over at most k rows per task


def test_sliding_sums_match_brute_force(spark):
    """Contracts with gaps shorter and longer than a window, in several categories, over all cutoffs."""
    rng = random.Random(3)
    data = []
    for contract in "abcdef":
        for month in range(1, 61):
            for _ in range(rng.choice([0, 0, 1, 2]) if not 20 < month < 20 + rng.choice([3, 13, 30]) else 0):
                data.append({"contrato": contract, "date": windows.shift_months(dt.date(2015, 1, 1), month),
                             "consumo": rng.choice([None, 0.0, 1.0, 7.5]), "categoria": rng.choice(["X", "Y", None])})
    cutoffs = [windows.shift_months(dt.date(2015, 6, 1), m) for m in range(70) if m % 7]
    expected = {}
    for c in cutoffs:
        for r in data:
            back = (c.year - r["date"].year) * 12 + c.month - r["date"].month
            if r["categoria"] and 1 <= back <= 12:
                held = expected.setdefault((c, r["categoria"], r["contrato"]), {12: 0.0})
                for m in (12, 6, 3):
                    if back <= m:
                        held[m] = held.get(m, 0.0) + (r["consumo"] or 0.0)
    got = contract_sums(rows(spark, data), cutoffs)
    assert as_set(got, "cutoff", "categoria", "contrato", "sum_12", "sum_6", "sum_3") == {
        (*key, v[12], v.get(6), v.get(3)) for key, v in expected.items()}
    assert got.count() == len(expected)
    opened = wide.window_contracts(rows(spark, data), cutoffs)
    pairs = {(r["contrato"], c) for r in data for c in cutoffs if 1 <= windows_back(c, r["date"]) <= 12}
    assert {(r["contrato"], c) for r in opened.collect() for c in r["cutoffs"]} == pairs


def windows_back(cutoff, date):
    return (cutoff.year - date.year) * 12 + cutoff.month - date.month


def test_sliding_sums_do_not_multiply_months(spark):
    """A contract with a row in every month opens each window once."""
    months = [{"contrato": "a", "date": windows.shift_months(dt.date(2015, 1, 1), m), "consumo": 1.0, "categoria": "X"} for m in range(48)]
    cutoffs = [windows.shift_months(dt.date(2015, 1, 1), m) for m in range(1, 61)]
    made = rows(spark, months).select("contrato", "date").distinct()
    assert windows.windows_opened(made, ["contrato"], cutoffs).count() == 59


def test_means_of_sliding_profiles_travel_in_plain_columns(spark, capsys):
    data = [{"contrato": "a", "date": f"2023-{m:02d}-01", "consumo": float(m)} for m in (1, 2, 5, 12)]
    made = profile.window_profiles(rows(spark, data), [dt.date(2023, 6, 1), JAN, dt.date(2025, 1, 1)])
    series_only = made.select("contrato", "cutoff", "serie_raw")
    series_only.explain()
    assert "collect_list" not in capsys.readouterr().out
    held = {r["cutoff"]: r["serie_raw"] for r in series_only.collect()}
    assert held == {
        dt.date(2023, 6, 1): [*[None] * 7, 1.0, 2.0, None, None, 5.0],
        JAN: [1.0, 2.0, None, None, 5.0, *[None] * 6, 12.0]}


def test_a_task_of_a_large_shuffle_gets_at_most_16_mb(spark):
    assert configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_rows_outside_all_targets_windows_are_not_shuffled(spark):
    """One target of one year: the contract's other years are left out before the pieces, and nothing changes for the target."""
    data = [{"contrato": "a", "date": windows.shift_months(dt.date(2015, 1, 1), m), "consumo": float(m),
             "estado": "xy"[m % 2], "categoria": "X"} for m in range(60)]
    cutoffs = [windows.shift_months(dt.date(2016, 1, 1), m) for m in range(48)]
    targets = spark.createDataFrame([("a", cutoffs[5], (1,))], "contrato string, cutoff date, label struct<is_fraud:int>")
    seen, pieces = [], profile.pieces
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(profile, "pieces", lambda rows, *a: seen.append(rows.count()) or pieces(rows, *a))
        made = profile.target_profiles(rows(spark, data), targets, cutoffs).collect()
    assert seen == [12]
    assert [(r["serie_raw"], r["cambios_estado"], r["cant_estado"]) for r in made] == [([float(m) for m in range(5, 17)], 11, 2)]


def test_training_rows_read_consumption_and_inspections_once_each_way(spark, consumption, labels):
    """Consumption is summed by month once, for the population and for the negatives; the targets are kept once."""
    seen, sums = [], wide.monthly_sums
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(wide, "monthly_sums", lambda made: seen.append(made) or sums(made), raising=False)
        made = wide.train_wide(consumption, labels, [JAN, dt.date(1996, 6, 1)], 12, 5, 45)
    assert len(seen) == 1 and made.count() >= 0


def test_asked_windows_are_sliced_after_the_join(spark):
    """The rows of the asked windows as by slicing everything; rows are shuffled before they are repeated, not after."""
    rng = random.Random(8)
    days = [dt.date(2022 + m // 12, m % 12 + 1, 1) for m in range(30)]
    data = [(rng.choice(["a", "b", "c", "d", None]), rng.choice(days + [dt.date(2023, 3, 15), None]), i) for i in range(600)]
    read = spark.createDataFrame(data + data[:40], "contrato string, date date, pos bigint")
    pairs = [(rng.choice(["a", "b", "x", None]), rng.choice(days + [None])) for _ in range(40)]
    asked = spark.createDataFrame(pairs + pairs[:9] + [("c", None), ("d", JAN)], "contrato string, cutoff date")
    for cutoffs in ([JAN], days[12:24], [dt.date(2023, 2, 1), JAN]):
        expected = windows.slice_windows(read, cutoffs).join(asked, ["contrato", "cutoff"], "left_semi")
        for most in (0, 100):
            made = windows.slice_asked(read, asked, cutoffs, max_rows=most)
            assert sorted_rows(made) == sorted_rows(expected) and made.count() > 0
    plan = windows.slice_asked(read, asked, days[12:24], max_rows=0)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.index("Generate explode") < plan.index("Join")


def test_inspected_window_rows_repeat_rows_last(spark, sf_dir):
    plan = catalog.queries()["inspected_window_rows"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join")
