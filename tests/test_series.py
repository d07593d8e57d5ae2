import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gotera.functions import series
from gotera.functions.features import consumption_features, domain_features, scalar_domain_columns

GOLDEN = {
    "g1": [3, 3, 3, 0, 0, 0, 5, 1, 2, 2, 2, 2],
    "g2": [5] * 12,
    "g3": list(range(1, 13)),
    "g4": [0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0],
    "g5": [10] * 6 + [0.5] * 6,
    "zero": [0] * 12,
}


@pytest.fixture(scope="module")
def golden(spark):
    data = [(k, [float(x) for x in v]) for k, v in GOLDEN.items()]
    df = consumption_features(spark.createDataFrame(data, "id string, serie array<double>"))
    return {r["id"]: r.asDict() for r in df.collect()}


def close(a, b):
    return a == pytest.approx(b, abs=1e-6)


@pytest.mark.parametrize("name, m, mean, std, skew, kurt, slope", [
    ("g1", 12, 1.916667, 1.505042, 0.359550, 0.134361, -0.031469),
    ("g2", 12, 5, 0, 0, 0, 0),
    ("g3", 12, 6.5, 3.605551, 0, -1.2, 1),
    ("g4", 12, 0.083333, 0.288675, 3.464102, 12, -0.024476),
    ("g5", 12, 5.25, 4.961213, 0, -2.444444, -1.195804),
    ("g1", 6, 2.333333, 1.366260, 1.934373, 4.553571, -0.342857),
    ("g4", 6, 0, 0, 0, 0, 0),
])
def test_golden_moments(golden, name, m, mean, std, skew, kurt, slope):
    row = golden[name]
    assert close(row[f"mean_{m}"], mean) and close(row[f"std_cons{m}"], std)
    assert close(row[f"skew_cons{m}"], skew) and close(row[f"kurt_cons{m}"], kurt) and close(row[f"slope_{m}"], slope)


def test_moments_match_pandas(golden):
    for name, values in GOLDEN.items():
        for m in (3, 6, 12):
            part = pd.Series(values[-m:], dtype=float)
            row = golden[name]
            assert close(row[f"var_cons{m}"], part.var()) and close(row[f"skew_cons{m}"], part.skew())
            assert close(row[f"slope_{m}"], np.polyfit(range(m), part, 1)[0])
            if m > 3:
                assert close(row[f"kurt_cons{m}"], part.kurt())
            assert (row[f"min_cons{m}"], row[f"max_cons{m}"]) == (part.min(), part.max())


def test_no_kurtosis_for_three_months(golden):
    assert "kurt_cons3" not in golden["g1"] and "kurt_cons6" in golden["g1"]


def test_runs(golden):
    zeros = {k: (r["cant_ceros_12"], r["max_cant_ceros_seg_12"]) for k, r in golden.items()}
    assert zeros == {"g1": (3, 3), "g2": (0, 0), "g3": (0, 0), "g4": (11, 9), "g5": (0, 0), "zero": (12, 12)}
    flags = {k: [r[f"constant_{n}"] for n in (3, 4, 5, 8, 9, 10)] for k, r in golden.items()}
    assert flags["g1"] == [1, 1, 0, 0, 0, 0] and flags["g2"] == [1] * 6 and flags["g3"] == [0] * 6
    assert flags["g4"] == [1, 1, 1, 1, 1, 0] and flags["g5"] == [1, 1, 1, 0, 0, 0]


def test_single_zero_is_no_run(spark):
    df = spark.createDataFrame([([1.0, 0.0, 2.0],)], "serie array<double>")
    assert df.select(series.longest_zero_run(F.col("serie"))).head()[0] == 0


def test_trend_flags(golden):
    assert golden["g5"]["trend_perc_6_6"] == 1 and golden["g2"]["trend_perc_6_6"] == 0
    assert golden["g4"]["trend_perc_1_4"] == 1


def test_gap_fill_and_null_count(spark):
    df = spark.createDataFrame([([None, 2.0, None, 4.0, None],), ([None] * 5,)], "raw array<double>")
    out = df.select(series.fill_gaps(F.col("raw"), 5).alias("f"), series.null_count(F.col("raw")).alias("n")).collect()
    assert out[0]["f"] == [2, 2, 2, 4, 4] and out[0]["n"] == 3 and out[1]["f"] == [None] * 5
    again = df.select(series.fill_gaps(series.fill_gaps(F.col("raw"), 5), 5).alias("f")).head()["f"]
    assert again == [2, 2, 2, 4, 4]


def test_row_minmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 5.0],), ([2.0, 2.0, 2.0],)], "s array<double>")
    out = [r[0] for r in df.select(series.row_minmax(F.col("s"))).collect()]
    assert out == [[0, 0.5, 1], [0, 0, 0]]


def test_fourier_power_matches_numpy(golden):
    for name, values in GOLDEN.items():
        expected = np.abs(np.fft.rfft(values)) ** 2
        assert golden[name]["ts_fft_power"] == pytest.approx(list(expected), abs=1e-6)


def test_statistical_domain_matches_numpy(golden):
    for name, values in GOLDEN.items():
        x, row = np.array(values, dtype=float), golden[name]
        assert close(row["ts_median"], np.median(x)) and close(row["ts_variance"], x.var())
        assert close(row["ts_interquartile_range"], np.percentile(x, 75) - np.percentile(x, 25))
        assert row["ts_ecdf_percentile"] == pytest.approx(list(np.percentile(x, [20, 80])))
        assert close(row["ts_median_abs_deviation"], np.median(np.abs(x - np.median(x))))
        counts = [12] + [0] * 9 if x.min() == x.max() else list(np.histogram(x, 10)[0])
        assert row["ts_histogram"] == counts


def test_temporal_domain(golden):
    for name, values in GOLDEN.items():
        x, row = np.array(values, dtype=float), golden[name]
        d = np.diff(x)
        assert close(row["ts_area_under_curve"], ((x[1:] + x[:-1]) / 2).sum())
        assert close(row["ts_signal_distance"], np.sqrt(1 + d * d).sum()) and close(row["ts_median_diff"], np.median(d))
        assert row["ts_zero_cross"] == int((np.sign(x[1:]) != np.sign(x[:-1])).sum())
    assert golden["zero"]["ts_centroid"] is None and close(golden["g3"]["ts_entropy"], 1) and golden["g2"]["ts_entropy"] == 0


def test_spectral_edge_cases(golden):
    empty = golden["zero"]
    assert empty["ts_fundamental_frequency"] == 0 and empty["ts_spectral_centroid"] is None
    assert empty["ts_roll_off"] is None and golden["g2"]["ts_spectral_spread"] == 0
    assert close(golden["g1"]["ts_fundamental_frequency"], 2 / 12)  # bins 2 and 6 tie, the lower one counts
    assert not any(isinstance(v, float) and math.isnan(v) for v in golden["g4"].values())


def test_chosen_features_and_unknown_name(spark):
    df = spark.createDataFrame([([float(i) for i in range(12)],)], "serie array<double>")
    assert domain_features(df, features=["median", "spectral_spread"]).columns == [
        "serie", "ts_median", "ts_spectral_spread"]
    with pytest.raises(ValueError, match="nope"):
        domain_features(df, features=["median", "nope"])
    assert "ts_histogram" not in scalar_domain_columns()


def test_windows_need_twelve_months(spark):
    df = spark.createDataFrame([([1.0] * 6,)], "serie array<double>")
    with pytest.raises(ValueError):
        series.add_constant_runs(df, 6)
    with pytest.raises(ValueError):
        series.add_moments(df, 6)


def test_statistical_features_are_plain_generated_code(spark, capsys):
    data = [(k, [float(x) for x in v]) for k, v in GOLDEN.items()]
    df = spark.createDataFrame(data, "id string, serie array<double>")
    domain_features(df, domains=["statistical"]).explain()
    plan = capsys.readouterr().out
    assert "ts_kurtosis" in plan and "lambda" not in plan
