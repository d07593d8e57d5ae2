import importlib.util
import os

import pytest

from conftest import ROOT, SF
from gotera import catalog, oracles

spec = importlib.util.spec_from_file_location("check_queries", os.path.join(ROOT, "tools", "check_queries.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)

# the zone queries write whole raw zones and are covered by test_zones; the tool runs them all
QUICK = [
    "clean_consumption", "clean_inspections", "label_argmax_dedup", "population_stats_12_6_3", "attr_change_counts",
    "latest_attributes", "gap_fill", "population_ratios", "negative_sample", "train_wide_multi_cutoff", "constant_runs",
    "series_moments", "ts_statistical", "ts_temporal", "ts_spectral", "target_encode", "model_preprocessing",
    "oversampled_rows", "auc_rank_sum", "corr_select", "normalized_text",
]


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    good, note = check.compare(spark, duck, SF, name)
    assert good, note


def test_every_sql_has_a_query():
    assert set(oracles.oracle_sql()) <= set(catalog.queries())


def test_flagship(spark):
    made = catalog.flagship(spark, SF)
    assert made.count() == 70 and {"12_anterior", "ts_spectral_entropy", "constant_8"} <= set(made.columns)
