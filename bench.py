"""Benchmark: median seconds of the headline workloads at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from gotera import catalog  # noqa: E402
from gotera.functions.features import consumption_features  # noqa: E402
from gotera.operators import wide  # noqa: E402
from gotera.operators.cutoffs import cutoff_list  # noqa: E402
from gotera.session import get_session  # noqa: E402
from gotera.sources import fixtures as fx  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
TRAIN_CUTOFFS = [f"{y}-{m:02d}-01" for y in (1998, 1999) for m in range(1, 13)]
SIX = cutoff_list(f"1999-{m:02d}-01" for m in range(1, 7))
REGISTERED = {
    "clean_consumption": SIX, "label_argmax_dedup": SIX, "population_stats_12_6_3": SIX, "attr_change_counts": SIX,
    "wide_pivot": SIX, "negative_sample": SIX, "ts_spectral": SIX[:1], "oversampled_rows": SIX,
}


def z1_inference_dataset(spark):
    made = wide.inference_wide(fx.consumption(spark, SF_DIR), catalog.CUTOFF, 12, chunk_bits=fx.CHUNK_BITS)
    return wide.wide_columns(consumption_features(made, 12), 12)


def z2_train_dataset_24_cutoffs(spark):
    rows, labels = fx.consumption(spark, SF_DIR), fx.inspections(spark, SF_DIR)
    made = wide.train_wide(rows, labels, TRAIN_CUTOFFS, 12, 1500, fx.CHUNK_BITS)
    return wide.wide_columns(consumption_features(made, 12), 12)


def z3_series_features(spark, series):
    return consumption_features(series, 12)


def registered(spark, name: str, cutoffs=SIX):
    catalog.months = lambda spark, sf_dir: cutoffs
    return catalog.queries()[name](spark, SF_DIR)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, repeats: int) -> float:
    run()
    spent = []
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        spent.append(time.perf_counter() - start)
    return round(statistics.median(spent), 3)


def main() -> None:
    spark = get_session("bench", f"local[{CPUS}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(CPUS), "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    catalog.months = lambda spark, sf_dir: SIX
    profiles = catalog.all_profiles(spark, SF_DIR, keep_empty=False)
    filled = profiles.select("contrato", "cutoff", catalog.series.fill_gaps(F.col("serie_raw"), 12).alias("serie"))
    stored = f"{catalog.scratch(spark)}/series"
    filled.repartition(CPUS).write.parquet(stored)
    series = spark.read.parquet(stored)
    runs = {
        "z1_inference_dataset": lambda: noop(z1_inference_dataset(spark)),
        "z2_train_dataset_24_cutoffs": lambda: noop(z2_train_dataset_24_cutoffs(spark)),
        "z3_series_features": lambda: noop(z3_series_features(spark, series)),
        "z4_encoders": lambda: noop(registered(spark, "model_preprocessing")),
    }
    for name, cutoffs in REGISTERED.items():
        runs[name] = lambda name=name, cutoffs=cutoffs: noop(registered(spark, name, cutoffs))
    only = sys.argv[1:]
    times = {name: timed(run, REPEATS) for name, run in runs.items() if not only or name in only}
    print(json.dumps({
        "metric": "total median seconds of the headline workloads", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
