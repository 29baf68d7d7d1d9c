"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. Every query runs whole: its
rows go to Spark's no-op sink, so nothing is pruned and nothing is collected. Each is timed once,
from building the DataFrame to the last row; the JVM is warmed up before on the smallest tables.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfcast.models.gbt import DEPTH_WISE, LEAF_WISE
from shelfcast.plans.features import build_features
from shelfcast.plans.jobs import load_ensemble, read_features, run_data_job, run_feature_job, run_training_job
from shelfcast.sources.schemas import RAW
from shelfcast.workload import queries as q
from shelfcast.workload.tables import SPEC, RetailTables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Rounds of each flavour that the timed training job grows at most.
ROUNDS = 30

# The stages of the data job, whole tables; then reports and forecasts.
STAGES = {
    "grid": q.full_grid,
    "master": q.master,
    "features": lambda spark, sf_dir: build_features(q.master(spark, sf_dir), SPEC),
}
HEADLINES = [
    "baseline_scores",
    "ewma_features",
    "rolling_stds",
    "split_parts",
    "oil_interpolated",
    "holiday_flags",
    "month_year_matrix",
    "pareto",
    "store_type_boxes",
    "forecast_kpis",
    "promo_scenarios",
    "forecast_slice",
    "asked_days",
    "submission",
    "dataset_sizes",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("shelfcast-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def calibration(spark: SparkSession) -> float:
    """Seconds of a fixed piece of work that no change to this library touches, to tell a slower machine."""
    start = time.perf_counter()
    spark.range(400_000_000).agg(F.sum(F.xxhash64("id").cast("decimal(38,0)"))).collect()
    return time.perf_counter() - start


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def jobs(spark: SparkSession, sf_dir: str) -> dict:
    """The three jobs one after the other, from CSV files to stored layers, models and forecasts: seconds of each, with
    the rows and rounds that they worked on. Both flavours with their real depth, rate and patience, on all rows, for
    ROUNDS rounds at most."""
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    t = RetailTables(spark, sf_dir)
    tables = {"train": t.train, "test": t.test, "stores": t.stores, "oil": t.oil, "holidays_events": t.holidays, "transactions": t.transactions}
    for name, df in tables.items():
        names = [part.split()[0] for part in RAW[name].split(", ")]
        df.select(*names).write.option("header", True).csv(f"{root}/raw/{name}.csv")
    seconds = {
        "data": timed(lambda: run_data_job(spark, f"{root}/raw", root, SPEC)),
        "features": timed(lambda: run_feature_job(spark, root, f"{root}/features", SPEC)),
        "training": timed(
            lambda: run_training_job(
                spark, f"{root}/features", f"{root}/out", leaf_wise=replace(LEAF_WISE, rounds=ROUNDS), depth_wise=replace(DEPTH_WISE, rounds=ROUNDS)
            )
        ),
    }
    features = read_features(spark, f"{root}/features")
    models = load_ensemble(spark, f"{root}/out").models
    return {
        "seconds": seconds,
        "feature_rows": features.count(),
        "rounds_at_most": ROUNDS,
        "labelled_rows": features.filter("log_sales IS NOT NULL").count(),
        "rounds_kept": {name: model.stages[-1].getNumTrees for name, model in models.items()},
    }


def main() -> None:
    spark = session()
    runs = {**STAGES, **{name: q.QUERIES[name] for name in HEADLINES}}
    root = os.path.dirname(SF_DIR.rstrip("/"))
    smallest = os.path.join(root, "sf0.001")
    if os.path.isdir(smallest):
        for build in STAGES.values():
            build(spark, smallest).write.format("noop").mode("overwrite").save()
    fixed = round(calibration(spark), 3)
    times = {}
    for name, build in runs.items():
        start = time.perf_counter()
        build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    rows = q.full_grid(spark, SF_DIR).count()
    smaller = os.path.join(root, "sf0.01")
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else None,
        "calibration_seconds": fixed,
        "grid_rows": rows,
        "grid_rows_per_sec": {name: round(rows / times[name]) for name in STAGES},
        "jobs_sf0.01": jobs(spark, smaller) if os.path.isdir(smaller) else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
