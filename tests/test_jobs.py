"""The batch jobs end to end on CSV files made from the test tables."""

import os
import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfcast.models.gbt import (
    DEPTH_WISE,
    LEAF_WISE,
    feature_importance,
    fit_forecaster,
    with_prediction,
)
from shelfcast.plans.jobs import (
    Ensemble,
    answer_requests,
    feature_table,
    load_ensemble,
    master_table,
    read_features,
    run_data_job,
    run_feature_job,
    run_training_job,
)
from shelfcast.plans.features import build_features
from shelfcast.plans.reports import forecast_slice, rejected_requests
from shelfcast.sources.ingest import read_layer, read_raw, read_report, typed
from shelfcast.sources.publish import current, prune
from shelfcast.sources.schemas import BENCHMARK, RAW, SUBMISSION
from shelfcast.sources.sinks import write_series_table
from shelfcast.spec import DemandSpec, feature_columns
from shelfcast.workload import queries
from shelfcast.workload.tables import SPEC, RetailTables

# Two years keep the run short; every rule of the full calendar occurs in them.
SHORT = replace(SPEC, calendar_start=date(1999, 8, 1), feature_start=date(2000, 1, 1))
TREES = {"rounds": 3, "depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def out(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    t = RetailTables(spark, sf_dir, SHORT)
    tables = {
        "train": t.train,
        "test": t.test,
        "stores": t.stores,
        "oil": t.oil,
        "holidays_events": t.holidays,
        "transactions": t.transactions,
    }
    for name, df in tables.items():
        columns = RAW[name].replace(",", "").split()[::2]
        df.select(*columns).write.option("header", True).csv(f"{root}/raw/{name}.csv")
    run_data_job(spark, f"{root}/raw", root, SHORT)
    run_feature_job(spark, root, f"{root}/features", SHORT)
    run_training_job(
        spark,
        f"{root}/features",
        f"{root}/out",
        leaf_wise=replace(LEAF_WISE, **TREES),
        depth_wise=replace(DEPTH_WISE, **TREES),
    )
    return root


def test_layers(spark, out):
    grid = read_layer(spark, f"{current(spark, out)}/silver/grid")
    master = read_layer(spark, f"{current(spark, out)}/gold/master")
    features = read_features(spark, f"{out}/features")
    assert (len(grid.columns), len(master.columns), len(features.columns)) == (8, 20, 54)
    assert len(feature_columns(features.columns)) == 49
    assert grid.count() == master.count() == 10 * 6 * SHORT.n_days
    assert features.agg(F.min("date")).first()[0] == SHORT.feature_start
    warm = [c for c in features.columns if c.startswith(("sales_lag_", "sales_roll_", "sales_ewm_"))]
    assert len(warm) == 17
    assert features.filter(" OR ".join(f"{c} IS NULL" for c in warm)).count() == 0
    assert features.filter("sales IS NULL AND log_sales IS NOT NULL").count() == 0


def test_benchmark_and_submission(spark, sf_dir, out):
    board = read_report(spark, f"{current(spark, out + '/out')}/benchmark", BENCHMARK).collect()
    assert len(board) == 6 and [r["rmsle"] for r in board] == sorted(r["rmsle"] for r in board)
    assert "trees" in board[0]["model"] or "Blend" in board[0]["model"]
    sent = read_report(spark, f"{current(spark, out + '/out')}/submission", SUBMISSION)
    asked = RetailTables(spark, sf_dir, SHORT).test.filter(F.col("date") <= F.lit(SHORT.calendar_end))
    assert sent.count() == asked.count()
    assert sent.filter("sales < 0 OR sales IS NULL").count() == 0


def test_models_load_and_score_subsets_alike(spark, out):
    models = load_ensemble(spark, f"{out}/out").models
    features = read_features(spark, f"{out}/features").filter("is_test")
    whole = with_prediction(models["pred_leaf_wise"], features, "p").filter("family = 'PROMO'")
    part = with_prediction(models["pred_leaf_wise"], features.filter("family = 'PROMO'"), "p")
    assert whole.count() == part.count() == 160
    assert whole.exceptAll(part).count() == 0
    sent = read_report(spark, f"{current(spark, out + '/out')}/submission", SUBMISSION)
    both = features.filter("id IS NOT NULL")
    for name, model in models.items():
        both = with_prediction(model, both, name)
    gap = both.join(sent.withColumnRenamed("sales", "sent"), "id").select(
        F.max(F.abs((F.col("pred_leaf_wise") + F.col("pred_depth_wise")) / 2 - F.col("sent")))
    )
    assert gap.first()[0] < 1e-9


def test_unseen_names_are_scored(spark, out):
    model = load_ensemble(spark, f"{out}/out").models["pred_depth_wise"]
    features = read_features(spark, f"{out}/features").filter("is_test").withColumn("family", F.lit("NEW"))
    assert with_prediction(model, features, "p").filter("p IS NULL").count() == 0


def test_importance(spark, out):
    model = load_ensemble(spark, f"{out}/out").models["pred_leaf_wise"]
    features = read_features(spark, f"{out}/features")
    rows = feature_importance(model, features, 49).collect()
    gains = [r["importance_gain"] for r in rows]
    assert gains == sorted(gains, reverse=True) and sum(gains) == pytest.approx(1.0)
    assert {r["feature"] for r in rows} <= set(feature_columns(features.columns))
    splits = sum(r["importance_split"] for r in rows)
    assert splits == sum(t.numNodes // 2 for t in model.stages[-1].trees)


def test_one_encoding_at_every_size(spark, out):
    """100, 215 or 1,000 stores: the same stages, and a stable value of its own for every store."""
    features = read_features(spark, f"{out}/features").filter("log_sales IS NOT NULL").limit(40)
    params = replace(LEAF_WISE, rounds=1, depth=2, patience=1)
    stages = set()
    for n in (100, 215, 1000):
        many = features.crossJoin(spark.range(n).withColumnRenamed("id", "n")).withColumn("store_nbr", F.col("n").cast("int"))
        many = many.filter("pmod(hash(n, date), 4) > 0 OR n % 3 = 0").drop("n")
        model = fit_forecaster(many, many, params)
        stages.add(tuple(type(s).__name__ for s in model.stages))
        for rows in (many, many.filter("store_nbr < 20")):
            codes = model.transform(rows).select("store_nbr", "e_store_nbr").distinct().collect()
            assert len(codes) == len({r[0] for r in codes}) == len({r[1] for r in codes}) == (n if rows is many else 20)
    assert len(stages) == 1


def test_stores_outside_the_learning_rows_keep_their_codes(spark, sf_dir, monkeypatch):
    """Fewer learning rows than stores: every store of the train part still has a code of its own."""
    monkeypatch.setattr(queries, "LABELLED_ROWS", 5)
    train, learn, val = queries._model_parts(spark, sf_dir)
    stores = train.select("store_nbr").distinct()
    params = replace(LEAF_WISE, rounds=1, depth=2, patience=1, min_rows_per_leaf=1)
    model = fit_forecaster(train, val, params, learn)
    assert learn.count() == 5 < stores.count()
    codes = model.transform(train).select("store_nbr", "e_store_nbr").distinct().collect()
    assert len(codes) == stores.count() == len({r["e_store_nbr"] for r in codes})


def test_ensemble_weights_are_stored(spark, out, run_dir):
    first = load_ensemble(spark, f"{out}/out")
    assert first.weights == (0.5, 0.5)
    Ensemble(first.models, (0.3, 0.7)).save(run_dir)
    again = load_ensemble(spark, run_dir)
    assert again.weights == (0.3, 0.7) and list(again.models) == list(first.models)
    rows = again.score(read_features(spark, f"{out}/features").filter("is_test").limit(50))
    gap = F.max(F.abs(F.col("pred_leaf_wise") * 0.3 + F.col("pred_depth_wise") * 0.7 - F.col("pred_blend")))
    assert rows.agg(gap).first()[0] < 1e-9


def test_requests_for_past_days_are_scored(spark, out):
    asked = [
        (1, 3, "PROMO", date(2001, 3, 1), date(2001, 3, 10)),
        (2, 3, "PROMO", None, None),
        (3, 3, "NONE", date(2001, 3, 1), date(2001, 3, 2)),
        (4, 999, "PROMO", None, None),
        (5, 4, "SMALL", date(1990, 1, 1), date(1990, 1, 2)),
    ]
    requests = spark.createDataFrame(asked, "request_id long, store_nbr long, family string, start_date date, end_date date")
    features = read_features(spark, f"{out}/features")
    ensemble = load_ensemble(spark, f"{out}/out")
    checked = answer_requests(ensemble, features, requests, (1, 100), (SHORT.test_start, SHORT.calendar_end))
    rows = forecast_slice(checked).orderBy("request_id", "date").collect()
    assert [r["request_id"] for r in rows] == [1] * 10 + [2] * 16
    assert all(r["predicted_sales"] >= 0 for r in rows)
    expected = ensemble.score(features.filter("store_nbr = 3 AND family = 'PROMO' AND date = '2001-03-04'")).first()
    assert rows[3]["predicted_sales"] == pytest.approx(expected["pred_blend"], abs=0.0051)
    reasons = {r["request_id"]: r["reason"] for r in rejected_requests(checked).collect()}
    assert reasons == {3: "unknown_family", 4: "store_out_of_range", 5: "no_data"}


def test_features_read_the_master_without_a_shuffle(spark, out):
    """The master is written by the tasks that fill the days, a file per bucket, and read in these buckets."""
    df = feature_table(spark, out, SHORT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    files = [f for f in os.listdir(f"{current(spark, out)}/gold/master") if f.startswith("part-")]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the same as from the cells, in one plan
    layers = current(spark, out)
    whole = build_features(master_table(spark, f"{layers}/bronze", f"{layers}/silver", SHORT), SHORT)
    columns = ["store_nbr", "family", "date", "sales_lag_16", "sales_roll_mean_7", "sales_ewm_alpha_01", "promo_roll_mean_14"]
    columns = [c for c in columns if c in df.columns]
    assert df.select(columns).exceptAll(whole.select(columns)).count() == 0 and df.count() == whole.count()


def test_missing_file_fails(spark, out):
    with pytest.raises(AnalysisException):
        read_raw(spark, f"{out}/nothing", "train")


def test_absent_report_is_empty(spark, out):
    empty = read_report(spark, f"{out}/nothing", BENCHMARK)
    assert empty.count() == 0 and empty.columns[0] == "model"


def csv(run_dir, name, text):
    os.makedirs(f"{run_dir}/{name}.csv", exist_ok=True)
    with open(f"{run_dir}/{name}.csv/part.csv", "w") as f:
        f.write(text)


@pytest.mark.parametrize(
    "text",
    [
        "id,date,store_nbr,sales,family,onpromotion\n1,2017-01-01,3,7.5,A,0\n",  # columns in another order
        "id,date,store_nbr,family,sales,onpromotion\n1,01/02/2017,3,A,7.5,0\n",
        "id,date,store_nbr,family,sales,onpromotion\n1,2017-01-01,3,A,many,0\n",
        "id,date,store_nbr,family,sales,onpromotion\n1,2017-01-01,3,A,n/a,0\n",
        "id,date,store_nbr,family,sales,onpromotion\n1,2017-01-01,3\n",
    ],
)
def test_reading_is_strict(spark, run_dir, text):
    csv(run_dir, "train", text)
    with pytest.raises(Exception, match="(?i)malformed|header|FAILED_READ_FILE|conform"):
        typed(read_raw(spark, run_dir, "train")).collect()


def test_no_row_is_lost_between_raw_and_bronze(spark, out):
    for name in ("train", "test", "stores", "oil", "holidays_events", "transactions"):
        lines = spark.read.text(f"{out}/raw/{name}.csv").filter("value <> ''").count()
        files = spark.read.text(f"{out}/raw/{name}.csv").select(F.input_file_name()).distinct().count()
        assert read_layer(spark, f"{current(spark, out)}/bronze/{name}").count() == lines - files


def test_typed_cleans(spark, run_dir):
    os.makedirs(f"{run_dir}/train.csv")
    with open(f"{run_dir}/train.csv/part.csv", "w") as f:
        f.write("id,date,store_nbr,family,sales,onpromotion\n1,2017-01-01,3,A,NaN,\n2,2017-01-02,3,A,2.5,4.0\n")
    rows = typed(read_raw(spark, run_dir, "train")).orderBy("id").collect()
    assert rows[0]["sales"] is None and rows[0]["onpromotion"] == 0
    assert rows[1]["sales"] == 2.5 and rows[1]["onpromotion"] == 4 and rows[1]["date"] == date(2017, 1, 2)


def test_bucketed_table_needs_no_shuffle(spark, out):
    from pyspark.sql import Window

    grid = read_layer(spark, f"{current(spark, out)}/silver/grid")
    write_series_table(grid, "grid_by_series", 4)
    try:
        w = Window.partitionBy("store_nbr", "family").orderBy("date")
        lagged = spark.table("grid_by_series").withColumn("p", F.lag("sales", 16).over(w))
        assert "Exchange" not in lagged._jdf.queryExecution().executedPlan().toString()
        assert lagged.count() == grid.count()
    finally:
        spark.sql("DROP TABLE grid_by_series")


def test_default_rules():
    spec = DemandSpec()
    assert spec.n_days == 1704 and spec.val_start == date(2017, 7, 31)
    assert spec.since(date(2017, 1, 1)).calendar_start == date(2017, 1, 1)
    assert spec.since(date(2000, 1, 1)).calendar_start == spec.calendar_start


def test_a_failed_job_leaves_the_last_set(spark, run_dir, monkeypatch):
    """Killed between two layers: readers keep the set before, and the next run publishes whole."""
    from shelfcast.plans import jobs

    def write(version, fail=False):
        with jobs.new_set(spark, run_dir) as folder:
            for layer in ("first", "second"):
                if fail and layer == "second":
                    raise RuntimeError("killed")
                jobs.write_layer(spark.range(version), f"{folder}/{layer}")

    def seen():
        return [read_layer(spark, f"{current(spark, run_dir)}/{layer}").count() for layer in ("first", "second")]

    with pytest.raises(FileNotFoundError):
        current(spark, run_dir)
    write(3)
    before = read_layer(spark, f"{current(spark, run_dir)}/first")
    with pytest.raises(RuntimeError):
        write(5, fail=True)
    assert seen() == [3, 3]
    write(7)
    assert seen() == [7, 7] and before.count() == 3  # a reader that began earlier goes on
    prune(spark, run_dir, keep=1)
    assert seen() == [7, 7] and len(os.listdir(f"{run_dir}/sets")) == 1
