"""The physical plans that matter at scale."""

import re
from datetime import timedelta

from pyspark.sql import functions as F

from shelfcast.operators.lags import with_lag_features
from shelfcast.workload import queries as q
from shelfcast.workload.tables import SPEC, RetailTables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_sort_each_series_once(spark, sf_dir):
    text = plan(with_lag_features(q.full_grid(spark, sf_dir), SPEC))
    above_grid = text[: text.index("REPARTITION_BY_NUM")]
    assert len(re.findall(r"\bWindow \[", above_grid)) == 2  # features, and the day after each cell
    assert len(re.findall(r"\bSort \[", above_grid)) == 2
    assert len(re.findall(r"\bExchange ", above_grid)) == 1


def test_gold_does_not_shuffle_the_grid(spark, sf_dir):
    text = plan(q.master(spark, sf_dir))
    joins = text[: text.index("Generate explode(sequence(0")]
    assert "SortMergeJoin" not in joins and joins.count("BroadcastHashJoin") >= 4


def test_no_grid_is_joined_by_store(spark, sf_dir, monkeypatch):
    """Attributes ride on the seeds, with any number of stores: here no dimension may be broadcast."""
    monkeypatch.setattr("shelfcast.operators.sides.MAX_BROADCAST_ROWS", 0)
    t = RetailTables(spark, sf_dir)
    grid = q.continuous_grid(t.train, t.test, SPEC, stores=t.stores)
    for df in (q.master(spark, sf_dir), q.with_holiday_flags(grid, q.effective_holidays(t.holidays), SPEC)):
        text = plan(df)
        above = text[: text.index("Generate explode(sequence(0")]
        assert "SortMergeJoin" not in above and "Exchange hashpartitioning" not in above
        assert not re.search(r"Join \[store_nbr", above)


def test_requests_read_the_sales_three_times(spark, sf_dir):
    text = plan(q.forecast_slice(spark, sf_dir))
    sales = [s for s in re.findall(r"ReadSchema: (\S*)", text) if "l_shipdate" in s]
    assert len(sales) == 2  # one more made the stored catalogue


def test_asked_days_leave_dense_rows_in_place(spark, sf_dir):
    text = plan(q.reports.only_asked(q.recent_grid(spark, sf_dir), q.reports.asked_days(q.short_requests(spark, sf_dir), (SPEC.test_start, SPEC.calendar_end))))
    above = text[: text.index("Generate explode(sequence(0")]
    assert "BroadcastHashJoin" in above and "SortMergeJoin" not in above


def test_no_cross_joins(spark, sf_dir):
    for build in (q.full_grid, q.master, q.validation, q.horizon):
        text = plan(build(spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_recent_days_only_are_read(spark, sf_dir):
    text = plan(q.validation(spark, sf_dir))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\].*?ReadSchema: (\S*)", text)
    sales = [(f, s) for f, s in pushed if "l_shipdate" in s]
    # one more scan, of all days, makes the catalogue
    assert len(sales) == 3 and sum("GreaterThanOrEqual(l_shipdate" in f for f, _ in sales) == 2
    assert all("l_extendedprice" not in s for _, s in sales)


def test_short_calendar_gives_the_same_scores(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    long = q.baseline_features(q.continuous_grid(t.train, t.test, SPEC))
    in_val = F.col("date").between(F.lit(SPEC.val_start), F.lit(SPEC.test_start - timedelta(days=1)))
    long = q.with_baselines(long.filter(in_val)).filter("sales IS NOT NULL")
    short = q.validation(spark, sf_dir).filter("sales IS NOT NULL")
    columns = ["store_nbr", "family", "date", "pred_naive", "pred_seasonal_naive"]
    assert long.select(columns).exceptAll(short.select(columns)).count() == 0
    assert long.count() == short.count() > 0


def test_reports_read_recent_days_only(spark, sf_dir):
    """Of the three scans of line items only the one for the catalogue is of all days."""
    for build in (q.recent_grid, q.horizon):
        text = plan(build(spark, sf_dir))
        pushed = re.findall(r"PushedFilters: \[([^\]]*)\].*?ReadSchema: (\S*)", text)
        sales = [f for f, s in pushed if "l_shipdate" in s]
        assert len(sales) == 3 and sum("GreaterThanOrEqual(l_shipdate" in f for f in sales) == 2


def test_stores_that_stopped_selling_stay(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    first_day = SPEC.val_start - timedelta(days=q.LOOKBACK_DAYS)
    recent = t.train.filter(F.col("date") >= F.lit(first_day)).filter("store_nbr <> 7")
    grid = q.continuous_grid(recent, t.test, SPEC.since(first_day), catalogue=t.catalogue)
    assert grid.filter("store_nbr = 7").count() == 6 * SPEC.since(first_day).n_days
    assert grid.select("store_nbr").distinct().count() == 10


def test_only_observed_pairs_if_so_asked(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    pairs = t.train.filter("store_nbr < 4 AND family <> 'SMALL'").select("store_nbr", "family").distinct()
    grid = q.continuous_grid(t.train, t.test, SPEC, catalogue=pairs)
    assert grid.count() == pairs.count() * SPEC.n_days
