"""Every operator as a query over the star-schema tables.

Queries that produce a row per grid row are checked through digests: per series, the count, the
mean, the mean square and the day-weighted mean of each column, so a value on the wrong day shows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.calendar import calendar_columns, payday_columns
from shelfcast.functions.metrics import evaluate, leaderboard, residual_correlation
from shelfcast.functions.scale import from_log
from shelfcast.models.baselines import (
    BASELINES,
    LOOKBACK_DAYS,
    baseline_leaderboard,
    with_baselines,
)
from shelfcast.models.blend import blend_sweep
from shelfcast.models.gbt import LEAF_WISE, feature_importance, fit_forecaster
from shelfcast.operators import lags
from shelfcast.operators.events import effective_holidays, with_holiday_flags
from shelfcast.operators.exogenous import oil_daily
from shelfcast.operators.gold import gold_master, with_shock_flag
from shelfcast.operators.grid import continuous_grid, series_catalogue, union_sales
from shelfcast.operators.lineage import scratch_folder, settled
from shelfcast.operators.split import split_report, temporal_split
from shelfcast.operators.sums import PARTIAL_SUMS, partial_sums
from shelfcast.operators.workers import ship
from shelfcast.plans import profile, reports
from shelfcast.plans.features import build_features, fill_warm_up
from shelfcast.plans.jobs import MODELS, Ensemble, fit_models
from shelfcast.sources.ingest import read_layer, read_raw, read_report, typed
from shelfcast.sources.schemas import RAW
from shelfcast.sources.sinks import write_report, write_series_layer
from shelfcast.spec import CATEGORICALS, SERIES, feature_columns
from shelfcast.workload.tables import SPEC, RetailTables, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 4


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(c: Column, digits: int = DIGITS) -> Column:
    return F.round(c.cast("double"), digits)


def digest(
    df: DataFrame, by: tuple[str, ...], columns: list[str], digits: tuple[int, int, int] = (6, 5, 6), dated: bool = True
) -> DataFrame:
    """Count, mean, day-weighted mean and mean square of each column. Rows are first summed up by `partial_sums`, a batch at
    a time, and Spark adds these few: so many sums over single rows fit no compiled method. `dated` says that every
    row has a date, as those of a grid do.
    """
    ship(df.sparkSession)
    day = F.datediff("date", F.lit(SPEC.calendar_start)).cast("double")
    rows = df.select(*by, day.alias("day"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema)
    numbers = ", ".join(f"{name} array<{kind}>" for name, kind in PARTIAL_SUMS.items())
    sums = rows.mapInArrow(partial_sums(len(by)), f"{keys}, n long, {numbers}")
    aggs = [F.expr("sum(n) AS n_rows")]
    for i, c in enumerate(columns):
        n, n_dated = (f"nullif(sum({name}[{i}]), 0)" for name in ("known", "dated"))
        by_day = f"if(sum(dated[{i}]) > 0, sum(by_day[{i}]), NULL)"
        aggs += [
            F.expr(f"sum(known[{i}]) AS {c}_known"),
            F.expr(f"round(sum(total[{i}]) / {n}, {digits[0]}) AS {c}_mean"),
            F.expr(f"round({by_day} / {n if dated else n_dated}, {digits[1]}) AS {c}_by_day"),
            F.expr(f"round(sum(square[{i}]) / {n}, {digits[2]}) AS {c}_square"),
        ]
    return sums.groupBy(*by).agg(*aggs)


# ---------------------------------------------------------------- inputs of several queries


def full_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = RetailTables(spark, sf_dir)
    return continuous_grid(t.train, t.test, SPEC)


def recent_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of the days that reports show; older sales stay unread."""
    t = RetailTables(spark, sf_dir)
    spec = SPEC.since(SPEC.test_start - timedelta(days=reports.HISTORY_DAYS))
    recent = t.train.filter(F.col("date") >= F.lit(spec.calendar_start))
    return continuous_grid(recent, t.test, spec, catalogue=t.catalogue)


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = RetailTables(spark, sf_dir)
    grid = continuous_grid(t.train, t.test, SPEC, stores=t.stores)
    return gold_master(grid, oil_daily(t.oil, SPEC), effective_holidays(t.holidays), SPEC)


def baseline_features(grid: DataFrame) -> DataFrame:
    windows = {**lags.sales_lags(), **lags.rolling_means()}
    needed = {feature: windows[feature] for feature, _ in BASELINES.values()}
    return fill_warm_up(lags.with_log_sales(grid).withColumns(needed))


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows with actual sales and baseline predictions; reads recent days only."""
    first_day = SPEC.val_start - timedelta(days=LOOKBACK_DAYS)
    t = RetailTables(spark, sf_dir)
    recent = t.train.filter(F.col("date") >= F.lit(first_day))
    grid = continuous_grid(recent, t.test, SPEC.since(first_day), catalogue=t.catalogue)
    in_val = F.col("date").between(F.lit(SPEC.val_start), F.lit(SPEC.last_train_day))
    return with_baselines(baseline_features(grid).filter(in_val))


def horizon(spark: SparkSession, sf_dir: str, catalogue: DataFrame | None = None) -> DataFrame:
    """A forecast for every series and test day: the moving-average baseline."""
    t = RetailTables(spark, sf_dir)
    catalogue = t.catalogue if catalogue is None else catalogue
    first_day = SPEC.test_start - timedelta(days=LOOKBACK_DAYS)
    recent = t.train.filter(F.col("date") >= F.lit(first_day))
    grid = continuous_grid(recent, t.test, SPEC.since(first_day), catalogue=catalogue)
    ahead = baseline_features(grid).filter("is_test")
    return ahead.select(
        "id", *SERIES, "date", "onpromotion", from_log(F.col("sales_roll_mean_7")).alias("sales_pred")
    )


# ---------------------------------------------------------------------- ingest and grid


@query
def typed_sales(spark, sf_dir):
    """Sales rows as text, with promotions of none left blank, cast back to types."""
    train = RetailTables(spark, sf_dir).train
    blank = F.when(F.col("onpromotion") > 0, F.col("onpromotion"))
    text = train.withColumn("onpromotion", blank).select(*[F.col(c).cast("string") for c in train.columns])
    text = text.withColumn("id", (F.col("id").cast("long") % 10007).cast("string"))
    return digest(typed(text), ("family",), ["id", "store_nbr", "sales", "onpromotion"], dated=False)


@query
def union_parts(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    rows = union_sales(t.train, t.test)
    return rows.groupBy("store_nbr").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("sales").alias("n_sales"),
        F.sum("sales").alias("sales"),
        F.sum("onpromotion").alias("onpromotion"),
    )


@query
def series_list(spark, sf_dir):
    return series_catalogue(RetailTables(spark, sf_dir).train).orderBy(*SERIES)


@query
def grid_rows(spark, sf_dir):
    columns = ["id", "sales", "onpromotion", "is_test", "is_closed"]
    # Ids are reduced so that their means keep all digits.
    small = {"id": F.col("id") % 10007, "is_test": F.col("is_test").cast("int")}
    return digest(full_grid(spark, sf_dir).withColumns(small), SERIES, columns)


@query
def grid_gap_profile(spark, sf_dir):
    """Gaps, closures and test days per year of the grid."""
    gap = F.col("sales").isNull() & ~F.col("is_test")
    return (
        full_grid(spark, sf_dir)
        .groupBy(F.year("date").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(gap).alias("n_gaps"),
            F.count_if("is_test").alias("n_test"),
            F.sum("is_closed").alias("n_closed"),
            F.countDistinct("date").alias("n_days"),
        )
    )


# ------------------------------------------------------------------ files written and read


@query
def raw_round_trip(spark, sf_dir):
    """Sales written as raw CSV files, then read strictly and typed."""
    train = RetailTables(spark, sf_dir).train
    folder = scratch_folder(spark, "raw")
    names = [part.split()[0] for part in RAW["train"].split(", ")]
    blank = F.when(F.col("onpromotion") > 0, F.col("onpromotion")).cast("double")
    raw = train.withColumn("onpromotion", blank).select(*names)
    raw.write.option("header", True).csv(f"{folder}/train.csv")
    rows = typed(read_raw(spark, folder, "train")).withColumn("id", F.col("id") % 10007)
    return digest(rows, ("family",), ["id", "store_nbr", "sales", "onpromotion"], dated=False)


@query
def layer_round_trip(spark, sf_dir):
    """The recent grid written as a layer in series order and read back: its rows, and how many of a file come before
    the row that they follow."""
    folder = scratch_folder(spark, "layer")
    write_series_layer(recent_grid(spark, sf_dir), folder)
    key = F.struct(*SERIES, "date")
    in_file = Window.partitionBy("_metadata.file_path").orderBy("_metadata.row_index")
    rows = read_layer(spark, folder).select("*", F.coalesce(key < F.lag(key).over(in_file), F.lit(False)).alias("late"))
    return rows.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_rows"), rounded(F.sum("sales")).alias("sales"), F.sum("onpromotion").alias("onpromotion"), F.count_if("late").alias("n_late")
    )


@query
def report_round_trip(spark, sf_dir):
    """A report with quotes, commas, line ends, blanks and nulls in its fields, written as CSV and read back (an empty
    text is NULL then), and one that was never written."""
    folder = scratch_folder(spark, "report")
    schema = "family string, note string, n_rows long, sales double"
    table = RetailTables(spark, sf_dir).train.groupBy("family").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("sales"))
    kind = F.col("n_rows") % 4
    note = F.when(kind == 0, F.concat(F.lit('said "'), "family", F.lit('", then\nleft, '))).when(kind == 1, "").when(kind == 2, " a \\ b ")
    write_report(table.withColumn("note", note).select("family", "note", "n_rows", "sales"), folder)
    rows = read_report(spark, folder, schema).unionByName(read_report(spark, f"{folder}-absent", schema))
    return rows.withColumn("sales", rounded(F.col("sales")))


# ---------------------------------------------------------------------- exogenous and events


@query
def oil_interpolated(spark, sf_dir):
    """Prices rounded to float32: decimal rounding would meet exact ties here."""
    oil = oil_daily(RetailTables(spark, sf_dir).oil, SPEC)
    return oil.select("date", *[F.col(c).cast("float").cast("double").alias(c) for c in oil.columns[1:]])


@query
def oil_by_region(spark, sf_dir):
    """A price series per region, filled and averaged over one calendar, on the grid rows of the region's stores."""
    t = RetailTables(spark, sf_dir)
    oil = oil_daily(t.regional_oil, SPEC, keys=("state",))
    prices = [c for c in oil.columns if c not in ("state", "date")]
    rows = gold_master(continuous_grid(t.train, t.test, SPEC, stores=t.stores), oil, effective_holidays(t.holidays), SPEC)
    return digest(rows, ("store_nbr", "state"), prices, digits=(4, 2, 2))


@query
def holiday_calendar(spark, sf_dir):
    """Effective holidays with the sales of their day."""
    t = RetailTables(spark, sf_dir)
    return effective_holidays(t.holidays).join(profile.daily_totals(t.train), "date", "left")


@query
def holiday_flags(spark, sf_dir):
    """Grid rows and sales under each kind of holiday, by city."""
    t = RetailTables(spark, sf_dir)
    grid = continuous_grid(t.train, t.test, SPEC, stores=t.stores)
    rows = with_holiday_flags(grid, effective_holidays(t.holidays), SPEC)
    flags = ["is_holiday_national", "is_holiday_regional", "is_holiday_local", "is_holiday_any"]
    return rows.groupBy("city", *flags).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("sales"))


@query
def holiday_flags_without_work_days(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    rows = with_holiday_flags(
        t.train.join(t.stores, "store_nbr"), effective_holidays(t.holidays), SPEC, ("Work Day",)
    )
    return rows.groupBy("state", "is_holiday_any").agg(F.sum("sales").alias("sales"))


@query
def shock_flag(spark, sf_dir):
    rows = with_shock_flag(RetailTables(spark, sf_dir).train, SPEC)
    return rows.groupBy("store_nbr", "is_earthquake_period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query
def gold_digest(spark, sf_dir):
    df = master(spark, sf_dir).withColumn("is_test", F.col("is_test").cast("int"))
    numeric = [c for c in df.columns if c not in ("date", *SERIES, "city", "state", "type")]
    df = df.withColumn("id", F.col("id") % 10007)
    return digest(df, (*SERIES, "city", "state", "type"), numeric, digits=(5, 3, 3))


# ------------------------------------------------------------------------------- features


@query
def calendar_features(spark, sf_dir):
    days = RetailTables(spark, sf_dir).train.select("date").distinct()
    columns = {n: rounded(c, 6) if n[:4] in ("sin_", "cos_") else c for n, c in calendar_columns().items()}
    return days.withColumns(columns)


@query
def payday_features(spark, sf_dir):
    days = RetailTables(spark, sf_dir).train.select("date").distinct()
    return days.withColumns(payday_columns())


def _window_digest(spark, sf_dir, columns) -> DataFrame:
    df = lags.with_log_sales(full_grid(spark, sf_dir)).withColumns(columns)
    return digest(df, SERIES, list(columns))


@query
def sales_lags(spark, sf_dir):
    return _window_digest(spark, sf_dir, lags.sales_lags())


@query
def rolling_means(spark, sf_dir):
    return _window_digest(spark, sf_dir, lags.rolling_means())


@query
def rolling_stds(spark, sf_dir):
    return _window_digest(spark, sf_dir, lags.rolling_stds())


@query
def ewma_features(spark, sf_dir):
    return _window_digest(spark, sf_dir, lags.sales_ewma(SPEC))


@query
def promo_features(spark, sf_dir):
    columns = lags.promo_windows()
    df = full_grid(spark, sf_dir).withColumns(columns).withColumns(lags.promo_intensity())
    return digest(df, SERIES, [*columns, "promo_intensity"])


@query
def feature_table(spark, sf_dir):
    """All model inputs of the full feature table, digested per series."""
    df = build_features(master(spark, sf_dir), SPEC)
    text = ("family", "city", "state", "type")
    numeric = [c for c in feature_columns(df.columns) if c not in text and c != "store_nbr"]
    return digest(df, SERIES, ["log_sales", *numeric], digits=(5, 3, 3))


@query
def feature_list(spark, sf_dir):
    """Model inputs by position, with the number of known values of each."""
    df = build_features(master(spark, sf_dir), SPEC)
    names = feature_columns(df.columns)
    known = df.agg(*[F.count(c).alias(c) for c in names])
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(c).alias("n_known"))
            for i, c in enumerate(names)
        ]
    )
    return known.select(F.inline(rows))


# --------------------------------------------------------------- split, baselines, metrics


@query
def split_parts(spark, sf_dir):
    grid = full_grid(spark, sf_dir)
    return split_report(temporal_split(grid, SPEC.val_days, last_train_day=SPEC.last_train_day))


@query
def split_by_date(spark, sf_dir):
    """The same cut on rows without a test flag, per store."""
    t = RetailTables(spark, sf_dir)
    rows = t.train.unionByName(t.actuals)
    parts = temporal_split(rows, SPEC.val_days, SPEC.test_start)
    return parts.groupBy("store_nbr", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("sales")
    )


def _rounded_scores(df: DataFrame) -> DataFrame:
    scores = ("rmsle", "mae", "rmse", "wape_pct", "bias_pct")
    return df.withColumns({c: rounded(F.col(c), 6) for c in scores})


@query
def baseline_scores(spark, sf_dir):
    return _rounded_scores(baseline_leaderboard(validation(spark, sf_dir)))


@query
def scores_by_family(spark, sf_dir):
    return _rounded_scores(evaluate(validation(spark, sf_dir), "sales", "pred_seasonal_naive", ["family"]))


@query
def scores_on_test(spark, sf_dir):
    """Forecasts of the horizon scored on the sales kept aside."""
    actuals = RetailTables(spark, sf_dir).actuals.select("id", F.col("sales").alias("actual"))
    return _rounded_scores(evaluate(horizon(spark, sf_dir).join(actuals, "id"), "actual", "sales_pred"))


@query
def series_inspection(spark, sf_dir):
    """Actual and naive forecasts of every series over the validation days."""
    return validation(spark, sf_dir).select(
        *SERIES,
        "date",
        "sales",
        rounded(F.col("pred_seasonal_naive")).alias("pred_seasonal_naive"),
        rounded(F.col("pred_naive")).alias("pred_naive"),
    )


@query
def blend_weights(spark, sf_dir):
    df = validation(spark, sf_dir)
    return _rounded_scores(blend_sweep(df, "sales", "pred_seasonal_naive", "pred_moving_average"))


@query
def residual_corr(spark, sf_dir):
    df = residual_correlation(validation(spark, sf_dir), "sales", "pred_naive", "pred_moving_average")
    return df.select(rounded(F.col("residual_corr"), 6).alias("residual_corr"))


@query
def benchmark_table(spark, sf_dir):
    return reports.benchmark_report(baseline_leaderboard(validation(spark, sf_dir)))


# ------------------------------------------------------------------------------- profiling


@query
def dataset_sizes(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    return profile.dataset_profile(
        {
            "train": t.train,
            "test": t.test,
            "stores": t.stores,
            "oil": t.oil,
            "holidays_events": t.holidays,
            "transactions": t.transactions,
        }
    )


@query
def daily_totals(spark, sf_dir):
    return profile.daily_totals(RetailTables(spark, sf_dir).train)


@query
def shock_day_total(spark, sf_dir):
    return profile.total_on(RetailTables(spark, sf_dir).train, SPEC.shock_start)


def _filled(spark, sf_dir) -> DataFrame:
    """Train part of the grid with gaps read as days without sales."""
    return full_grid(spark, sf_dir).filter(~F.col("is_test")).fillna(0.0, subset=["sales"])


@query
def zero_share(spark, sf_dir):
    df = profile.zero_share(_filled(spark, sf_dir))
    return df.select(rounded(F.col("zero_pct"), 6).alias("zero_pct"))


@query
def zero_share_by_family(spark, sf_dir):
    df = profile.zero_share(_filled(spark, sf_dir), "family")
    return df.withColumn("zero_pct", rounded(F.col("zero_pct"), 6))


@query
def weekday_profile(spark, sf_dir):
    df = profile.weekday_profile(RetailTables(spark, sf_dir).train)
    return df.withColumn("mean_sales", rounded(F.col("mean_sales"), 6))


@query
def month_day_profile(spark, sf_dir):
    df = profile.month_day_profile(RetailTables(spark, sf_dir).train)
    return df.withColumn("mean_sales", rounded(F.col("mean_sales"), 6))


@query
def year_totals(spark, sf_dir):
    df = profile.year_totals(RetailTables(spark, sf_dir).train)
    return df.withColumn("sales_millions", rounded(F.col("sales_millions"), 6))


YEARS = list(range(SPEC.calendar_start.year, SPEC.calendar_end.year + 1))


@query
def month_year_matrix(spark, sf_dir):
    df = profile.month_year_matrix(RetailTables(spark, sf_dir).train, YEARS)
    return df.select("month", *[rounded(F.col(str(y)), 6).alias(f"y{y}") for y in YEARS])


@query
def promo_share_by_month(spark, sf_dir):
    df = profile.promo_share_by_month(RetailTables(spark, sf_dir).train)
    return df.withColumn("promo_pct", rounded(F.col("promo_pct"), 6))


@query
def pareto(spark, sf_dir):
    df = profile.pareto(RetailTables(spark, sf_dir).train)
    return df.withColumns({c: rounded(F.col(c), 6) for c in ("share_pct", "cumulative_pct")})


@query
def store_totals(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    return profile.store_totals(t.train, t.stores)


@query
def store_type_boxes(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    return profile.store_type_boxes(t.train, t.stores)


@query
def top_cities(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    return profile.top_cities(t.train, t.stores)


@query
def top_families(spark, sf_dir):
    return profile.top_groups(RetailTables(spark, sf_dir).train, "family", 15)


# ----------------------------------------------------------------------- forecast views


@query
def forecast_kpis(spark, sf_dir):
    df = reports.forecast_kpis(horizon(spark, sf_dir))
    return df.withColumns({c: rounded(F.col(c)) for c in ("total_forecast", "mean_forecast")})


@query
def planned_promotions(spark, sf_dir):
    return reports.planned_promotions(horizon(spark, sf_dir))


@query
def store_cards(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    return reports.store_cards(t.stores.join(t.train.select("store_nbr"), "store_nbr", "left_semi"))


@query
def last_history(spark, sf_dir):
    return digest(reports.last_history(recent_grid(spark, sf_dir), SPEC), SERIES, ["sales", "onpromotion"])


@query
def demand_view(spark, sf_dir):
    view = reports.demand_view(recent_grid(spark, sf_dir), horizon(spark, sf_dir), SPEC)
    return digest(view, (*SERIES, "kind"), ["units", "onpromotion"])


@query
def submitted_forecasts(spark, sf_dir):
    """Submitted rows joined back to the horizon by id, as a table for people."""
    ahead = horizon(spark, sf_dir)
    joined = reports.with_submitted(ahead.drop("sales_pred"), reports.submission(ahead))
    return reports.display_table(joined)


@query
def submission(spark, sf_dir):
    df = reports.submission(horizon(spark, sf_dir))
    return df.withColumn("sales", rounded(F.col("sales")))


@query
def promo_scenarios(spark, sf_dir):
    df = reports.promo_scenarios(horizon(spark, sf_dir))
    return df.groupBy("store_nbr", "boost_pct").agg(
        F.count(F.lit(1)).alias("n_rows"),
        rounded(F.sum("sales_pred")).alias("base"),
        rounded(F.sum("sales_simulated")).alias("simulated"),
    )


@query
def promo_plan(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    observed = t.test.join(horizon(spark, sf_dir).select("id", "sales_pred"), "id")
    return reports.promo_plan(observed)


def forecast_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer, some for unknown stores or families or for other days."""
    families = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "BULK", "GIFT"]
    key = F.col("c_custkey")
    start = F.when(key % 3 > 0, F.date_add(F.lit(SPEC.test_start), (key % 5).cast("int") * 5))
    return read(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        (key % 120).alias("store_nbr"),
        F.element_at(F.array(*map(F.lit, families)), (F.col("c_nationkey") % 8 + 1)).alias("family"),
        start.alias("start_date"),
        F.when(key % 4 > 0, F.lit(SPEC.calendar_end)).alias("end_date"),
    )


def _checked(spark, sf_dir) -> DataFrame:
    catalogue = settled(RetailTables(spark, sf_dir).catalogue)
    return reports.checked_requests(
        forecast_requests(spark, sf_dir),
        horizon(spark, sf_dir, catalogue),
        catalogue,
        store_range=(0, 109),
        default_days=(SPEC.test_start, SPEC.calendar_end),
    )


def short_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer for a few recent days of one of few series, so that their days overlap, meet or leave
    gaps; some end before they start, some leave an end open."""
    key = F.col("c_custkey")
    start = F.date_sub(F.lit(SPEC.test_start), (key * 13 % 60).cast("int"))
    return read(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        (key % 12).alias("store_nbr"),
        F.when(key % 5 < 4, "PROMO").otherwise("SMALL").alias("family"),
        start.alias("start_date"),
        F.when(key % 17 > 0, F.date_add(start, (key % 4 - 1).cast("int"))).alias("end_date"),
    )


@query
def asked_days(spark, sf_dir):
    """The days that requests ask for, and the grid rows on them."""
    spans = reports.asked_days(short_requests(spark, sf_dir), (SPEC.test_start, SPEC.calendar_end))
    rows = reports.only_asked(recent_grid(spark, sf_dir), spans).groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n_rows"))
    listed = spans.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n_spans"), F.min("first_day").alias("first_day"), F.sum(F.datediff("last_day", "first_day") + 1).alias("n_days")
    )
    return listed.join(rows, list(SERIES), "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


@query
def forecast_slice(spark, sf_dir):
    return reports.forecast_slice(_checked(spark, sf_dir))


@query
def request_rejects(spark, sf_dir):
    return reports.rejected_requests(_checked(spark, sf_dir))


@query
def catalogue_health(spark, sf_dir):
    return reports.catalogue_health(full_grid(spark, sf_dir))


# ------------------------------------------------------------------------- boosted trees

# The trees of these queries learn from all labelled rows, or, only if a number is set, from so many, chosen by hash.
LABELLED_ROWS: int | None = None


def _labelled(spark, sf_dir) -> DataFrame:
    """Train and validation rows with sales, stored: the windows are computed in one pass for all that is read of them."""
    features = build_features(master(spark, sf_dir), SPEC)
    parts = temporal_split(features, SPEC.val_days, last_train_day=SPEC.last_train_day)
    return settled(parts.filter("log_sales IS NOT NULL AND split IN ('train', 'val')"))


def _parts(labelled: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Train rows, their categoricals and log sales, those that the trees learn from, and validation rows."""
    train, val = (labelled.filter(F.col("split") == x).drop("split") for x in ("train", "val"))
    learn = train if LABELLED_ROWS is None else train.orderBy(F.xxhash64(*SERIES, "date")).limit(LABELLED_ROWS)
    return train, train.select("date", *CATEGORICALS, "log_sales"), learn, val


def _model_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train rows with sales, those of them that the trees learn from, and validation rows with sales."""
    train, _, learn, val = _model_tables(spark, sf_dir)
    return train, learn, val


def _model_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return _parts(_labelled(spark, sf_dir))


@query
def gbt_scores(spark, sf_dir):
    """Benchmark of both boosted flavours, their blend and the naive forecast, and what must hold of it."""
    labelled = _labelled(spark, sf_dir)
    _, encoded, learn, val = _parts(labelled)
    ensemble = Ensemble(fit_models(encoded, val, learn=learn))
    scored = ensemble.score(with_baselines(val))
    names = {**MODELS, "Blend 50% + 50%": "pred_blend", "Naive (Lag 16)": "pred_naive"}
    board = leaderboard(scored, "sales", names)
    known = scored.agg(*[F.count_if(F.col(c) >= 0).alias(c) for c in names.values()]).first()  # one row
    counts = F.create_map(*[F.lit(x) for name, c in names.items() for x in (name, known[c])])
    naive = F.max(F.when(F.col("model") == "Naive (Lag 16)", F.col("rmsle"))).over(Window.partitionBy())
    facts = board.select(
        "model",
        "n_scored",
        counts[F.col("model")].cast("long").alias("n_not_negative"),
        (F.col("rmsle") <= naive).alias("no_worse_than_naive"),
    )
    rows = spark.createDataFrame(facts.collect(), facts.schema)  # one row per model
    labelled.unpersist()
    return rows


@query
def gbt_importance(spark, sf_dir):
    """The features a model may use, the sum of their gains, and whether the splits are the trees' inner nodes."""
    labelled = _labelled(spark, sf_dir)
    _, encoded, learn, val = _parts(labelled)
    model = fit_forecaster(encoded, val, LEAF_WISE, learn)
    names = feature_columns(learn.columns)
    table = feature_importance(model, learn, len(names))
    inner = sum(tree.numNodes // 2 for tree in model.stages[-1].trees)
    labelled.unpersist()
    return table.agg(
        F.count("*").alias("n_features"),
        F.count_if(F.col("feature").isin(names)).alias("n_known"),
        F.round(F.sum("importance_gain"), 6).alias("gain"),
        (F.sum("importance_split") == inner).alias("splits_are_inner_nodes"),
        F.count_if(F.col("importance_gain") < 0).alias("n_negative"),
    )
