"""Tables behind forecast views: KPIs, demand view, scenarios, requests, benchmark, catalogue.

A forecast table has one row per series and horizon day: store_nbr, family, date, id,
onpromotion and sales_pred.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.scale import promo_uplift, simulated_promotions
from shelfcast.operators.grid import distinct_values
from shelfcast.operators.sides import broadcast_dimension
from shelfcast.spec import SERIES, DemandSpec

# Change in promotions offered by the what-if table, in percent.
PROMO_BOOSTS = tuple(range(-50, 101, 5))
HISTORY_DAYS = 60


def with_submitted(test: DataFrame, submission: DataFrame) -> DataFrame:
    """Horizon rows joined by id with a submission (id, sales); its sales become sales_pred."""
    return test.join(submission.withColumnRenamed("sales", "sales_pred"), "id")


def forecast_kpis(forecasts: DataFrame) -> DataFrame:
    """Total, mean, peak day (the earliest of equal peaks) and days of each series."""
    peak = F.max(F.struct(F.col("sales_pred"), -F.datediff("date", F.lit("1970-01-01")), "date"))
    return (
        forecasts.groupBy(*SERIES)
        .agg(
            F.sum("sales_pred").alias("total_forecast"),
            F.avg("sales_pred").alias("mean_forecast"),
            peak.alias("peak"),
            F.count(F.lit(1)).alias("horizon_days"),
        )
        .withColumn("peak", F.col("peak.date"))
        .withColumnRenamed("peak", "peak_date")
    )


def planned_promotions(forecasts: DataFrame) -> DataFrame:
    """Mean planned promotions per series, cut to a whole number."""
    return forecasts.groupBy(*SERIES).agg(F.avg("onpromotion").cast("int").alias("planned"))


def store_cards(df: DataFrame) -> DataFrame:
    """One row of attributes per store: if they differ between rows, the first of them in order."""
    columns = ["city", "state", "type", "cluster"]
    return df.groupBy("store_nbr").agg(F.min(F.struct(*columns)).alias("card")).select("store_nbr", "card.*")


def last_history(grid: DataFrame, spec: DemandSpec, n: int = HISTORY_DAYS) -> DataFrame:
    """The latest `n` days before the test part of every series: the grid has every day, so it is a date range."""
    first_day = spec.test_start - timedelta(days=n)
    return grid.filter(~F.col("is_test") & (F.col("date") >= F.lit(first_day)))


def demand_view(grid: DataFrame, forecasts: DataFrame, spec: DemandSpec, n: int = HISTORY_DAYS) -> DataFrame:
    """Recent actuals and the forecast of every series in one long table."""
    history = last_history(grid, spec, n).select(
        *SERIES, "date", "onpromotion", F.lit("actual").alias("kind"), F.col("sales").alias("units")
    )
    horizon = forecasts.select(
        *SERIES, "date", "onpromotion", F.lit("forecast").alias("kind"), F.col("sales_pred").alias("units")
    )
    return history.unionByName(horizon)


def display_table(forecasts: DataFrame) -> DataFrame:
    """Forecast days as text with rounded units, for people."""
    return forecasts.select(
        *SERIES,
        F.date_format("date", "yyyy-MM-dd").alias("day"),
        F.col("onpromotion").alias("active_promotions"),
        F.round("sales_pred", 2).alias("forecast_units"),
    )


def promo_scenarios(forecasts: DataFrame, boosts: tuple[int, ...] = PROMO_BOOSTS) -> DataFrame:
    """Every forecast row under every change in promotions."""
    boost = F.explode(F.array(*map(F.lit, boosts))).alias("boost_pct")
    return forecasts.select("*", boost).withColumn(
        "sales_simulated", promo_uplift(F.col("sales_pred"), F.col("boost_pct"))
    )


def promo_plan(forecasts: DataFrame, boosts: tuple[int, ...] = PROMO_BOOSTS) -> DataFrame:
    """Planned and simulated promotion count per series and change in promotions."""
    boost = F.explode(F.array(*map(F.lit, boosts))).alias("boost_pct")
    return (
        planned_promotions(forecasts)
        .select("*", boost)
        .withColumn("simulated", simulated_promotions(F.col("planned"), F.col("boost_pct")))
    )


def asked_days(requests: DataFrame, default_days: tuple[date, date]) -> DataFrame:
    """The days that requests (store_nbr, family, start_date, end_date) ask for, as few spans as they make per series:
    store_nbr, family, first_day, last_day. Spans that overlap or follow each other are one; spans that end before
    they start ask for nothing.

    Requests shrink to one per series and first day before the shuffle, so a series in great demand holds at most
    a row per day.
    """
    start, end = (F.coalesce(c, F.lit(d)) for c, d in zip(("start_date", "end_date"), default_days))
    spans = requests.select(*SERIES, start.alias("first_day"), end.alias("last_day")).filter("first_day <= last_day")
    spans = spans.groupBy(*SERIES, "first_day").agg(F.max("last_day").alias("last_day"))
    by_day = Window.partitionBy(*SERIES).orderBy("first_day")
    reached = F.max("last_day").over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first_day") > F.date_add("reached", 1), F.lit(True))
    islands = spans.withColumn("reached", reached).withColumn("island", F.sum(opens.cast("int")).over(by_day))
    return islands.groupBy(*SERIES, "island").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).drop("island")


def only_asked(df: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of a dense table on the days of `spans`, as `asked_days` gives them. A short list of spans is broadcast, and
    the dense rows stay where they are."""
    side = broadcast_dimension(spans.select(*[F.col(c).alias(f"_{c}") for c in spans.columns]))
    same = [F.col(c) == F.col(f"_{c}") for c in SERIES]
    return df.join(side, [*same, F.col("date").between(F.col("_first_day"), F.col("_last_day"))], "left_semi")


def checked_requests(
    requests: DataFrame,
    forecasts: DataFrame,
    known_series: DataFrame,
    store_range: tuple[int, int],
    default_days: tuple[date, date],
) -> DataFrame:
    """Forecast requests (request_id, store_nbr, family, start_date, end_date) with `reason`,
    NULL for a valid one, and `days`, the forecast days it asks for.

    Missing dates take the defaults. `known_series` (store_nbr, family) tells which stores and
    families exist, so the forecasts are built once. Forecasts are gathered to one row per series, bounded by
    the horizon, so a series in great demand is joined once per request and not once per
    request and day.
    """
    start, end = (F.coalesce(c, F.lit(d)) for c, d in zip(("start_date", "end_date"), default_days))
    pairs = known_series.select(*SERIES).distinct()
    known = {
        "known_store": broadcast_dimension(distinct_values(pairs, "store_nbr")),
        "known_family": broadcast_dimension(distinct_values(pairs, "family")),
    }
    by_series = forecasts.groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct("date", "sales_pred"))).alias("days")
    )
    asked = requests.withColumns({"start_date": start, "end_date": end})
    for flag, values in known.items():
        asked = asked.join(values.withColumn(flag, F.lit(True)), values.columns, "left")
    asked = asked.join(by_series, list(SERIES), "left").withColumn(
        "days",
        F.filter("days", lambda d: d["date"].between(F.col("start_date"), F.col("end_date"))),
    )
    reason = (
        F.when(~F.col("store_nbr").between(*store_range), "store_out_of_range")
        .when(F.col("known_family").isNull(), "unknown_family")
        .when(F.col("known_store").isNull(), "unknown_store")
        .when(F.coalesce(F.size("days"), F.lit(0)) <= 0, "no_data")
    )
    return asked.withColumn("reason", reason).drop(*known)


def forecast_slice(checked: DataFrame) -> DataFrame:
    """One row per valid request and forecast day, predictions rounded to cents."""
    return (
        checked.filter(F.col("reason").isNull())
        .select("request_id", *SERIES, F.size("days").alias("forecast_horizon"), F.inline("days"))
        .withColumn("predicted_sales", F.round("sales_pred", 2))
        .drop("sales_pred")
    )


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNotNull()).select(
        "request_id", *SERIES, "start_date", "end_date", "reason"
    )


def benchmark_report(board: DataFrame) -> DataFrame:
    """A leaderboard rounded for people, the model of lowest RMSLE marked as champion."""
    digits = {"rmsle": 4, "mae": 2, "rmse": 2, "wape_pct": 2, "bias_pct": 2}
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("rmsle"), "model"))
    return board.withColumn("is_champion", place == 1).select(
        "model", *[F.round(c, d).alias(c) for c, d in digits.items()], "is_champion"
    )


def catalogue_health(df: DataFrame) -> DataFrame:
    """Stores, families, the series they span, rows and dates of a feature or grid table."""
    series = df.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    return series.agg(
        F.countDistinct("store_nbr").alias("n_stores"),
        F.countDistinct("family").alias("n_families"),
        F.sum("n").alias("n_rows"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
    ).withColumn("n_series", F.col("n_stores") * F.col("n_families"))


def submission(forecasts: DataFrame) -> DataFrame:
    """id and forecast units of every row that asked for one, ordered by id."""
    rows = forecasts.filter(F.col("id").isNotNull())
    return rows.select("id", F.col("sales_pred").alias("sales")).orderBy("id")
