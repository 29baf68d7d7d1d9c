"""Profiling reports over raw sales and dimensions.

Each report is one or two aggregations with map-side combine, so hot stores or families cost
no more than others.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import box_stats


def dataset_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and first and last date of each named table."""

    def row(name: str, df: DataFrame) -> DataFrame:
        day = F.col("date") if "date" in df.columns else F.lit(None).cast("date")
        return df.select(day.alias("date")).agg(
            F.lit(name).alias("dataset"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )

    return reduce(DataFrame.unionByName, [row(*item) for item in tables.items()])


def daily_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date").agg(F.sum("sales").alias("sales"))


def total_on(sales: DataFrame, day: date) -> DataFrame:
    """Total of one day; the filter reaches the scan."""
    return daily_totals(sales.filter(F.col("date") == F.lit(day)))


def zero_share(sales: DataFrame, by: str | None = None) -> DataFrame:
    """Percent of rows without any units sold, highest first when grouped."""
    share = (F.avg((F.col("sales") == 0).cast("double")) * 100).alias("zero_pct")
    if by is None:
        return sales.agg(share)
    return sales.groupBy(by).agg(share).orderBy(F.desc("zero_pct"), by)


def weekday_profile(sales: DataFrame) -> DataFrame:
    """Mean sales per row by weekday, Monday first."""
    named = sales.select(
        F.weekday("date").alias("dayofweek"), F.date_format("date", "EEEE").alias("day_name"), "sales"
    )
    return (
        named.groupBy("dayofweek", "day_name")
        .agg(F.avg("sales").alias("mean_sales"))
        .orderBy("dayofweek")
    )


def month_day_profile(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(F.dayofmonth("date").alias("day"))
        .agg(F.avg("sales").alias("mean_sales"))
        .orderBy("day")
    )


def year_totals(sales: DataFrame) -> DataFrame:
    """Units sold per year, in millions."""
    return (
        sales.groupBy(F.year("date").alias("year"))
        .agg((F.sum("sales") / 1e6).alias("sales_millions"))
        .orderBy("year")
    )


def month_year_matrix(sales: DataFrame, years: list[int]) -> DataFrame:
    """Mean sales per row, months down and the given years across. Sales of any other year are an error: they would
    vanish without a word."""
    year = F.year("date")
    other = F.raise_error(F.concat(F.lit("sales of a year that is not listed: "), year.cast("string"))).cast("int")
    listed = F.when(year.isin(*years) | year.isNull(), year).otherwise(other)
    dated = sales.select(listed.alias("year"), F.month("date").alias("month"), "sales")
    return dated.groupBy("month").pivot("year", years).agg(F.avg("sales")).orderBy("month")


def promo_share_by_month(sales: DataFrame) -> DataFrame:
    """Percent of rows with a promotion per calendar month."""
    promoted = (F.col("onpromotion") > 0).cast("double")
    return (
        sales.groupBy(F.date_format("date", "yyyy-MM").alias("period"))
        .agg((F.avg(promoted) * 100).alias("promo_pct"))
        .orderBy("period")
    )


def top_groups(df: DataFrame, by: str, n: int) -> DataFrame:
    """The `n` groups that sold most."""
    totals = df.groupBy(by).agg(F.sum("sales").alias("sales"))
    return totals.orderBy(F.desc("sales"), by).limit(n)


def pareto(sales: DataFrame, by: str = "family", n: int = 15) -> DataFrame:
    """Top groups with their share of all sales and the running share.

    The report holds the top `n` rows, and their running share needs no others, so only they
    are ordered in one task.
    """
    overall = sales.agg(F.sum("sales")).scalar()
    running = Window.orderBy(F.desc("sales"), by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        top_groups(sales, by, n)
        .withColumn("share_pct", F.col("sales") / overall * 100)
        .withColumn("cumulative_pct", F.sum("share_pct").over(running))
    )


def store_totals(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Units sold per store with the store's attributes; the join meets one row per store."""
    totals = sales.groupBy("store_nbr").agg(F.sum("sales").alias("sales"))
    return totals.join(stores, "store_nbr")


def store_type_boxes(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return box_stats(store_totals(sales, stores), "type", "sales")


def top_cities(sales: DataFrame, stores: DataFrame, n: int = 10) -> DataFrame:
    return top_groups(store_totals(sales, stores), "city", n)
