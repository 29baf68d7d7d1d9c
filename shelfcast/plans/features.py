"""Feature table: calendar, payday, lag, rolling, EWMA and promotion columns on the master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import calendar_columns, payday_columns
from shelfcast.operators.lags import with_lag_features
from shelfcast.spec import DemandSpec

WARM_UP = ("sales_lag_", "sales_roll_", "sales_ewm_")


def with_time_features(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns()).withColumns(payday_columns())


def fill_warm_up(df: DataFrame) -> DataFrame:
    """Zero for every missing lag, rolling or weighted mean.

    `fillna` would also look for NaN, which ingestion has removed; its longer code keeps the
    JVM from compiling the projection of the wide table.
    """
    warm = [c for c in df.columns if c.startswith(WARM_UP)]
    return df.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in warm})


def build_features(master: DataFrame, spec: DemandSpec) -> DataFrame:
    """54 columns from the feature start date on.

    The date filter comes after the windows: they need the days before it. Calendar columns
    follow the windows, which so carry fewer columns, and are then put before the lags.
    """
    windowed = with_lag_features(master, spec)
    kept = fill_warm_up(windowed.filter(F.col("date") >= F.lit(spec.feature_start)))
    df = with_time_features(kept)
    time_columns = df.columns[len(windowed.columns) :]
    return df.select(*master.columns, *time_columns, *windowed.columns[len(master.columns) :])
