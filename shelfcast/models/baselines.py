"""Reference forecasts read off the feature columns, and their leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import leaderboard
from shelfcast.functions.scale import from_log

# Model name -> log-scale feature it repeats, and its prediction column.
BASELINES = {
    "Naive (Lag 16)": ("sales_lag_16", "pred_naive"),
    "Seasonal Naive (Lag 21)": ("sales_lag_21", "pred_seasonal_naive"),
    "Moving Average 7d (Shift 16)": ("sales_roll_mean_7", "pred_moving_average"),
}
PREDICTIONS = {model: column for model, (_, column) in BASELINES.items()}

# Days before a forecast day that the three models look back: 16 shifted days and 7 averaged.
LOOKBACK_DAYS = 22


def with_baselines(features: DataFrame) -> DataFrame:
    """One prediction column per baseline, in units sold."""
    return features.withColumns(
        {column: from_log(F.col(feature)) for feature, column in BASELINES.values()}
    )


def baseline_leaderboard(features: DataFrame) -> DataFrame:
    """Scores of the three baselines over the rows with actual sales, best first."""
    return leaderboard(with_baselines(features), "sales", PREDICTIONS)
