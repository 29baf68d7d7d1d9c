"""Parameters shared by every operator: series keys, dates, horizon and feature lists."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

# One series is one store selling one product family, one row per day.
SERIES = ("store_nbr", "family")
CELL = (*SERIES, "date")

# Days to forecast, and the look-back of every lag and rolling feature.
HORIZON = 16
SALES_LAGS = (16, 17, 18, 19, 20, 21, 28, 35, 42)
MEAN_SPANS = (7, 14, 30, 60)
STD_SPANS = (7, 30)
EWM_ALPHAS = {"sales_ewm_alpha_01": 0.1, "sales_ewm_alpha_03": 0.3}
PROMO_SPAN = 14
OIL_SPANS = (7, 30)

# Columns of the feature table that a model must not see, and the categorical inputs.
NON_FEATURES = ("id", "date", "sales", "log_sales", "is_test")
CATEGORICALS = ("store_nbr", "family", "city", "state", "type", "cluster")

# A daily table holds one row per calendar day, so this many days bound its size.
MAX_BROADCAST_DAYS = 100_000


@dataclass(frozen=True)
class DemandSpec:
    """Calendar and rules of one retail data set. The defaults are those of the original data."""

    calendar_start: date = date(2013, 1, 1)
    calendar_end: date = date(2017, 8, 31)
    test_start: date = date(2017, 8, 16)
    feature_start: date = date(2014, 5, 1)
    shock_start: date = date(2016, 4, 16)
    shock_end: date = date(2016, 5, 31)
    closures: tuple[tuple[int, int], ...] = ((12, 25),)  # (month, day) of every year
    val_days: int = 16

    @property
    def last_train_day(self) -> date:
        return self.test_start - timedelta(days=1)

    @property
    def val_start(self) -> date:
        return self.test_start - timedelta(days=self.val_days)

    @property
    def n_days(self) -> int:
        return (self.calendar_end - self.calendar_start).days + 1

    def since(self, first_day: date) -> DemandSpec:
        """The same rules on a calendar that starts no earlier than `first_day`.

        Frames look back a fixed number of days, so a job that needs only recent days can
        leave older sales unread.
        """
        return replace(self, calendar_start=max(self.calendar_start, first_day))


def is_feature(column: str) -> bool:
    return column not in NON_FEATURES


def feature_columns(columns: list[str]) -> list[str]:
    """Model inputs, in table order: every column but the ignored ones."""
    return [c for c in columns if is_feature(c)]
