"""Leakage-safe lag, rolling and promotion features of each series on the dense grid.

Sales features look back at least HORIZON days. All frames count rows, which are days here
because the grid has no gaps; a series holds one row per calendar day, so a window task is
bounded by the calendar however skewed the sales are. Every window has the same partitioning
and order: Spark evaluates all of them in one pass over one sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scale import to_log
from shelfcast.operators.ewma import ewma
from shelfcast.operators.rolling import rolled
from shelfcast.operators.workers import ship
from shelfcast.spec import (
    EWM_ALPHAS,
    HORIZON,
    MEAN_SPANS,
    PROMO_SPAN,
    SALES_LAGS,
    SERIES,
    STD_SPANS,
    DemandSpec,
)

BY_DAY = f"PARTITION BY {', '.join(SERIES)} ORDER BY date"
LOG_UNITS = 2**40  # units per 1.0 of log sales; a sum of 400,000 days still fits 64 bits


def with_log_sales(df: DataFrame) -> DataFrame:
    return df.withColumn("log_sales", to_log(F.col("sales")))


def sales_lags() -> dict[str, Column]:
    return {f"sales_lag_{n}": F.expr(f"lag(log_sales, {n}) OVER ({BY_DAY})") for n in SALES_LAGS}


def _running(value: str, delay: int) -> str:
    """Sum of all days up to `delay` days back."""
    frame = f"ROWS BETWEEN UNBOUNDED PRECEDING AND {-delay} FOLLOWING"
    return f"coalesce(sum({value}) OVER ({BY_DAY} {frame}), 0)"


def _rolling(value: str, span: int, delay: int) -> str:
    """Sum of the `span` days up to `delay` days back, as a difference of running sums.

    The cost per row does not grow with the span. Whole numbers only: their sums are exact.
    """
    return f"({_running(value, delay)} - {_running(value, delay + span)})"


def rolling_means() -> dict[str, Column]:
    """Means over the delayed days that have sales; shorter at the start of a series.

    Log sales are summed as 64-bit counts of a tiny unit, which moves a mean by less than 1e-12.
    """
    units = f"CAST(rint(log_sales * {LOG_UNITS}D) AS BIGINT)"
    known = "CAST(log_sales IS NOT NULL AS INT)"
    return {
        f"sales_roll_mean_{n}": F.expr(
            f"try_divide({_rolling(units, n, HORIZON)}, {_rolling(known, n, HORIZON)}) / {LOG_UNITS}D"
        )
        for n in MEAN_SPANS
    }


def rolling_stds() -> dict[str, Column]:
    """Sample deviation; a single observation, or none, gives 0.

    Differences of running sums of squares would lose the small deviations, so these frames
    slide.
    """
    return {
        f"sales_roll_std_{n}": F.expr(
            f"coalesce(stddev_samp(log_sales) OVER ({BY_DAY}"
            f" ROWS BETWEEN {HORIZON + n - 1} PRECEDING AND {HORIZON} PRECEDING), 0D)"
        )
        for n in STD_SPANS
    }


def sales_ewma(spec: DemandSpec) -> dict[str, Column]:
    return {
        name: ewma("log_sales", alpha, SERIES, spec.calendar_start, spec.n_days, shift=HORIZON)
        for name, alpha in EWM_ALPHAS.items()
    }


def promo_windows() -> dict[str, Column]:
    """Promotions are planned ahead, so the current day counts too."""
    return {
        "promo_lag_0": F.expr("CAST(onpromotion AS DOUBLE)"),
        "promo_lag_16": F.expr(
            f"CAST(coalesce(lag(onpromotion, {HORIZON}) OVER ({BY_DAY}), 0) AS DOUBLE)"
        ),
        "promo_roll_mean_14": F.expr(
            f"{_rolling('onpromotion', PROMO_SPAN, 0)} / {_rolling('1', PROMO_SPAN, 0)}"
        ),
    }


def promo_intensity() -> dict[str, Column]:
    return {"promo_intensity": F.col("promo_lag_0") / (F.col("promo_roll_mean_14") + 1.0)}


def with_rolled(df: DataFrame, names: list[str]) -> DataFrame:
    """The rolling and weighted columns `names`, in the order MEAN_SPANS, STD_SPANS, EWM_ALPHAS, of rows that lie series by
    series in order of days, as a window has left them. Day and value go to Python alone; a filter must not get below,
    hence not deterministic."""
    ship(df.sparkSession)
    schema = ", ".join(f"c{i} double" for i in range(len(names)))
    run = rolled(HORIZON, MEAN_SPANS, STD_SPANS, tuple(EWM_ALPHAS.values()), LOG_UNITS)

    @F.arrow_udf(schema)
    def columns(rows: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from run(rows)

    made = columns.asNondeterministic()(F.xxhash64(*SERIES), F.unix_date("date"), "log_sales")
    in_order = df.sortWithinPartitions(*SERIES, "date").withColumn("_rolled", made)  # no sort: the windows have made it
    return in_order.select(*df.columns, *[F.col("_rolled")[f"c{i}"].alias(name) for i, name in enumerate(names)])


def with_lag_features(df: DataFrame, spec: DemandSpec) -> DataFrame:
    """log_sales and the 21 lag, rolling, weighted and promotion columns of a dense grid.

    Lags and promotions are windows; rolling and weighted columns, equal to `rolling_means`, `rolling_stds` and
    `sales_ewma`, follow in one pass over the rows that these windows have put in order.
    """
    windows = {**sales_lags(), **promo_windows()}
    names = [*rolling_means(), *rolling_stds(), *sales_ewma(spec)]
    rows = with_rolled(with_log_sales(df).withColumns(windows), names)
    rows = rows.select(*df.columns, "log_sales", *sales_lags(), *names, *promo_windows())
    return rows.withColumns(promo_intensity())
