"""Column expressions on sales and forecasts: log scale, blending, promotion what-if."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: share of a change in promotions that reaches sales.
PROMO_ELASTICITY = 0.35


def floor_zero(c: Column) -> Column:
    """max(c, 0) that keeps NULL: `greatest` alone would turn a gap into a real zero."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def to_log(c: Column) -> Column:
    return F.log1p(floor_zero(c))


def from_log(c: Column) -> Column:
    return F.expm1(floor_zero(c))


def blend(parts: list[tuple[Column | float, Column]]) -> Column:
    """Weighted sum of predictions."""
    total = None
    for weight, prediction in parts:
        term = (F.lit(weight) if isinstance(weight, float) else weight) * prediction
        total = term if total is None else total + term
    return total


def promo_uplift(prediction: Column, boost_pct: Column) -> Column:
    return prediction * (1 + boost_pct / 100.0 * PROMO_ELASTICITY)


def simulated_promotions(planned: Column, boost_pct: Column) -> Column:
    """Planned promotion count under a change in percent, cut to a whole number."""
    return (planned * (1 + boost_pct / 100.0)).cast("int")
