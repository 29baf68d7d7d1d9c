"""Exact linear quantiles per group for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # the sketch misses a rank by at most rows / ACCURACY
MARGIN = 10 / ACCURACY  # bracket on each side of a quantile, in ranks / rows


def exact_quantiles(df: DataFrame, group: str, value: str, probs: dict[str, float]) -> DataFrame:
    """`group` and one column per named quantile, interpolated between neighbouring ranks.

    The built-in exact percentile gathers all values of a group in one task. Here a mergeable
    sketch brackets each quantile first; rows below the bracket are only counted, and only the
    small share inside it is ordered.
    """
    lows = [max(p - MARGIN, 0.0) for p in probs.values()]
    highs = [min(p + MARGIN, 1.0) for p in probs.values()]
    large = F.col("rows") > ACCURACY  # a smaller group is ordered whole
    brackets = (
        df.groupBy(group)
        .agg(
            F.count(value).alias("rows"),
            F.percentile_approx(value, lows, ACCURACY).alias("lows"),
            F.percentile_approx(value, highs, ACCURACY).alias("highs"),
        )
        .withColumn(
            "targets",
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("name"),
                        F.when(large, F.col("lows")[i]).alias("low"),
                        F.when(large, F.col("highs")[i]).alias("high"),
                        ((F.col("rows") - 1) * F.lit(p)).alias("rank"),
                    )
                    for i, (name, p) in enumerate(probs.items())
                ]
            ),
        )
        .select(group, F.inline("targets"))
    )
    # Equal values collapse into one counted row before anything is ordered.
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    under = F.coalesce(F.col(value) < F.col("low"), F.lit(False))
    over = F.coalesce(F.col(value) > F.col("high"), F.lit(False))
    targeted = counts.join(brackets, group).filter(~over)
    key = [group, "name"]
    below = targeted.groupBy(*key).agg(
        F.sum(F.when(under, F.col("n")).otherwise(0)).alias("below")
    )
    in_order = Window.partitionBy(*key).orderBy(value)
    upto = F.col("below") + F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = (
        targeted.filter(~under)
        .join(below, key)
        .withColumn("upto", upto)
        .withColumn("start", F.col("upto") - F.col("n"))
    )

    def at(rank):
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("upto")), F.col(value)))

    lower, upper = at(F.floor("rank")), at(F.ceil("rank"))
    missed = F.raise_error(F.lit("the sketch's bracket misses a quantile")).cast("double")
    lower, upper = F.coalesce(lower, missed), F.coalesce(upper, missed)
    share = F.max(F.col("rank") - F.floor("rank"))
    quantiles = ranked.groupBy(*key).agg((lower + (upper - lower) * share).alias("quantile"))
    return quantiles.groupBy(group).agg(
        *[F.max(F.when(F.col("name") == name, F.col("quantile"))).alias(name) for name in probs]
    )


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and the rows outside them."""
    quartiles = exact_quantiles(df, group, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    v, reach = F.col(value), (F.col("q3") - F.col("q1")) * 1.5
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        df.join(quartiles, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )
