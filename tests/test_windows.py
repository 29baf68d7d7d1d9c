"""Window features against their definitions, day by day, on small dense series with gaps and zeros."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import lags
from shelfcast.operators.ewma import era_ends, ewma
from shelfcast.spec import EWM_ALPHAS, MEAN_SPANS, SALES_LAGS, STD_SPANS, DemandSpec

START, DAYS = date(2015, 1, 1), 730
SPEC = DemandSpec(calendar_start=START, calendar_end=START + timedelta(days=DAYS - 1))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    frames = []
    for store, family in [(1, "A"), (1, "B"), (2, "A"), (2, "B")]:
        sales = np.round(rng.gamma(2.0, 30.0, DAYS))
        kind = rng.random(DAYS)
        sales[kind < 0.2] = np.nan
        sales[kind > 0.8] = 0.0
        sales[-16:] = np.nan
        frames.append(
            pd.DataFrame(
                {
                    "store_nbr": store,
                    "family": family,
                    "date": pd.date_range(START, periods=DAYS).date,
                    "sales": sales,
                    "onpromotion": rng.integers(0, 6, DAYS),
                }
            )
        )
    frames[3].loc[:400, "sales"] = np.nan  # late start
    frames[2].loc[100:500, "sales"] = np.nan  # long gap
    frames[0].loc[50:90, "sales"] = 7.0  # constant stretch: deviation is exactly zero
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, rows):
    schema = "store_nbr int, family string, date date, sales double, onpromotion long"
    values = rows.astype(object).where(rows.notna(), None)
    return spark.createDataFrame(list(values.itertuples(index=False, name=None)), schema)


@pytest.fixture(scope="module")
def features(spark, rows):
    df = lags.with_lag_features(to_spark(spark, rows), SPEC).toPandas()
    return df.sort_values(["store_nbr", "family", "date"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def series(rows):
    """Arrays of log sales and promotions of every series, by day, in the order of the feature rows."""
    ordered = rows.sort_values(["store_nbr", "family", "date"])
    out = []
    for k in range(0, len(ordered), DAYS):
        part = ordered.iloc[k : k + DAYS]
        sales = part["sales"].to_numpy(dtype=float)
        out.append((np.log1p(np.maximum(sales, 0)), part["onpromotion"].to_numpy(dtype=float)))
    return out


def same(actual, expected, tolerance=1e-10):
    np.testing.assert_allclose(np.asarray(actual, float), np.asarray(expected, float), rtol=0, atol=tolerance, equal_nan=True)


def by_day(series, value, which=0):
    """`value(x, t)` of every series and day t."""
    return [value(s[which], t) for s in series for t in range(DAYS)]


def known(x, low, high):
    """Known values of days low to high, as far as there are such days."""
    part = x[max(0, low) : max(0, high + 1)]
    return part[~np.isnan(part)]


@pytest.mark.parametrize("n", SALES_LAGS)
def test_lags(features, series, n):
    same(features[f"sales_lag_{n}"], by_day(series, lambda x, t: x[t - n] if t >= n else np.nan))


@pytest.mark.parametrize("n", MEAN_SPANS)
def test_rolling_means(features, series, n):
    def mean(x, t):
        window = known(x, t - 15 - n, t - 16)
        return sum(window) / len(window) if len(window) else np.nan

    same(features[f"sales_roll_mean_{n}"], by_day(series, mean))


@pytest.mark.parametrize("n", STD_SPANS)
def test_rolling_stds(features, series, n):
    def deviation(x, t):
        window = known(x, t - 15 - n, t - 16)
        if len(window) < 2:
            return 0.0
        centre = sum(window) / len(window)
        return (sum((v - centre) ** 2 for v in window) / (len(window) - 1)) ** 0.5

    same(features[f"sales_roll_std_{n}"], by_day(series, deviation), 1e-6)
    flat = features["sales_roll_std_7"][50 + 16 + 7 : 90 + 16]
    assert (flat == 0).all()


@pytest.mark.parametrize("name", EWM_ALPHAS)
def test_weighted_means(features, series, name):
    keep = 1 - EWM_ALPHAS[name]
    expected = []
    for x, _ in series:
        top = bottom = 0.0  # sums of weighted values and of weights, both fading day by day
        for t in range(DAYS):
            top, bottom = top * keep, bottom * keep
            if t >= 16 and not np.isnan(x[t - 16]):
                top, bottom = top + x[t - 16], bottom + 1
            expected.append(top / bottom if bottom else np.nan)
    same(features[name], expected)


def test_promotions(features, series):
    def mean(x, t):
        window = x[max(0, t - 13) : t + 1]
        return sum(window) / len(window)

    means = np.array(by_day(series, mean, 1))
    same(features["promo_lag_16"], by_day(series, lambda x, t: x[t - 16] if t >= 16 else 0, 1))
    same(features["promo_roll_mean_14"], means)
    same(features["promo_intensity"], features["onpromotion"] / (means + 1.0))


@pytest.mark.parametrize("alpha", [0.02, 0.1, 0.3, 0.6, 0.95])
def test_weighted_mean_over_many_eras(spark, alpha):
    """Long series, and gaps far beyond the days after which a weight underflows."""
    n = 4000
    rng = np.random.default_rng(3)
    x = np.where(rng.random(n) < 0.3, np.nan, rng.random(n) * 9)
    x[:40] = np.nan
    x[300:2900] = np.nan
    first = date(1990, 1, 1)
    rows = [
        (first + timedelta(days=i), None if np.isnan(v) else float(v)) for i, v in enumerate(x)
    ]
    df = spark.createDataFrame(rows, "date date, x double").withColumn("k", F.lit(1))
    result = df.select("date", ewma("x", alpha, ("k",), first, n, shift=5).alias("y")).toPandas()
    expected, mean, weight = [], np.nan, 0.0
    for t in range(n):
        weight *= 1 - alpha  # what earlier days weigh together; their mean stays through a gap
        if t >= 5 and not np.isnan(x[t - 5]):
            before = mean * weight if weight else 0.0
            mean, weight = (before + x[t - 5]) / (weight + 1), weight + 1
        expected.append(mean)
    same(result.sort_values("date")["y"], expected)


def test_eras_cover_the_calendar():
    for alpha in (0.01, 0.3, 0.9, 0.999):
        ends = era_ends(alpha, 2404)
        assert ends[-1] == 2403 and all(a < b for a, b in zip(ends, ends[1:]))
    assert era_ends(0.1, 1704) == [1703]


def test_no_leakage(spark, rows, features):
    """Sales of the last 16 days before a day do not change any feature of that day."""
    changed = rows.copy()
    cut = START + timedelta(days=600)
    changed.loc[changed["date"] > cut - timedelta(days=16), "sales"] = 1e6
    again = lags.with_lag_features(to_spark(spark, changed), SPEC).toPandas()
    again = again.sort_values(["store_nbr", "family", "date"]).reset_index(drop=True)
    columns = [c for c in features.columns if c.startswith(("sales_", "promo_"))]
    at = features["date"] == cut
    pd.testing.assert_frame_equal(features.loc[at, columns], again.loc[at, columns])
    assert not features["sales_lag_16"].equals(again["sales_lag_16"])
