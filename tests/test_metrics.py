import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.metrics import evaluate, leaderboard, residual_correlation
from shelfcast.functions.scale import from_log, promo_uplift, simulated_promotions, to_log
from shelfcast.models.blend import blend_sweep
from shelfcast.models.boosting import best_round
from shelfcast.operators.quantiles import ACCURACY, box_stats, exact_quantiles


def frame(spark, y, p, q=None):
    rows = list(zip(map(float, y), map(float, p), map(float, q if q is not None else p)))
    return spark.createDataFrame(rows, "y double, p double, q double")


def expected(y, p):
    p = np.clip(p, 0, None)
    return {
        "rmsle": np.sqrt(np.mean((np.log1p(np.clip(y, 0, None)) - np.log1p(p)) ** 2)),
        "mae": np.mean(np.abs(y - p)),
        "rmse": np.sqrt(np.mean((y - p) ** 2)),
        "wape_pct": np.sum(np.abs(y - p)) / np.sum(np.abs(y)) * 100,
        "bias_pct": np.sum(p - y) / np.sum(y) * 100,
    }


def test_metrics_as_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.gamma(2, 50, 500), rng.normal(100, 80, 500)
    y[:20], y[20:25] = 0, -3
    row = evaluate(frame(spark, y, p), "y", "p").first()
    for name, value in expected(y, p).items():
        assert row[name] == pytest.approx(value, rel=1e-12)
    assert row["n_scored"] == 500


def test_zero_denominators_and_missing_rows(spark):
    row = evaluate(frame(spark, [0, 0], [1, 2]), "y", "p").first()
    assert row["wape_pct"] == 0.0 and row["bias_pct"] == 0.0
    df = spark.createDataFrame([(1.0, 2.0), (None, 9.0), (5.0, None)], "y double, p double")
    row = evaluate(df, "y", "p").first()
    assert row["n_scored"] == 1 and row["mae"] == 1.0 and row["bias_pct"] == 100.0


def test_leaderboard_order(spark):
    y, p, q = np.array([1.0, 5, 9]), np.array([1.0, 5, 8]), np.array([9.0, 9, 9])
    board = leaderboard(frame(spark, y, p, q), "y", {"bad": "q", "good": "p"}).collect()
    assert [r["model"] for r in board] == ["good", "bad"]
    assert board[1]["rmse"] == pytest.approx(expected(y, q)["rmse"])


def test_blend_sweep(spark):
    y, p, q = np.array([4.0, 8]), np.array([2.0, 6]), np.array([8.0, 14])
    board = blend_sweep(frame(spark, y, p, q), "y", "p", "q").toPandas().set_index("model")
    assert board.loc["Blend 30% + 70%", "mae"] == pytest.approx(expected(y, 0.3 * p + 0.7 * q)["mae"])
    assert len(board) == 3


def test_residual_correlation(spark):
    rng = np.random.default_rng(2)
    y, p, q = (rng.gamma(2, 50, 200) for _ in range(3))
    a, b = np.log1p(y) - np.log1p(p), np.log1p(y) - np.log1p(q)
    actual = residual_correlation(frame(spark, y, p, q), "y", "p", "q").first()[0]
    assert actual == pytest.approx(np.corrcoef(a, b)[0, 1], rel=1e-10)


def test_log_scale_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (3.0,)], "x double")
    rows = df.select(to_log(F.col("x")).alias("l"), from_log(F.col("x")).alias("e")).collect()
    assert rows[0]["l"] is None and rows[0]["e"] is None and rows[1]["l"] == 0 and rows[1]["e"] == 0
    assert rows[2]["l"] == pytest.approx(np.log1p(3)) and rows[2]["e"] == pytest.approx(np.expm1(3))


def test_promotion_what_if(spark):
    df = spark.range(1).select(
        promo_uplift(F.lit(200.0), F.lit(20)).alias("up"), simulated_promotions(F.lit(7), F.lit(-50)).alias("n")
    )
    assert df.first()["up"] == pytest.approx(200 * 1.07) and df.first()["n"] == 3


@pytest.mark.parametrize("size", [1, 2, 5, 1000, 3 * ACCURACY])
def test_exact_quantiles(spark, size):
    rng = np.random.default_rng(size)
    values = rng.lognormal(3, 2, size)
    values[: size // 3] = values[0]  # a third of the group is one value
    pdf = pd.DataFrame({"g": "hot", "v": values})
    pdf = pd.concat([pdf, pd.DataFrame({"g": "small", "v": [1.0, 2.0, 4.0]})])
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    rows = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(pdf), "g", "v", probs).collect()}
    for name, p in probs.items():
        assert rows["hot"][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert rows["small"]["b"] == 1.5


def test_box_stats(spark):
    pdf = pd.DataFrame({"t": "A", "v": [1.0, 2, 3, 4, 5, 6, 7, 100]})
    row = box_stats(spark.createDataFrame(pdf), "t", "v").first()
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (1.0, 7.0, 1)


def test_best_round():
    assert best_round([5, 4, 3, 3.5, 3.4, 2], 2) == 3
    assert best_round([5, 4, 3, 3.5, 2], 3) == 5
    assert best_round([1], 50) == 1
