"""Rolling columns in one pass, and sums of many columns, against what windows and aggregates give."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import lags
from shelfcast.operators.rolling import rolled
from shelfcast.operators.sums import partial_sums
from shelfcast.workload import queries as q
from shelfcast.workload.tables import SPEC


def days(spark, n_days=420):
    """Five series of all days: known all the time, seldom, never, after a long gap, and always the same; one key is null."""
    df = spark.range(5 * n_days).select(
        F.when(F.col("id") % 5 != 3, F.col("id") % 5).alias("store_nbr"),
        F.concat(F.lit("F"), F.col("id") % 5 % 2).alias("family"),
        F.date_add(F.lit(SPEC.calendar_start), (F.col("id") / 5).cast("int")).alias("date"),
        (F.col("id") % 5).alias("kind"), F.rand(1).alias("r"), F.rand(2).alias("level"),
    )
    nth = F.datediff("date", F.lit(SPEC.calendar_start))
    known = (F.col("kind") == 0) | ((F.col("kind") == 1) & (F.col("r") < 0.1)) | ((F.col("kind") == 3) & ((nth < 9) | (nth > 350))) | (F.col("kind") == 4)
    sales = F.when(known, F.when(F.col("kind") == 4, 7.3).otherwise(F.round(F.col("level") * 900, 1)))
    return df.select("store_nbr", "family", "date", sales.alias("sales"), (F.col("r") * 4).cast("int").alias("onpromotion"))


@pytest.mark.parametrize("batch", [10_000, 37])
def test_one_pass_gives_what_windows_give(spark, batch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = days(spark).repartition(3, "store_nbr", "family")
        columns = {**lags.rolling_means(), **lags.rolling_stds(), **lags.sales_ewma(SPEC)}
        got = lags.with_lag_features(df, SPEC)
        want = lags.with_log_sales(df).withColumns({f"w_{c}": expr for c, expr in columns.items()})
        key = [F.coalesce("store_nbr", F.lit(-1)).alias("k"), "family", "date"]
        rows = got.select(*key, *columns).join(want.select(*key, *[f"w_{c}" for c in columns]), ["k", "family", "date"]).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(rows) == 5 * 420
    for c in columns:
        assert (rows[c].isna() == rows[f"w_{c}"].isna()).all(), c
        assert np.allclose(rows[c].fillna(-1), rows[f"w_{c}"].fillna(-1), rtol=0 if "mean" in c else 1e-9, atol=1e-12), c
    same = rows[rows["k"] == 4]
    assert len(same) == 420 and (same["sales_roll_std_30"] == 0).all()


def test_no_frame_slides(spark):
    """The feature table keeps lags and promotions as windows; nothing is added up anew for each row."""
    text = lags.with_lag_features(days(spark), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "stddev" not in text and "ArrowEvalPython" in text
    early = lags.with_lag_features(days(spark), SPEC).filter(F.col("date") >= F.lit("1996-01-01")).filter("log_sales IS NOT NULL")
    text = early._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Filter") < text.index("ArrowEvalPython")  # the pass sees the days before


def test_rows_out_of_order_fail():
    def run(days):
        keys = pa.array([1] * len(days), pa.int64())
        return list(rolled(1, (3,), (3,), (0.5,), 2**40)(iter([(keys, pa.array(days, pa.int32()), pa.array([1.0, 2.0, 4.0][: len(days)]))])))

    assert [r["c2"] for r in run([5, 6, 7])[0].to_pylist()] == [None, 1.0, (0.5 * 1 + 2) / 1.5]
    assert [r["c2"] for r in run([5, 8, 8])[0].to_pylist()] == [None, 1.0, pytest.approx((0.125 * 1 + 2) / 1.125)]
    with pytest.raises(ValueError, match="in order"):
        run([6, 5])


def test_sums_of_many_columns(spark):
    """Keys apart and together, null keys, values and days; more rows than a batch."""
    df = spark.range(25_000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), (F.col("id") / 9000).cast("int").alias("g"),
        F.when(F.col("id") % 11 > 0, F.date_add(F.lit(SPEC.calendar_start), (F.col("id") % 300).cast("int"))).alias("date"),
        F.when(F.col("id") % 3 > 0, F.rand(1)).alias("x"), (F.col("id") % 13).cast("int").alias("y"), F.when(F.col("k") > 9, 1.0).alias("z"))
    day = F.datediff("date", F.lit(SPEC.calendar_start))
    for by in (("k",), ("g",), ("k", "g")):
        got = {tuple(r[c] for c in by): r for r in q.digest(df, by, ["x", "y", "z"], dated=False).collect()}
        sums = [f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in {
            "known": F.count, "mean": lambda c: F.avg(c), "by_day": lambda c: F.avg(F.col(c) * day), "square": lambda c: F.avg(F.col(c) * F.col(c))}.items()]
        want = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *sums).collect()
        assert len(want) == len(got)
        for r in want:
            for c, v in r.asDict().items():
                assert got[tuple(r[x] for x in by)][c] == (v if c in by or v is None or isinstance(v, int) else pytest.approx(v, abs=2e-5)), c


def test_a_digest_is_few_sums_over_batches(spark):
    df = days(spark)
    text = q.digest(df, ("family",), ["sales"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text
    assert list(partial_sums(1)(iter([]))) == []
