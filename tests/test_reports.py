from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfcast.plans import profile, reports
from shelfcast.spec import DemandSpec

FIRST, LAST = date(2017, 8, 16), date(2017, 8, 18)


@pytest.fixture(scope="module")
def forecasts(spark):
    rows = [
        (10 * s + d, s, "A", date(2017, 8, d), s, float(p))
        for s, peaks in ((1, (5, 9, 9)), (2, (7, 7, 1)))
        for d, p in zip((16, 17, 18), peaks)
    ]
    return spark.createDataFrame(
        rows, "id long, store_nbr int, family string, date date, onpromotion int, sales_pred double"
    )


def test_kpis_take_the_earliest_peak(forecasts):
    rows = {r["store_nbr"]: r for r in reports.forecast_kpis(forecasts).collect()}
    assert rows[1]["peak_date"] == date(2017, 8, 17) and rows[2]["peak_date"] == date(2017, 8, 16)
    assert rows[1]["total_forecast"] == 23 and rows[1]["horizon_days"] == 3


def test_requests(spark, forecasts):
    asked = [
        (1, 1, "A", None, None),
        (2, 1, "A", date(2017, 8, 17), date(2017, 8, 30)),
        (3, 99, "A", None, None),
        (4, 3, "A", None, None),
        (5, 1, "Z", None, None),
        (6, 2, "A", date(2018, 1, 1), date(2018, 1, 2)),
        (7, 3, "Z", None, None),
    ]
    requests = spark.createDataFrame(
        asked, "request_id long, store_nbr int, family string, start_date date, end_date date"
    )
    checked = reports.checked_requests(requests, forecasts, forecasts, (1, 54), (FIRST, LAST))
    reasons = {r["request_id"]: r["reason"] for r in reports.rejected_requests(checked).collect()}
    assert reasons == {
        3: "store_out_of_range",
        4: "unknown_store",
        5: "unknown_family",
        6: "no_data",
        7: "unknown_family",
    }
    rows = reports.forecast_slice(checked).orderBy("request_id", "date").collect()
    assert [(r["request_id"], r["forecast_horizon"]) for r in rows] == [(1, 3)] * 3 + [(2, 2)] * 2
    assert [r["predicted_sales"] for r in rows[3:]] == [9.0, 9.0]


def test_asked_days(spark):
    def day(d):
        return date(2017, 8, d)

    asked = [
        (1, "A", day(1), day(3)),
        (1, "A", day(2), day(2)),  # inside
        (1, "A", day(4), day(5)),  # follows
        (1, "A", day(8), day(9)),  # a gap before
        (1, "A", day(9), day(7)),  # ends before it starts
        (1, "B", None, None),
        (2, "A", day(5), None),
    ]
    requests = spark.createDataFrame(asked, "store_nbr int, family string, start_date date, end_date date")
    spans = reports.asked_days(requests, (FIRST, LAST))
    assert sorted(tuple(r) for r in spans.collect()) == [
        (1, "A", day(1), day(5)), (1, "A", day(8), day(9)), (1, "B", FIRST, LAST), (2, "A", day(5), LAST),
    ]
    rows = spark.createDataFrame([(1, "A", day(d)) for d in range(1, 12)], "store_nbr int, family string, date date")
    assert sorted(r.date.day for r in reports.only_asked(rows, spans).collect()) == [1, 2, 3, 4, 5, 8, 9]


def test_one_card_per_store(spark):
    rows = [(1, "Z", "s", "t", 1), (1, "A", "s", "t", 2), (2, "B", "s", "t", 3)]
    cards = reports.store_cards(spark.createDataFrame(rows, "store_nbr int, city string, state string, type string, cluster int"))
    assert sorted(tuple(r) for r in cards.collect()) == [rows[1], rows[2]]


def test_submission_and_join(forecasts):
    sent = reports.submission(forecasts.withColumn("id", F.when(F.col("id") != 27, F.col("id"))))
    assert [r["id"] for r in sent.collect()] == [26, 28, 36, 37, 38]
    joined = reports.with_submitted(forecasts.drop("sales_pred"), reports.submission(forecasts))
    assert joined.count() == 6 and "sales_pred" in joined.columns
    shown = reports.display_table(joined).orderBy("store_nbr", "day").first()
    assert shown["day"] == "2017-08-16" and shown["forecast_units"] == 5.0


def test_scenarios(forecasts):
    rows = reports.promo_scenarios(forecasts)
    assert rows.count() == 6 * 31
    up = rows.filter("boost_pct = 100 AND id = 26").first()
    assert up["sales_simulated"] == pytest.approx(5 * 1.35)
    plan = reports.promo_plan(forecasts).filter("store_nbr = 2 AND boost_pct = 75").first()
    assert (plan["planned"], plan["simulated"]) == (2, 3)


def test_last_history(spark):
    rows = [(1, "A", date(2017, 8, d), d >= 16, float(d)) for d in range(1, 19)]
    df = spark.createDataFrame(rows, "store_nbr int, family string, date date, is_test boolean, sales double")
    kept = reports.last_history(df, DemandSpec(), 5).agg(F.min("sales"), F.max("sales"), F.count("*")).first()
    assert tuple(kept) == (11.0, 15.0, 5)


def test_benchmark_report(spark):
    board = spark.createDataFrame(
        [("b", 0.51239, 1.0, 2.0, 3.456, -1.005), ("a", 0.41299, 1.0, 2.0, 3.0, 1.0)],
        "model string, rmsle double, mae double, rmse double, wape_pct double, bias_pct double",
    )
    rows = {r["model"]: r for r in reports.benchmark_report(board).collect()}
    assert rows["a"]["is_champion"] and not rows["b"]["is_champion"]
    assert rows["b"]["rmsle"] == 0.5124 and rows["b"]["wape_pct"] == 3.46


def test_catalogue_health(forecasts):
    row = reports.catalogue_health(forecasts).first()
    assert (row["n_stores"], row["n_families"], row["n_series"], row["n_rows"]) == (2, 1, 2, 6)


def test_profiles(spark):
    sales = spark.createDataFrame(
        [
            (1, "A", date(2017, 1, 2), 0.0, 1),
            (1, "B", date(2017, 1, 2), 6.0, 0),
            (2, "A", date(2017, 1, 8), 2.0, 0),
            (2, "B", date(2016, 2, 1), 4.0, 0),
        ],
        "store_nbr int, family string, date date, sales double, onpromotion int",
    )
    assert profile.zero_share(sales).first()[0] == 25.0
    assert [tuple(r) for r in profile.zero_share(sales, "family").collect()] == [("A", 50.0), ("B", 0.0)]
    names = [r["day_name"] for r in profile.weekday_profile(sales).collect()]
    assert names == ["Monday", "Sunday"]
    top = profile.pareto(sales, n=1).collect()
    assert len(top) == 1 and top[0]["family"] == "B" and top[0]["share_pct"] == pytest.approx(10 / 12 * 100)
    matrix = profile.month_year_matrix(sales, [2016, 2017]).collect()
    assert matrix[0]["2017"] == pytest.approx(8 / 3) and matrix[0]["2016"] is None
    with pytest.raises(Exception, match="not listed: 2016"):
        profile.month_year_matrix(sales, [2017]).collect()
    assert profile.total_on(sales, date(2017, 1, 2)).first()["sales"] == 6.0
