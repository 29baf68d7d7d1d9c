from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from shelfcast.functions.calendar import calendar_columns, payday_columns
from shelfcast.operators.events import effective_holidays, with_holiday_flags
from shelfcast.operators.exogenous import fill_daily, oil_daily
from shelfcast.operators.grid import continuous_grid
from shelfcast.operators.split import split_report, temporal_split
from shelfcast.spec import DemandSpec

SPEC = DemandSpec(
    calendar_start=date(2016, 12, 20),
    calendar_end=date(2017, 1, 20),
    test_start=date(2017, 1, 11),
    val_days=5,
)
SALES = "id long, date date, store_nbr int, family string, sales double, onpromotion int"


def day(text):
    return date.fromisoformat(text)


@pytest.fixture(scope="module")
def grid(spark):
    train = spark.createDataFrame(
        [
            (1, day("2016-12-20"), 1, "A", 5.0, 1),
            (2, day("2016-12-25"), 1, "A", 9.0, 2),  # closed day with a row
            (3, day("2016-12-27"), 1, "A", 2.0, 0),
            (4, day("2016-12-27"), 1, "A", 3.0, 4),  # second row of the cell
            (5, day("2017-01-10"), 2, "B", 8.0, None),
            (6, day("2016-12-01"), 2, "B", 8.0, 1),  # before the calendar
        ],
        SALES,
    )
    test = spark.createDataFrame(
        [(7, day("2017-01-15"), 1, "B", 3), (8, day("2017-01-15"), 9, "B", 3)],  # store 9 is unknown
        "id long, date date, store_nbr int, family string, onpromotion int",
    )
    return continuous_grid(train, test, SPEC).toPandas().set_index(["store_nbr", "family", "date"]).sort_index()


def test_every_cell_once(grid):
    assert len(grid) == 2 * 2 * 32 and grid.index.is_unique
    assert set(grid.index.get_level_values("store_nbr")) == {1, 2}
    assert list(grid.columns) == ["id", "sales", "onpromotion", "is_test", "is_closed"]


def test_values_and_gaps(grid):
    assert grid.loc[(1, "A", day("2016-12-20")), ["id", "sales", "onpromotion"]].tolist() == [1, 5.0, 1]
    assert grid.loc[(1, "A", day("2016-12-27")), ["id", "sales", "onpromotion"]].tolist() == [3, 5.0, 4]
    gap = grid.loc[(1, "A", day("2016-12-21"))]
    assert pd.isna(gap["sales"]) and pd.isna(gap["id"]) and gap["onpromotion"] == 0
    assert grid.loc[(2, "B", day("2017-01-10")), "onpromotion"] == 0
    assert grid.loc[(1, "B", day("2017-01-15")), ["id", "onpromotion"]].tolist() == [7, 3]


def test_closures_overwrite(grid):
    closed = grid.xs(day("2016-12-25"), level="date")
    assert (closed["sales"] == 0).all() and (closed["onpromotion"] == 0).all() and (closed["is_closed"] == 1).all()
    assert grid.loc[(1, "A", day("2016-12-25")), "id"] == 2
    assert grid["is_closed"].sum() == 4


def test_test_flag(grid):
    assert (grid["is_test"] == (grid.index.get_level_values("date") >= SPEC.test_start)).all()


def test_split(spark, grid):
    df = spark.createDataFrame(grid.reset_index()[["date", "is_test"]])
    report = split_report(temporal_split(df, SPEC.val_days)).toPandas().set_index("split")
    assert report.loc["val", "n_days"] == 5 and report.loc["val", "last_date"] == day("2017-01-10")
    assert report.loc["train", "last_date"] == day("2017-01-05")
    assert report.loc["test", "n_rows"] == 10 * 4
    by_date = temporal_split(df.drop("is_test"), SPEC.val_days, SPEC.test_start)
    assert split_report(by_date).toPandas().set_index("split").sort_index().equals(report.sort_index())


@pytest.mark.parametrize("known", [[3, 4, 9], [0, 11], [5], [19], []])
def test_interpolation_as_pandas(spark, known):
    values = pd.Series([None] * 20, index=pd.date_range("2017-01-01", periods=20), dtype=float)
    for i in known:
        values.iloc[i] = 10.0 + i * i
    present = values[values.notna() | (np.arange(20) == 0)].drop(pd.Timestamp("2017-01-05"), errors="ignore")
    rows = [(d.date(), None if np.isnan(v) else float(v)) for d, v in present.items()]
    df = spark.createDataFrame(rows, "date date, v double")
    actual = fill_daily(df, "v", date(2017, 1, 25)).toPandas().sort_values("date")["v"]
    full = present.reindex(pd.date_range("2017-01-01", "2017-01-25"))
    expected = full.interpolate(method="linear").bfill().ffill()
    np.testing.assert_allclose(actual.to_numpy(dtype=float), expected.to_numpy(), atol=1e-12, equal_nan=True)


def test_interpolation_of_several_series(spark):
    rows = [("a", day("2017-01-01"), 1.0), ("a", day("2017-01-03"), 3.0), ("b", day("2017-01-02"), 5.0)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    actual = fill_daily(df, "v", date(2017, 1, 4), ("k",)).orderBy("k", "date").toPandas()
    assert actual["v"].tolist() == [1.0, 2.0, 3.0, 3.0, 5.0, 5.0, 5.0]


def test_oil_moving_averages(spark):
    rows = [(date(2017, 1, 1) + timedelta(days=i), float(i)) for i in range(40)]
    spec = DemandSpec(calendar_end=date(2017, 2, 9))
    oil = oil_daily(spark.createDataFrame(rows, "date date, dcoilwtico double"), spec).orderBy("date").toPandas()
    s = pd.Series(np.arange(40.0))
    np.testing.assert_allclose(oil["oil_ma7"], s.rolling(7, min_periods=1).mean())
    np.testing.assert_allclose(oil["oil_ma30"], s.rolling(30, min_periods=1).mean())


def test_holiday_scopes(spark):
    holidays = spark.createDataFrame(
        [
            (day("2017-01-01"), "Holiday", "National", "X", False),
            (day("2017-01-01"), "Additional", "National", "X", False),
            (day("2017-01-02"), "Holiday", "Regional", "S1", False),
            (day("2017-01-03"), "Event", "Local", "C1", False),
            (day("2017-01-04"), "Holiday", "National", "X", True),
            (day("2017-01-05"), "Work Day", "National", "X", False),
        ],
        "date date, type string, locale string, locale_name string, transferred boolean",
    )
    days = [day(f"2017-01-0{i}") for i in range(1, 6)]
    rows = spark.createDataFrame(
        [(d, s, c) for d in days for s, c in (("S1", "C1"), ("S2", "C2"))], "date date, state string, city string"
    )
    kept = effective_holidays(holidays)
    flagged = with_holiday_flags(rows, kept, SPEC).orderBy("date", "state").toPandas()
    assert len(flagged) == 10
    assert flagged["is_holiday_any"].tolist() == [1, 1, 1, 0, 1, 0, 0, 0, 1, 1]
    assert flagged["is_holiday_national"].sum() == 4 and flagged["is_holiday_local"].sum() == 1
    rested = with_holiday_flags(rows, kept, SPEC, ("Work Day",))
    assert rested.agg({"is_holiday_any": "sum"}).first()[0] == 4
    assert kept.filter("is_workday").count() == 1 and kept.filter("is_event").count() == 1


def test_calendar_as_pandas(spark):
    days = pd.date_range("2015-12-20", "2017-03-10")
    df = spark.createDataFrame([(d.date(),) for d in days], "date date")
    f = df.withColumns({**calendar_columns(), **payday_columns()}).orderBy("date").toPandas()
    d = days.to_series().reset_index(drop=True).dt
    assert (f["dayofweek"] == d.dayofweek).all() and (f["weekofyear"] == d.isocalendar().week).all()
    assert (f["is_weekend"] == (d.dayofweek >= 5)).all() and (f["is_payday"] == ((d.day == 15) | d.is_month_end)).all()
    until = np.where(d.day <= 15, 15 - d.day, d.days_in_month - d.day)
    assert (f["days_to_payday"] == until).all()
    np.testing.assert_allclose(f["sin_dow"], np.sin(2 * np.pi * d.dayofweek / 7), atol=1e-12)
    np.testing.assert_allclose(f["cos_month"], np.cos(2 * np.pi * d.month / 12), atol=1e-12)
