"""Retail inputs derived from the star-schema test tables.

A supplier is a store, a part type is a family, a line item is a sale on its ship date, and
the mean order value of a day stands for the oil price. See FIXTURES in the README.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.grid import series_catalogue
from shelfcast.spec import CELL, DemandSpec

SPEC = DemandSpec(
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2001, 7, 31),
    test_start=date(2001, 7, 16),
    feature_start=date(1996, 5, 1),
    shock_start=date(1998, 4, 16),
    shock_end=date(1998, 5, 31),
)

# The day that ids count from, and the yearly holiday calendar as
# (month, day, type, locale, locale_name, description, transferred in even years, only in even years).
DAY_ZERO = date(1990, 1, 1)
HOLIDAYS = (
    (1, 1, "Holiday", "National", "NATION", "New Year", False, False),
    (1, 1, "Additional", "National", "NATION", "New Year again", False, False),
    (3, 6, "Work Day", "National", "NATION", "Recovered day", False, False),
    (4, 12, "Holiday", "Local", "NATION_7", "City day", False, False),
    (5, 24, "Holiday", "National", "NATION", "Battle day", True, False),
    (5, 27, "Transfer", "National", "NATION", "Battle day moved", False, True),
    (6, 25, "Holiday", "Regional", "ASIA", "Region day", False, False),
    (7, 3, "Event", "Local", "NATION_3", "Fair", False, False),
    (12, 26, "Bridge", "National", "NATION", "After Christmas", False, False),
)


# Columns in use; a stated schema saves a job that looks into the files.
SCHEMAS = {
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_discount double,"
        " l_shipdate timestamp_ntz"
    ),
    "orders": "o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_type string",
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey long, c_nationkey int",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def sales_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per store, family and day with sales: id, sales, onpromotion and the cell key.

    All line items count; the grid keeps the days of its calendar. The id has the store in its top bits, then 14
    bits of day number and 30 bits of the family's hash, so no list of families is needed.
    """
    items = read(spark, sf_dir, "lineitem")
    parts = read(spark, sf_dir, "part")
    cells = (
        items.join(parts, items.l_partkey == parts.p_partkey)
        .groupBy(
            F.col("l_suppkey").alias("store_nbr"),
            F.col("p_type").alias("family"),
            F.to_date("l_shipdate").alias("date"),
        )
        .agg(
            F.sum("l_quantity").alias("sales"),
            F.count_if(F.col("l_discount") >= 0.05).alias("onpromotion"),
        )
    )
    family_code = F.conv(F.substring(F.md5("family"), 1, 8), 16, 10).cast("long").bitwiseAND(F.lit((1 << 30) - 1))
    day_nbr = F.datediff("date", F.lit(DAY_ZERO)).cast("long")
    cell_id = (F.col("store_nbr") * (1 << 14) + day_nbr) * (1 << 30) + family_code
    return cells.select(cell_id.alias("id"), *CELL, "sales", "onpromotion")


def store_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("s_suppkey").alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.char(F.lit(65) + F.col("s_suppkey") % 5).alias("type"),
            (F.col("s_suppkey") % 17 + 1).cast("int").alias("cluster"),
        )
    )


def oil_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays only, without a value in the first ten days of a year."""
    day = F.to_date("o_orderdate")
    cents = F.rint(F.col("o_totalprice") * 100).cast("long")
    daily = (
        read(spark, sf_dir, "orders")
        .groupBy(day.alias("date"))
        .agg((F.sum(cents) / (F.count(cents) * 100_000)).alias("price"))
    )
    new_year = (F.month("date") == 1) & (F.dayofmonth("date") <= 10)
    return daily.filter(F.weekday("date") < 5).select(
        "date", F.when(~new_year, F.col("price")).alias("dcoilwtico")
    )


def regional_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by region of the customer: one price series per state."""
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    places = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    orders = read(spark, sf_dir, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))
    cents = F.rint(F.col("o_totalprice") * 100).cast("long")
    daily = orders.groupBy(F.col("r_name").alias("state"), F.to_date("o_orderdate").alias("date")).agg(
        (F.sum(cents) / (F.count(cents) * 100_000)).alias("price")
    )
    new_year = (F.month("date") == 1) & (F.dayofmonth("date") <= 10)
    return daily.filter(F.weekday("date") < 5).select("state", "date", F.when(~new_year, F.col("price")).alias("dcoilwtico"))


def holiday_events(spark: SparkSession, spec: DemandSpec = SPEC) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(month).alias("month"),
                F.lit(day).alias("day"),
                F.lit(kind).alias("type"),
                F.lit(locale).alias("locale"),
                F.lit(place).alias("locale_name"),
                F.lit(text).alias("description"),
                F.lit(moved).alias("moved"),
                F.lit(even_only).alias("even_only"),
            )
            for month, day, kind, locale, place, text, moved, even_only in HOLIDAYS
        ]
    )
    even = F.col("year") % 2 == 0
    return (
        spark.range(spec.calendar_start.year, spec.calendar_end.year + 1)
        .select(F.col("id").cast("int").alias("year"), F.inline(rows))
        .filter(even | ~F.col("even_only"))
        .select(
            F.make_date("year", "month", "day").alias("date"),
            "type",
            "locale",
            "locale_name",
            "description",
            (F.col("moved") & even).alias("transferred"),
        )
    )


def store_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("l_shipdate")
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy(day.alias("date"), F.col("l_suppkey").alias("store_nbr"))
        .agg(F.countDistinct("l_orderkey").alias("transactions"))
    )


class RetailTables:
    """The inputs of one data set, each made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, spec: DemandSpec = SPEC):
        self.spark, self.sf_dir, self.spec = spark, sf_dir, spec

    @cached_property
    def cells(self) -> DataFrame:
        return sales_cells(self.spark, self.sf_dir)

    @cached_property
    def train(self) -> DataFrame:
        return self.cells.filter(F.col("date") < F.lit(self.spec.test_start))

    @cached_property
    def actuals(self) -> DataFrame:
        """The test part with its sales, for scoring checks only."""
        return self.cells.filter(F.col("date") >= F.lit(self.spec.test_start))

    @cached_property
    def test(self) -> DataFrame:
        return self.actuals.drop("sales")

    @cached_property
    def stores(self) -> DataFrame:
        return store_dimension(self.spark, self.sf_dir)

    @cached_property
    def oil(self) -> DataFrame:
        return oil_prices(self.spark, self.sf_dir)

    @cached_property
    def regional_oil(self) -> DataFrame:
        return regional_prices(self.spark, self.sf_dir)

    @cached_property
    def holidays(self) -> DataFrame:
        return holiday_events(self.spark, self.spec)

    @cached_property
    def transactions(self) -> DataFrame:
        return store_transactions(self.spark, self.sf_dir)

    @cached_property
    def catalogue(self) -> DataFrame:
        """Every store with every family of the whole train part, whatever days a grid covers."""
        return series_catalogue(self.train)
