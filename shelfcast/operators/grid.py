"""Dense daily grid: every store x family x day of the calendar, gaps kept as NULL sales."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.calendar import on_month_day
from shelfcast.spec import CELL, SERIES, DemandSpec

# Stores and families are paired block by block; the square of this is the number of blocks.
PRODUCT_BUCKETS = 32

# Dense rows that a task sorts, some 250 bytes each in the master table; calendars too short to need a count of series.
ROWS_A_TASK = 1_000_000
SHORT_DAYS = 366


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def series_catalogue(train: DataFrame) -> DataFrame:
    """Every store paired with every family.

    The product itself is the result here. Stores fall into row blocks and families into column
    blocks, each copied along the other axis, and every block pairs its own; so it spreads over
    many tasks and needs neither side in memory. One scan of the sales gives both sides.
    """
    side = F.explode(F.array(F.struct(F.col("store_nbr"), F.lit(None).cast("string").alias("family")),
                             F.struct(F.lit(None).cast(train.schema["store_nbr"].dataType).alias("store_nbr"), F.col("family"))))
    sides = train.select(*SERIES).distinct().select(side.alias("s")).select("s.*").distinct()
    every = F.sequence(F.lit(0), F.lit(PRODUCT_BUCKETS - 1))
    of_store = F.col("family").isNull()

    def own(column: str):
        return F.array(F.pmod(F.hash(column), F.lit(PRODUCT_BUCKETS)))

    blocks = (
        sides.withColumn("row", F.explode(F.when(of_store, own("store_nbr")).otherwise(every)))
        .withColumn("col", F.explode(F.when(of_store, every).otherwise(own("family"))))
        .groupBy("row", "col")
        .agg(F.collect_list("store_nbr").alias("stores"), F.collect_list("family").alias("families"))
    )
    return blocks.select(F.explode("stores").alias("store_nbr"), "families").select("store_nbr", F.explode("families").alias("family"))


def union_sales(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train and test rows in one table; test rows have no sales."""
    return train.unionByName(test, allowMissingColumns=True)


def dense_partitions(catalogue: DataFrame, spec: DemandSpec) -> int:
    """Partitions of a grid: those of the session, or more if the tasks would hold over ROWS_A_TASK dense rows.

    A cell turns into many days, so sizes measured before must not merge partitions, and windows over the days sort
    them: what does not fit a task's memory goes to disk once more. Series are counted for long calendars only.
    """
    asked = int(catalogue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if spec.n_days <= SHORT_DAYS:
        return asked
    return max(asked, -(-catalogue.count() * spec.n_days // ROWS_A_TASK))


def continuous_grid(
    train: DataFrame,
    test: DataFrame,
    spec: DemandSpec,
    partitions: int | None = None,
    catalogue: DataFrame | None = None,
    stores: DataFrame | None = None,
) -> DataFrame:
    """One row per series and calendar day: date, store_nbr, family, id, sales, onpromotion,
    is_test, is_closed, and with `stores` their attributes.

    A left join of the exploded grid would shuffle the grid, which can be far larger than the
    sales. Here only sales cells travel: each series gets a seed row on the first day, and
    every cell fills the days up to the next one in place. The seed also marks the series of
    the catalogue, so rows of unknown stores or families fall away as in a left join.

    `catalogue` (store_nbr, family, unique) names the series, such as a stored one, or the
    observed pairs alone; without it, it is every store of `train` with every family.

    Attributes of `stores` (store_nbr, unique, others) ride on the seeds: they are joined to the catalogue, one
    row per series, and carried along as the days are filled in, so the dense rows are never joined by store,
    however many stores there are. A store that is not listed has none.

    Sales are first summed to one row per cell with map-side combine, so a hot cell or series
    shrinks to at most one row per calendar day before it reaches a single task. The result
    stays hash-partitioned by series, which the feature windows use without another shuffle.
    """
    start, end = F.lit(spec.calendar_start), F.lit(spec.calendar_end)
    sales = union_sales(train, test).filter(F.col("date").between(start, end))
    catalogue = series_catalogue(train) if catalogue is None else catalogue
    attributes = [c for c in stores.columns if c not in SERIES] if stores is not None else []
    if attributes:
        catalogue = catalogue.join(stores.select("store_nbr", F.struct(*attributes).alias("about")), "store_nbr", "left")
    about = [F.col("about")] if attributes else []
    seeds = catalogue.select(*SERIES, start.alias("date"), F.lit(1).alias("seed"), *about)
    cells = (
        sales.select(*CELL, "id", "sales", "onpromotion")
        .unionByName(seeds, allowMissingColumns=True)
        .groupBy(*CELL)
        .agg(
            F.min("id").alias("id"),
            F.sum("sales").alias("sales"),
            F.sum("onpromotion").alias("onpromotion"),
            F.max("seed").alias("seed"),
            *[F.max(c).alias("about") for c in about],
        )
    )
    if partitions is None:
        partitions = dense_partitions(catalogue, spec)
    by_day = Window.partitionBy(*SERIES).orderBy("date")
    day_after = F.lit(spec.calendar_end + timedelta(days=1))
    dense = (
        cells.repartition(partitions, *SERIES)
        .withColumns(
            {
                "known": F.first("seed").over(by_day),
                "until": F.coalesce(F.lead("date").over(by_day), day_after),
                **({"about": F.first("about").over(by_day)} if attributes else {}),
            }
        )
        .filter("known = 1")
        .withColumn("ahead", F.explode(F.sequence(F.lit(0), F.datediff("until", "date") - 1)))
        .withColumn("day", F.date_add("date", F.col("ahead")))
    )
    seen = F.col("ahead") == 0
    closed = on_month_day("day", spec.closures)
    return dense.select(
        F.col("day").alias("date"),
        *SERIES,
        F.when(seen, F.col("id")).alias("id"),
        F.when(closed, F.lit(0.0)).when(seen, F.col("sales")).alias("sales"),
        F.when(closed | ~seen, F.lit(0)).otherwise(F.coalesce("onpromotion", F.lit(0))).alias("onpromotion"),
        (F.col("day") >= F.lit(spec.test_start)).alias("is_test"),
        closed.cast("int").alias("is_closed"),
        *[F.col("about")[c].alias(c) for c in attributes],
    )
