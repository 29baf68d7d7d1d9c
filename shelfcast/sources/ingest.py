"""Reading raw CSV, typed Parquet and report files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.schemas import RAW

# Types of a typed table, where they differ from the raw text columns.
TYPED = {
    "id": "long",
    "date": "date",
    "store_nbr": "int",
    "sales": "double",
    "onpromotion": "int",
    "cluster": "int",
    "dcoilwtico": "double",
    "transactions": "int",
    "transferred": "boolean",
}


def read_raw(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """One of the six raw files; a missing one fails at once.

    Reading is strict: a header that differs from the schema in names or order fails, and so does a value
    that is no number or date. An empty field is NULL, NaN is a number; no other text stands for a missing value.
    """
    reader = spark.read.schema(RAW[name]).option("header", True)
    return reader.option("mode", "FAILFAST").option("enforceSchema", False).csv(f"{raw_dir}/{name}.csv")


def typed(df: DataFrame) -> DataFrame:
    """Casts every known column, turns NaN into NULL and unknown promotions into 0."""
    columns = {}
    for name, kind in df.dtypes:
        if name in TYPED:
            c = F.col(name)
            if kind in ("float", "double"):
                c = F.when(~F.isnan(c), c)
            c = c.cast(TYPED[name])
            columns[name] = F.coalesce(c, F.lit(0)) if name == "onpromotion" else c
    return df.withColumns(columns)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV report, or an empty table if it was never written. An empty field is NULL."""
    try:
        return spark.read.schema(schema).options(header=True, escape='"', multiLine=True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
