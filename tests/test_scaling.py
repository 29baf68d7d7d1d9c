"""What keeps queries over dense rows within their limits as tables grow."""

from dataclasses import replace

from pyspark.sql import functions as F

from shelfcast.workload import queries as q


def test_digest_keeps_one_count_a_column(spark):
    rows = [(1, "2001-01-02", 3.0), (1, None, 5.0), (1, "2001-01-03", None), (2, "2001-01-02", None)]
    df = spark.createDataFrame(rows, "k int, day string, x double").select("k", F.to_date("day").alias("date"), "x")
    out = q.digest(df, ("k",), ["x"], dated=False).orderBy("k")
    nth = df.filter("date = '2001-01-02'").selectExpr(f"datediff(date, DATE '{q.SPEC.calendar_start}') AS n").first()["n"]
    assert [tuple(r) for r in out.collect()] == [(1, 3, 2, 4.0, 3.0 * nth, 17.0), (2, 1, 0, None, None, None)]
    text = q.digest(df, ("k",), ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert "avg(" not in text and text.count("count(x") <= 4


def test_partitions_grow_with_the_dense_rows(spark, sf_dir, monkeypatch):
    whole = q.full_grid(spark, sf_dir)
    monkeypatch.setattr("shelfcast.operators.grid.ROWS_A_TASK", 5_000)
    many = q.full_grid(spark, sf_dir)
    n_rows = whole.count()
    assert many.rdd.getNumPartitions() == -(-n_rows // 5_000) > whole.rdd.getNumPartitions()
    assert many.count() == n_rows and many.exceptAll(whole).count() == 0


def test_boosted_queries_store_what_the_encodings_read(spark, sf_dir, monkeypatch):
    """One narrow table for codes and means; rows to learn from and validation rows come from one pass."""
    monkeypatch.setattr(q, "LABELLED_ROWS", 40)
    train, encoded, learn, val = q._model_tables(spark, sf_dir)
    key = [*q.SERIES, "date"]
    first = train.select(*key).orderBy(F.xxhash64(*key)).limit(40)
    assert learn.select(*key).exceptAll(first).count() == 0 and learn.count() == 40 and learn.columns == train.columns
    assert encoded.count() == train.count() and set(encoded.columns) == {"date", *q.CATEGORICALS, "log_sales"}
    assert val.count() == q.validation(spark, sf_dir).filter("sales IS NOT NULL").count()
    params = replace(q.LEAF_WISE, rounds=1, depth=2, patience=1, min_rows_per_leaf=1)
    codes = [q.fit_forecaster(t, val, params, learn).transform(val).select(*key, "e_store_nbr", "e_family") for t in (train, encoded)]
    assert codes[0].exceptAll(codes[1]).count() == 0
