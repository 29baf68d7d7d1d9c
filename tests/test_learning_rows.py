"""What the boosted queries learn from."""

from pyspark.sql import functions as F

from shelfcast.spec import CATEGORICALS
from shelfcast.workload import queries as q


def test_queries_learn_from_all_labelled_rows(spark, monkeypatch):
    """More rows than the 5,000 that the trees were once given."""
    columns = {c: F.col("id") % (k + 2) for k, c in enumerate(CATEGORICALS)}
    features = spark.range(6500).withColumns({
        **columns, "date": F.date_sub(F.lit(q.SPEC.last_train_day), (F.col("id") % 6500).cast("int")), "is_test": F.lit(False),
        "log_sales": F.when(F.col("id") % 100 > 0, F.col("id") % 7 + 0.5)})
    monkeypatch.setattr(q, "master", lambda *_: None)
    monkeypatch.setattr(q, "build_features", lambda *_: features)
    train, encoded, learn, val = q._model_tables(spark, "")
    known = features.filter("log_sales IS NOT NULL").count()
    assert known > 6400 and val.count() == 15  # the sixteenth has no sales
    assert learn.count() == train.count() == encoded.count() == known - 15
