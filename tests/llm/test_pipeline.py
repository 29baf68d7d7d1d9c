import random

import test_jaccard_join as near
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm.jaccard_join import one_of_each_group


def documents(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


def test_one_of_each_group(spark):
    data = near.corpus(5, 100)
    data += [(3, data[0][1], ""), (3, data[0][1], ""), (None, data[4][1], ""), (None, "nobody else has this text at all", ""), (7, None, ""), (7, "", "")]
    docs = spark.createDataFrame([(d, t, "k", 0) for d, t, _ in data], "doc_id long, text string, __many string, late int")
    out = one_of_each_group(docs).collect()
    # by brute force: the groups, and of each the smallest id
    groups = {}
    shingles = near.sets_of([t for _, t, *_ in data])
    up = list(range(len(data)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(shingles):
        for k in range(i):
            if x and shingles[k] and 100 * len(x & shingles[k]) >= 80 * len(x | shingles[k]):
                up[root(i)] = root(k)
    for i in range(len(data)):
        groups.setdefault(root(i), []).append(i)
    expected = sorted(
        str(min((data[i][0] is None, data[i][0] or 0) for i in members)) for members in groups.values()
    )
    assert sorted(str((r.doc_id is None, r.doc_id or 0)) for r in out) == expected
    texts = {(d, t) for d, t, _ in data}
    assert all((r.doc_id, r.text) in texts for r in out) and out[0].asDict().keys() == {"doc_id", "text", "__many", "late"}


def test_stages(spark, sf_dir, run_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "mixing", "packing"]
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf_dir).write.parquet(f"{run_dir}/{name}")
        docs = spark.read.parquet(f"{run_dir}/{name}")
        rows[name] = docs.count()
        if name != "packing":
            assert docs.columns == before.columns
    assert rows["near_duplicates"] < rows["toxicity"] < 200 and rows["suffix_dedup"] == rows["near_duplicates"]
    dirty = spark.read.parquet(f"{run_dir}/toxicity").filter("lower(text) RLIKE '(idiot|moron|scum).*(idiot|moron|scum|trash|stupid|clown)'")
    assert dirty.count() <= 2
    mixed = spark.read.parquet(f"{run_dir}/mixing")
    packed = docs.groupBy().sum("size").first()[0]
    assert packed == sum(len(r.text.split()) for r in mixed.select("text").collect())


def test_mixing_stage_cuts_the_last_document(spark):
    random.seed(1)
    data = [(i, " ".join(f"w{k}" for k in range(random.randrange(1, 90))), "en", "ab"[i % 2], 0) for i in range(40)]
    out = corpus_pipeline.mix(spark, documents(spark, data), "").collect()
    text = {d: t for d, t, *_ in data}
    taken = {"a": 0, "b": 0}
    for r in out:
        assert text[r.doc_id].startswith(r.text)
        taken[r.source] += len(r.text.split())
    total = sum(len(t.split()) for t in text.values())
    size = {s: sum(len(t.split()) for _, t, _, x, _ in data if x == s) for s in "ab"}
    assert abs(sum(taken.values()) - total) <= 2 and taken["a"] >= size["a"]


def test_odd_rows_pass_all_stages(spark, sf_dir):
    odd = [(None, None, None, None, None), (1, "", "en", None, 0), (2, None, "en", "a", 0), (2, "é" * 700, "en", "a", 700), (3, "one", None, "a", 3), (3, "one", None, "a", 3)]
    for rows in (odd, []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), stage(spark, docs, sf_dir).schema)
        if not rows:
            assert docs.count() == 0


def test_clashing_columns_pass_all_stages(spark, sf_dir):
    names = ["size", "h", "target", "copies", "part", "score", "predicted", "taken", "kept", "row", "words", "uid", "shard", "cluster", "th", "component", "class", "__id", "__row", "n"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 3000")
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{k} "), F.col("doc_id").cast("string")))
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf_dir)
        if name == "packing":
            assert rows.count() >= docs.count()
            break
        kept = rows.collect()
        assert rows.columns == docs.columns and kept
        assert all(r[c] == f"{k} {r.doc_id}" for r in kept for k, c in enumerate(names)), name
        texts[name] = len(kept)
        docs = spark.createDataFrame(kept, docs.schema)
