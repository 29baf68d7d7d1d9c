import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import jaccard_join as j


def sets_of(texts):
    out = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return out


def brute(data):
    shingles = sets_of([t for _, t, *_ in data])
    up = list(range(len(data)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(shingles):
        for k in range(i):
            y = shingles[k]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                up[root(i)] = root(k)
    links = [sum(bool(x and y) and 100 * len(x & y) >= 80 * len(x | y) for y in shingles) - bool(x) for x in shingles]
    low = {}
    for i, (doc, *_) in enumerate(data):
        r = root(i)
        low[r] = doc if low.get(r) is None else low[r] if doc is None else min(low[r], doc)
    return sorted(((d, len(shingles[i]), low[root(i)], links[i]) for i, (d, *_) in enumerate(data)), key=str)


def corpus(seed, n=150):
    random.seed(seed)
    vocabulary = ["".join(random.choices("abcdé", k=random.randrange(1, 6))) for _ in range(200)]
    data, base = [], []
    for i in range(n):
        kind = random.random()
        if base and kind < 0.6:  # a copy with a few edits, chains of them too
            words = list(random.choice(base))
            for _ in range(random.randrange(0, 1 + len(words) // 40 + random.randrange(3))):
                at = random.randrange(len(words))
                words[at : at + random.randrange(0, 2)] = random.choices(vocabulary, k=random.randrange(0, 2)) or ["x"]
        else:
            words = random.choices(vocabulary, k=random.choice([1, 2, 4, 5, 6, 8, 9, 12, 30, 70, 150, 400]))
        base.append(words)
        data.append((i * 3 % 1000, random.choice([" ", "\n", "\t "]).join(w.upper() if random.random() < 0.1 else w for w in words), "c"))
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    data = corpus(seed)
    data += [(5000, None, ""), (5001, "", ""), (5002, " \n\t", ""), (None, None, ""), (None, data[0][1], ""), (5003, data[0][1], ""), (5003, data[0][1], "")]
    data += [(5004, "long words here " * 20000, ""), (5005, "Long words here " * 20001, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, component_id string")
    out = j.near_duplicates(docs, sample_of_hot=64 if seed == 1 else 1, links=True).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in out), key=str) == brute(data)


def test_links_of_a_component_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK", 7)
    base = [f"w{k}" for k in range(60)]
    data = []
    for i in range(40):  # neighbours are near, those further apart are not
        words = [f"x{i}_{k}" if k < i else w for k, w in enumerate(base[: 60 - i % 3])]
        data.append((i, " ".join(words), ""))
    out = j.near_duplicates(spark.createDataFrame(data, "doc_id long, text string, x string"), links=True).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in out), key=str) == brute(data)


def test_many_rows_without_ids_and_many_equal_rows(spark):
    words = [f"w{k}" for k in range(60)]
    near = [" ".join(words), " ".join([*words[:-1], "x"])]
    rows = [(None, near[k % 2]) for k in range(6000)] + [(k % 2, near[k % 2].upper()) for k in range(2000)]
    out = j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), links=True)
    found = {(r.doc_id, r.component_id, r.n_links): r.n for r in out.groupBy("doc_id", "component_id", "n_links").agg(F.count("*").alias("n")).collect()}
    assert found == {(None, 0, 7999): 6000, (0, 0, 7999): 1000, (1, 0, 7999): 1000}


def test_sets_are_one_per_class(spark, monkeypatch):
    rows = [(None, "a b c d e f g h") for _ in range(500)] + [(7, "A b c d e f g  h")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.xxhash64("text")).repartition(6)
    own = next(j.shingle_sets(pa.array([rows[0][1]])))
    for most in (1 << 28, 1):  # by the filter, by the join
        monkeypatch.setattr(j, "MOST_FILTER_BITS", most)
        fp = j.fingerprint(own)
        wanted = texts.groupBy().agg(F.min("th").alias("th")).select(F.lit(fp).alias("fp"), "th")
        sets = j._sets_of(texts, wanted, j.Scratch(spark, "test")).collect()
        assert [(r.fp, r.n, bytes(r.members)) for r in sets] == [(fp, 4, own.tobytes())]


def test_empty(spark):
    assert j.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(4000):
        n = int(rng.integers(4, 14)) if rng.random() < 0.6 else int(rng.integers(14, 900))
        shared = rng.integers(0, 2**64, n, dtype=np.uint64)
        spare = int(n * 0.25)
        left = int(rng.integers(0, spare + 1))
        a = np.unique(np.concatenate((shared, rng.integers(0, 2**64, left, dtype=np.uint64))))
        b = np.unique(np.concatenate((shared, rng.integers(0, 2**64, spare - left, dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        assert 100 * both >= 80 * (len(a) + len(b) - both)
        assert np.array_equal(a, b) or len(np.intersect1d(j.keys(a), j.keys(b)))


def test_badly_fallen_sets_share_a_key():
    # All shingles in a few segments: the deletions, then the single shingles have to find the pair.
    rng = np.random.default_rng(4)
    for _ in range(2000):
        n = int(rng.integers(4, 60))
        low = rng.integers(0, 2 ** int(rng.integers(50, 62)), n, dtype=np.uint64)
        a = np.unique(low)
        b = np.delete(a, rng.choice(len(a), len(a) // 5, replace=False))
        assert len(np.intersect1d(j.keys(a), j.keys(b)))


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 500)), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**64, int(rng.integers(1, 90)), dtype=np.uint64))))
        x, y = (np.frombuffer(j.sketch(s), np.uint64) for s in (a, b))
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(j.fold(x, size) ^ j.fold(y, size)).sum())
        assert apart <= len(np.setxor1d(a, b))
