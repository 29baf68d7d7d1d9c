import random
from collections import Counter, defaultdict

from shelfcast.llm import packing as p
from shelfcast.llm.queries import op9_best_fit_packing


def brute(sizes, sources, clusters, capacity, per_source):
    """Looks at every bin for every piece."""
    bins, out = [], [None] * len(sizes)
    moved = 0  # when a bin got its room; of equal room the one that has had it longest
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = [
            (b["free"], b["since"], k)
            for k, b in enumerate(bins)
            if b["free"] >= sizes[i] and b["sources"][sources[i]] < per_source and clusters[i] not in b["clusters"]
        ]
        if fit:
            k = min(fit)[2]
        else:
            k = len(bins)
            bins.append({"free": capacity, "sources": Counter(), "clusters": set(), "n": 0})
        b, moved = bins[k], moved + 1
        out[i] = k, b["n"]
        b["free"] -= sizes[i]
        b["since"] = moved
        b["n"] += 1
        b["sources"][sources[i]] += 1
        b["clusters"].add(clusters[i])
    return out


def test_against_brute_force():
    random.seed(9)
    for _ in range(60):
        n = random.randrange(1, 150)
        sizes = [random.choice([1, 3, 7, 20, random.randrange(1, 101)]) for _ in range(n)]
        sources = [random.choice("aaaabcd") for _ in range(n)]
        clusters = [random.choice([1, 1, 2, i + 10]) for i in range(n)]
        per_source = random.randrange(1, 4)
        assert p.pack(sizes, sources, clusters, 100, per_source) == brute(sizes, sources, clusters, 100, per_source)


def test_whole_table(spark):
    random.seed(6)
    data = [(i, " ".join("w" * random.randrange(1, 400)), random.choice(["hot"] * 5 + ["b", "c", None]), i) for i in range(600)]
    data += [(1000 + i, "the same text " * 20, "hot", 0) for i in range(100)]
    data += [(2000, "word " * 5000, "b", 0), (2001, None, "b", 0), (None, "", None, 0), (2002, "x " * 512, "c", 0)] + [(9007, "again and again", "b", 0)] * 3
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, bin_id long")
    out = p.best_fit_packing(docs, capacity=512, shard_items=100).collect()
    words = defaultdict(int)
    for r in out:
        words[r.doc_id] += r["size"]
    assert words[2000] == 5000 and words[9007] == 9 and words[2002] == 512
    assert sum(words.values()) == sum(len((t or "").split()) for _, t, *_ in data)
    bins = defaultdict(list)
    text = {i: t for i, t, *_ in data}
    for r in out:
        if r["size"]:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None
    for rows in bins.values():
        used = sum(r["size"] for r in rows)
        assert used <= 512 and {r.free for r in rows} == {512 - used}
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert max(Counter(r.source for r in rows).values()) <= p.PER_SOURCE
        assert max(Counter(text[r.doc_id] for r in rows).values()) == 1
    assert len([r for r in out if r.doc_id == 2000]) == 10


def test_pieces_alone_set_the_shards(spark):
    """200 short documents and one of 300 pieces, 100 pieces a shard, whatever partitions the session has."""
    data = [(i, f"{i} " * (i % 7 + 1), "ab"[i % 2]) for i in range(200)] + [(200, "w " * 2400, "c")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(p.best_fit_packing(docs, capacity=8, shard_items=100).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
    assert {r.bin_id >> 32 for r in found[0]} == set(range(5))


def test_near_copies_share_no_bin(spark, run_dir):
    """Copies that differ in case or a blank, and near ones; wordless texts and a null id among them."""
    random.seed(3)
    text = " ".join(random.choice("abcdefgh") + str(random.randrange(999)) for _ in range(60))
    near = [text, text.upper(), text.replace(" ", "  ", 1), text + " more", "less " + text]
    data = [(i, t, f"s{i}") for i, t in enumerate(near)] + [(None, text, "n"), (90, "", "n"), (91, None, "n")]
    data += [(100 + i, f"w{i} v{i} u{i}", f"o{i % 9}") for i in range(50)]
    spark.createDataFrame(data, "doc_id long, text string, source string").write.parquet(f"{run_dir}/documents.parquet")
    out = op9_best_fit_packing(spark, run_dir).collect()
    assert len(out) == len(data) and sum(r["size"] for r in out) == sum(len((t or "").split()) for _, t, _ in data)
    bins = [r.bin_id for r in out if r.doc_id is None or r.doc_id < len(near)]
    assert len(bins) == len(set(bins)) == len(near) + 1


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert p.best_fit_packing(docs).count() == 0
