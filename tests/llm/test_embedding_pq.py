import numpy as np

from shelfcast.llm import embedding_pq as e


def brute(ids, vectors, threshold=0.9):
    n = len(ids)
    ok = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    units = {i: np.array(vectors[i], np.float64) for i in range(n) if ok[i]}
    units = {i: v / np.sqrt((v**2).sum()) for i, v in units.items()}
    links = {i: set() for i in range(n)}
    for i in units:
        for k in units:
            if i < k and len(units[i]) == len(units[k]) and units[i] @ units[k] >= threshold:
                links[i].add(k)
                links[k].add(i)
    comp = {}
    for i in range(n):
        if i not in comp:
            todo, seen = [i], {i}
            while todo:
                for k in links[todo.pop()]:
                    if k not in seen:
                        seen.add(k)
                        todo.append(k)
            low = min((ids[k] for k in seen if ids[k] is not None), default=None)
            comp |= dict.fromkeys(seen, low)
    return links, comp


def made(seed, n=1200, width=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    base = centres[rng.integers(0, 12, n)] * 0.5 + rng.normal(size=(n, width))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    out = [base]
    for cos in (0.905, 0.93, 0.97, 0.99):
        picked = base[rng.integers(0, n, n // 6)]
        noise = rng.normal(size=picked.shape)
        noise -= (noise * picked).sum(1, keepdims=True) * picked
        noise /= np.linalg.norm(noise, axis=1, keepdims=True)
        out.append(cos * picked + np.sqrt(1 - cos**2) * noise)
    return (np.concatenate(out) * rng.uniform(0.1, 9, (len(np.concatenate(out)), 1))).astype(np.float32)


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cid int")


def test_recall_and_no_false_links(spark):
    vectors = made(1).tolist()
    ids = [int(i) for i in np.random.default_rng(2).permutation(len(vectors)) * 3]
    links, _ = brute(ids, vectors)
    out = {r.vec_id: r for r in e.near_vectors(frame(spark, ids, vectors)).collect()}
    true = sum(len(x) for x in links.values())
    found = sum(r.n_links for r in out.values())
    assert all(out[ids[i]].n_links <= len(x) for i, x in links.items())
    assert found >= 0.97 * true > 1000


def test_recall_at_scale_of_many_lists(spark):
    """20,000 vectors, 283 lists: the probes are a tenth of them."""
    vectors = made(8, 12_000)[:20_000]
    units = e.unit_rows(vectors.astype(np.float64))
    true = sum(int((units[k : k + 2000] @ units.T >= 0.9).sum()) for k in range(0, len(units), 2000)) - len(units)
    out = e.near_vectors(frame(spark, list(range(len(vectors))), vectors.tolist()))
    assert 0.97 * true <= out.agg({"n_links": "sum"}).first()[0] <= true and true > 10_000


def test_doubles_stay_doubles(spark):
    """Vectors apart by less than a float tells, and beyond what a float holds."""
    rows = [(1, [1e300, 1e299]), (2, [2e300, 2e299]), (3, [1e-300, 0.0]), (4, [0.9, 0.43588989435406733]), (5, [1.0, 0.0]), (6, [0.8999999, 0.4358901])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r.vec_id: r.n_links for r in e.near_vectors(docs).collect()}
    units = e.unit_rows(np.array([v for _, v in rows]))
    near = units @ units.T >= 0.9
    assert out == {i: int(near[k].sum()) - 1 for k, (i, _) in enumerate(rows)}


def test_spanning_pairs():
    rng = np.random.default_rng(9)
    for n, m in ((30, 12), (200, 190), (300, 2000)):
        a, b = rng.integers(0, n, m) * 7, rng.integers(0, n, m) * 7
        low = {x: x for x in {*a.tolist(), *b.tolist()}}
        for _ in range(n):
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                low[x] = low[y] = min(low[x], low[y])
        assert dict(zip(*(x.tolist() for x in e.spanning(a, b)), strict=True)) == {x: y for x, y in low.items() if x != y}


def test_odd_rows_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    vectors = made(3, 60, 8).tolist()
    ids = list(range(100, 100 + len(vectors)))
    odd = [None, [], [0.0] * 8, [nan] + [1.0] * 7, [inf] + [0.0] * 7, [None] + [1.0] * 7, [1.0] * 3, [2.0] * 3, [1.0, 0.0, -0.0], [1.0, -0.0, 0.0]]
    vectors += odd + [vectors[0]] * 30 + [[2 * x for x in vectors[0]]] * 2 + [vectors[5]] * 2
    ids += list(range(10)) + [50] + list(range(1000, 1029)) + [1029, 1030] + [None, None]
    links, comp = brute(ids, vectors)
    out = e.near_vectors(frame(spark, ids, vectors)).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=str)
    expected = [(ids[i], len(links[i]), comp[i], ids[i] is not None and ids[i] == comp[i]) for i in range(len(ids))]
    assert got == sorted(expected, key=str)


def test_blocks(spark, monkeypatch):
    # Every list in many blocks: the same result.
    vectors = made(4, 200, 16).tolist()
    ids = list(range(len(vectors)))
    whole = sorted(e.near_vectors(frame(spark, ids, vectors)).collect())
    monkeypatch.setattr(e, "MEMBERS", 5)
    monkeypatch.setattr(e, "QUERIES", 30)
    assert sorted(e.near_vectors(frame(spark, ids, vectors)).collect()) == whole


def test_empty(spark):
    assert e.near_vectors(frame(spark, [], [])).count() == 0
    assert [tuple(r) for r in e.near_vectors(frame(spark, [3], [None])).collect()] == [(3, 0, 3, True)]
