import random

import pytest

from shelfcast.llm.mixing import WEIGHTS, mix_sources


def targets(sizes):
    """Reshared by weight, round after round, until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8"))
    names += [None] * (None in sizes)
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    left, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (left - sum(capped.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in names}
        capped |= {s: 3 * sizes[s] for s in over}


def rows_of(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, source string, taken string")


def test_against_loop(spark):
    random.seed(3)
    data = []
    for i in range(400):
        source = random.choice(["a"] * 8 + ["b", "c", "é", "Z", None])
        text = random.choice([None, "", " \t", "w " * random.randrange(1, 60), "x y z"])
        data.append((i if i % 50 else 7, text, source, "clash"))
    data.append((1000, "very long " * 5000, "b", ""))
    out = mix_sources(rows_of(spark, data)).collect()
    assert len(out) == len(data)
    sizes, taken, target = {}, {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r["size"] and r.taken == r["size"] * r.copies + r.part
    expected = targets(sizes)
    for s, words in sizes.items():
        assert target[s] == pytest.approx(expected[s])
        assert {r.source_size for r in out if r.source == s} == {words}
        assert abs(taken[s] - expected[s]) <= 10
    again = mix_sources(rows_of(spark, data)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_empty_and_wordless(spark):
    assert mix_sources(rows_of(spark, [])).count() == 0
    out = mix_sources(rows_of(spark, [(1, None, None, None), (None, "", "a", None)])).collect()
    assert [(r["size"], r.target, r.taken) for r in out] == [(0, 0.0, 0)] * 2


def test_no_python_in_plan(spark):
    plan = mix_sources(rows_of(spark, [(1, "a b", "s", "")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
