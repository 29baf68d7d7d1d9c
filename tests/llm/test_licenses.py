import random
import re
from collections import Counter

from shelfcast.llm import licenses as s


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def dice(a, b):
    x, y = Counter(zip(a, a[1:], strict=False)), Counter(zip(b, b[1:], strict=False))
    return 2 * sum((x & y).values()) / (sum(x.values()) + sum(y.values()))


def best_of_all(text):
    """Highest coefficient of any stretch of words with any template."""
    w = words(text)
    best = (0.0, "")
    for name, template in s.TEMPLATES:
        t = words(template)
        if len(t) > 20:
            continue
        for i in range(len(w)):
            for j in range(i + 2, min(len(w), i + 2 * len(t)) + 1):
                best = max(best, (dice(w[i:j], t), name))
    return best


def result(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licences string")
    return {r.doc_id: r for r in s.license_scan(docs).collect()}


def test_short_notices_against_brute_force(spark):
    random.seed(1)
    fill = "one two three licensed under the terms of this work version 2 0 public license cc by".split()
    texts = []
    for _ in range(60):
        w = random.choices(fill, k=random.randrange(0, 25))
        if random.random() < 0.7:
            t = random.choice([t for _, t in s.TEMPLATES if len(words(t)) <= 14]).split()
            if random.random() < 0.5:
                t.pop(random.randrange(len(t)))
            at = random.randrange(len(w) + 1)
            w[at:at] = t
        texts.append(random.choice([" ", "\n"]).join(w))
    out = result(spark, texts)
    for i, text in enumerate(texts):
        score, _ = best_of_all(text)
        assert (out[i].n_matches > 0) == (score >= s.THRESHOLD)
        if score >= s.THRESHOLD:
            assert out[i].best_dice == score


def test_long_texts(spark):
    random.seed(2)
    noise = lambda n: " ".join(random.choices("alpha beta gamma delta software the of".split(), k=n))
    texts, expected = [], []
    for name, template in s.TEMPLATES:
        changed = template.split()
        for _ in range(len(changed) // 25):
            changed[random.randrange(len(changed))] = "other"
        texts.append(f"{noise(40)}.\n{' '.join(changed).upper()}\n{noise(60)}")
        expected.append(name)
    texts.append("\n".join(t for _, t in s.TEMPLATES[::4]) + noise(50_000))
    out = result(spark, texts)
    for i, name in enumerate(expected):
        assert name in out[i].licences.split(","), (name, out[i])
    assert out[len(expected)].n_matches == len(s.TEMPLATES[::4])


def test_size_bounds_lose_nothing():
    templates, _ = s.compile_templates()
    for t in templates:
        for b in range(1, 3 * t.size):
            reachable = 2 * min(b, t.size) / (b + t.size) >= s.THRESHOLD
            assert reachable == (t.least <= b <= t.most)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "Released"), (2, "Released under the MIT License.")] + [(3, "é" * 70000)] * 2, "doc_id long, text string")
    out = s.license_scan(docs).collect()
    assert sorted((r.n_matches, r.licences, r.best_dice) for r in out) == [(0, "", 0.0)] * 5 + [(1, "MIT", 1.0)]
    assert s.license_scan(docs.limit(0)).count() == 0


def test_own_templates(spark):
    own = (("Mine", "you may copy this text as often as you like but not on sundays"),)
    docs = spark.createDataFrame([(1, "Well: You may copy this text as often as you like, but not on Sundays!"), (2, "Licensed under the MIT license.")], "doc_id long, text string")
    out = {r.doc_id: (r.n_matches, r.licences, r.best_dice) for r in s.license_scan(docs, templates=own).collect()}
    assert out == {1: (1, "Mine", 1.0), 2: (0, "", 0.0)}
