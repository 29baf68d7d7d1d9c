import hashlib
import random

import numpy as np

from shelfcast.llm import winnowing as w


def slow(codes):
    """Every window by itself: the smallest hash, of equal ones the rightmost."""
    if len(codes) < w.GRAM:
        return [h for h, _ in zip(*w.winnow(codes), strict=True)]
    grams = w.gram_hashes(codes).tolist()
    size = min(w.WINDOW, len(grams))
    out = []
    for i in range(len(grams) - size + 1):
        best = min(range(i, i + size), key=lambda p: (grams[p], -p))
        if not out or out[-1] != (grams[best], best):
            out.append((grams[best], best))
    return out


def test_selection_and_stretches(monkeypatch):
    rng = np.random.default_rng(1)
    for n in (16, 17, 78, 79, 80, 500, 3000):
        codes = rng.integers(97, 100, n).astype("<u4")
        expected = slow(codes)
        for stretch in (1 << 20, 100):
            monkeypatch.setattr(w, "STRETCH", stretch)
            h, p = w.winnow(codes)
            assert list(zip(h.tolist(), p.tolist(), strict=True)) == expected


def test_guarantee():
    random.seed(5)
    letters = "abcdefgh "
    for _ in range(20):
        passage = "".join(random.choices(letters, k=w.GRAM + w.WINDOW - 1))
        a = "".join(random.choices(letters, k=200)) + passage + "".join(random.choices(letters, k=90))
        b = "".join(random.choices(letters, k=33)) + passage + "".join(random.choices(letters, k=300))
        found = w.shared_passages(a, b)
        assert any(a[i : i + n] == b[j : j + n] and i <= 200 and i + n >= 200 + len(passage) for i, j, n in found)


def documents(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, bucket string, guard string")


def test_query_rows(spark):
    random.seed(2)
    data = [(i * 3, "".join(random.choices("abc déß😀\n", k=random.randrange(0, 400))), "x", "y") for i in range(60)]
    data += [(9, None, "", ""), (9, "same", "", ""), (9, "same", "", ""), (None, "no id", "", ""), (500, "z" * 30000, "", "")]
    out = w.fingerprints(documents(spark, data), bucket_rows=7).collect()
    order = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    expected = []
    for k, (doc, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, after = ({int(x[0] if isinstance(x, tuple) else x) for x in slow(w.code_points(t))} for t in (text, edited, following))
        near = [len(own & x) / len(own | x) if own | x else 1.0 for x in (changed, after)]
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), w._facts(text)[0], w._facts(edited)[0], *near))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in out]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert len({r.near_edited for r in out}) > 20


def test_small_tables(spark):
    assert w.fingerprints(documents(spark, [])).count() == 0
    only = w.fingerprints(documents(spark, [(4, "one document " * 9, "", "")])).first()
    assert only.near_next == 1.0 and only.doc_id == 4
    nulls = w.fingerprints(documents(spark, [(None, None, "", ""), (None, None, "", "")])).collect()
    assert [(r.n_chars, r.fingerprint, r.near_next) for r in nulls] == [(0, "", 1.0)] * 2
