import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from shelfcast.llm import suffix_dedup as s


def covered(texts, keep_first=False):
    """Flag of every byte, from a table of all 200-byte strings."""
    places = defaultdict(list)
    for d, t in enumerate(texts):
        for p in range(len(t) - s.MATCH + 1):
            places[t[p : p + s.MATCH]].append((d, p))
    out = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, p in found[1:] if keep_first else found:
                out[d][p : p + s.MATCH] = True
    return out


def corpus(seed):
    random.seed(seed)
    letters = "abcdefgh é\n"
    fresh = lambda n: "".join(random.choices(letters, k=n))
    passages = [fresh(n) for n in (150, 190, 205, 240, 400, 1500)]
    data = []
    for i in range(60):
        text = fresh(random.choice([0, 10, 150, 500, 2000]))
        for _ in range(random.randrange(0, 4)):
            p = random.choice(passages)
            cut = random.randrange(0, 20)
            at = random.randrange(len(text) + 1)
            text = text[:at] + p[cut:] + text[at:]
        data.append((i * 2, text, "c"))
    data += [(200, "ab" * 700, ""), (201, "ab" * 99, ""), (202, "x" * 1000, ""), (203, "x" * 199, ""), (204, None, ""), (205, "", "")]
    data += [(206, data[3][1] + fresh(300), ""), (207, data[7][1], ""), (207, data[7][1], ""), (None, passages[5], "")]
    return data


@pytest.mark.parametrize("hot", [s.HOT, 5])
def test_against_all_strings(spark, hot):
    data = corpus(hot)
    texts = [(t or "").encode() for _, t, _ in data]
    expected = []
    for (doc, *_), t, flags in zip(data, texts, covered(texts), strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~flags])
        edges = int(np.count_nonzero(np.diff(np.concatenate(([0], flags.astype(int)))) == 1))
        expected.append((doc, len(t), int(flags.sum()), edges, hashlib.sha256(kept).hexdigest()))
    docs = spark.createDataFrame(data, "doc_id long, text string, th string")
    out = s.repeated_passages(docs, hot=hot).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("hot", [s.HOT, 5])
def test_first_copies_stay(spark, hot):
    data = [r for r in corpus(hot + 1) if r[0] is not None]
    data = [r for i, r in enumerate(data) if r not in data[:i]]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_chars string")
    out = {r.doc_id: r for r in s.without_later_copies(docs, hot=hot).collect()}
    order = sorted(data)
    texts = [(t or "").encode() for _, t, _ in order]
    for (doc, *_), t, flags in zip(order, texts, covered(texts, True), strict=True):
        # characters cut in part stay
        text, at, kept = t.decode(), 0, []
        for ch in text:
            size = len(ch.encode())
            if not flags[at : at + size].all():
                kept.append(ch)
            at += size
        assert out[doc].text == "".join(kept)
        assert int(out[doc].n_chars) == len(out[doc].text)


def test_empty_and_equal_rows(spark):
    schema = "doc_id long, text string"
    assert s.repeated_passages(spark.createDataFrame([], schema)).count() == 0
    twice = spark.createDataFrame([(1, "y z " * 80)] * 2, schema)
    assert [r.n_removed for r in s.repeated_passages(twice).collect()] == [320, 320]
    assert s.without_later_copies(spark.createDataFrame([], schema)).count() == 0


def test_anchors_depend_on_the_stretch_alone():
    rng = np.random.default_rng(2)
    for n in (199, 200, 201, 1000, 3000):
        data = rng.integers(0, 3, n).astype(np.uint8)
        places, hashes, first = s.anchors(data)
        for p in range(n - s.MATCH + 1):
            k = np.searchsorted(first, p, side="right") - 1
            own, h, _ = s.anchors(data[p : p + s.MATCH])
            assert own.tolist() == [places[k] - p] and h[0] == hashes[k]


def test_long_text_goes_in_steps():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, (1 << 19) * 2 + 777).astype(np.uint8)
    places, hashes, first = s.anchors(data)
    assert np.all(np.diff(places) > 0) and np.all(np.diff(first) > 0)
    for p in (0, (1 << 19) - 1, 1 << 19, (1 << 19) + 1, len(data) - s.MATCH):
        k = np.searchsorted(first, p, side="right") - 1
        own, h, _ = s.anchors(data[p : p + s.MATCH])
        assert own[0] == places[k] - p and h[0] == hashes[k]


def test_longest_factors_against_all_pairs():
    rng = np.random.default_rng(4)
    for letters in (1, 2, 30):
        data = rng.integers(97, 97 + letters, 900).astype(np.uint8)
        data[500:800] = data[100:400]
        starts = np.sort(rng.choice(700, 300, replace=False))
        ends = np.minimum(starts + 260, len(data))
        lpf, lnf = s.longest_factors(data, starts, ends)

        def shared(i, j):
            a, b = data[starts[i] : ends[i]], data[starts[j] : ends[j]]
            n = min(len(a), len(b))
            return int(np.append(a[:n] != b[:n], True).argmax())

        for i in range(len(starts)):
            for out, others in ((lpf, range(i)), (lnf, range(i + 1, len(starts)))):
                best = max((shared(i, j) for j in others), default=0)
                assert (out[i] >= s.MATCH) == (best >= s.MATCH)
                assert out[i] <= best  # in steps of five bytes


def test_previous_smaller():
    rng = np.random.default_rng(5)
    for values in (rng.permutation(500), np.arange(50), np.arange(50)[::-1], np.array([], int)):
        expected = [max((k for k in range(i) if values[k] < values[i]), default=-1) for i in range(len(values))]
        assert s.previous_smaller(values).tolist() == expected


@pytest.mark.parametrize("keep_first", [False, True])
def test_a_hot_anchor_in_many_texts(spark, keep_first):
    """One line of 100 bytes in all texts, with other text around it or the same, beyond the bound for hot anchors."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("klmnop ", k=n))
    line = word(100)
    around = [(word(90), word(90)) for _ in range(6)]
    data = []
    for i in range(300):
        left, right = rng.choice(around) if i % 3 else (word(90), word(90))
        data.append((i, left[rng.randrange(30) :] + line + right[: rng.randrange(60, 90)] + word(rng.randrange(40))))
    data += [(900 + i, data[7][1]) for i in range(40)]
    texts = [t.encode() for _, t in data]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    flags = covered(texts, keep_first)
    if keep_first:
        out = {r.doc_id: r.text for r in s.without_later_copies(docs, hot=20).collect()}
        assert out == {d: bytes(np.frombuffer(t, np.uint8)[~f]).decode() for (d, _), t, f in zip(data, texts, flags, strict=True)}
    else:
        out = {r.doc_id: r.n_removed for r in s.repeated_passages(docs, hot=20).collect()}
        assert out == {d: int(f.sum()) for (d, _), f in zip(data, flags, strict=True)}
