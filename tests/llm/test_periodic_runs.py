import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shelfcast.llm import periodic_runs as p


def brute(words):
    """All runs by trying every period at every place."""
    n, out = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : i + length]
            if length >= max(24, 3 * q) and not any(part[k:] == part[:-k] for k in range(1, q)):
                out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % period] for i in range(n)]


def digest(doc_id, text):
    words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def repeat(block, length):
    return (block * (length // len(block) + 1))[:length]


def texts(seed, count=60):
    """Words of few or many kinds with runs of short and long periods, nested ones and near misses among them."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        words = []
        for _ in range(int(rng.integers(1, 6))):
            kind = int(rng.integers(0, 7))
            letters = [f"w{k}" for k in range(int(rng.choice([1, 2, 3, 50, 1000])))]
            block = rng.choice(letters, int(rng.integers(1, 200 if kind else 12))).tolist()
            if kind < 3:
                words += repeat(block, int(len(block) * rng.uniform(2.5, 5)))
            elif kind == 3:  # a run within the period of a run
                inner = rng.choice(letters, int(rng.integers(1, 9))).tolist()
                words += repeat(repeat(inner, int(rng.integers(8, 60))) + block[: int(rng.integers(1, 90))], int(rng.integers(30, 500)))
            elif kind == 4:  # a run with one word changed
                words += repeat(block, 4 * len(block))
                words[-int(rng.integers(1, 2 * len(block) + 1))] = "other"
            else:
                words += block
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    data = texts(seed)
    codes = {w: k for k, w in enumerate(sorted({w for t in data for w in t}))}
    hashed = p.mix(np.arange(1, len(codes) + 1, dtype=np.uint64))
    first = np.concatenate(([0], np.cumsum([len(t) for t in data])))
    x = np.concatenate([hashed[[codes[w] for w in t]] for t in data])
    together = p.Texts(x, first)
    found = [(s - first[together.owner[s]], n, q, int(together.owner[s])) for s, n, q in p.runs_of(together)]
    for k, words in enumerate(data):
        assert [f[:3] for f in found if f[3] == k] == brute(words), (seed, k)


def test_constant_and_thue_morse_words():
    bits = np.array([bin(i).count("1") & 1 for i in range(4096)])
    cases = [np.zeros(5000, int), np.tile(bits[:700], 5), np.tile(np.repeat([0, 1], [300, 1]), 9), np.tile(np.repeat([0, 1], [30, 1]), 50), bits]
    for case in cases:
        x = p.mix(case.astype(np.uint64) + np.uint64(9))
        assert p.runs_of(p.Texts(x, np.array([0, len(x)]))) == brute(case.tolist()), case[:9]


def test_a_hot_passage_does_not_multiply_seeds():
    # One long line again and again, each time followed by another word: equal grams everywhere, no run.
    line = [f"l{k}" for k in range(40)]
    words = [w for k in range(3000) for w in [*line, f"x{k}"]]
    codes = {w: k for k, w in enumerate(dict.fromkeys(words))}
    x = p.mix(np.array([codes[w] for w in words], np.uint64) + np.uint64(1))
    texts = p.Texts(x, np.array([0, len(x)]))
    hashes = p._prefix_hashes(x)
    for scale in (48, 384, 6144):
        places, _ = p.minimizers(texts, scale, [], hashes)
        assert len(places) <= 8 * len(x) // scale + 3000
    assert p.runs_of(texts) == []


def test_query_rows(spark):
    data = [(i, " ".join(t)) for i, t in enumerate(texts(11, 70))]
    data += [(900, None), (901, ""), (902, " \n\t"), (None, "a " * 30), (None, None), (903, "É\tb\r\n" * 20), (903, "É\tb\r\n" * 20)]
    data += [(2000 + i, " ".join(f"w{k}" for k in range(17 * i))) for i in range(40)]
    docs = spark.createDataFrame([(t, i, 1, "r") for i, t in data], "text string, doc_id long, start int, row string")
    out = p.run_digests(p.with_planted_runs(docs)).collect()
    assert sorted((tuple(r) for r in out), key=str) == sorted((digest(i, t) for i, t in data), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data)
    assert p.run_digests(p.with_planted_runs(docs.limit(0))).collect() == []


def test_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "a b " * 12 + "c", "kept", 5), (2, None, None, None)], "doc_id long, text string, runs string, row int")
    one, two = sorted(p.periodic_runs(docs).collect(), key=lambda r: r.row.doc_id)
    assert one.row == ((1, "a b " * 12 + "c", "kept", 5)) and one.text == "a b c"
    assert [tuple(r) for r in one.runs] == [(0, 24, 2)] and (two.runs, two.text) == ([], "")
