import heapq
import struct
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfcast.llm import token_files as t
from shelfcast.llm.common import text_pieces

PATH = public_tokenizers.path(t.VOCABULARY)


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def optimal(counts, most):
    """The least number of bits, over all sets of lengths that a prefix code can have."""
    best = None
    for lengths in product(range(1, most + 1), repeat=len(counts)):
        if sum(2.0**-n for n in lengths) <= 1:
            cost = sum(c * n for c, n in zip(counts, lengths, strict=True))
            best = cost if best is None else min(best, cost)
    return best


def test_code_lengths_are_optimal_under_the_limit():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = rng.integers(1, 40, int(rng.integers(2, 6))) ** 3
        most = int(rng.integers(3, 5))
        bits = t.code_lengths(counts, most)
        assert bits.max() <= most and (counts * bits).sum() == optimal(counts.tolist(), most)


def test_code_lengths_are_huffman_without_a_limit():
    rng = np.random.default_rng(2)
    counts = rng.zipf(1.3, 3000)
    counts[rng.random(3000) < 0.2] = 0
    heap, cost = sorted(int(c) for c in counts if c), 0
    while len(heap) > 1:
        low = heapq.heappop(heap) + heapq.heappop(heap)
        cost += low
        heapq.heappush(heap, low)
    bits = t.code_lengths(counts, 60)
    assert (counts * bits).sum() == cost and not bits[counts == 0].any()
    assert t.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0] and not t.code_lengths(np.zeros(4, int)).any()


def test_bits_round_trip():
    rng = np.random.default_rng(3)
    for size, n in [(1, 5), (2, 1), (5, 700), (50_000, 100_000), (40, 0)]:
        ids = np.minimum(rng.zipf(1.2, n) - 1, size - 1).astype(np.uint32)
        bits = t.code_lengths(np.bincount(ids, minlength=size))
        packed, starts = t.pack_bits(t.canonical_codes(bits)[ids], bits[ids])
        assert len(packed) == -(-int(bits[ids].astype(int).sum()) // 8)
        lanes = starts[:: t.CHECKPOINT_IDS]
        found = t.Decoder(bits).lanes(np.frombuffer(packed, np.uint8), lanes, t.CHECKPOINT_IDS).ravel()[:n]
        assert np.array_equal(found, ids)


ODD = [
    "a  b", "a  b", "a　 b c  ", "  x", "\n\nfoo's  \t bar", "<|endoftext|> x<|endoftext|>", "é è  ü", "", None, "a\u0085 b", "x    y",
    "中文 字 a1 2b", " ", "\t\n", "naïve\x1f z", "a\r\n\r\nb", "  q", "Â â € 1",
]


def test_words_have_the_ids_of_whole_texts(plain):
    rng = np.random.default_rng(4)
    letters = list("ab' .\n\té  字9")
    texts = ODD + ["".join(rng.choice(letters, int(rng.integers(0, 60)))) for _ in range(600)]
    words = t.WordIds(PATH, remembered=50)  # forgets on the way
    import pyarrow as pa

    for piece in (20, 1 << 20):
        for i, j, data, offsets in text_pieces(pa.array(texts, pa.string()), piece):
            ids, upto = words(data, offsets)
            for k in range(i, j):
                assert ids[upto[k - i] : upto[k - i + 1]].tolist() == plain(texts[k]), texts[k]


def expected(data, plain):
    start, out = 0, []
    for doc_id, text in data:
        ids = [*plain(text), t.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_written_files_read_back(spark, run_dir, plain):
    rng = np.random.default_rng(5)
    data = [(int(i) * 7 - 50, " ".join(rng.choice(["the", "cat", "Žluť", "12", "\n"], int(rng.integers(0, 90))))) for i in range(60)]
    data += [(1000 + i, text) for i, text in enumerate(ODD)] + [(5000, "one long text " * 30_000)]
    rows = [(text, i, "x", 1.0) for i, text in data]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(r[0], int(r[1]), r[2], float(r[3])) for r in rows], "text string, doc_id long, ids string, n double")
    t.write_token_files(docs.repartition(5), f"{run_dir}/files", block_ids=700, file_ids=4000)
    out = sorted(t.token_digests(spark, f"{run_dir}/files").collect())
    assert [tuple(r) for r in out] == expected(data, plain)
    whole = {r.doc_id: r for r in t.read_token_files(spark, f"{run_dir}/files").collect()}
    for doc_id, text in data:
        assert np.frombuffer(whole[doc_id].ids, "<u4").tolist() == [*plain(text), t.END_ID]
    # any stretch of a block is decoded from the start before it alone
    content = max((r.content for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{run_dir}/files").collect()), key=len)
    _, decoder, blocks = t.read_file(content)
    for block in blocks:
        ids = block.span(decoder, 0, block.n)
        for a, z in [(0, 1), (255, 257), (300, 300), (block.n - 1, block.n)]:
            if z <= block.n:
                assert np.array_equal(block.span(decoder, a, z), ids[a:z])


def test_repeated_rows_null_ids_and_an_empty_table(spark, plain):
    data = [(None, "b"), (None, "b"), (None, None), (3, "x y"), (3, "x y"), (3, ""), (2, "<|endoftext|>")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    out = t.tokens_written_and_read(docs).collect()
    assert sorted((r.n_tokens, str(r.doc_id)) for r in out) == sorted((len(plain(x)) + 1, str(d)) for d, x in data)
    spans = sorted((r.start, r.start + r.n_tokens, r.doc_id is not None, r.doc_id or 0) for r in out)
    assert all(a[1] == b[0] and a[2:] <= b[2:] for a, b in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0
    again = t.tokens_written_and_read(docs.repartition(3)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert t.tokens_written_and_read(docs.limit(0)).collect() == []
