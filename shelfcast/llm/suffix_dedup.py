"""Repeated passages, byte-exact: suffix order finds, for every place in a text, earlier matches of it elsewhere.

Text places that cannot be in a repeat are ruled out first. Every stretch of MATCH bytes has an anchor, its
minimiser, chosen by its content alone; so a stretch that occurs twice has the same anchor twice, and one whose
anchor occurs once does not. What is left is cut into contexts and brought together by anchor, so equal
stretches meet in one block. There the suffixes are sorted, and the previous and the next smaller position of each in
that order give its longest previous factor: the longest match that starts earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfcast.llm.common import (
    BYTE_CODES,
    Scratch,
    U,
    arrow_schema,
    ceil_div,
    mix,
    ship,
    shuffle_partitions,
    span_hashes,
    text_pieces,
)

# Bytes of the shortest repeat, and bytes of an anchor; any MATCH bytes hold SPAN anchor places.
MATCH, GRAM = 200, 40
SPAN = MATCH - GRAM + 1
# Context bytes of a block, about. The contexts of an anchor that occurs more often than HOT are dealt to blocks by the
# bytes beside it too, in PARTS parts, and leave their owners behind.
BLOCK_BYTES = 300_000
HOT = 100_000
PARTS = 4
_POWER = 0xD1342543DE82EF95


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each GRAM bytes in a row."""
    h, power, reach = BYTE_CODES[data], _POWER, 1
    while reach < 32:
        if reach == 8:
            eight, eighth = h, power
        h = h[:-reach] * U(power) + h[reach:]
        power, reach = power * power & 0xFFFFFFFFFFFFFFFF, 2 * reach
    count = len(data) - GRAM + 1  # 40 bytes: 32, then 8
    return mix(h[:count] * U(eighth) + eight[32 : 32 + count])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and 64-bit hashes of a text's anchors, and the first stretch that each is the anchor of.

    The anchor of a stretch is the one of its SPAN grams with the smallest hash, the rightmost of equal ones. Texts
    shorter than MATCH have none. The anchors of one stretch after another never go back, so an anchor's
    stretches follow each other.
    """
    n = len(data) - GRAM + 1
    if n < SPAN:
        return np.empty(0, np.int64), np.empty(0, U), np.empty(0, np.int64)
    found = []
    step = 1 << 19
    for at in range(0, n - SPAN + 1, step):
        part = data[at : min(len(data), at + step + MATCH - 1)]
        grams = gram_hashes(part)
        count = len(grams)
        places = np.arange(at, at + count, dtype=U)
        keys = (grams >> U(32) << U(32)) | (U(0xFFFFFFFF) - places)
        reach = 1
        while 2 * reach <= SPAN:
            keys = np.minimum(keys[:-reach], keys[reach:])
            reach *= 2
        keys = np.minimum(keys[: count - SPAN + 1], keys[SPAN - reach :])
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        chosen = (U(0xFFFFFFFF) - (keys[first] & U(0xFFFFFFFF))).astype(np.int64)
        found.append((chosen, grams[chosen - at], first + at))
    places, hashes, first = (np.concatenate(x) for x in zip(*found, strict=True))
    fresh = np.flatnonzero(np.diff(places, prepend=-1))
    return places[fresh], hashes[fresh], first[fresh]


ANCHOR = "h long, doc_id long, th long, first int, last int"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every anchor with the first and the last stretch it is the anchor of."""
    schema = arrow_schema(ANCHOR)
    for batch in batches:
        ids, hashes = batch.column("doc_id"), batch.column("th").to_numpy()
        rows, held = [], 0
        for i, j, data, offsets in text_pieces(batch.column("text")):
            for k in range(i, j):
                size = int(offsets[k - i + 1] - offsets[k - i])
                _, h, first = anchors(data[offsets[k - i] : offsets[k - i + 1]])
                if len(h):
                    rows.append((k, h, first, np.append(first[1:], size - MATCH + 1) - 1))
                    held += len(h)
            if rows and (held > 1 << 17 or j == batch.num_rows):
                owner = np.repeat([r[0] for r in rows], [len(r[1]) for r in rows])
                h, first, last = (np.concatenate([r[c] for r in rows]) for c in (1, 2, 3))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        ids.take(pa.array(owner)),
                        pa.array(hashes[owner]),
                        pa.array(first.astype(np.int32)),
                        pa.array(last.astype(np.int32)),
                    ],
                    schema=schema,
                )
                rows, held = [], 0


CONTEXT = "block int, h long, bytes binary, owners binary, ref long"


def _contexts(blocks: int, hot: bool):
    """For every anchor that occurs again the bytes of its stretches, to the block of the anchor, with the owners
    (document, text hash, start: three longs each); or those of hot anchors, in parts.

    Equal contexts that lie together, as in periodic text and copies, go once with all their owners.
    """
    schema = arrow_schema(CONTEXT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners: dict[tuple[int, bytes], list[int]] = {}
        held, ref = 0, TaskContext.get().partitionId() << 40

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ref
            rows = []
            for (h, piece), own in owners.items():
                ref += 1
                rows.append((h % blocks, h, piece, np.array(own, np.int64).tobytes(), ref))
            yield _batch(rows, schema)

        for batch in batches:
            ids, hashes = batch.column("__id").to_pylist(), batch.column("__th").to_pylist()
            for k, (doc_id, th) in enumerate(zip(ids, hashes, strict=True)):
                text = batch.column("text")[k].as_buffer()
                listed = batch.column("__places")[k].values
                chosen = listed.filter(pc.equal(listed.field("hot"), hot))
                fields = (chosen.field(c).to_pylist() for c in ("h", "first", "last"))
                for h, first, last in zip(*fields, strict=True):
                    piece = bytes(text[first : last + MATCH])
                    for key, start, part in beside(h, piece) if hot else [(h, 0, piece)]:
                        known = owners.get((key, part))
                        if known is None:
                            owners[key, part] = [doc_id, th, first + start]
                            held += len(part) + 24
                        else:
                            known += (doc_id, th, first + start)
                            held += 24
                if held > 1 << 23:
                    yield from flush()
                    owners, held = {}, 0
        if owners:
            yield from flush()

    return run


def beside(h: int, piece: bytes) -> Iterator[tuple[int, int, bytes]]:
    """A hot anchor's context in parts: (key, start of the part in it, its bytes).

    The windows in which the anchor stands at most SPAN / PARTS places apart make a part. All of them share the bytes
    beside the anchor, 160 in all of MATCH, and those with the anchor make the key. Equal windows have the anchor at the
    same place, so they meet in one part of one key.
    """
    data = np.frombuffer(piece, np.uint8)
    last = len(piece) - MATCH
    places = gram_hashes(data).view(np.int64)[: SPAN]
    at = int(np.flatnonzero(places == h)[-1])  # the rightmost of the first window, so of all
    step = SPAN // PARTS
    for k in range(PARTS):
        low, high = k * step, SPAN - 1 if k == PARTS - 1 else (k + 1) * step - 1
        first, final = max(0, at - high), min(last, at - low)
        if first <= final:
            shared = data[at - low : at - high + MATCH]
            key = span_hashes(shared, np.array([0]), np.array([len(shared)])) ^ U(k)
            yield int(mix(key).view(np.int64)[0]), first, piece[first : final + MATCH]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


# Bytes by which suffixes are told apart, doubling from the first; with LCP from these, up to their sum.
REACHES = (5, 10, 20, 40, 80, 160)


def suffix_ranks(data: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 5, 10, ... 160 bytes; equal ones have equal ranks. Prefix doubling: the order
    by 5 bytes gives that by 10, and so on."""
    n = len(data)
    wide = np.concatenate((data, np.zeros(5, np.uint8))).astype(U)
    key = np.zeros(n, U)
    for k in range(5):
        key = (key << U(8)) | wide[k : k + n]
    ranks = [_dense(key, 40)]
    for reach in REACHES[:-1]:
        second = np.zeros(n, U)
        second[: max(0, n - reach)] = ranks[-1][reach:]
        ranks.append(_dense_pair(ranks[-1], second))
    return ranks


def common_prefix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at a and at b have in common, in steps of the first of REACHES and up to their sum."""
    n, out = len(ranks[0]), np.zeros(len(a), np.int64)
    for rank, reach in zip(reversed(ranks), reversed(REACHES), strict=True):
        inside = np.maximum(a, b) + out < n
        i, j = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
        out += np.where(inside & (rank[i] == rank[j]), reach, 0)
    return out


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value; -1 if there is none. A place that does not
    qualify hands on to the one it points to, so the steps double."""
    found = np.arange(-1, len(values) - 1)
    wrong = np.flatnonzero(values[1:] < values[:-1]) + 1
    while len(wrong):
        found[wrong] = found[found[wrong]]
        to = found[wrong]
        wrong = wrong[(to >= 0) & (values[to] > values[wrong])]
    return found


def _suffix_order(ranks: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """The order of the suffixes at `starts` by twice the longest reach, equal ones by place."""
    n, reach = len(ranks[-1]), REACHES[-1]
    second = np.zeros(n, U)
    second[: max(0, n - reach)] = ranks[-1][reach:]
    bits, place_bits = n.bit_length(), max(1, len(starts).bit_length())
    if 2 * bits + place_bits > 64:
        return np.lexsort((starts, second[starts], ranks[-1][starts]))
    # ranks and place in one word: a plain sort
    key = ((ranks[-1][starts] << U(bits) | second[starts]) << U(place_bits)) | np.arange(len(starts), dtype=U)
    return (np.sort(key) & U((1 << place_bits) - 1)).astype(np.int64)


def longest_factors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of the suffixes at `starts` (ascending), which go up to `ends`: bytes
    of the longest match that starts earlier, and later.

    In suffix order, the candidates are the nearest entries on either side that stand earlier (later) in the text: the
    previous and the next smaller (greater) position. Entries that share less than MATCH bytes with both neighbours
    share no more with any other; they are left out, and get 0.
    """
    ranks = suffix_ranks(data)
    order = _suffix_order(ranks, starts)
    lpf, lnf = np.zeros((2, len(starts)), np.int64)
    # MATCH bytes are the longest reach and what is left of them.
    whole, rest = ranks[-1][starts[order]], ranks[REACHES.index(MATCH - REACHES[-1])][starts[order] + REACHES[-1]]
    near = (whole[1:] == whole[:-1]) & (rest[1:] == rest[:-1])
    some = order[np.concatenate((near, [False])) | np.concatenate(([False], near))]
    if not len(some):
        return lpf, lnf
    for out, sign in ((lpf, 1), (lnf, -1)):
        position = sign * starts[some]
        before = previous_smaller(position)
        after = len(some) - 1 - previous_smaller(position[::-1])[::-1]
        for other in (before, np.where(after == len(some), -1, after)):
            there = np.flatnonzero(other >= 0)
            a, b = some[there], some[other[there]]
            shared = common_prefix(ranks, starts[a], starts[b])
            shared = np.minimum(shared, np.minimum(ends[a] - starts[a], ends[b] - starts[b]))
            out[a] = np.maximum(out[a], shared)
    return lpf, lnf


def _dense(key: np.ndarray, bits: int) -> np.ndarray:
    """Numbers 0, 1, ... in the order of the keys, the same for equal ones."""
    n = len(key)
    place_bits = max(1, int(n - 1).bit_length())
    out = np.empty(n, U)
    if bits + place_bits <= 64:
        # key and place in one word: a plain sort, ties by place in the text
        both = np.sort((key << U(place_bits)) | np.arange(n, dtype=U))
        place = (both & U((1 << place_bits) - 1)).astype(np.int64)
        value = both >> U(place_bits)
    else:
        place = np.argsort(key, kind="stable")
        value = key[place]
    step = np.zeros(n, U)
    step[1:] = value[1:] != value[:-1]
    out[place] = np.cumsum(step)
    return out


def _dense_pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    bits = max(1, int(max(first.max(initial=U(0)), second.max(initial=U(0)))).bit_length())
    return _dense((first << U(bits)) | second, 2 * bits)


SPANS = "doc_id long, th long, start long, stop long"


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def repeated_windows(pieces: list[bytes], weights: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(context, flag of each of its windows that occurs elsewhere, and of those that occur earlier) of contexts with any.

    Contexts come in the order of documents and places, and those of one block hold all occurrences of their
    windows; a weight says how many occurrences a context stands for, of which it is the first. A window of MATCH
    bytes occurs earlier if its longest previous factor is that long, and elsewhere if its longest next factor is, or its
    context stands for several. Contexts with equal bytes are sorted once, and contexts none of whose windows has
    the same hash as another are left out: they have no factor of MATCH bytes.
    """
    first: dict[bytes, int] = {}
    like = [first.setdefault(p, i) for i, p in enumerate(pieces)]
    own = sorted(set(like))  # by first place
    times = np.bincount(like, weights=weights, minlength=len(pieces))[own]
    data, starts, owner, _ = _laid_out([pieces[i] for i in own])
    _, group, sizes = np.unique(span_hashes(data, starts, starts + MATCH), return_inverse=True, return_counts=True)
    hopeful = times > 1
    np.logical_or.at(hopeful, owner, sizes[group] > 1)
    own, times = [i for i, ok in zip(own, hopeful.tolist(), strict=True) if ok], times[hopeful]
    if not own:
        return []
    data, starts, owner, ends = _laid_out([pieces[i] for i in own])
    lpf, lnf = longest_factors(data, starts, ends)
    earlier = lpf >= MATCH
    found = earlier | (lnf >= MATCH) | (times[owner] > 1)
    begin = np.searchsorted(owner, np.arange(len(own) + 1))
    number = {i: k for k, i in enumerate(own)}
    out = []
    for i, origin in enumerate(like):
        k = number.get(origin)
        if k is None:
            continue
        part = slice(begin[k], begin[k + 1])
        if found[part].any():
            out.append((i, found[part], earlier[part] if origin == i else found[part]))
    return out


def _laid_out(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts end to end: their bytes, the starts of their windows, whose window each is, and where that ends."""
    sizes = np.array([len(p) for p in pieces])
    counts = sizes - MATCH + 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    at = np.cumsum(sizes) - sizes
    begin = np.cumsum(counts) - counts
    starts = np.arange(len(owner)) - begin[owner] + at[owner]
    return np.frombuffer(b"".join(pieces), np.uint8), starts, owner, (at + sizes)[owner]


def _in_chunks(h: np.ndarray, sizes: list[int]) -> Iterator[list[int]]:
    """Rows of a block, in order, in parts of about twice BLOCK_BYTES that keep each anchor's rows together; anchors do
    not share stretches. Rows alone with their anchor are left out: equal stretches have the same anchor in two places."""
    heads = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))).tolist()
    chunk: list[int] = []
    held = 0
    for a, z in zip(heads, [*heads[1:], len(h)], strict=True):
        if z - a == 1:
            continue
        chunk.extend(range(a, z))
        held += sum(sizes[a:z])
        if held > 2 * BLOCK_BYTES:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def _block_spans(keep_first: bool):
    schema = arrow_schema(SPANS)

    def run(table: pa.Table) -> pa.Table:
        pieces = table.column("bytes").to_pylist()
        lists = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in table.column("owners").to_pylist()]
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        doc_id, th, start = np.concatenate(lists).T
        h = table.column("h").to_numpy()[row]
        order = np.lexsort((start, th, doc_id, h))
        if keep_first:  # rows equal in id and text are one document
            keys = np.stack([x[order] for x in (h, doc_id, th, start)])
            order = order[np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))]
        h, doc_id, th, start, row = (x[order] for x in (h, doc_id, th, start, row))
        rows, lows, highs = [], [], []
        seen: set[int] = set()
        sizes = [0 if r in seen or seen.add(r) else len(pieces[r]) for r in row.tolist()]
        for chunk in _in_chunks(h, sizes):
            for i, found, earlier in repeated_windows([pieces[r] for r in row[chunk]], [1] * len(chunk)):
                low, high = _runs(earlier if keep_first else found)
                rows.extend([chunk[i]] * len(low))
                lows.extend((start[chunk[i]] + low).tolist())
                highs.extend((start[chunk[i]] + high - 1 + MATCH).tolist())
        arrays = [pa.array(doc_id[rows]), pa.array(th[rows]), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())]
        return pa.table(arrays, schema=schema)

    return run


HOT_RUN = "ref long, first_doc long, first_th long, first_start long, low long, high long, for_first boolean"


def _hot_runs(table: pa.Table) -> pa.Table:
    """Runs of the windows of hot anchors' contexts, each standing for its owners: those that occur elsewhere, for all
    owners, and those that occur earlier, for the first of all owners of these bytes."""
    schema = arrow_schema(HOT_RUN)
    table = table.sort_by([(c, "ascending") for c in ("h", "doc_id", "th", "start")])
    pieces, weights = table.column("bytes").to_pylist(), table.column("owners").to_pylist()
    h, ref = table.column("h").to_numpy(), table.column("ref").to_numpy()
    places = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "th", "start")), strict=True))
    rows: list[tuple] = []

    def add(chunk: list[int]) -> None:
        own, count = [pieces[r] for r in chunk], [weights[r] for r in chunk]
        first: dict[bytes, int] = {}
        for r in chunk:
            first.setdefault(pieces[r], r)
        for i, found, earlier in repeated_windows(own, count):
            origin = first[own[i]]
            # A later row of the same bytes may hold the first owner once more, if its row is repeated.
            known = earlier if origin == chunk[i] else runs[origin]
            if origin == chunk[i]:
                runs[origin] = earlier
            for flags, for_first in ((found, False), (known, True)):
                low, high = _runs(flags)
                rows.extend((int(ref[chunk[i]]), *places[origin], a, z - 1 + MATCH, for_first) for a, z in zip(low.tolist(), high.tolist(), strict=True))

    runs: dict[int, np.ndarray] = {}
    heads = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))).tolist()
    for a, z in zip(heads, [*heads[1:], len(h)], strict=True):
        if sum(weights[a:z]) > 1:
            add(list(range(a, z)))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else schema.empty_table()


def _handed_out(keep_first: bool):
    """The runs of a context's windows for each of its owners."""
    schema = arrow_schema(SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts = np.stack([batch.column(c).to_numpy() for c in ("first_doc", "first_th", "first_start")], axis=1)
            low, high = (batch.column(c).to_numpy() for c in ("low", "high"))
            for_first = batch.column("for_first").to_numpy(zero_copy_only=False)
            parts, held = [], 0
            for k in range(batch.num_rows):
                own = np.frombuffer(batch.column("owners")[k].as_buffer(), np.int64).reshape(-1, 3)
                is_first = (own == firsts[k]).all(axis=1) if keep_first else np.zeros(len(own), bool)
                own = own[is_first == for_first[k]]
                parts.append(np.column_stack((own[:, :2], own[:, 2] + low[k], own[:, 2] + high[k])))
                held += len(own)
                if held > 1 << 16 or k == batch.num_rows - 1:
                    columns = np.concatenate(parts).T
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=schema)
                    parts, held = [], 0

    return run


def _hot_spans(with_places: DataFrame, blocks: int, keep_first: bool, scratch: Scratch) -> DataFrame:
    """Spans in the contexts of hot anchors. Blocks get each context of a batch once, with its first owner and their
    number, however many there are; the owners wait in a stored table and get the runs by a join on its number."""
    some = with_places.filter(F.exists("__places", lambda x: x["hot"]))
    stored = scratch.store(some.mapInArrow(_contexts(blocks, True), CONTEXT))

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(THIN)
        for batch in batches:
            lists = [np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 3) for x in batch.column("owners")]
            first = np.array([min(map(tuple, own.tolist())) for own in lists], np.int64).reshape(-1, 3)
            columns = [batch.column(c) for c in ("block", "h", "bytes", "ref")]
            arrays = [*columns, pa.array([len(own) for own in lists], pa.int64()), *[pa.array(np.ascontiguousarray(c)) for c in first.T]]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    runs = stored.mapInArrow(thinned, THIN).groupBy("block").applyInArrow(_hot_runs, HOT_RUN)
    return runs.join(stored.select("ref", "owners"), "ref").mapInArrow(_handed_out(keep_first), SPANS)


THIN = "block int, h long, bytes binary, ref long, owners long, doc_id long, th long, start long"


def union_of(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes covered by [start, stop) spans."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    head = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[head], reach[np.append(np.flatnonzero(head)[1:] - 1, len(reach) - 1)]


def keyed_texts(docs: DataFrame, *others: str) -> DataFrame:
    """text (never null) and the key of its place order, __id (null first) and __th, the text's hash; the other
    columns go along in the struct __row, where no name clashes."""
    return docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("__th"),
        *([F.struct(*[F.col(c) for c in others]).alias("__row")] if others else []),
    )


def repeated_spans(keyed: DataFrame, keep_first: bool, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """Spans of repeated bytes of each text of `keyed`, gathered: __id, __th, __spans (unmerged)."""
    spark = keyed.sparkSession
    short = keyed.select(F.col("__id").alias("doc_id"), F.col("__th").alias("th"), "text")
    rows = scratch.store(short.filter(F.octet_length("text") >= MATCH).mapInArrow(_anchor_rows, ANCHOR))
    found = rows.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1")
    # Summed before the shuffle; the join deals a hot anchor's rows by adaptive splitting.
    again = scratch.store(rows.join(found, "h").select("doc_id", "th", "h", "first", "last", (F.col("times") > hot).alias("hot")))
    scratch.drop(rows)
    facts = again.agg(F.count("*").alias("n"), F.count_if("hot").alias("hot")).first()
    listed = again.groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(
        F.collect_list(F.struct("h", "first", "last", "hot")).alias("__places")
    )
    # All columns go along, so that this shuffle of the texts is the one that the last join uses.
    with_places = keyed.join(listed, ["__id", "__th"])
    blocks = max(shuffle_partitions(spark), ceil_div(facts["n"] * (MATCH + SPAN // 2), BLOCK_BYTES))
    spans = with_places.mapInArrow(_contexts(blocks, False), CONTEXT).groupBy("block").applyInArrow(_block_spans(keep_first), SPANS)
    if facts["hot"]:
        spans = spans.unionByName(_hot_spans(with_places, blocks, keep_first, scratch))
    return spans.groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(
        F.collect_list(F.struct("start", "stop")).alias("__spans")
    )


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(RESULT)
    for batch in batches:
        rows = []
        for k, doc_id in enumerate(batch.column("__id").to_pylist()):
            text = batch.column("text")[k].as_py().encode()
            low, high = _merged(batch.column("__spans")[k])
            kept = b"".join(text[a:z] for a, z in zip([0, *high], [*low, len(text)], strict=True))
            rows.append((None if doc_id == -(1 << 63) else doc_id, len(text), len(text) - len(kept), len(low), hashlib.sha256(kept).hexdigest()))
        yield _batch(rows, schema) if rows else pa.RecordBatch.from_pylist([], schema=schema)


def _merged(spans: pa.Scalar) -> tuple[list[int], list[int]]:
    if spans.as_py() is None:
        return [], []
    values = spans.values
    low, high = union_of(values.field("start").to_numpy(), values.field("stop").to_numpy())
    return low.tolist(), high.tolist()


def repeated_passages(docs: DataFrame, scratch: Scratch | None = None, hot: int = HOT) -> DataFrame:
    """Per row of `docs` (doc_id, text): n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256, the
    hash of what is left when every byte goes that a string of MATCH bytes covers which also starts elsewhere.

    Elsewhere is another place in the same or another document; matches do not cross documents. Null text is empty.
    Repeated rows repeat each other. Rows with a null id take part. Columns not named are not read. An empty
    table gives an empty one.
    """
    ship(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession, "suffix")
    keyed = keyed_texts(docs)
    spans = repeated_spans(keyed, False, scratch, hot)
    return keyed.join(spans, ["__id", "__th"], "left").mapInArrow(_digests, RESULT)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans. A character that a span covers in part stays whole."""
    for batch in batches:
        texts = []
        for k in range(batch.num_rows):
            text = batch.column("text")[k].as_py().encode()
            low, high = _merged(batch.column("__spans")[k])
            kept, at = [], 0
            for a, z in zip(low, high, strict=True):
                while a < z and text[a] & 0xC0 == 0x80:
                    a += 1
                while z > a and z < len(text) and text[z] & 0xC0 == 0x80:
                    z -= 1
                kept.append(text[at:a])
                at = z
            texts.append(b"".join([*kept, text[at:]]).decode())
        index = batch.schema.get_field_index("text")
        yield batch.set_column(index, "text", pa.array(texts, pa.string())).drop_columns(["__spans"])


def without_later_copies(docs: DataFrame, scratch: Scratch | None = None, hot: int = HOT) -> DataFrame:
    """`docs` with each repeated passage of MATCH bytes or more cut from `text` wherever it stands but in its first
    place, by ascending doc_id (null first), then text hash, then place. All rows and columns stay; a text
    may become empty, and a null text becomes empty. Rows equal in id and text are one document here and are cut
    alike. `n_chars`, if there, is counted anew.
    """
    ship(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession, "suffix")
    others = [c for c in docs.columns if c != "text"]
    keyed = keyed_texts(docs, *others)
    joined = keyed.join(repeated_spans(keyed, True, scratch, hot), ["__id", "__th"], "left")
    schema = StructType([StructField("__row", keyed.schema["__row"].dataType), StructField("text", StringType())])
    cut = joined.select("__row", "text", "__spans").mapInArrow(_cut, schema)
    counted = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    columns = {"text": F.col("text"), **{c: F.col("__row")[c] for c in others}, **counted}
    return cut.select(*[columns[c].alias(c) for c in docs.columns])
