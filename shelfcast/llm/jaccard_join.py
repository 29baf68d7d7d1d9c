"""Near-duplicate documents by exact Jaccard similarity of word shingles: universe partition and pigeonhole.

The hash range of the shingles is cut into segments. Two sets with similarity of at least 0.8 differ in at most
(a + b) / 9 shingles, so among more segments than that, some are the same in both. Keys of segments find
candidates; bit sketches and then whole sets decide, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import (
    LOWER,
    WORD,
    Scratch,
    U,
    arrow_schema,
    ceil_div,
    components,
    mix,
    ship,
    shuffle_partitions,
    span_hashes,
    text_pieces,
    word_spans,
)

# Words of a shingle, and the least similarity as a fraction.
SHINGLE = 5
NUMERATOR, DENOMINATOR = 80, 100
# Keys are sorted in buckets of about this many; a key found so often in the sample has its own path.
BUCKET_KEYS = 250_000
SAMPLE_OF, HOT_IN_SAMPLE = 64, 64
# Members of a group that are compared with each other in one step, and rows of such steps in one task.
BLOCK, TASK_ROWS = 512, 20_000
# Hot keys that the driver sends to all tasks at most (the most frequent; others stay in buckets).
MOST_HOT = 1 << 20
# Bits per set of the filter of sets to fetch, and its largest size (32 MB); more sets are found by a join.
FILTER_BITS_A_SET, MOST_FILTER_BITS = 16, 1 << 28
# Bytes of sets that are compared in one step and in one task, about.
BLOCK_BYTES, TASK_BYTES = 1 << 24, 1 << 25
_WORD_PLACES = mix(np.arange(1, SHINGLE + 1, dtype=U) * U(0xA24BAED4963EE407)) | U(1)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For every text the sorted distinct 64-bit hashes of its shingles; of all its words if they are fewer."""
    return (own for _, own in shingled(column))


def shingled(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """For every text the number of its words, and its set as in `shingle_sets`."""
    for i, j, data, offsets in text_pieces(column):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets)
        words = span_hashes(data, starts, ends)
        n = len(words)
        if n >= SHINGLE:
            grams = sum((words[k : n - SHINGLE + 1 + k] * _WORD_PLACES[k] for k in range(SHINGLE)), np.zeros(n - SHINGLE + 1, U))
            grams = mix(grams)
        for k in range(j - i):
            at, upto = first[k], first[k + 1]
            if upto - at >= SHINGLE:
                own = np.sort(grams[at : upto - SHINGLE + 1])
                yield upto - at, own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif upto > at:
                few = (words[at:upto] * _WORD_PLACES[: upto - at]).sum(keepdims=True) + U(upto - at)
                yield upto - at, mix(few)
            else:
                yield 0, np.empty(0, U)


def fingerprint(own: np.ndarray) -> int:
    """A set's 64-bit class; equal sets are one class. (Two of n different sets meet with odds n^2 / 2^65.)"""
    total = mix((mix(own ^ U(0x5851F42D4C957F2D)).sum() + U(len(own))).reshape(1))
    return int(total.view(np.int64)[0])


# Keys -------------------------------------------------------------------------------------------


def band(n: int) -> int:
    """Sets of 2^(b-1) + 1 to 2^b shingles are in band b."""
    return (n - 1).bit_length()


def segments(b: int) -> int:
    """Segments in band b: so many that even its largest sets (3.2 shingles a segment) have, as a rule, more
    segments with two shingles or more than they can differ in."""
    return int(0.31 * (1 << b)) + 4


def most_apart(a: int, b: int) -> int:
    """The largest symmetric difference of sets of a and b shingles that are similar enough."""
    return (a + b) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def keys(own: np.ndarray) -> np.ndarray:
    """64-bit keys of a set; any two sets that are similar enough, and not equal, share one.

    A set goes into its own band and, if a partner may be there, into the next smaller one. In each it
    allocates, by cost: nothing to segments of no or one shingle, whose keys many sets share by chance; one
    key to larger ones, for segments equal in both. If those are not more than the largest possible
    difference, it cannot rely on equal ones alone, and the set also gives every segment its key and all keys of
    it with one shingle deleted, where a segment that differs by one still meets. If even that does not add up
    (sets of a few shingles that fell badly), every single shingle is a key. Both sets of a pair give
    all of a step's keys, and a pair needs only one of them to add up in a step that both take; a set takes a
    later step only after failing the earlier one, so two that miss each other have both gone on.
    """
    n = len(own)
    if n * (DENOMINATOR - NUMERATOR) < NUMERATOR:  # only an equal set is similar enough
        return np.empty(0, U)
    out = []
    codes = mix(own ^ U(0x14057B7EF767814F))
    sums = np.concatenate((np.zeros(1, U), np.cumsum(codes)))
    b = band(n)
    plans = [(b, most_apart(n, n * DENOMINATOR // NUMERATOR))]
    below = 1 << (b - 1)
    if n * NUMERATOR <= below * DENOMINATOR:
        plans.append((b - 1, most_apart(n, below)))
    for level, apart in plans:
        m = segments(level)
        bounds = np.searchsorted(((own >> U(32)) * U(m)) >> U(32), np.arange(m + 1, dtype=U))
        counts = np.diff(bounds)
        whole = sums[bounds[1:]] - sums[bounds[:-1]]
        salt = mix(np.arange(m, dtype=U) + U(level << 40))
        useful = counts >= 2
        out.append(mix(whole[useful] + salt[useful]))
        if np.count_nonzero(useful) > apart:
            continue
        salt = mix(salt)
        filled = counts >= 1
        out.append(mix(whole[filled] + salt[filled]))
        owner = np.repeat(np.arange(m), counts)
        deleted = useful[owner]
        out.append(mix((whole[owner] - codes + salt[owner])[deleted]))
        if np.count_nonzero(filled) + np.count_nonzero(useful) > apart:
            continue
        out.append(mix(codes + U(level << 20)))
    return np.unique(np.concatenate(out))


PACKED = "bucket int, keys binary, fps binary, ids binary, ths binary, words binary"
NULL_ID = 1 << 62


def _sampled_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("key long, fp long")
    for batch in batches:
        for own in shingle_sets(batch.column("text")):
            found = keys(own).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), fingerprint(own)))], schema=schema)


def _packed_keys(buckets: int, hot: np.ndarray, salts: int):
    """Keys and their sets' classes, packed by bucket: the top of a key tells the bucket, the next 40 bits stay.
    Hot keys are kept whole and dealt at random to the buckets below zero. Each document's size and class go the same
    way, to the buckets from `buckets` on, with its number of words, so that a text is shingled once for all."""
    schema = arrow_schema(PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, fps, facts, held, flushes = [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal flushes
            flushes += 1
            key = np.concatenate([np.empty(0, U), *found])
            fp = np.repeat(np.array(fps, np.int64), [len(k) for k in found])
            known = np.array(facts, np.int64).T
            rows = [(buckets + flushes * 7919 % buckets if len(facts) else 0, *[column.tobytes() for column in known])]
            if len(hot):
                at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                is_hot = hot[at] == key
                if is_hot.any():
                    rows.append((-1 - (flushes * 7919 + int(fp[0] & 1023)) % salts, key[is_hot].tobytes(), fp[is_hot].tobytes(), None, None, None))
                key, fp = key[~is_hot], fp[~is_hot]
            part = ((key >> U(32)) * U(buckets)) >> U(32)
            order = np.argsort(part, kind="stable")
            key, fp, part = key[order], fp[order], part[order]
            cuts = np.searchsorted(part, np.arange(buckets + 1, dtype=U))
            short = (key & U((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]
            for k in np.flatnonzero(np.diff(cuts)):
                a, z = cuts[k], cuts[k + 1]
                rows.append((int(k), short[a:z].tobytes(), fp[a:z].tobytes(), None, None, None))
            names = schema.names
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i : i + 4096]], schema=schema)

        for batch in batches:
            ids, ths = batch.column("doc_id"), batch.column("th").to_numpy().tolist()
            for doc_id, th, (words, own) in zip(ids.to_pylist(), ths, shingled(batch.column("text")), strict=True):
                fp = fingerprint(own) if len(own) else 0
                facts.append((len(own) | (NULL_ID if doc_id is None else 0), fp, doc_id or 0, th, words))
                some = keys(own)
                if len(some):
                    found.append(some)
                    fps.append(fp)
                held += len(some) + 1
                if held > 1 << 19:
                    yield from flush()
                    found, fps, facts, held = [], [], [], 0
        if facts:
            yield from flush()

    return run


GROUP = "gid long, fp long, n_shingles long, doc_id long, th long, n_words long"


def _groups(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        raw = b"".join(table.column("keys").to_pylist())
        fp = np.frombuffer(b"".join(table.column("fps").to_pylist()), np.int64)
        schema = arrow_schema(GROUP)
        if bucket >= buckets:
            ids, ths, words = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("ids", "ths", "words"))
            n = np.frombuffer(raw, np.int64)
            columns = [pa.nulls(len(n), pa.int64()), fp, n & ~NULL_ID, pa.array(ids, mask=n & NULL_ID != 0), ths, words]
            return pa.table([pa.array(c) for c in columns], schema=schema)
        gid, fp = (np.frombuffer(raw, np.int64), fp) if bucket < 0 else _sharing(raw, fp)
        return pa.table([pa.array(gid), pa.array(fp), *[pa.nulls(len(fp), pa.int64())] * 4], schema=schema)

    return run


def _sharing(raw: bytes, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes that share a key, a group each: (gid, fp). Groups of the same classes share a gid, and are given once."""
    key = np.zeros((len(fp), 8), np.uint8)
    key[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    key = key.view(U).ravel()
    # Only keys that occur again are sorted out by class.
    order = np.argsort(key)
    key, fp = key[order], fp[order]
    same = key[1:] == key[:-1]
    again = np.concatenate((same, [False])) | np.concatenate(([False], same))
    key, fp = key[again], fp[again]
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
    key, fp = key[fresh], fp[fresh]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(head)
    sizes = np.diff(np.append(starts, len(key)))
    if not len(starts):
        return np.empty(0, np.int64), fp
    gid = mix(np.add.reduceat(mix(fp.view(U)), starts) + sizes.astype(U))
    several = sizes > 1
    chosen = np.flatnonzero(several)
    _, once = np.unique(gid[chosen], return_index=True)
    keep = np.zeros(len(starts), bool)
    keep[chosen[once]] = True
    rows = np.repeat(keep, sizes)
    return np.repeat(gid, sizes)[rows].view(np.int64), fp[rows]


# Sets and verification ----------------------------------------------------------------------------


def sketch(own: np.ndarray) -> bytes:
    """Parities of the shingles that fall on each of 2 to 4 bits per shingle (a power of two, 64 at least).

    Every shingle in which two sets differ turns one bit, so the number of bits in which sketches differ is at
    most the size of the sets' difference. The longer sketch folds onto the shorter by parity.
    """
    bits = max(64, 2 << band(max(2, len(own))))
    parity = np.bincount((mix(own) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) folded to `size` words."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def filter_places(th: np.ndarray, bits: int) -> np.ndarray:
    first = mix(th.view(U))
    return np.stack([(first >> U(s)) & U(bits - 1) for s in (0, 32)], axis=-1).astype(np.int64)


SET = "fp long, n int, sketch binary, members binary"


def _fetched_sets(shared):
    """Sets of the texts that the filter lets through, by their hash; a few others come along and are never asked for.
    Without a filter, of all texts. Equal texts of a batch give one."""
    schema = arrow_schema(SET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8) if shared else None
        for batch in batches:
            _, some = np.unique(batch.column("th").to_numpy(), return_index=True)
            if bits is not None:
                at = filter_places(batch.column("th").to_numpy()[some], 8 * len(bits))
                some = some[(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)]
            rows, held = [], 0
            for own in shingle_sets(batch.column("text").take(pa.array(some))):
                if not len(own):
                    continue
                rows.append((fingerprint(own), len(own), sketch(own), own.tobytes()))
                held += 8 * len(own)
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _filter_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("place int, bits long")
        for batch in batches:
            at = filter_places(batch.column("th").to_numpy(), bits).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> 6).astype(np.int32)), pa.array((U(1) << (at & 63).astype(U)).view(np.int64))], schema=schema
            )

    return run


def _sets_of(texts: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per class of `wanted` (fp, th: the hash of one of its texts), with its size, sketch and set.

    A filter by text hash goes to all tasks, sized by the number of classes, and spares the other texts their
    shingling; where it would get too large, the texts are joined instead.
    """
    spark = texts.sparkSession
    bits = 1 << max(10, (FILTER_BITS_A_SET * wanted.count()).bit_length())
    if bits <= MOST_FILTER_BITS:
        words = (
            wanted.select("th")
            .mapInArrow(_filter_words(bits), "place int, bits long")
            .groupBy("place")
            .agg(F.bit_or("bits").alias("bits"))
            .toArrow()  # at most MOST_FILTER_BITS / 64 rows
        )
        filled = np.zeros(bits // 64, np.int64)
        filled[words.column("place").to_numpy()] = words.column("bits").to_numpy()
        fetched = texts.mapInArrow(_fetched_sets(spark.sparkContext.broadcast(filled.tobytes())), SET)
    else:
        fetched = texts.join(wanted.select("th"), "th", "left_semi").mapInArrow(_fetched_sets(None), SET)
    # Copies of a text give one set per batch they lie in; one per class stays.
    return scratch.store(fetched.join(wanted.select("fp"), "fp", "left_semi").dropDuplicates(["fp"]))


def _words_of(value: bytes) -> np.ndarray:
    return np.frombuffer(value, U)


def _sketch_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that sizes and sketches do not rule out."""
    schema = arrow_schema("a long, b long")
    for batch in batches:
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        keep = np.minimum(na, nb) * DENOMINATOR >= np.maximum(na, nb) * NUMERATOR
        for i in np.flatnonzero(keep):
            x, y = _words_of(batch.column("sa")[int(i)].as_py()), _words_of(batch.column("sb")[int(i)].as_py())
            size = min(len(x), len(y))
            apart = int(np.bitwise_count(fold(x, size) ^ fold(y, size)).sum())
            keep[i] = apart <= most_apart(int(na[i]), int(nb[i]))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], schema=schema)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets are similar enough."""
    schema = arrow_schema("a long, b long")
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("ma"), batch.column("mb"), strict=True):
            both = np.concatenate((_words_of(x.as_py()), _words_of(y.as_py())))
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(DENOMINATOR * shared >= NUMERATOR * (len(both) - shared))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], schema=schema)


def _side(sets: DataFrame, which: str, *columns: str) -> DataFrame:
    return sets.select(F.col("fp").alias(which), *[F.col(c).alias(c[0] + which) for c in columns])


def _verified(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of `pairs` that are similar enough. Sketches go first; whole sets travel for the rest."""
    thin = pairs.join(_side(sets, "a", "n", "sketch"), "a").join(_side(sets, "b", "n", "sketch"), "b")
    likely = scratch.store(thin.mapInArrow(_sketch_filter, "a long, b long"))
    full = likely.join(_side(sets, "b", "members"), "b").join(_side(sets, "a", "members"), "a")
    links = scratch.store(full.select("a", "b", "ma", "mb").mapInArrow(_similar, "a long, b long"))
    scratch.drop(likely)
    return links


def _cross_pairs(table: pa.Table) -> pa.Table:
    """Pairs of a block pair's members from different components that sizes and sketches do not rule out."""
    frame = table.to_pandas()
    out = set()
    for (_, low, high), part in frame.groupby(["area", "low", "high"], sort=False):
        part = part.sort_values(["n", "fp"])
        fp, n, comp, block = (part[c].to_numpy() for c in ("fp", "n", "comp", "block"))
        own = [_words_of(s) for s in part["sketch"]]
        sizes = np.array([len(s) for s in own])
        for size in np.unique(sizes):
            # members with sketches of this size against later ones, at this size
            rows = np.flatnonzero(sizes == size)
            later = np.flatnonzero((sizes == size) | (sizes == 2 * size))
            table_ = np.stack([fold(own[i], size) for i in later])
            for i in rows:
                reach = (later > i) & (n[later] * NUMERATOR <= n[i] * DENOMINATOR) & (comp[later] != comp[i])
                if low != high:
                    reach &= block[later] != block[i]
                if not reach.any():
                    continue
                apart = np.bitwise_count(table_[reach] ^ own[i]).sum(axis=1, dtype=np.int64)
                limit = (n[i] + n[later[reach]]) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)
                for j in later[reach][apart <= limit]:
                    out.add((min(int(fp[i]), int(fp[j])), max(int(fp[i]), int(fp[j]))))
    pairs = sorted(out)
    return pa.table([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], schema=arrow_schema("a long, b long"))


def _linked(table: pa.Table) -> pa.Table:
    """For members of block pairs, the documents of other classes that link with them, summed by class.

    Shared shingles are counted on bitmaps over the shingles that two members at least have, so all pairs of two blocks
    cost a few passes over a small matrix and none becomes a row.
    """
    total: dict[int, int] = {}
    table = table.sort_by([("component", "ascending"), ("low", "ascending"), ("high", "ascending"), ("n", "ascending")])
    keys_ = np.stack([table.column(c).to_numpy() for c in ("component", "low", "high")])
    heads = np.flatnonzero(np.concatenate(([True], (keys_[:, 1:] != keys_[:, :-1]).any(axis=0))))
    columns = [table.column(c).to_numpy() for c in ("fp", "n", "block", "times")]
    members = table.column("members").to_pylist()
    for a, z in zip(heads.tolist(), [*heads[1:].tolist(), table.num_rows], strict=True):
        fp, n, block, times = (c[a:z] for c in columns)
        n = n.astype(np.int64)
        lone = keys_[1, a] == keys_[2, a]
        sets = [_words_of(x) for x in members[a:z]]
        _, which, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        common = np.cumsum(often > 1) - 1
        width = int(common[-1]) + 1
        bits = np.zeros((z - a, -(-max(1, width) // 64) * 8), np.uint8)
        at = 0
        for k, own in enumerate(sets):
            mine = which[at : at + len(own)]
            at += len(own)
            flags = np.zeros(bits.shape[1] * 8, bool)
            flags[common[mine[often[mine] > 1]]] = True
            bits[k] = np.packbits(flags)
        bits = bits.view(U)
        links = np.zeros(z - a, np.int64)
        for i in range(z - a - 1):
            upto = int(np.searchsorted(n, n[i] * DENOMINATOR // NUMERATOR, side="right"))
            if upto <= i + 1:
                continue
            shared = np.bitwise_count(bits[i + 1 : upto] & bits[i]).sum(axis=1, dtype=np.int64)
            near = DENOMINATOR * shared >= NUMERATOR * (n[i] + n[i + 1 : upto] - shared)
            if not lone:
                near &= block[i + 1 : upto] != block[i]
            links[i] += times[i + 1 : upto][near].sum()
            links[i + 1 : upto][near] += times[i]
        for key, count in zip(fp.tolist(), links.tolist(), strict=True):
            total[key] = total.get(key, 0) + count
    return pa.table([pa.array(list(c), pa.int64()) for c in (total.keys(), total.values())], schema=arrow_schema("fp long, linked long"))


def _links_of(parts: DataFrame, sizes: DataFrame, sets: DataFrame, partitions: int) -> DataFrame:
    """fp, linked: of every class in a component, the documents of other classes that link with it.

    All that link lie in one component, so its members are compared with each other, block by block; a large component
    is as many steps as it has pairs of blocks.
    """
    members = parts.select(F.col("node").alias("fp"), "component").join(sizes, "fp").join(sets.select("fp", "n", "members"), "fp")
    bytes_ = F.sum(F.col("n").cast("long") * 8)
    blocks = parts.select(F.col("node").alias("fp"), "component").join(sets.select("fp", "n"), "fp").groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(bytes_ / BLOCK_BYTES)).cast("int").alias("blocks"), bytes_.alias("bytes")
    )
    work = blocks.agg(F.sum(F.col("blocks") * F.col("bytes"))).first()[0] or 0
    tasks = max(partitions, ceil_div(int(work), TASK_BYTES))
    dealt = (
        members.join(blocks.select("component", "blocks"), "component")
        .withColumn("block", F.pmod(F.xxhash64("fp", "component"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .withColumn("task", F.pmod(F.xxhash64("component", "low", "high"), F.lit(tasks)).cast("int"))
    )
    counted = dealt.select("task", "component", "low", "high", "block", "fp", "n", "times", "members").groupBy("task")
    return counted.applyInArrow(_linked, "fp long, linked long").groupBy("fp").agg(F.sum("linked").alias("linked"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    scratch: Scratch | None = None,
    sample_of_hot: int = HOT_IN_SAMPLE,
    links: bool = False,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, the smallest id that links reach; then `th`, the text's
    xxhash64, `n_words`, `component`, a number for the component, and `class`, one for its set (null for texts without
    words); and with `links` also n_links, the other rows that link with it directly.

    Two documents link when 100 * shared shingles >= 80 * all shingles of both. Texts without words (null too) have
    no shingles and link with nothing: their component is their own id. Equal sets are one class, so copies
    cost one row each and are never paired. Rows with a null id take part; they never name a component unless
    nothing else is in it. Repeated rows are rows of their own. Columns not named are not read.

    1. A sample of the texts shows which keys are hot. One pass then shingles each text, and gives its set's size and
       class, and its keys, packed by bucket.
    2. Buckets give groups of classes that share a key. A hot key skips the buckets: its members stay rows, dealt
       over tasks. Each class in a group gets its set from one text, once.
    3. Every group's members are compared with its two smallest members by two hashes (a star, not all
       pairs), and similar ones linked into components.
    4. Within groups that still span several components, members of different components are compared by
       sketch, block by block, and what the sketch leaves by whole sets. Groups of which one component holds
       half are compared as one area, since they share most members. Then no link between components is left:
       pairs in one component need no check, all others that share a key had one.
    5. With `links`, the members of each component are compared with each other, by whole sets.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark, "jaccard")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text"))
    # One text in SAMPLE_OF, chosen in the JVM; copies of a text are in or out together.
    some = texts.filter(F.pmod(F.xxhash64("th", F.lit(5)), F.lit(SAMPLE_OF)) == 0).select("text")
    sampled = some.mapInArrow(_sampled_keys, "key long, fp long").distinct()
    counts = scratch.store(sampled.groupBy("key").agg(F.count("*").alias("n")))
    size = SAMPLE_OF * (counts.agg(F.sum("n")).first()[0] or 0)  # keys of all texts, about
    often = counts.filter(F.col("n") >= sample_of_hot)
    hot_rows = often.orderBy(F.desc("n"), "key").limit(MOST_HOT).select("key").collect()
    hot = np.sort(np.array([r["key"] for r in hot_rows], np.int64).view(U))

    partitions = shuffle_partitions(spark)
    buckets = max(partitions, ceil_div(size, BUCKET_KEYS))
    packed = texts.mapInArrow(_packed_keys(buckets, hot, partitions), PACKED)
    made = scratch.store(packed.groupBy("bucket").applyInArrow(_groups(buckets), GROUP))
    profile = made.filter("n_shingles IS NOT NULL").select("doc_id", "th", "n_shingles", "n_words", "fp")
    groups = scratch.store(made.filter("n_shingles IS NULL").select("gid", "fp").distinct())

    # Each class's set is fetched from one of its texts.
    classes = profile.filter("n_shingles > 0").groupBy("fp").agg(F.min("th").alias("th"))
    wanted = scratch.store(classes.join(groups.select("fp").distinct(), "fp", "left_semi"))
    sets = _sets_of(texts, wanted, scratch)

    def star(salt: int) -> DataFrame:
        rank = F.struct(F.xxhash64("fp", F.lit(salt)).alias("r"), "fp")
        centre = groups.groupBy("gid").agg(F.min(rank)["fp"].alias("centre"))
        return groups.join(centre, "gid").select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))

    pairs = scratch.store(star(1).union(star(2)).filter("a <> b").distinct())
    links = _verified(pairs, sets, scratch)
    parts = scratch.store(components(links, scratch))

    labelled = groups.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "gid", "fp", F.coalesce("component", "fp").alias("comp")
    )
    # Groups that a component dominates overlap by most of their members; they are compared as one.
    dominant = (
        labelled.groupBy("gid", "comp")
        .agg(F.count("*").alias("n"))
        .groupBy("gid")
        .agg(F.sum("n").alias("k"), F.count("*").alias("comps"), F.max(F.struct("n", "comp")).alias("top"))
        .filter("comps > 1 AND k > 2")  # two members were each other's star
    )
    by_comp = (F.col("top.n") > 1) & (F.col("top.n") * 2 >= F.col("k"))
    label = F.when(by_comp, F.xxhash64(F.lit(1), "top.comp")).otherwise(F.xxhash64(F.lit(0), "gid"))
    spread = dominant.select("gid", label.alias("area"))
    open_areas = scratch.store(labelled.join(spread, "gid").select("area", "fp", "comp").distinct())
    rows = open_areas.count()
    more = None
    if rows:
        sizes = open_areas.groupBy("area").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        dealt = (
            open_areas.join(sizes, "area")
            .withColumn("block", F.pmod(F.xxhash64("fp", "area"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("area", "fp", "comp", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
            .join(sets.select("fp", "n", "sketch"), "fp")
        )
        tasks = max(partitions, ceil_div(rows, TASK_ROWS))
        dealt = dealt.withColumn("task", F.pmod(F.xxhash64("area", "low", "high"), F.lit(tasks)).cast("int"))
        crossing = dealt.groupBy("task").applyInArrow(_cross_pairs, "a long, b long").distinct()
        fresh = scratch.store(crossing.join(pairs, ["a", "b"], "left_anti"))
        more = _verified(fresh, sets, scratch)
        if more.isEmpty():
            more = None
    if more is not None:
        parts = scratch.store(components(links.union(more), scratch))

    sizes = profile.filter("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("times"))
    of_class = sizes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    of_component = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = of_class.join(of_component, "component").select("fp", "component_id", "component", (F.col("times") - 1).alias("n_links"))
    names = ["doc_id", "n_shingles", "component_id", "th", "n_words", "component", F.col("fp").alias("class")]
    if links:
        counted = scratch.store(_links_of(parts, sizes.select("fp", "times"), sets, partitions))
        answer = answer.join(counted, "fp", "left").withColumn("n_links", F.col("n_links") + F.coalesce("linked", F.lit(0)))
        names.append("n_links")
    found = profile.filter("n_shingles > 0").join(answer, "fp").select(*names)
    nothing = F.lit(None).cast("long")
    none = profile.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "th", "n_words", nothing.alias("component"), nothing.alias("class"),
        *([F.lit(0).cast("long").alias("n_links")] if links else []),
    )
    return found.union(none)


def one_of_each_group(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """`docs` (doc_id, text, others) with one row of every group of near duplicates: that with the smallest id (null
    last), then the smallest text hash; of rows equal in both, the first by all columns. Texts without words are
    in no group, and all stay. Columns stay as they are.
    """
    facts = near_duplicates(docs, scratch=scratch)
    key = F.struct(F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("th").alias("_th"))
    rows = facts.filter("component IS NOT NULL").groupBy("component", key.alias("k")).agg(F.count("*").alias("n"))
    leaders = rows.groupBy("component").agg(F.min(F.struct("k", "n")).alias("x")).select("x.k.*", (F.col("x.n") > 1).alias("many"))
    text = F.col("text").cast("string")
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("row")  # so that no name of theirs clashes
    keyed = docs.select(
        whole,
        F.col("doc_id").isNull().alias("late"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(text).alias("_th"),
    )
    chosen = keyed.join(leaders, ["late", "_id", "_th"])
    lone = chosen.filter("NOT many").select("row.*")
    # Equal rows: one of each key, picked before the shuffle where they lie together.
    crowded = chosen.filter("many").groupBy("late", "_id", "_th").agg(F.min("row").alias("row")).select("row.*")
    wordless = docs.filter(F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)) == 0)
    return lone.unionByName(crowded).unionByName(wordless)
