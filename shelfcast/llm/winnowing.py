"""Document fingerprints by winnowing: rolling k-gram hashes, the minimum of every window, positions kept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import U, arrow_schema, mix, ship, shuffle_partitions

# A passage of at least GRAM + WINDOW - 1 = 79 code points that two texts share gives a shared fingerprint.
# Both are powers of two, so that hashes and minima double their reach in each step.
GRAM, WINDOW = 16, 64
# Code points worked on at once; longer texts go piece by piece.
STRETCH = 1 << 20
# Documents a task of the ordered pass works on, about.
BUCKET_ROWS = 1000
# The ranges of ids are part of the plan, so there are at most so many; a bucket is streamed and may be large.
MOST_BUCKETS = 20_000

_CODE = U(0x9E3779B97F4A7C15)
_POWER = U(0xD1342543DE82EF95)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """32-bit hashes of all GRAM-grams, in uint64. Doubling: the hash of 2m codes comes from two of m."""
    h = mix(codes.astype(U) + _CODE)
    reach, power = 1, int(_POWER)
    while reach < GRAM:
        h = h[:-reach] * U(power) + h[reach:]
        power = power * power & 0xFFFFFFFFFFFFFFFF
        reach *= 2
    return mix(h) >> U(32)


def _pick(keys: np.ndarray) -> np.ndarray:
    """Smallest key of every window of WINDOW keys, each chosen key once."""
    reach = 1
    while reach < WINDOW:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    return keys[np.flatnonzero(np.diff(keys, prepend=~keys[:1]))]


def winnow(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of a text's fingerprint, by position.

    Of equal hashes in a window the rightmost is chosen. Texts with fewer than WINDOW grams are one window;
    texts shorter than a gram are hashed whole. An empty text has none.
    """
    n = len(codes)
    if n == 0:
        return np.empty(0, U), np.empty(0, np.int64)
    if n < GRAM:
        whole = mix(codes.astype(U) * U(31) + _CODE)
        total = mix(np.array([(whole * (np.arange(n, dtype=U) * U(2) + U(1))).sum() + U(n)], dtype=U))
        return total >> U(32), np.zeros(1, np.int64)
    found = []
    last = n - GRAM + 1  # number of grams
    step = STRETCH
    for at in range(0, max(1, last - WINDOW + 1), step):
        # windows that start in [at, at + step)
        grams = gram_hashes(codes[at : min(n, at + step + WINDOW - 1 + GRAM - 1)])
        here = np.arange(at, at + len(grams), dtype=U)
        keys = (grams << U(32)) | (U(0xFFFFFFFF) - here)
        found.append(_pick(keys) if len(keys) >= WINDOW else keys.min(keepdims=True))
    keys = np.concatenate(found)
    keys = keys[np.flatnonzero(np.diff(keys, prepend=~keys[:1]))]
    return keys >> U(32), (U(0xFFFFFFFF) - (keys & U(0xFFFFFFFF))).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def encode(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Eight hex digits of hash and eight of position for each chosen gram."""
    pairs = np.empty((len(hashes), 2), dtype=">u4")
    pairs[:, 0], pairs[:, 1] = hashes, positions
    return pairs.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of chosen hashes (sorted, distinct); 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def shared_passages(a: str, b: str) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the passages around equal fingerprints, each extended both ways as far
    as the texts agree. Every common passage of GRAM + WINDOW - 1 code points or more is among them: equal
    fingerprints anchor it, and positions lead to it."""
    ha, pa_ = winnow(code_points(a))
    hb, pb = winnow(code_points(b))
    places: dict[int, list[int]] = {}
    for h, p in zip(hb.tolist(), pb.tolist(), strict=True):
        places.setdefault(h, []).append(p)
    out: set[tuple[int, int, int]] = set()
    reached: dict[int, int] = {}  # by diagonal: the end of the last passage on it
    for h, p in zip(ha.tolist(), pa_.tolist(), strict=True):
        for q in places.get(h, ()):
            if p < reached.get(p - q, -1) or a[p : p + 1] != b[q : q + 1]:
                continue
            i, j = p, q
            while i and j and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
            end, most = p, min(len(a) - p, len(b) - q) + p
            while end < most and a[end] == b[end - p + q]:
                end += 1
            reached[p - q] = end
            if end - i >= min(GRAM, len(a), len(b)):
                out.add((i, j, end - i))
    return sorted(out)


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_grams long"
)


def _facts(text: str) -> tuple[str, np.ndarray, np.ndarray]:
    codes = code_points(text)
    hashes, positions = winnow(codes)
    return encode(hashes, positions), np.unique(hashes), codes


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket and document; every row is compared with the next of its bucket. A guard row stands
    for the document after a bucket's last and gives no result of its own."""
    schema = arrow_schema(RESULT)
    rows: list[tuple] = []
    before = None  # bucket, doc_id, text, facts of the row that waits for its next
    held = 0
    for batch in batches:
        ids = batch.column("doc_id")
        buckets, guards, texts = batch.column("bucket"), batch.column("guard"), batch.column("text")
        for i in range(batch.num_rows):
            bucket, text = buckets[i].as_py(), texts[i].as_py() or ""
            facts = _facts(text)
            if before is not None and before[0] == bucket:
                rows.append(_compare(before, text, facts))
                held += len(rows[-1][3]) + len(rows[-1][4])
            before = None if guards[i].as_py() else (bucket, ids[i].as_py(), text, facts)
            if held > 1 << 23:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)


def _compare(before: tuple, next_text: str, next_facts: tuple) -> tuple:
    _, doc_id, text, (code, hashes, codes) = before
    half = len(codes) // 2
    edited = text[: len(codes) - half] + next_text[:half]
    edited_code, edited_hashes, _ = _facts(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    near = likeness(hashes, edited_hashes), likeness(hashes, next_facts[1])
    return (doc_id, len(codes), digest, code, edited_code, *near, len(hashes))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they and the next text are.

    The next document is that of the next larger id; after the last comes the first, and a single document is
    its own next. Rows of equal id are ordered by text, null ids come last. Null text is empty: its
    fingerprint is empty, and two empty ones are alike (1). Other columns are not read. An empty table gives an
    empty one.

    Documents are dealt by ranges of ids into buckets of about `bucket_rows`, in one shuffle of the texts. The
    smallest document of each bucket also goes to the end of the bucket before, as its guard, so no task
    needs another's rows. Ranges come from approximate quantiles of the ids and only balance the tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = rows.count()
    wanted = min(MOST_BUCKETS, max(shuffle_partitions(spark), total // bucket_rows))
    cuts = []
    if total > 1:
        shares = [i / wanted for i in range(1, wanted)]
        cuts = sorted({int(c) for c in rows.approxQuantile("doc_id", shares, 0.5 / wanted)})
    # The bucket is the number of cuts at or below the id; null ids go to the last one.
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(_rank(cuts))
    dealt = rows.select("doc_id", "text", bucket.cast("int").alias("bucket"))
    # One row per bucket: its smallest id. Bounded by the number of tasks.
    firsts = sorted(
        (r["bucket"], r["first"]) for r in rows.select("doc_id", bucket.cast("int").alias("bucket")).groupBy("bucket").agg(F.min("doc_id").alias("first")).collect()
    )
    if not firsts:
        return spark.createDataFrame([], RESULT)
    order = [b for b, _ in firsts]
    guard_of = {b: order[i - 1] for i, b in enumerate(order)}  # the bucket before; the first guards the last
    targets = spark.createDataFrame(
        [(b, guard_of[b], first) for b, first in firsts], "bucket int, guarded int, first long"
    )
    plain = dealt.withColumn("guard", F.lit(False))
    guards = (
        dealt.join(F.broadcast(targets), "bucket")  # one row per bucket
        .filter(F.col("doc_id").eqNullSafe(F.col("first")))
        .select("doc_id", "text", F.col("guarded").alias("bucket"), F.lit(True).alias("guard"))
    )
    arranged = (
        plain.unionByName(guards)
        .repartition(max(shuffle_partitions(spark), len(order)), "bucket")
        .sortWithinPartitions("bucket", "guard", F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())
    )
    return arranged.mapInArrow(_ordered, RESULT)


def _rank(cuts: list[int]):
    """How many of the sorted cuts are at or below the id, by binary search in halving steps."""
    n = len(cuts)
    if not n:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])

    def take(rank, step):
        there = F.element_at(bounds, F.least(rank + step, F.lit(n))) <= F.col("doc_id")
        return rank + F.when((rank + step <= n) & there, step).otherwise(0)

    return F.aggregate(steps, F.lit(0), take)
