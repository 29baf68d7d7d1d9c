"""Best-fit packing of documents into bins of fixed length under source and duplicate conflicts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import Scratch, arrow_schema, ship
from shelfcast.llm.mixing import word_count

# Words of a bin, documents of one source that a bin takes at most, and pieces that one task packs, about.
CAPACITY = 2048
PER_SOURCE = 2
SHARD_ITEMS = 8192
# Copies of a text's component, so that a hot text's rows spread over as many tasks.
SALTS = 16


class Bins:
    """Open bins by the words still free in them, with what each may not take any more.

    A bin carries two bitmaps: the sources of which it has its fill, and the duplicate clusters in it. A set of
    free sizes is the bits of one integer, so the tightest size that is large enough is one shift and the lowest
    bit. For every source and cluster another such integer has the sizes at which all bins refuse it; the search
    skips them at once, and goes on to the next larger size while no bin of a size takes both.
    """

    def __init__(self, capacity: int, per_source: int = PER_SOURCE):
        self.capacity, self.per_source = capacity, per_source
        self.by_free: list[dict[int, None]] = [{} for _ in range(capacity + 1)]
        self.sizes = 0
        self.refusing: list[dict[int, int]] = [{} for _ in range(capacity + 1)]  # by free size: tag -> bins
        self.refused: dict[int, int] = {}  # tag -> free sizes at which all bins refuse it
        self.free: list[int] = []
        self.tags: list[int] = []  # bitmap of refused tags of each bin
        self.seen: list[dict[int, int]] = []  # of each bin: tag -> pieces of that source

    def _mark(self, size: int, tag: int) -> None:
        if self.by_free[size] and self.refusing[size].get(tag, 0) == len(self.by_free[size]):
            self.refused[tag] = self.refused.get(tag, 0) | 1 << size
        elif tag in self.refused:
            self.refused[tag] &= ~(1 << size)

    def _move(self, b: int, size: int, into: bool) -> None:
        if into:
            self.by_free[size][b] = None
            self.sizes |= 1 << size
        else:
            del self.by_free[size][b]
            if not self.by_free[size]:
                self.sizes &= ~(1 << size)
        counts, bits = self.refusing[size], self.tags[b]
        while bits:
            low = bits & -bits
            tag = low.bit_length() - 1
            counts[tag] = counts.get(tag, 0) + (1 if into else -1)
            bits ^= low
        for tag in list(counts):
            self._mark(size, tag)
            if not counts[tag]:
                del counts[tag]

    def find(self, size: int, source: int, cluster: int) -> int | None:
        """The compatible bin with the least room that is enough; of equals the oldest there."""
        wanted = 1 << source | (1 << cluster if cluster >= 0 else 0)
        fits = self.sizes & ~self.refused.get(source, 0) & ~(self.refused.get(cluster, 0) if cluster >= 0 else 0)
        fits = fits >> size << size
        while fits:
            low = fits & -fits
            for b in self.by_free[low.bit_length() - 1]:
                if not self.tags[b] & wanted:
                    return b
            fits ^= low
        return None

    def put(self, size: int, source: int, cluster: int = -1) -> int:
        """Places a piece; tags of sources and clusters are small numbers that differ. Returns its bin."""
        b = self.find(size, source, cluster)
        if b is None:
            b = len(self.free)
            self.free.append(self.capacity)
            self.tags.append(0)
            self.seen.append({})
        else:
            self._move(b, self.free[b], False)
        self.free[b] -= size
        times = self.seen[b][source] = self.seen[b].get(source, 0) + 1
        if times >= self.per_source:
            self.tags[b] |= 1 << source
        if cluster >= 0:
            self.tags[b] |= 1 << cluster
        self._move(b, self.free[b], True)
        return b


def pack(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int = PER_SOURCE) -> list[tuple[int, int]]:
    """(bin, place in it) of every piece; pieces go in from the longest to the shortest, equal ones in the given
    order. Only clusters that occur again need a bit."""
    source_tag: dict = {}
    for s in sources:
        source_tag.setdefault(s, len(source_tag))
    times: dict = {}
    for c in clusters:
        times[c] = times.get(c, 0) + 1
    cluster_tag: dict = {}
    for c, n in times.items():
        if n > 1:
            cluster_tag[c] = len(source_tag) + len(cluster_tag)
    bins, filled, out = Bins(capacity, per_source), {}, [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = bins.put(sizes[i], source_tag[sources[i]], cluster_tag.get(clusters[i], -1))
        out[i] = b, filled.get(b, 0)
        filled[b] = out[i][1] + 1
    return out


PLACED = "doc_id long, source string, piece int, n_pieces int, size long, shard int, bin int, slot int, free long"


def _pack_shard(capacity: int, per_source: int):
    schema = arrow_schema(PLACED)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"), ("uid", "ascending")])
        sizes = table.column("size").to_pylist()
        places = pack(sizes, table.column("source").to_pylist(), table.column("cluster").to_pylist(), capacity, per_source)
        bins = np.array([b for b, _ in places], np.int64)
        free = capacity - np.bincount(bins, weights=np.array(sizes, float)).astype(np.int64)
        columns = [table.column(n).cast(schema.field(n).type) for n in schema.names[:6]]
        columns += [pa.array(bins, pa.int32()), pa.array([s for _, s in places], pa.int32()), pa.array(free[bins], pa.int64())]
        return pa.table(columns, schema=schema)

    return run


def _near_copies(sized: DataFrame, groups: DataFrame) -> DataFrame:
    """`sized` with the components of `groups` (th, component, n_words) as clusters in place of the texts' hashes, and
    their words; texts without words are in none."""
    named = groups.filter("component IS NOT NULL").groupBy(F.col("th").alias("cluster"))
    named = named.agg(F.min("component").alias("component"), F.min("n_words").alias("n_words"))
    named = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = sized.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(named, ["cluster", "salt"], "left").withColumn("cluster", F.coalesce("component", "cluster"))
    joined = joined.withColumn("words", F.coalesce("n_words", F.lit(0).cast("long")))
    return joined.select(*sized.columns)


def best_fit_packing(
    docs: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_items: int = SHARD_ITEMS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Where each piece of each document goes: doc_id, source, piece, n_pieces, size, bin_id, slot, free.

    A document longer than `capacity` words is cut into pieces of that many and one with the rest. A bin takes
    pieces of `capacity` words in all, at most `per_source` of one source, and none of a duplicate cluster it
    already has (`cluster_col`, or else near copies by `groups`, what `near_duplicates` gives for these rows, or else equal texts). Each piece goes into the tightest bin that takes it, or opens
    one. `slot` counts from 0 within a bin; `free` are the words that the bin has left at the end.

    Pieces are dealt at random, by hash, into shards of about `shard_items`; every shard packs its own bins. So a hot
    source or cluster spreads like everything else, tasks are bounded, and what is lost against one big
    packing is a few open bins per shard. The number of shards follows from the number of pieces alone, so the
    session's partitions do not change the packing. Null or wordless texts have one piece of size 0 without a bin (null
    bin_id, slot and free). Null sources are one source. Repeated rows are packed each. An empty table gives
    an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    cluster = F.col(cluster_col) if cluster_col else F.col(text_col)
    # The row number keeps repeated rows apart; it follows the order in which the files are read.
    # Stored without the texts, since words are counted once for the number of shards and the pieces themselves.
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (word_count(text_col) if groups is None else F.lit(0).cast("long")).alias("words"),  # else told by the groups
        F.xxhash64(cluster).alias("cluster"),
        F.monotonically_increasing_id().alias("uid"),
    )
    if groups is not None:
        sized = _near_copies(sized, groups)
    sized = Scratch(spark, "packing").store(sized)
    n_pieces = F.greatest(F.ceil(F.col("words") / capacity), F.lit(1)).cast("int")
    pieces = sized.withColumn("n_pieces", n_pieces).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)).alias("piece")
    )
    size = F.least(F.col("words") - F.col("piece").cast("long") * capacity, F.lit(capacity)).cast("long")
    pieces = pieces.withColumn("size", size)
    placed = F.sum(F.when(F.col("words") > 0, F.col("n_pieces")))
    shards = max(1, -(-(sized.withColumn("n_pieces", n_pieces).agg(placed).first()[0] or 0) // shard_items))
    shard = F.pmod(F.xxhash64("doc_id", "uid", "piece"), F.lit(shards)).cast("int")
    packed = (
        pieces.filter("size > 0")
        .select("doc_id", "source", "piece", "n_pieces", "size", shard.alias("shard"), "cluster", "uid")
        .groupBy("shard")
        .applyInArrow(_pack_shard(capacity, per_source), PLACED)
    )
    named = packed.select(
        "doc_id",
        "source",
        "piece",
        "n_pieces",
        "size",
        (F.shiftleft(F.col("shard").cast("long"), 32) + F.col("bin")).alias("bin_id"),
        "slot",
        "free",
    )
    empty = pieces.filter("size = 0").select("doc_id", "source", "piece", "n_pieces", "size")
    return named.unionByName(empty, allowMissingColumns=True)
