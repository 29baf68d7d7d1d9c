"""What several operators share: tables stored between jobs, words of texts as numpy arrays, components."""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these bytes.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"
# Texts are worked on in pieces of about this many bytes, so that arrays stay small.
PIECE = 1 << 20


def work_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only on a single machine where none is set, as in
    tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Tables written to the shared folder to cut lineage. They outlive lost executors.

    `drop` deletes a table that no later step reads; what the returned frame reads has to stay,
    and is left to whoever cleans the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self) -> str:
        self.count += 1
        return f"{self.base}/{self.count}"

    def store(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        path = self.path()
        df.write.parquet(path, compression=compression)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored.scratch_path = path
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self.delete(table.scratch_path)

    def delete(self, path: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, as `--py-files` would: a zip of its sources goes
    through the driver's file server, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_sample(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """At most `most` rows, those with the smallest hashes of `keys`; all rows if there are no more.

    A first cut by the hash leaves a few times `most` rows of any table, so what partitions hand in does not
    grow with their number.
    """
    share = max(1, df.count() // (4 * most))
    h = F.xxhash64(*keys)
    return df.filter(F.pmod(h, F.lit(share)) == 0).orderBy(h, *keys).limit(most)


# 64-bit hashing -----------------------------------------------------------------------------

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer: every input bit changes about half of the output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SEPARATOR = np.zeros(256, dtype=bool)
IS_SEPARATOR[list(SEPARATORS)] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=U)
    out[0] = 1
    if n > 1:
        out[1:] = U(base & 0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class _Powers:
    """Powers of the hash base and of its inverse, made once per process and grown on demand."""

    up = powers(_BASE, 1)
    down = powers(_INVERSE, 1)

    @classmethod
    def to(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up, cls.down = powers(_BASE, 2 * n), powers(_INVERSE, 2 * n)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes have equal hashes wherever they stand."""
    _Powers.to(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=U)
    sums[0] = 0
    np.cumsum(BYTE_CODES[data] * _Powers.up[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _Powers.down[starts]
    return mix(raw + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = IS_SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts laid end to end, and the number of words up to each text's start.

    `offsets` has the first byte of every text and the end of the last; `separators` says of every byte value
    whether it parts words.
    """
    inside = ~separators[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def text_pieces(column: pa.Array, piece: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [i, j) of a string column at a time: their bytes end to end, and offsets. NULL is empty."""
    kind = pa.large_binary()
    column = column.cast(pa.large_string()).fill_null("").cast(kind) if column.type != kind else column
    n = len(column)
    if n == 0:
        return
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + piece, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        i = j


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a few plain types, written like a Spark one."""
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(","))])


# Components -----------------------------------------------------------------------------------


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """The smallest node that each node of `edges` (a, b: long) reaches: node, component.

    Every round, nodes hang their neighbours under the smallest node in sight (large-star, then
    small-star), until nothing moves; rounds grow with the logarithm of a component's diameter. Rows
    of a hub are pre-aggregated before the shuffle for its minimum; the join back onto a hub is an
    equi-join that adaptive execution splits. Rounds are stored in the shared folder.
    """
    links = edges.select("a", "b").filter("a <> b").distinct()
    state = scratch.store(links)
    last = None
    for _ in range(max_rounds):
        both = state.select("a", "b").union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        ).distinct()
        # small-star: every node's smaller neighbours and itself under the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a <> b")
            .distinct()
        )
        after = scratch.store(small)
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(state)
        state = after
        if mark == last:
            break
        last = mark
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    result = state.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.col("m").alias("component"))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = result.union(roots)
    return out


def ceil_div(a: int, b: int) -> int:
    return max(1, math.ceil(a / b))
