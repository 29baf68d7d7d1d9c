"""Near-duplicate vectors by cosine: inverted lists with product-quantised residuals, then exact cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import Scratch, arrow_schema, bounded_sample, components, ship

THRESHOLD = 0.9
# Training sample, by hash of the vector: at most so many rows and so many bytes. All else sees all vectors.
SAMPLE_ROWS, SAMPLE_BYTES = 40_000, 32 << 20
# Residuals are cut into SUBSPACES parts of at most CODES codewords each.
SUBSPACES, CODES = 8, 256
MOST_LISTS = 4096
# Every vector looks into so many lists, and into this share of them besides.
LEAST_PROBES, PROBE_SHARE = 24, 1 / 64
# Members and queries that meet in one task.
MEMBERS, QUERIES = 2048, 8192
# Pairs whose probes are compared in one step.
PAIRS = 1 << 16


def kmeans(points: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids by Lloyd's rounds from a random start; empty ones move to random points."""
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        label = nearest(points, centroids, 1)[:, 0]
        counts = np.bincount(label, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, label, points)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
        if not full.all():
            centroids[~full] = points[rng.integers(0, len(points), int((~full).sum()))]
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the `count` nearest centroids of every point, the nearest first."""
    out = np.empty((len(points), count), np.int32)
    norms = (centroids**2).sum(axis=1)
    step = max(1, (1 << 21) // max(1, len(centroids)))
    for i in range(0, len(points), step):
        apart = norms - 2 * points[i : i + step] @ centroids.T
        if count < len(centroids):
            few = np.argpartition(apart, count - 1, axis=1)[:, :count]
        else:
            few = np.broadcast_to(np.arange(len(centroids)), apart.shape)
        order = np.argsort(np.take_along_axis(apart, few, 1), axis=1, kind="stable")
        out[i : i + step] = np.take_along_axis(few, order, 1)
    return out


@dataclass
class Quantiser:
    """Coarse centroids, and a codebook of residuals per subspace (subspaces, codes, width)."""

    coarse: np.ndarray
    books: np.ndarray
    probes: int

    @classmethod
    def fit(cls, units: np.ndarray, total: int) -> Quantiser:
        lists = int(np.clip(round(2 * np.sqrt(total)), 1, min(MOST_LISTS, len(units))))
        coarse = kmeans(units, lists)
        rest = cls._parts(units - coarse[nearest(units, coarse, 1)[:, 0]])
        codes = min(CODES, len(units))
        books = np.stack([kmeans(rest[:, m], codes) for m in range(SUBSPACES)])
        probes = min(lists, LEAST_PROBES + int(lists * PROBE_SHARE))
        return cls(coarse, books, probes)

    @staticmethod
    def _parts(points: np.ndarray) -> np.ndarray:
        """(rows, SUBSPACES, width), padded with zeros to whole parts."""
        width = -(-points.shape[1] // SUBSPACES)
        out = np.zeros((len(points), SUBSPACES * width), np.float32)
        out[:, : points.shape[1]] = points
        return out.reshape(len(points), SUBSPACES, width)

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probed lists (the own one first), residual codes in it, and the length of what the codes miss."""
        lists = nearest(units, self.coarse, self.probes)
        rest = self._parts(units - self.coarse[lists[:, 0]])
        codes = np.stack([nearest(rest[:, m], self.books[m], 1)[:, 0] for m in range(SUBSPACES)], axis=1)
        told = self.books[np.arange(SUBSPACES), codes]
        missed = np.sqrt(((rest - told) ** 2).sum(axis=(1, 2)))
        return lists, codes.astype(np.uint8), missed

    def tables(self, units: np.ndarray) -> np.ndarray:
        """Inner products of a query's parts with all codewords: (queries, SUBSPACES, codes)."""
        return np.einsum("qmw,mkw->qmk", self._parts(units), self.books, optimize=True)


def unit_rows(raw: np.ndarray) -> np.ndarray:
    wide = raw / np.abs(raw).max(axis=1, keepdims=True)  # so that no square passes what a double holds
    return wide / np.sqrt((wide**2).sum(axis=1, keepdims=True))


ENTRY = "cid long, mult long, vector binary, list int, probes binary, codes binary, missed double"


def _encoded(shared):
    schema = arrow_schema(ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser = Quantiser(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                raw = np.stack([np.frombuffer(v.as_py(), np.float64) for v in batch.column("vector")])
                lists, codes, missed = quantiser.encode(unit_rows(raw).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("cid"),
                        batch.column("mult"),
                        batch.column("vector"),
                        pa.array(lists[:, 0], pa.int32()),
                        pa.array([x.tobytes() for x in lists], pa.binary()),
                        pa.array([x.tobytes() for x in codes], pa.binary()),
                        pa.array(missed.astype(np.float64)),
                    ],
                    schema=schema,
                )

    return run


FOUND = "kind int, a long, b long"


def _matches(shared, threshold: float):
    """Queries against the members of one list: table lookups bound the cosine, and the exact one decides.

    Rows out: (0, query, copies found), (0, member, copies of the queries) of those in whose own list the member does
    not look and so cannot find them itself, both summed; and (1, a, b): of each task's links as many pairs as it
    takes to connect what they connect. So no pair has a row or a step of its own.
    """
    schema = arrow_schema(FOUND)

    def run(table: pa.Table) -> pa.Table:
        quantiser = Quantiser(*shared.value)
        member = table.filter(pa.compute.equal(table.column("role"), 0))
        query = table.filter(pa.compute.equal(table.column("role"), 1))
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if member.num_rows and query.num_rows:
            ids, mult = member.column("cid").to_numpy(), member.column("mult").to_numpy()
            units = unit_rows(np.stack([np.frombuffer(v.as_py(), np.float64) for v in member.column("vector")]))
            codes = np.stack([np.frombuffer(v.as_py(), np.uint8) for v in member.column("codes")])
            missed = member.column("missed").to_numpy()
            probed = np.stack([np.frombuffer(v.as_py(), np.int32) for v in member.column("probes")])
            centre = quantiser.coarse[int(member.column("list")[0].as_py())]
            step = max(1, (1 << 21) // max(1, len(ids)))
            for i in range(0, query.num_rows, step):
                part = query.slice(i, step)
                q_ids, q_mult = part.column("cid").to_numpy(), part.column("mult").to_numpy()
                q_home = part.column("home").to_numpy()
                q_units = unit_rows(np.stack([np.frombuffer(v.as_py(), np.float64) for v in part.column("vector")]))
                tables = quantiser.tables(q_units.astype(np.float32))
                told = (q_units.astype(np.float32) @ centre)[:, None]
                for m in range(SUBSPACES):
                    told = told + tables[:, m][:, codes[:, m]]
                # Both have length one, so what the codes miss cannot add more than its own length.
                x, y = np.nonzero(told + missed[None, :] >= threshold - 1e-4)
                exact = np.einsum("ij,ij->i", q_units[x], units[y])
                good = (exact >= threshold) & (q_ids[x] != ids[y])
                x, y = x[good], y[good]
                if not len(x):
                    continue
                unseen = np.concatenate(
                    [(probed[y[a : a + PAIRS]] != q_home[x[a : a + PAIRS], None]).all(axis=1) for a in range(0, len(x), PAIRS)]
                )
                for own, of, weights in ((q_ids, x, mult[y]), (ids, y[unseen], q_mult[x[unseen]])):
                    counts = np.bincount(of, weights=weights, minlength=len(own)).astype(np.int64)
                    some = np.flatnonzero(counts)
                    rows.append((np.zeros(len(some), np.int64), own[some], counts[some]))
                a, b = spanning(q_ids[x], ids[y])
                rows.append((np.ones(len(a), np.int64), a, b))
        columns = [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]
        return pa.table([pa.array(c).cast(f.type) if len(c) else pa.array([], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links a - b, as few pairs as connect what they connect: every number with the smallest that it reaches."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[x], low[y])
        after = low.copy()
        for side in (x, y, low[x], low[y]):
            np.minimum.at(after, side, least)
        after = after[after]
        if np.array_equal(after, low):
            break
        low = after
    other = low != np.arange(len(nodes))
    return nodes[other], nodes[low[other]]


def _vector_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("cid long, mult long, first long, vector binary")
    for batch in batches:
        column = batch.column("embedding")
        vectors = [np.asarray(v.values, dtype=np.float64).tobytes() for v in column]
        yield pa.RecordBatch.from_arrays(
            [batch.column("cid"), batch.column("mult"), batch.column("first"), pa.array(vectors, pa.binary())], schema=schema
        )


def _linked(classes: DataFrame, total: int, scratch: Scratch, threshold: float) -> DataFrame:
    """Links among the classes (cid, mult, vector) of one dimension: rows of `_matches`."""
    spark = classes.sparkSession
    width = len(classes.select("vector").first()["vector"])
    rows = min(SAMPLE_ROWS, max(1000, SAMPLE_BYTES // width))
    sample = bounded_sample(classes.select("cid", "vector"), ["cid"], rows).select("vector").collect()
    units = unit_rows(np.stack([np.frombuffer(r["vector"], np.float64) for r in sample])).astype(np.float32)
    quantiser = Quantiser.fit(units, total)
    shared = spark.sparkContext.broadcast((quantiser.coarse, quantiser.books, quantiser.probes))  # bounded by MOST_LISTS
    entries = scratch.store(classes.select("cid", "mult", "vector").mapInArrow(_encoded(shared), ENTRY))

    looks = entries.select("cid", "mult", "vector", F.col("list").alias("home"), F.explode(_numbers("probes", quantiser.probes)).alias("list"))
    # A long list is cut into blocks of members, and its queries too; every block meets every part.
    sizes = entries.groupBy("list").agg(F.count("*").alias("m"))
    asked = looks.groupBy("list").agg(F.count("*").alias("q"))
    plan = scratch.store(
        sizes.join(asked, "list").select(
            "list", F.ceil(F.col("m") / MEMBERS).cast("int").alias("blocks"), F.ceil(F.col("q") / QUERIES).cast("int").alias("parts")
        )
    )
    shares = F.broadcast(plan)  # one row per list, MOST_LISTS at most
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    members = entries.join(shares, "list").select(
        "list", own.alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"),
        "cid", "mult", "vector", F.col("list").alias("home"), "probes", "codes", "missed",
    )
    none = F.lit(None).cast("binary")
    queries = looks.join(shares, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"),
        "cid", "mult", "vector", "home", none.alias("probes"), none.alias("codes"), F.lit(0.0).alias("missed"),
    )
    return members.unionByName(queries).groupBy("list", "block", "part").applyInArrow(_matches(shared, threshold), FOUND)


def _numbers(column: str, count: int):
    """The 32-bit little-endian numbers packed in a binary column, as an array."""
    text = F.hex(F.col(column))

    def number(i):
        at = i * 8
        swapped = F.concat(*[F.substring(text, at + k, F.lit(2)) for k in (7, 5, 3, 1)])
        return F.conv(swapped, 16, 10).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), number)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Per row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors link if their cosine in double precision is at least `threshold` and the search meets them; no
    other pair is linked. Equal vectors are one class: they link with each other and are searched for once.
    Vectors that are null, zero, or hold null or non-finite components link with nothing, and vectors link
    only with those of their own dimension. `n_links` counts the other rows linked directly; `component_id` is the
    smallest vec_id that links reach; `kept` says whether that is the row's own. Rows with a null id take part,
    and are not kept; repeated ids are rows of their own. Columns not named are not read.

    Every class is a member of its nearest list, and looks into the nearest LEAST_PROBES and PROBE_SHARE of
    all besides. A pair counts once for each side, even if only one side's look finds it.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark, "vectors")
    own = F.col(vector_col).cast("array<double>")
    usable = (
        own.isNotNull()
        & F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(own, lambda x: x != 0)
    )
    # Adding zero turns -0.0 into 0.0, so that equal vectors hash alike.
    plain = F.transform(own, lambda x: x + F.lit(0.0))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
        F.when(F.coalesce(usable, F.lit(False)), plain).alias("embedding"),
    ).withColumn("cid", F.when(F.col("usable"), F.xxhash64(F.size("embedding"), F.col("embedding"))))
    grouped = (
        rows.filter("usable")
        .groupBy("cid")
        .agg(F.min("vec_id").alias("first"), F.count("*").cast("long").alias("mult"), F.first("embedding").alias("embedding"))
    )
    classes = scratch.store(grouped.select("cid", "mult", "first", "embedding").mapInArrow(_vector_bytes, "cid long, mult long, first long, vector binary"))
    widths = classes.groupBy(F.octet_length("vector").alias("width")).agg(F.count("*").alias("n")).collect()
    found = None
    for w in sorted(widths, key=lambda w: w["width"]):  # as a rule one
        part = _linked(classes.filter(F.octet_length("vector") == w["width"]), w["n"], scratch, threshold)
        found = part if found is None else found.union(part)
    empty = spark.createDataFrame([], FOUND)
    found = scratch.store(found if found is not None else empty)
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("near"))
    parts = components(found.filter("kind = 1"), scratch)
    labelled = classes.select("cid", "mult", "first").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    labelled = scratch.store(labelled.withColumn("component", F.coalesce("component", "cid")))
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    facts = (
        labelled.join(smallest, "component")
        .join(counts, "cid", "left")
        .select("cid", "component_id", (F.coalesce("near", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    )
    linked = rows.filter("usable").select("vec_id", "cid").join(facts, "cid").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

