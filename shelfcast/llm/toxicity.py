"""Toxicity scores from non-negative positive-unlabelled learning: a linear model trained in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from shelfcast.llm.common import U, arrow_schema, bounded_sample, ship, span_hashes, text_pieces, word_spans

# Letters are a-z and all bytes of longer characters; what stands between them parts words.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[97:123] = False
NO_LETTER[128:] = False
# Beside whole words, their beginnings of so many bytes are features, and so is a beginning that at least so
# many different words of the text share.
BEGINNINGS = (4, 5, 6, 7, 8)
SHARED_BY = (2, 3, 5)


@dataclass(frozen=True)
class ToxicityParams:
    """Bounds and rates of the training. The sample is all that is bounded; scores see whole texts."""

    bits: int = 20  # features are hashed to 2^bits places
    most_positive: int = 2000  # confirmed toxic rows in the sample, chosen by hash of the id
    most_unlabelled: int = 4000  # rows of any kind in the sample, taken as unlabelled
    least_deviation: float = 5.0  # standard errors between a feature's shares of the two samples
    steps: int = 300
    rate: float = 0.05
    decay: float = 5e-4
    threshold: float = 0.7


def features(column: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """For every text the sorted distinct places of its features."""
    shift = U(64 - bits)
    for i, j, data, offsets in text_pieces(pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))):
        starts, ends, first = word_spans(data, offsets, NO_LETTER)
        words = span_hashes(data, starts, ends)
        table = np.stack(
            [
                np.where(ends - starts > n, span_hashes(data, starts, np.minimum(ends, starts + n)) * U(2 * n + 1), U(0))
                for n in BEGINNINGS
            ],
            axis=1,
        )
        for k in range(j - i):
            at, upto = first[k], first[k + 1]
            distinct, where = np.unique(words[at:upto], return_index=True)
            begins, times = np.unique(table[at:upto][where], return_counts=True)
            shared = [begins[times >= least] * U(2 * least + 17) for least in SHARED_BY]
            yield np.unique((np.concatenate([distinct, begins, *shared]) >> shift).astype(np.int32))


@dataclass
class LinearModel:
    """Score of a text: sigmoid of the bias and the weights of its distinct features."""

    weights: np.ndarray
    bias: float
    bits: int

    def score(self, column: pa.Array) -> np.ndarray:
        sums = [self.weights[places].sum(dtype=np.float64) for places in features(column, self.bits)]
        margin = np.clip(np.array(sums, dtype=np.float64) + self.bias, -500, 500)
        return 1 / (1 + np.exp(-margin))


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, params: ToxicityParams) -> LinearModel:
    """Minimises prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)) with the logistic loss.

    R- of unlabelled rows counts the hidden positives among them as negative; subtracting prior * R- of known
    positives corrects it. Where that difference falls below zero it counts as zero and gives no gradient (the
    non-negative estimator). Adam steps over the whole sample, so the outcome does not hang on an order of rows.
    """
    size = 1 << params.bits
    if not positive:  # nothing to learn from: everything is as likely as the prior
        return LinearModel(np.zeros(size, np.float32), float(np.log(prior / (1 - prior))), params.bits)
    rows = positive + unlabelled
    # Features whose share of confirmed rows differs from that of unlabelled rows by more than chance; the rest
    # would only be memorised.
    share = [np.zeros(size), np.zeros(size)]
    for seen, part in zip(share, (positive, unlabelled), strict=True):
        for r in part:
            seen[r] += 1
    n1, n0 = len(positive), max(1, len(unlabelled))
    pooled = (share[0] + share[1]) / (n1 + n0)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n1 + 1 / n0))
    kept = np.flatnonzero(np.abs(share[0] / n1 - share[1] / n0) > params.least_deviation * error)
    place = np.full(size, -1, np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    lengths = np.array([len(r) for r in rows])
    index = np.concatenate(rows) if lengths.sum() else np.empty(0, np.int32)
    owner = np.repeat(np.arange(len(rows)), lengths)
    w, bias = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(len(kept)), np.zeros(len(kept)), 0.0, 0.0
    for step in range(1, params.steps + 1):
        g = np.clip(np.bincount(owner, weights=w[index], minlength=len(rows)) + bias, -60, 60)
        q = 1 / (1 + np.exp(-g))
        corrected = np.logaddexp(0, g[n1:]).sum() / n0 - prior * np.logaddexp(0, g[:n1]).mean()
        push = np.zeros(len(rows))  # gradient by margin
        push[:n1] = prior * (q[:n1] - 1) / n1
        if corrected > 0:
            push[:n1] -= prior * q[:n1] / n1
            push[n1:] = q[n1:] / n0
        grad = np.bincount(index, weights=push[owner], minlength=len(kept)) + params.decay * w
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        mb = 0.9 * mb + 0.1 * push.sum()
        vb = 0.999 * vb + 0.001 * push.sum() ** 2
        scale = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= params.rate * scale * m / (np.sqrt(v) + 1e-8)
        bias -= params.rate * scale * mb / (np.sqrt(vb) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[kept] = w
    return LinearModel(weights, float(bias), params.bits)


def held_out_fold(id_col: str):
    """Rows whose crc32 of the id, written as text, leaves 1 when divided by 3. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample_features(bits: int) -> Callable:
    schema = arrow_schema("toxic int, places binary")

    def run(batches):
        for batch in batches:
            places = [p.tobytes() for p in features(batch.column("text"), bits)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(places, pa.binary())], schema=schema)

    return run


def train_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> LinearModel:
    """A model from confirmed toxic rows and unlabelled text, neither from the held-out fold.

    The class prior is the toxic share of all labelled rows of the training fold (with one row of each class
    added, so that it is never 0 or 1). Ids with several labels are toxic if one says so; null labels are none.
    """
    ship(docs.sparkSession)
    marks = (
        labels.select(F.col("doc_id"), F.col("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out_fold("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = marks.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    prior = (counts["t"] + 1) / (counts["n"] + 2)
    ids = (
        docs.select("doc_id")
        .filter(F.col("doc_id").isNotNull() & ~held_out_fold("doc_id"))
        .join(marks.filter("toxic = 1"), "doc_id", "left")
        .select("doc_id", F.coalesce("toxic", F.lit(0)).alias("toxic"))
    )

    def some(rows: DataFrame, toxic: int, most: int) -> DataFrame:
        first = bounded_sample(rows.select("doc_id").distinct(), ["doc_id"], most)
        return first.select("doc_id", F.lit(toxic).alias("toxic"))

    # The unlabelled sample stands for all rows, confirmed ones among them, as the class prior does. At most so
    # many ids by the parameters, hence the broadcast.
    chosen = some(ids.filter("toxic = 1"), 1, params.most_positive).union(some(ids, 0, params.most_unlabelled))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    rows = sample.mapInArrow(_sample_features(params.bits), "toxic int, places binary").collect()
    parts: dict[int, list[np.ndarray]] = {0: [], 1: []}
    for r in sorted(rows, key=lambda r: (r["toxic"], bytes(r["places"]))):
        parts[r["toxic"]].append(np.frombuffer(r["places"], np.int32))
    return fit_nnpu(parts[1], parts[0], prior, params)


def score_toxicity(docs: DataFrame, model: LinearModel, threshold: float = 0.7) -> DataFrame:
    """All columns of `docs`, with score and predicted in front: doc order is kept, nothing is shuffled.

    The score of a text uses nothing but the text. Null and empty texts get the score of the bias alone.
    A column of `docs` named score or predicted gives way to the new one.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.bits))  # 4 * 2^bits bytes
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    fields = {f.name: f for f in docs.schema.fields}

    def run(batches):
        own = LinearModel(*shared.value)
        for batch in batches:
            scores = own.score(batch.column("text"))
            columns = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays(
                [pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), *columns], names=["score", "predicted", *rest]
            )

    schema = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType()), *[fields[c] for c in rest]])
    return docs.select(*rest).mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted.

    Trained on the other fold's labels alone; see `train_toxicity` and `score_toxicity`. An empty table gives an
    empty one, and without any toxic label every score is the prior.
    """
    model = train_toxicity(docs, labels, params)
    scored = score_toxicity(docs.select("doc_id", "text", held_out_fold("doc_id").alias("held_out")), model, params.threshold)
    return scored.select("doc_id", "held_out", "score", "predicted")
