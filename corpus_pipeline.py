"""A training corpus from raw documents: toxic ones go, one of each near-duplicate group stays, repeated passages
keep their first place, sources are mixed to target weights, and what is left is packed into bins.

Every stage takes (spark, docs, sf_dir) and works on all rows of the one before; `run` writes each result as
Parquet to the shared checkpoint folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import Scratch
from shelfcast.llm.jaccard_join import one_of_each_group
from shelfcast.llm.mixing import mix_sources
from shelfcast.llm.packing import best_fit_packing
from shelfcast.llm.suffix_dedup import without_later_copies
from shelfcast.llm.toxicity import ToxicityParams, score_toxicity, train_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, with all their columns as they were."""
    params = ToxicityParams()
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), params)
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("text", F.struct(*[F.col(c) for c in others]).alias("row"))  # so that no name of theirs clashes
    kept = score_toxicity(rows, model, params.threshold).filter("predicted = 0")
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the row with the smallest id; see `one_of_each_group`."""
    return one_of_each_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every passage of 200 bytes or more stays in its first place alone."""
    return without_later_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, as often as it takes them; of a source's last one, its first words."""
    mixed = mix_sources(docs, keep=tuple(docs.columns)).select("copies", "part", "kept")
    whole = mixed.filter("copies > 0").withColumn("n", F.explode(F.expr("sequence(1, copies)")))
    whole = whole.select(*[F.col("kept")[c].alias(c) for c in docs.columns])
    words = F.regexp_extract_all(F.col("kept")["text"], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), "")
    new = {"text": cut}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(cut).cast(docs.schema["n_chars"].dataType)
    part = mixed.filter("part > 0").select(*[new.get(c, F.col("kept")[c]).alias(c) for c in docs.columns])
    return whole.unionByName(part)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes; see `best_fit_packing`."""
    return best_fit_packing(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix),
    ("packing", pack),
]

# Training, similarity and packing are not SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        after = scratch.store(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        docs = before = after
    return docs
