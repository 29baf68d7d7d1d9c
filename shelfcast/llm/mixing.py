"""Mixing sources to target weights with hash-threshold histograms, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD, Scratch

# Weights by rank of the source name, repeating; a source gives at most so many times its size.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
# Bits of the hash that each histogram resolves; four of them use all 60 bits.
BITS, LEVELS = 15, 4
# Copies of each source's threshold, so that a hot source's rows spread over as many tasks.
SALTS = 32


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def target_words(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """source, source_size -> also rank, weight, target (double).

    All sizes together are shared by weight; a target above `most` times its source's size is cut there and
    the rest reshared by weight, until none is above. The outcome is one level L with target = least(most *
    size, weight * L): sources are capped in the order of size to weight, so running sums in that order give L.
    One row per source; its ranks need one sort of that small table.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*map(F.lit, weights))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(pattern, (F.col("rank") % len(weights) + 1).cast("int"))
    )
    # Exact decimals: a sum over sources may pass what a double holds.
    cap = (F.col("source_size") * most).cast("decimal(38,0)")
    fullness = F.col("source_size") / F.col("weight")
    order = Window.orderBy(fullness, "rank")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.col("source_size").cast("decimal(38,0)")).over(Window.partitionBy())
    levels = ranked.withColumns(
        {
            "cap": cap,
            "left": total - F.coalesce(F.sum(cap).over(upto), F.lit(0)),
            "weights_left": F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(upto), F.lit(0)),
        }
    ).withColumn("level", F.col("left").cast("double") / F.col("weights_left"))
    # The first source that the level does not fill fixes it for all that follow.
    is_open = F.col("level") * F.col("weight") <= F.col("cap").cast("double")
    final = F.min(F.when(is_open, F.struct(fullness.alias("f"), F.col("rank"), F.col("level")))).over(Window.partitionBy())
    return levels.withColumn("final", final["level"]).select(
        "source",
        "source_size",
        "weight",
        F.coalesce(
            F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")), F.col("cap").cast("double")
        ).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    scratch: Scratch | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_TIMES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, taken, copies, part; and with `keep` the
    struct `kept` of these columns.

    A source whose target is q whole times its size and a rest gives every document q times, and those
    documents once more whose hash lies below the source's threshold. The threshold comes from nested
    histograms: words are summed by source and the top bits of the hash, the bucket in which the rest runs out
    is resolved by the next bits, and so on; no rows are sorted. The last bucket is one hash value, that is one
    document id: of it only the words still missing are taken (`part`; repeated rows of the id share them in
    proportion). So a source meets its target but for rounding. `taken` = `size` * `copies` + `part`.

    Null text has size 0. A null source is a source of its own, the last. Rows with equal ids are decided
    together. Sources without words have target 0. An empty table gives an empty one. Columns of `docs` not
    named stay out, and `keep` ones lie in a struct, so clashing names do no harm.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    hashed = F.xxhash64(F.col(id_col), F.lit(17)).bitwiseAND(F.lit((1 << (BITS * LEVELS)) - 1))
    kept = [F.struct(*[F.col(c) for c in keep]).alias("kept")] if keep else []
    rows = scratch.store(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(text_col).alias("size"),
            hashed.alias("h"),
            *kept,
        )
    )

    def digit(level: int):
        return F.shiftright("h", BITS * (LEVELS - 1 - level)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    # Level 1 doubles as the source totals: one pass, summed before the shuffle.
    first = scratch.store(rows.groupBy("source", digit(0).alias("bucket")).agg(F.sum("size").alias("words")))
    sizes = first.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = scratch.store(
        target_words(sizes, weights, most)
        .withColumn("times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    )
    cut = plan.select("source", F.col("rest"), F.lit(0).cast("long").alias("prefix"))
    histogram = first
    for level in range(LEVELS):
        if level:
            inside = F.shiftright("h", BITS * (LEVELS - level)) == F.col("prefix")
            histogram = (
                _with_source(rows.select("source", "size", "h"), cut.select("source", "prefix"))
                .filter(inside)
                .groupBy("source", digit(level).alias("bucket"))
                .agg(F.sum("size").alias("words"))
            )
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        cumulated = histogram.withColumn("upto", running).withColumn("below", F.col("upto") - F.col("words"))
        # The bucket in which the rest runs out; beyond the last one, all is taken.
        rest = cut.select(F.col("source").alias("_s"), "rest", "prefix")
        joined = cumulated.join(rest, F.col("source").eqNullSafe(F.col("_s")), "inner")
        boundary = (
            joined.filter("upto > rest")
            .groupBy("source", "rest", "prefix")
            .agg(F.min(F.struct("bucket", "below", "words")).alias("b"))
        )
        found = boundary.select(
            "source",
            (F.col("rest") - F.col("b.below")).alias("rest"),
            (F.col("prefix") * (1 << BITS) + F.col("b.bucket")).alias("prefix"),
            F.col("b.words").alias("words"),
        )
        cut = scratch.store(found)
    # One hash value is left: its documents give the share that is still missing.
    threshold = cut.select(
        F.col("source").alias("_t"), F.col("prefix").alias("threshold"), (F.col("rest") / F.col("words")).alias("share")
    )
    decided = plan.join(threshold, F.col("source").eqNullSafe(F.col("_t")), "left").select(
        "source",
        "source_size",
        "target",
        "times",
        F.coalesce(F.when(F.col("rest") > 0, F.col("threshold")), F.lit(0)).alias("threshold"),
        F.when(F.col("rest") > 0, F.col("share")).otherwise(0.0).alias("share"),
    )
    copies = F.col("times") + (F.col("h") < F.col("threshold")).cast("long")
    part = F.when(F.col("h") == F.col("threshold"), F.floor(F.col("size") * F.col("share"))).otherwise(0).cast("long")
    return _with_source(rows, decided).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies + part).alias("taken"),
        copies.alias("copies"),
        part.alias("part"),
        *(["kept"] if keep else []),
    )


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """`rows` with their source's columns. A hot source is dealt over SALTS tasks, its one row copied to each;
    Spark may broadcast instead, by its own size check."""
    salted = per_source.withColumnRenamed("source", "_s").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    dealt = rows.withColumn("_k", F.pmod("h", F.lit(SALTS)).cast("int"))
    on = dealt.source.eqNullSafe(salted._s) & (dealt._k == salted._salt)
    return dealt.join(salted, on, "inner").drop("_s", "_salt", "_k")
