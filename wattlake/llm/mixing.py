"""Mixing sources to target weights by temperature.

A source with token share s gets weight s**a / sum(s**a).  The exponent a is
bisected to meet a target entropy of the weights, or a limit on how often any
source is repeated, and the weights are realised as block permutations within a
token budget: each source's documents fall into blocks by a hash of the id; an
epoch goes through all blocks in an order of its own, and the last, partial
epoch ends where the source's budget does.  Without a given budget, the
smallest one that goes through every source at least once is taken, so no
document is lost.

DataFrame functions only.  Running sums are over blocks of a source (a fixed
number) and over the documents of the one block in which a budget ends, never
over a whole source.

Defined results: null source counts as the empty name; null or empty texts have
no tokens and cost nothing; a source without tokens goes through once; rows
with the same id are drawn together; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm import common

MAX_REPETITION = 2.0
BLOCKS = 1024
#: Each pass over the source table tries so many exponents: four halvings.
INTERIOR, PASSES = 15, 7


def _bisect(sources: DataFrame, measure, target: float, low: float, high: float) -> float:
    """The smallest exponent in [low, high] at which ``measure``, which falls
    as the exponent grows, is at most ``target``. ``measure`` gives the
    aggregate for one exponent; all exponents of a pass share one job."""
    for _ in range(PASSES):
        step = (high - low) / (INTERIOR + 1)
        tried = [low + step * (i + 1) for i in range(INTERIOR)]
        found = sources.agg(*[measure(a).alias(f"m{i}") for i, a in enumerate(tried)]).first()
        met = [a for a, v in zip(tried, found) if v is None or v <= target]
        high = met[0] if met else high
        missed = [a for a in tried if a < high]
        low = missed[-1] if missed else low
    return high


def entropy(a: float) -> Column:
    """Of the weights, in nats."""
    power = F.pow("share", F.lit(a))
    return F.log(F.sum(power)) - F.lit(a) * F.sum(power * F.log("share")) / F.sum(power)


def repetition(budget: float | None):
    """The most often that any source is gone through, for an exponent."""
    def measure(a: float) -> Column:
        if budget is None:
            over = F.pow("share", F.lit(a - 1))
            return F.max(over) / F.min(over)
        return F.max(F.pow("share", F.lit(a)) * budget / F.col("tokens")) / F.sum(F.pow("share", F.lit(a)))
    return measure


def source_weights(sources: DataFrame, max_repetition: float | None = MAX_REPETITION,
                   target_entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """``sources`` (source, tokens) with share, weight and repeats (how often
    the budget goes through the source)."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    counted = common.materialise(sources.where("tokens > 0").withColumn(
        "share", F.col("tokens") / F.lit(float(total or 1))), "mixing-sources")
    if target_entropy is not None:
        a = _bisect(counted, entropy, target_entropy, 0.0, 16.0)
    elif max_repetition is not None:
        a = _bisect(counted, repetition(budget), max_repetition, 0.0, 1.0)
    else:
        a = 1.0
    power = F.pow("share", F.lit(a))
    z, least = counted.agg(F.sum(power), F.min(power / F.col("tokens"))).first()
    weight = power / F.lit(z or 1.0)
    repeats = power / F.col("tokens") / F.lit(least or 1.0) if budget is None \
        else weight * F.lit(float(budget)) / F.col("tokens")
    weighted = counted.select("source", "tokens", "share", weight.alias("weight"), repeats.alias("repeats"))
    zero = F.lit(0.0)
    return weighted.unionByName(sources.where("tokens = 0").select(
        "source", "tokens", zero.alias("share"), zero.alias("weight"), F.lit(1.0).alias("repeats")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_repetition: float | None = MAX_REPETITION, target_entropy: float | None = None,
        budget: float | None = None, blocks: int = BLOCKS, seed: int = 1) -> DataFrame:
    """One row per document and epoch that draws it: id, source, n_tokens,
    weight and repeats of the source, epoch (from 1), block (place of its
    block in the epoch's permutation) and place (order within the block)."""
    rows = common.materialise(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.regexp_count(common.whole_text(text_col), F.lit(common.WORD)).cast("long").alias("n_tokens"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(blocks)).cast("int").alias("block")), "mixing-rows")
    size = common.materialise(rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "mixing-blocks")
    weights = source_weights(size.groupBy("source").agg(F.sum("tokens").alias("tokens")),
                             max_repetition, target_entropy, budget)
    # a repeat count that misses a whole number by rounding is that number
    whole = F.floor(F.col("repeats") + 1e-9).cast("int")
    plan = weights.select("source", "weight", "repeats", whole.alias("epochs"), F.when(
        F.col("repeats") - whole > 1e-9, F.floor((F.col("repeats") - whole) * F.col("tokens"))).otherwise(0)
        .cast("long").alias("left"))

    # what each epoch draws of each block: all, or in the last epoch the start of one block
    epochs = F.explode(F.sequence(F.lit(1), F.col("epochs") + 1)).alias("epoch")
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64("block", "epoch", F.lit(seed)), "block")
    drawn = size.join(plan, "source").select("*", epochs).withColumns({
        "nth": F.row_number().over(order),
        "before": F.sum("tokens").over(order) - F.col("tokens")})
    room = F.when(F.col("epoch") <= F.col("epochs"), F.col("tokens")).otherwise(F.col("left") - F.col("before"))
    drawn = common.materialise(drawn.withColumn("room", room).where(
        (F.col("epoch") <= F.col("epochs")) | (F.col("room") > 0)).select(
        "source", "block", "epoch", "nth", "weight", "repeats", "room",
        (F.col("room") >= F.col("tokens")).alias("all")), "mixing-drawn")
    place = F.xxhash64("id", "epoch", F.lit(seed + 1))
    found = rows.join(drawn, ["source", "block"]).withColumn("place", place)
    ending = found.where(~F.col("all")).withColumn("sum", F.sum("n_tokens").over(
        Window.partitionBy("source", "epoch", "block").orderBy("place", "id"))).where("sum <= room")
    columns = [F.col("id").alias(id_col), "source", "n_tokens", "weight", "repeats", "epoch",
               F.col("nth").alias("block"), "place"]
    return found.where("all").select(*columns).unionByName(ending.select(*columns))


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mixture as rows of ``docs``, each as often as epochs draw it."""
    times = mix(docs, id_col, **options).select(F.col(id_col).alias("_id"), "epoch").distinct() \
        .groupBy("_id").agg(F.count("*").cast("int").alias("_times"))
    drawn = docs.join(times, F.col(id_col).eqNullSafe(F.col("_id")))
    return drawn.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))
