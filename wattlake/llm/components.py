"""Connected components of a link table, by alternating large-star and
small-star steps. Every step is a grouped minimum (combined before the
shuffle) and a join back to the links. That join shuffles on the node: the leaves
of a very large star meet in one partition, which skew handling splits while the
job runs (in a session without it, one task streams them). Each round is written
to the shared folder, so lost executors cost one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import common


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) longs, either direction, repeats and self links
    allowed -> (u, v): every linked node but the roots, with v the smallest
    node of its component."""
    edges = common.materialise(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = common.materialise(small.unionByName(
            least.select("u", F.col("m").alias("v"))).distinct(), "components")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
