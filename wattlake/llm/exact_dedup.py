"""Exact deduplication by progressive refinement.

Texts are equal when identical after each run of white space is replaced by
one space. Documents are grouped by normalised length, then by a hash of the
first characters, and only members of groups that survive both are compared by
SHA-256 of their whole normalised text. The first two steps move a few bytes a
document.

Defined results: null text counts as empty; of equal texts the row with the
smallest id stays (null ids last, repeated rows with the same id: one of them);
rows settled by length or prefix are groups of one; an empty table gives an
empty result; columns other than id and text are never looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import common

PREFIX_CHARS = 64


def normalised(text: str):
    return F.regexp_replace(common.whole_text(text), common.SPACE, " ")


def survivors(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Ids (distinct) of the documents whose length and prefix hash are both shared."""
    norm = normalised(text_col)
    keys = common.materialise(docs.select(
        F.col(id_col).alias("id"), norm.alias("norm")).select(
        "id", F.length("norm").alias("len"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix")), "exact-keys")
    total = keys.count()
    lengths = common.materialise(keys.groupBy("len").count().where("count > 1"), "exact-lengths")
    same_length = common.join_groups(keys, lengths, ["len"], "count", total).drop("count")
    prefixes = common.materialise(same_length.groupBy("len", "prefix").count().where("count > 1"), "exact-prefixes")
    found = common.join_groups(keys, prefixes, ["len", "prefix"], "count", total).select("id").distinct()
    return common.materialise(found, "exact-survivors")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_all: bool = False) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    ``text_sha256`` is null for documents that length or prefix settled, unless
    ``digest_all`` asks for every digest (the scan then hashes each text where
    it reads it, and no text is moved).  Without it, Spark sends the survivor
    ids to the texts where they fit its broadcast threshold, else joins.
    """
    ids = survivors(docs, id_col, text_col).select(F.col("id").alias("sid"), F.lit(True).alias("hit"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sha = F.sha2(normalised("text").cast("binary"), 256)
    if digest_all:
        hashed = texts.select("id", sha.alias("sha")).join(ids, F.col("id").eqNullSafe(F.col("sid")), "left")
    else:
        hashed = texts.join(ids, F.col("id").eqNullSafe(F.col("sid")), "left").withColumn(
            "sha", F.when(F.col("hit"), sha))
    hashed = common.materialise(hashed.select(
        "id", "sha", F.coalesce("hit", F.lit(False)).alias("hit"),
        F.monotonically_increasing_id().alias("tag")), "exact-hashed")
    shared = hashed.where("hit")
    groups = common.materialise(shared.groupBy("sha").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tag")).alias("first"),
        F.count("*").alias("n")), "exact-groups")
    dup = common.join_groups(shared, groups, ["sha"], "n", hashed.count()).select(
        F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("tag") == F.col("first.tag")).alias("kept"), F.col("sha").alias("text_sha256"))
    alone = hashed.where(~F.col("hit")).select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return dup.unionByName(alone)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns. A row without an id cannot be referred
    to and stays; of rows that repeat both id and text one stays; of an id with
    several texts, only the rows whose text is a copy go."""
    found = common.materialise(exact_dedup(docs, id_col, text_col).where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"), F.col("kept").alias("_kept")), "exact-found")
    by_id = common.materialise(found.groupBy("_id").agg(F.max("_kept").alias("_some"), F.min("_kept").alias("_all")).where(
        "not _all"), "exact-gone")
    match = F.col(id_col) == F.col("_id")
    # only ids meet the texts: those of which no row, or not every row, stays
    kept = docs.join(by_id.select("_id"), match, "left_anti")
    mixed = by_id.where("_some").select("_id")
    if not mixed.limit(1).count():
        return kept
    unclear = docs.join(mixed, match, "left_semi").withColumn("_own", F.sha2(normalised(text_col).cast("binary"), 256))
    stay = found.join(mixed, "_id").where("_kept").select("_id", "_sha").distinct()
    # a digest that length or prefix settled is null: that text is no copy
    settled = stay.where("_sha is null").select(F.col("_id").alias("_settled")).distinct()
    known = found.join(mixed, "_id").where("_sha is not null").select(F.col("_id").alias("_kid"), F.col("_sha").alias("_ksha")).distinct()
    named = unclear.join(stay, match & (F.col("_own") == F.col("_sha")), "left_semi").dropDuplicates([id_col, "_own"])
    alone = unclear.join(settled, F.col(id_col) == F.col("_settled"), "left_semi").join(
        known, (F.col(id_col) == F.col("_kid")) & (F.col("_own") == F.col("_ksha")), "left_anti")
    return kept.unionByName(named.unionByName(alone).select(*[f"`{c}`" for c in docs.columns]))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(common.table(spark, sf_dir, "documents"), digest_all=True)


ORACLE = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n
"""
