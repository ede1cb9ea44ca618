"""SimHash near-duplicate detection by anchor-point covering.

A covering code divides the 64 bits into blocks of odd length and takes all
words that are constant within each block as anchors (each block is a perfect
repetition code, so every fingerprint has one nearest anchor, within the
covering radius: the sum of (length - 1) / 2).  Every distinct fingerprint is
stored at its nearest anchor and replicated to each anchor, within covering
radius plus threshold, that can be the nearest anchor of a fingerprint at most
``threshold`` bits away.  Of two linked fingerprints, the one is thus always
replicated to where the other is stored, and it is enough to compare per
anchor. Components of the links follow.

The number of anchors grows with the number of distinct fingerprints, so that
about the same number is stored at each; anchors that still hold many are
split by a salt, and replicas go to each part.  Copies share one fingerprint
and are collapsed before anything is replicated: links join distinct
fingerprints, at most 2080 for each.

Defined results: null or empty text has fingerprint zero, linked like any
other; fewer words than a shingle: the whole sequence is the one shingle;
null ids never become a component id unless a component has no other; repeated
rows share a component; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import common
from wattlake.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
STORED_PER_ANCHOR = 32
STORED_PER_PART = 4096
COMPARE_CELLS = 1 << 20


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the XXH64 (seed 42) of word shingles, repeats included."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return digest(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle_words + 1].tolist()
    ends = ends[shingle_words - 1:].tolist()
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i:i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint as a signed long, one row per input row."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), common.whole_text(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.worker_cache("simhash", dict)  # nothing, and nothing of other operators
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp bigint")


def covering_code(n: int) -> list[int]:
    """Odd block lengths that add up to 64, for ``n`` distinct fingerprints."""
    blocks = max(8, math.ceil(math.log2(max(n, 2) / STORED_PER_ANCHOR)))
    blocks = min(64, blocks + blocks % 2)
    lengths = [1] * blocks
    for i in range((64 - blocks) // 2):
        lengths[i % blocks] += 2
    return lengths


def replicas(fp: np.ndarray, lengths: list[int], threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For unsigned fingerprints: (index, anchor, stored) of one stored row
    each at the nearest anchor, and of replicas there and at all anchors that
    lie some block changes away, at a cost of at most ``threshold`` bits."""
    nearest = np.zeros(len(fp), np.int64)
    cost = np.empty((len(fp), len(lengths)), np.int64)
    at = 0
    for b, length in enumerate(lengths):
        ones = np.bitwise_count((fp >> np.uint64(at)) & np.uint64((1 << length) - 1)).astype(np.int64)
        nearest |= (ones * 2 > length).astype(np.int64) << b
        cost[:, b] = np.abs(2 * ones - length) // 2 + 1
        at += length
    everyone = np.arange(len(fp))
    index, anchor = [everyone, everyone], [nearest, nearest]
    home = [np.ones(len(fp), bool), np.zeros(len(fp), bool)]
    for changes in range(1, threshold + 1):
        for blocks in combinations(range(len(lengths)), changes):
            who = np.flatnonzero(cost[:, blocks].sum(axis=1) <= threshold)
            flip = 0
            for b in blocks:
                flip |= 1 << b
            index.append(who)
            anchor.append(nearest[who] ^ np.int64(flip if flip < 1 << 63 else flip - (1 << 64)))
            home.append(np.zeros(len(who), bool))
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def _compare(stored: np.ndarray, probes: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (larger, smaller) at most ``threshold`` bits apart."""
    us, vs = [], []
    step = max(1, COMPARE_CELLS // max(1, len(stored)))
    for i in range(0, len(probes), step):
        part = probes[i:i + step]
        near = np.bitwise_count(part[:, None] ^ stored[None, :]) <= threshold
        near &= part[:, None] > stored[None, :]
        p, s = np.nonzero(near)
        us.append(part[p])
        vs.append(stored[s])
    return np.concatenate(us), np.concatenate(vs)


def links(distinct: DataFrame, threshold: int = MAX_BITS) -> DataFrame:
    """(u, v): the pairs of distinct fingerprints (column fp) at most
    ``threshold`` bits apart; a pair may come twice."""
    spark = distinct.sparkSession
    common.ship(spark)
    code = covering_code(distinct.count())

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fps), 8192):
                part = fps[i:i + 8192]
                index, anchor, home = replicas(part.view(np.uint64), code, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[index]), pa.array(home)], ["anchor", "fp", "home"])

    rows = distinct.select("fp").mapInArrow(spread, "anchor bigint, fp bigint, home boolean")
    own = distinct.select("fp").mapInArrow(
        lambda batches: (b.filter(b.column(2)) for b in spread(batches)), "anchor bigint, fp bigint, home boolean")
    crowded = own.groupBy("anchor").count().where(F.col("count") > STORED_PER_PART).select(
        "anchor", F.ceil(F.col("count") / STORED_PER_PART).cast("int").alias("parts"))
    crowded = common.materialise(crowded, "simhash-crowded")
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(crowded, "anchor", "left").select(
        "anchor", "fp", "home", F.explode(F.when(F.col("home"), F.array(F.pmod(F.xxhash64("fp"), parts).cast("int")))
                                          .otherwise(F.sequence(F.lit(0), parts - 1))).alias("part"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, stored = None, np.zeros(0, np.uint64)
        for batch in batches:
            anchor, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            home = batch.column(2).to_numpy(zero_copy_only=False)
            fps = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
            us, vs = [], []
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(fps)]):
                if a == b:
                    continue
                if key != (anchor[a], part[a]):
                    key, stored = (anchor[a], part[a]), np.zeros(0, np.uint64)
                mine = home[a:b]
                stored = np.concatenate([stored, fps[a:b][mine]])
                if len(stored) and not mine.all():
                    u, v = _compare(stored, fps[a:b][~mine], threshold)
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], ["u", "v"])

    # stored fingerprints come first within an anchor; replicas then stream past them
    return (dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.desc("home"))
            .select("anchor", "part", "home", "fp").mapInArrow(compare, "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id
    (smallest id reachable over links of at most ``max_bits`` bits)."""
    of = common.materialise(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fingerprints")
    distinct = common.materialise(of.groupBy("fp").agg(
        F.min("id").alias("least"), F.count("*").alias("rows")), "simhash-distinct")
    found = common.materialise(links(distinct, max_bits).distinct(), "simhash-links")
    root = connected_components(found)
    rooted = distinct.join(root, distinct["fp"] == root["u"], "left").select(
        "fp", "least", "rows", F.coalesce("v", "fp").alias("root"))
    rooted = common.materialise(rooted, "simhash-rooted")
    least = common.materialise(rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("fps")), "simhash-least")
    component = common.materialise(common.join_groups(rooted, least, ["root"], "fps", distinct.count()).select(
        "fp", "component_id", "rows"), "simhash-component")
    return common.join_groups(of, component, ["fp"], "rows", of.count()).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component, all columns; rows
    without an id cannot be referred to and stay. Of an id with several texts,
    only the rows whose text has a representative with another id go."""
    found = common.materialise(near_duplicates(docs, id_col, text_col).select(
        F.col(id_col).alias("_id"), F.col("fingerprint").alias("_fp"),
        F.coalesce(F.col(id_col) != F.col("component_id"), F.lit(False)).alias("_gone")), "simhash-found")
    by_id = common.materialise(found.where("_id is not null").groupBy("_id").agg(
        F.min("_gone").alias("_all"), F.max("_gone").alias("_any")).where("_any"), "simhash-gone")
    match = F.col(id_col) == F.col("_id")
    kept = docs.join(by_id, match, "left_anti")
    mixed = by_id.where("not _all")
    if not mixed.limit(1).count():
        return kept
    # ids of which some rows go: these rows are told apart by their fingerprints
    unclear = common.materialise(docs.join(mixed.select("_id"), match, "left_semi"), "simhash-mixed")
    texts = unclear.select(F.col(text_col).alias("_text")).distinct()
    prints = fingerprints(texts, "_text", "_text").select(
        F.col("id").alias("_text"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("_own"))
    gone = found.where("_gone").select("_id", "_fp").distinct()
    rest = unclear.join(prints, F.col(text_col).eqNullSafe(F.col("_text"))).join(
        gone, match & (F.col("_own") == F.col("_fp")), "left_anti")
    return kept.unionByName(rest.select(*[f"`{c}`" for c in docs.columns]))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))
