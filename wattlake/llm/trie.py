"""Prefix trie of rebuilt conversations, summed up by time-forward processing.

A node is a distinct sequence of first turns, its name the smallest conversation
that starts with it and its depth. Sequences are compared by 128-bit prefix
signatures: the exclusive or, so far, of hashes of (depth, role, text). What is
needed per node alone (members, parents, children) is grouped and joined.

Subtree totals go upwards by time-forward processing. Consecutive nodes with the
same members form one run, which has the totals of its lowest node plus what its
own turns add; only runs are processed, and a chain of n runs needs about n * n
/ 2 turns. Runs are sorted externally, by shard and in reverse level order, and
stream through a priority queue of messages to parents, which spills sorted
parts to anonymous files of the task (nothing else reads these; a task that is
lost starts again). A shard is a subtree whose root has at most ``SHARD``
members. The totals of shard roots, added up per parent, enter the next round,
whose shards are made of the runs with up to ``FAN`` times as many members, until
the trie's root is done.

A conversation may hold a third of all turns, and so may the members of a node:
turns are numbered over range partitions, prefixes are summed in blocks of
``BLOCK`` turns, hot nodes are sent to their turns, and the ids that end at a node
are joined to long strings in range partitions before one task digests them.

Defined results: rows without a conversation id are left out; null role or text
is empty; turns are ordered by number (null first), then role, then text, and
repeated rows are turns of their own; an empty table gives an empty result;
other columns are not looked at. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm import common

#: Ids of one block share its first conversation's turns, up to MOST_SHARED - 1.
SHARE_BLOCK, MOST_SHARED = 100, 6
BLOCK = 1024
SHARD, FAN = 256, 256
QUEUE_MESSAGES = 200_000
ID_CHARS = 1 << 18


# ---- rebuilt conversations ---------------------------------------------------
def numbered_turns(conversations: DataFrame, id_col: str) -> DataFrame:
    """(conv, pos, chars, t1, t2): turns at their positions, from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(F.col(id_col).cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text")) \
        .where("conv is not null")
    first = F.asc_nulls_first("turn")
    dealt = turns.repartitionByRange("conv", first, "role", F.substring("text", 1, 64)).sortWithinPartitions(
        "conv", first, "role", "text").select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
        F.char_length("text").cast("long").alias("chars"), F.xxhash64(F.lit(1), "role", "text").alias("t1"),
        F.xxhash64(F.lit(2), "text", F.lit("\x1f"), "role").alias("t2"))
    dealt = common.materialise(dealt, "trie-dealt")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n")).select(
        "conv", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return dealt.join(parts, ["conv", "part"]).select(
        "conv", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "chars", "t1", "t2")


def own_turns(conv: Column) -> Column:
    """How many of a conversation's first turns are those of its block's first."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, n_turns) of each conversation, and (conv, n_turns, depth, chars,
    t1, t2) of each of its rebuilt turns."""
    convs = common.materialise(turns.groupBy("conv").agg(F.count("*").alias("own")).select(
        "conv", "own", own_turns(F.col("conv")).alias("h"), (F.col("conv") - F.col("conv") % SHARE_BLOCK).alias("lead")),
        "trie-convs")
    leads = convs.select(F.col("conv").alias("lead"), F.col("own").alias("there"))
    shape = common.materialise(convs.join(leads, "lead", "left").withColumn(
        "taken", F.least("h", F.coalesce("there", F.lit(0)))).withColumn(
        "n_turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-shape")
    heads = turns.where(F.col("pos") < MOST_SHARED).withColumnRenamed("conv", "lead")
    shared = shape.where("taken > 0").select("conv", "lead", "taken", "n_turns").join(heads, "lead").where("pos <= taken")
    rest = common.join_groups(turns, shape.select("conv", "own", "h", "taken", "n_turns"), ["conv"], "own",
                              turns.count()).where("pos > h")
    columns = ["conv", "n_turns", "depth", "chars", "t1", "t2"]
    rows = shared.withColumn("depth", F.col("pos")).select(*columns).unionByName(
        rest.withColumn("depth", F.col("pos") - F.col("h") + F.col("taken")).select(*columns))
    return shape.select("conv", "n_turns"), rows


def prefixes(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, n_turns, depth, chars, cum, s1, s2): with the signature of the
    first ``depth`` turns and their characters."""
    rows = rows.withColumn("block", F.floor((F.col("depth") - 1) / block)).select(
        "conv", "n_turns", "block", "depth", "chars", F.xxhash64("depth", "t1", "t2").alias("x1"),
        F.xxhash64("t2", "depth", "t1").alias("x2"))
    so_far = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = common.materialise(rows.select(
        "conv", "n_turns", "block", "depth", "chars", F.sum("chars").over(so_far).alias("cum"),
        F.bit_xor("x1").over(so_far).alias("s1"), F.bit_xor("x2").over(so_far).alias("s2")), "trie-within")
    ends = within.where((F.col("depth") % block == 0) & (F.col("n_turns") > block))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    carried = ends.select("conv", (F.col("block") + 1).alias("block"), F.sum("cum").over(earlier).alias("c"),
                          F.bit_xor("s1").over(earlier).alias("b1"), F.bit_xor("s2").over(earlier).alias("b2"))
    later = within.where("block > 0").join(carried, ["conv", "block"]).select(
        "conv", "n_turns", "depth", "chars", (F.col("cum") + F.col("c")).alias("cum"),
        F.col("s1").bitwiseXOR(F.col("b1")).alias("s1"), F.col("s2").bitwiseXOR(F.col("b2")).alias("s2"))
    return within.where("block = 0").drop("block").unionByName(later)


# ---- time-forward processing -------------------------------------------------
class MessageQueue:
    """Messages (key, leaves, saved), taken in the order of their keys. Holds
    ``room`` in memory; the later half of more goes to a file, sorted."""

    def __init__(self, room: int = QUEUE_MESSAGES):
        self.room, self.held, self.files, self.made = room, [], [], 0

    def push(self, key: tuple, leaves: int, saved: int) -> None:
        heapq.heappush(self.held, (key, leaves, saved))
        if len(self.held) > self.room:
            self.held.sort()
            half = len(self.held) // 2
            self._open(self._written(self.held[half:]))
            del self.held[half:]

    def _written(self, messages: list) -> Iterator[tuple]:
        with tempfile.TemporaryFile() as f:
            for i in range(0, len(messages), 4096):
                pickle.dump(messages[i:i + 4096], f)
            size = f.tell()
            f.seek(0)
            del messages
            yield None
            while f.tell() < size:
                yield from pickle.load(f)

    def _open(self, messages: Iterator[tuple]) -> None:
        next(messages)
        self.made += 1
        heapq.heappush(self.files, (next(messages), self.made, messages))

    def take(self, key: tuple) -> tuple[int, int]:
        """The sum of all messages to ``key``."""
        leaves = saved = 0
        while self.held and self.held[0][0] == key:
            _, a, b = heapq.heappop(self.held)
            leaves, saved = leaves + a, saved + b
        while self.files and self.files[0][0][0] == key:
            (_, a, b), made, messages = self.files[0]
            leaves, saved = leaves + a, saved + b
            following = next(messages, None)
            if following is None:
                heapq.heappop(self.files)
            else:
                heapq.heapreplace(self.files, (following, made, messages))
        return leaves, saved


SHARD_ROWS = ["srep", "sn", "bottom", "rep", "n", "top", "prep", "pn", "leaves", "saved"]


def forward(rows: Iterator[tuple], room: int = QUEUE_MESSAGES) -> Iterator[tuple]:
    """Runs (as SHARD_ROWS), by shard and lowest level first -> (rep, n, leaves,
    saved, prep, pn) with the totals of their subtrees. ``leaves`` and ``saved``
    come in with what the run has itself and from earlier rounds."""
    shard, queue = None, MessageQueue(room)
    for srep, sn, bottom, rep, n, top, prep, pn, leaves, saved in rows:
        if shard != (srep, sn):
            shard, queue = (srep, sn), MessageQueue(room)
        more = queue.take((-bottom, rep, n))
        leaves, saved = leaves + more[0], saved + more[1]
        if (rep, n) != shard:
            queue.push((1 - top, prep, pn), leaves, saved)     # a parent ends a level above
        yield rep, n, leaves, saved, prep, pn


def _within_shards(runs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.worker_cache("trie", dict)
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for r in forward(rows):
            out.append(r)
            if len(out) == 8192:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                          ["rep", "n", "leaves", "saved", "prep", "pn"])

    return (runs.repartition("srep", "sn").sortWithinPartitions("srep", "sn", F.desc("bottom"), "rep", "n")
            .select(*SHARD_ROWS).mapInArrow(run, "rep bigint, n bigint, leaves bigint, saved bigint, prep bigint, pn bigint"))


def subtree_totals(runs: DataFrame, path: DataFrame, root: tuple[int, int], shard: int = SHARD, fan: int = FAN) -> DataFrame:
    """(rep, n, leaves, saved) of each run's subtree. ``path``: (conv, rep, n) of
    all nodes below the root; ``root``: the name and members of the root's run."""
    bounds = [shard]
    while bounds[-1] < root[1]:
        bounds.append(bounds[-1] * fan)
    # the highest run of at most so many members above each conversation's end
    tops = path.groupBy("conv").agg(*[
        F.max(F.when(F.col("n") <= most, F.struct("n", "rep"))).alias(f"top{j}") for j, most in enumerate(bounds[:-1])],
        F.count("*").alias("_rows"))
    placed = runs.join(tops.withColumnRenamed("conv", "rep"), "rep", "left")
    totals, least = None, 0
    for j, most in enumerate(bounds):
        level = (F.col("n") > least) & (F.col("n") <= most)
        mine = placed.where(level)
        if most >= root[1]:
            mine = mine.withColumn("srep", F.lit(root[0])).withColumn("sn", F.lit(root[1]))
        else:
            mine = mine.withColumn("srep", F.col(f"top{j}.rep")).withColumn("sn", F.col(f"top{j}.n"))
        if totals is not None:
            into = totals.where((F.col("pn") > least) & (F.col("pn") <= most)).groupBy(
                F.col("prep").alias("rep"), F.col("pn").alias("n")).agg(
                F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
            mine = mine.join(into, ["rep", "n"], "left").withColumn(
                "leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).withColumn(
                "saved", F.col("saved") + F.coalesce("more_saved", F.lit(0)))
        done = common.materialise(_within_shards(mine), "trie-totals")
        totals = done if totals is None else totals.unionByName(done)
        least = most
    return totals.select("rep", "n", "leaves", "saved")


# ---- ids that end at a node --------------------------------------------------
def ends_digests(ends: DataFrame, id_chars: int = ID_CHARS) -> DataFrame:
    """(rep, depth, conv) -> (rep, depth, ends_sha256) of the ids in ascending
    order, joined by commas. Ids become long strings where a range partition
    holds them; only these are gathered, and each node's are read one by one."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.worker_cache("trie", dict)
        key, first, ids, size, out = None, 0, [], 0, []
        for b in batches:
            for rep, depth, conv in zip(*(c.to_pylist() for c in b.columns)):
                if key != (rep, depth) or size > id_chars:
                    if ids:
                        out.append((*key, first, ",".join(ids)))
                    key, first, ids, size = (rep, depth), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield table(out, "ids", pa.string(), True)
                out = []
        if ids:
            yield table([(*key, first, ",".join(ids))], "ids", pa.string(), True)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for b in batches:
            for rep, depth, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if key != (rep, depth):
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (rep, depth), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_py().encode())
            if out:
                yield table(out, "ends_sha256", pa.string(), False)
                out = []
        if key:
            yield table([(*key, sha.hexdigest())], "ends_sha256", pa.string(), False)

    def table(rows: list[tuple], name: str, kind: pa.DataType, first: bool) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], kind)],
            ["rep", "depth", *["first"] * first, name])

    strings = ends.repartitionByRange("rep", "depth", "conv").sortWithinPartitions("rep", "depth", "conv").select(
        "rep", "depth", "conv").mapInArrow(join, "rep bigint, depth bigint, first bigint, ids string")
    return strings.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first").mapInArrow(
        digest, "rep bigint, depth bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", block: int = BLOCK, shard: int = SHARD,
                fan: int = FAN) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    common.ship(spark)
    turns = common.materialise(numbered_turns(conversations, id_col), "trie-turns")
    convs, rows = rebuilt(turns)
    signed = common.materialise(prefixes(rows, block), "trie-signed")
    n_convs, least = convs.agg(F.count("*"), F.min("conv")).first()
    if not n_convs:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                         "n_leaves long, saved_tokens long, ends_sha256 string")
    groups = common.materialise(signed.groupBy("depth", "s1", "s2").agg(
        F.count("*").alias("n"), F.min("conv").alias("rep")), "trie-groups")
    path = common.materialise(common.join_groups(signed, groups, ["depth", "s1", "s2"], "n", signed.count()).select(
        "conv", "depth", "n_turns", "rep", "n", "chars", "cum"), "trie-path")

    above = path.select(F.col("conv").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("rep").alias("prep"),
                        F.col("n").alias("pn"))
    own = path.where("conv = rep").select("rep", "depth", "n", "chars", "cum")
    deeper = own.where("depth > 1").join(above, ["rep", "depth"])
    top = own.where("depth = 1").withColumn("prep", F.lit(least)).withColumn("pn", F.lit(n_convs))
    root = spark.range(1).select(
        F.lit(least).alias("rep"), F.lit(0).cast("long").alias("depth"), F.lit(n_convs).alias("n"),
        *[F.lit(0).cast("long").alias(c) for c in ("chars", "cum")], *[F.lit(None).cast("long").alias(c) for c in ("prep", "pn")])
    nodes = common.materialise(deeper.unionByName(top).unionByName(root), "trie-nodes")

    runs = common.materialise(nodes.groupBy("rep", "n").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max("cum").alias("end"),
        F.sum("chars").alias("chars"), F.min_by(F.struct("prep", "pn"), "depth").alias("p"), F.count("*").alias("size")).select(
        "rep", "n", "top", "bottom", "end", "size", "p.prep", "p.pn", ((F.col("n") - 1) * F.col("chars")).alias("saved")),
        "trie-runs")
    below = runs.where("prep is not null").groupBy(F.col("prep").alias("rep"), F.col("pn").alias("n")).agg(
        F.count("*").alias("kids"))
    runs = common.materialise(runs.join(below, ["rep", "n"], "left").withColumn(
        "kids", F.coalesce("kids", F.lit(0))).withColumn("leaves", (F.col("kids") == 0).cast("long")), "trie-runs")
    totals = subtree_totals(runs, path, (least, n_convs), shard, fan)
    summed = common.materialise(runs.select("rep", "n", "bottom", "end", "size", "kids", F.col("saved").alias("own")).join(
        totals, ["rep", "n"]), "trie-summed")

    # only the ids that end below the root come from paths; turnless ones end at it
    ends = path.where("depth = n_turns").select("rep", "depth", "conv").unionByName(convs.where("n_turns = 0").select(
        F.lit(least).alias("rep"), F.lit(0).cast("long").alias("depth"), "conv"))
    digests = ends_digests(ends)
    placed = common.join_groups(nodes, summed, ["rep", "n"], "size", nodes.count())
    return placed.join(digests, ["rep", "depth"], "left").select(
        F.col("rep").alias("conv_id"), "depth", F.col("prep").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(F.col("depth") == F.col("bottom"), F.col("kids")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - F.col("own") + (F.col("n") - 1) * (F.col("end") - F.col("cum") + F.col("chars"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(common.table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS id FROM t),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS lead, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(id[i]) AS BIGINT))),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
  FROM ids),
said AS (
  SELECT c.conv_id, 0 AS part, t.* EXCLUDE (conv_id) FROM c JOIN t ON t.conv_id = c.lead AND t.pos <= c.h UNION ALL
  SELECT c.conv_id, 1 AS part, t.* EXCLUDE (conv_id) FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
deep AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM said),
path AS (
  SELECT conv_id, depth, length(text) AS chars, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS so_far
  FROM deep UNION ALL
  SELECT conv_id, 0, 0, list_slice([{'r': '', 't': ''}], 1, 0) FROM c),
last AS (SELECT conv_id, max(depth) AS n_turns FROM path GROUP BY conv_id),
node AS (
  SELECT so_far, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = n_turns) AS ended
  FROM path JOIN last USING (conv_id) GROUP BY so_far),
kids AS (SELECT list_slice(so_far, 1, depth - 1) AS so_far, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(n, 0) AS n_children FROM node LEFT JOIN kids ON kids.so_far = node.so_far),
totals AS (
  SELECT up.so_far, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved
  FROM full_node u JOIN path up ON up.conv_id = u.conv_id AND up.depth <= u.depth GROUP BY up.so_far)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs,
       CAST(v.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(v.ended, '')) AS ends_sha256
FROM full_node v JOIN totals ON totals.so_far = v.so_far
LEFT JOIN node p ON v.depth > 0 AND p.so_far = list_slice(v.so_far, 1, v.depth - 1)
"""
