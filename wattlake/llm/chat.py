"""Chat formatting: collapse of cumulative snapshots, then rendering.

Loggers often store a conversation after each turn, so shorter records are
prefixes of a longer one. Every turn gets the signature of the prefix that ends
with it: the sum, so far, of two 64-bit hashes of (position, role, text). A
conversation whose whole signature is that of a proper prefix elsewhere is a
snapshot; an anti-join on (length, signature) retains the maximal ones, and of
equal ones that with the smallest id. Only these are rendered.

Sums can be added up from parts: turns are numbered and summed within blocks of
turn numbers, and blocks within their conversation, so a conversation that
holds a third of all rows is not handled by one task. Both sides of the
anti-join are distinct, so common first turns meet once. Text moves once, and
only for conversations that stay.

Defined results: turns are ordered by number (null first), then by hash; rows
that repeat conversation, turn, role and text count once; null role or text
is empty; rows with null conversation ids form one conversation (last among equals); long
conversations are rendered in parts, one for each block of turn numbers; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wattlake.llm import common

BLOCK_TURNS = 256
#: The rendered form of a turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"


def _turns(conversations: DataFrame, id_col: str, block_turns: int) -> DataFrame:
    """Turns with a never-null conversation key (no_id, id) and their block."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    kind = conversations.schema[id_col].dataType
    nothing = F.lit("" if isinstance(kind, StringType) else 0).cast(kind)
    return conversations.select(
        F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col), nothing).alias("id"), "turn",
        role.alias("role"), text.alias("text"),
        F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 40))).cast("long").alias("block"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(text, F.lit("\x1f"), role).alias("h2"))


CONVERSATION = ["no_id", "id"]
BLOCK = [*CONVERSATION, "block"]


def prefixes(conversations: DataFrame, id_col: str = "conv_id", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per turn: no_id, id, block, k (its position from 1), n (turns of the
    conversation) and the prefix signature (s1, s2). Turns are dealt once, by
    block of a conversation; numbering, sums and joins stay within that."""
    exact = "decimal(38,0)"
    turns = _turns(conversations, id_col, block_turns).select(*BLOCK, "turn", "h1", "h2").repartition(*BLOCK).distinct()
    by_block = Window.partitionBy(*CONVERSATION).orderBy("block")
    place = turns.groupBy(*BLOCK).agg(F.count("*").alias("size")).select(
        *BLOCK, (F.sum("size").over(by_block) - F.col("size")).alias("before"),
        F.sum("size").over(Window.partitionBy(*CONVERSATION)).alias("n"))
    nth = F.row_number().over(Window.partitionBy(*BLOCK).orderBy("turn", "h1", "h2"))
    numbered = turns.withColumn("nth", nth).join(place, BLOCK).withColumn("k", F.col("before") + F.col("nth")).select(
        *BLOCK, "n", "k", F.xxhash64("k", "h1", "h2").cast(exact).alias("g1"),
        F.xxhash64("h2", "k", "h1").cast(exact).alias("g2"))
    sums = numbered.groupBy(*BLOCK).agg(F.sum("g1").alias("t1"), F.sum("g2").alias("t2")).select(
        *BLOCK, *[(F.sum(t).over(by_block) - F.col(t)).alias(t) for t in ("t1", "t2")])
    so_far = Window.partitionBy(*BLOCK).orderBy("k")
    running = numbered.select(*BLOCK, "n", "k", *[F.sum(g).over(so_far).alias(g) for g in ("g1", "g2")])
    return running.join(sums, BLOCK).select(
        *BLOCK, "k", "n", (F.col("g1") + F.col("t1")).cast(exact).alias("s1"),
        (F.col("g2") + F.col("t2")).cast(exact).alias("s2"))


def maximal(all_prefixes: DataFrame) -> DataFrame:
    """(no_id, id, n_turns, copies) of the conversations that are no proper
    prefix of another, one for each group of equal ones."""
    whole = all_prefixes.where("k = n").groupBy("k", "s1", "s2").agg(
        F.min(F.struct(*CONVERSATION)).alias("first"), F.count("*").alias("copies"))
    proper = all_prefixes.where("k < n").select("k", "s1", "s2").distinct()
    return whole.join(proper, ["k", "s1", "s2"], "left_anti").select(
        "first.no_id", "first.id", F.col("k").cast("long").alias("n_turns"), "copies")


def render(conversations: DataFrame, id_col: str = "conv_id", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per part of each maximal conversation: id, part (from 0),
    n_turns and copies of the conversation, rendered. Turn marks within a text
    are broken up."""
    all_prefixes = common.materialise(prefixes(conversations, id_col, block_turns), "chat-prefixes")
    part = F.row_number().over(Window.partitionBy(*CONVERSATION).orderBy("block")) - 1
    chosen = common.materialise(all_prefixes.select(*BLOCK).distinct().join(
        maximal(all_prefixes), CONVERSATION).withColumn("part", part.cast("int")), "chat-maximal")
    plain = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    kept = _turns(conversations, id_col, block_turns).join(chosen, BLOCK).select(
        *BLOCK, "part", "n_turns", "copies", "turn", "h1", "h2",
        F.concat(F.lit(TURN_START), plain("role"), F.lit("\n"), plain("text"), F.lit(TURN_END)).alias("one"))
    grouped = kept.groupBy(*BLOCK).agg(
        F.first("part").alias("part"), F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"),
        F.sort_array(F.collect_set(F.struct("turn", "h1", "h2", "one"))).alias("turns"))
    return grouped.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "part", "n_turns", "copies",
                          F.array_join("turns.one", "").alias("rendered"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(common.table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
convs AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role, text) AS said, count(*) AS n_turns
  FROM turns GROUP BY conv_id),
single AS (
  SELECT min(conv_id) AS conv_id, said, n_turns, count(*) AS copies FROM convs GROUP BY said, n_turns),
chosen AS (
  SELECT * FROM single a WHERE NOT EXISTS (
    SELECT 1 FROM single b WHERE b.said[1] = a.said[1] AND b.n_turns > a.n_turns
      AND list_slice(b.said, 1, a.n_turns) = a.said))
SELECT c.conv_id, CAST(dense_rank() OVER (PARTITION BY c.conv_id ORDER BY t.turn // 256) - 1 AS INTEGER) AS part,
       any_value(n_turns) AS n_turns, any_value(copies) AS copies,
       string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
                  || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
FROM chosen c JOIN turns t ON t.conv_id = c.conv_id
GROUP BY c.conv_id, t.turn // 256
"""
