"""User-event stream: source, profile enrichment, scoring, alert threshold,
archive and dual sinks, nested-payload flattening (S1-S7).

The enrichment + scoring + threshold chain is expressed with built-in column
expressions, so the same function runs as a stream (``readStream``) and as a
batch over the stored events (the registered query), and both give the same
rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StructType

from wattlake.schemas import EVENT_PROPS, EVENTS

# The recommendation actions a score maps to.
ACTION_BUY, ACTION_SELL, ACTION_NONE = "COMPRAR", "VENDER", "NADA"

FILES_PER_TRIGGER = 1000      # bound of a micro-batch
ARCHIVE_FILES_PER_DATE = 8    # of a micro-batch


# ---- S1 source ------------------------------------------------------------
def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Events as an unbounded stream from a folder of Parquet files (or a
    glob).  A single ``.parquet`` file is turned into a glob matching it,
    since the file source lists a folder or a pattern."""
    if path.endswith(".parquet"):
        path = path + "*"
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


# ---- S2 enrichment ----------------------------------------------------------
def user_profiles(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Profile (name, segment, balance) plus portfolio (order count, spend in
    whole units) per user.  The order rollup is a partial aggregate, so a user
    with a third of all orders is pre-reduced on every mapper."""
    portfolio = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 0).cast("bigint")
         .alias("spent_units"))
    return (customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
            .join(portfolio, customer.c_custkey == portfolio.o_custkey, "left")
            .select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment", "c_acctbal",
                    F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                    F.coalesce("spent_units", F.lit(0)).cast("bigint").alias("spent_units")))


def materialize_profiles(profiles: DataFrame, path: str) -> DataFrame:
    """Write the profile table once and return a frame reading it back.

    A stream-static join re-executes the static side's plan in every
    micro-batch; joining against the written table instead costs one scan
    of a keyed table per batch rather than a rollup of all orders, and cuts
    the lineage at a file in the shared lake folder."""
    profiles.write.mode("overwrite").parquet(path)
    return profiles.sparkSession.read.parquet(path)


def enrich_events(events: DataFrame, profiles: DataFrame, salt_buckets: int = 1) -> DataFrame:
    """Left join of each event to its user's profile (stream-static join when
    ``events`` is streaming).  Unknown users keep NULL profile fields.

    ``salt_buckets > 1`` splits a hot user across that many join partitions:
    each event gets a salt derived from its ``event_id`` (deterministic, so a
    retried task reproduces it) and every profile row is replicated once per
    salt.  The profile side grows ``salt_buckets``-fold in exchange.  On Spark
    4.1 AQE also splits skewed joins in streams, so this is for sessions that
    run without it."""
    if salt_buckets <= 1:
        return events.join(profiles, "user_id", "left")
    salted_events = events.withColumn("_salt", F.pmod(F.xxhash64("event_id"), F.lit(salt_buckets)))
    salted_profiles = profiles.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
    return salted_events.join(salted_profiles, ["user_id", "_salt"], "left").drop("_salt")


# ---- S3 scoring -------------------------------------------------------------
def model_scorer(predict, features: list[str]):
    """Wrap a trained model's ``predict(pandas.DataFrame) -> pandas.Series``
    as an Arrow-batched pandas UDF over ``features``; returns the score
    Column to pass to :func:`score_events`.  Batches of rows cross to Python
    together (never one row at a time); use it only when the model cannot be
    written as column expressions."""
    @F.pandas_udf("double")
    def _score(frame: pd.DataFrame) -> pd.Series:   # one struct column -> a frame per batch
        return pd.Series(predict(frame[features]), dtype="float64").reset_index(drop=True)

    return _score(F.struct(*[F.col(c) for c in features]))


def score_events(enriched: DataFrame, score: Column, threshold: float) -> DataFrame:
    """Adds ``score`` (any Column over the enriched event, e.g. from
    :func:`model_scorer`) and ``action``: buy for users in credit, sell for
    users in debt, nothing at or below the threshold."""
    scored = enriched.withColumn("score", score)
    action = (F.when(F.col("score") <= F.lit(threshold), ACTION_NONE)
              .when(F.coalesce(F.col("c_acctbal"), F.lit(0.0)) >= 0, ACTION_BUY)
              .otherwise(ACTION_SELL))
    return scored.withColumn("action", action)


# ---- S4 threshold -------------------------------------------------------------
def alerts(scored: DataFrame, threshold: float) -> DataFrame:
    """Events whose score exceeds the threshold (``score > umbral``)."""
    return scored.where(F.col("score") > F.lit(threshold))


ALERT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "c_name", "c_mktsegment",
                 "n_orders", "score", "action"]


def enriched_alerts(events: DataFrame, profiles: DataFrame, score: Column, threshold: float,
                    salt_buckets: int = 1) -> DataFrame:
    """S2 -> S3 -> S4 in one chain."""
    scored = score_events(enrich_events(events, profiles, salt_buckets), score, threshold)
    return alerts(scored, threshold).select(*ALERT_COLUMNS)


# ---- S7 flattening ------------------------------------------------------------
def parse_props(events: DataFrame, schema: StructType = EVENT_PROPS) -> DataFrame:
    """JSON payload text -> struct column ``props`` (malformed -> NULL fields)."""
    return events.withColumn("props", F.from_json("props", schema))


def flatten(df: DataFrame, sep: str = "_", explode_arrays: bool = False) -> DataFrame:
    """Expand nested struct columns into top-level ``parent_child`` columns,
    level by level; optionally explode arrays (one row per element, empty or
    NULL arrays keep the row).  Only the schema is inspected on the driver."""
    while True:
        fields = df.schema.fields
        nested = [f for f in fields if isinstance(f.dataType, StructType)]
        arrays = [f for f in fields if isinstance(f.dataType, ArrayType)] if explode_arrays else []
        if not nested and not arrays:
            return df
        if arrays:
            df = df.withColumn(arrays[0].name, F.explode_outer(arrays[0].name))
            continue
        cols = []
        for f in fields:
            if isinstance(f.dataType, StructType):
                cols += [F.col(f"`{f.name}`.`{c.name}`").alias(f"{f.name}{sep}{c.name}")
                         for c in f.dataType.fields]
            else:
                cols.append(F.col(f"`{f.name}`"))
        df = df.select(*cols)


def flatten_events(events: DataFrame) -> DataFrame:
    return flatten(parse_props(events))


# ---- S5 archive, S6 dual sink -----------------------------------------------------
def archive_events(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                   files_per_date: int = ARCHIVE_FILES_PER_DATE) -> StreamingQuery:
    """Every raw event, as Parquet partitioned by event date (exactly-once
    file sink). Events are first brought together by date, each date dealt to
    ``files_per_date`` tasks by event id, so a micro-batch adds at most so many
    files to a date and a busy date is not written by one task."""
    dated = stream.withColumn("event_date", F.to_date("ts"))
    dealt = dated.repartition(F.col("event_date"), F.pmod(F.xxhash64("event_id"), F.lit(files_per_date)))
    w = (dealt.writeStream.format("parquet")
         .partitionBy("event_date").option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path)


def dual_sink_writer(flat_path: str, ops_path: str, profiles: DataFrame, score: Column, threshold: float):
    """``foreachBatch`` function writing each micro-batch twice: a flat
    feature set (for model training) and the relational alert rows (for
    operations).  Events are enriched once, into the flat set; the alerts are
    derived from what was written.  Each write overwrites only its ``batch_id``
    partition, so a replayed batch replaces its own output instead of
    duplicating it."""

    def put(df: DataFrame, path: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("batch_id").parquet(path))

    def write(batch: DataFrame, batch_id: int) -> None:
        flat = flatten_events(enrich_events(batch, profiles)).withColumn("batch_id", F.lit(batch_id))
        put(flat, flat_path)
        written = batch.sparkSession.read.schema(flat.schema).parquet(flat_path).where(F.col("batch_id") == batch_id)
        ops = alerts(score_events(written, score, threshold), threshold).select(*ALERT_COLUMNS, "batch_id")
        put(ops, ops_path)

    return write


def start_dual_sink(stream: DataFrame, flat_path: str, ops_path: str, profiles: DataFrame,
                    checkpoint: str, score: Column, threshold: float, trigger: dict | None = None) -> StreamingQuery:
    w = (stream.writeStream.foreachBatch(dual_sink_writer(flat_path, ops_path, profiles, score, threshold))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()
