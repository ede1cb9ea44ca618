"""Profiles as of the event (S2): each event gets the version of its user's
profile that was valid at its time.

Profile versions have a user, a time from which they hold, and any columns. Both
sides are cut into ranges of time; within a range, events and versions of a user
are put in order together, and the version carried in from earlier ranges is found
among the last versions of each range. So a busy user is split by time, and
nothing is expanded by the length of a version's validity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlake.sources.lake import read_dataset

RANGE_DAYS = 1


def _range(ts: str, days: int) -> Column:
    return F.floor(F.datediff(F.to_date(F.col(ts)), F.lit("1970-01-01").cast("date")) / days)


def asof_join(events: DataFrame, history: DataFrame, key: str = "user_id", ts: str = "ts",
              valid_from: str = "valid_from", range_days: int = RANGE_DAYS) -> DataFrame:
    """Every event with the columns of the last ``history`` row of its key whose
    ``valid_from`` is not later; NULL before the first. Of several versions with
    one time the greatest counts. Events without key or time get none."""
    columns = [c for c in history.columns if c != key]
    version = F.struct(*[F.col(c) for c in [valid_from, *(c for c in columns if c != valid_from)]])
    versions = history.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_k"), F.col(valid_from).alias("_t"), version.alias("_v"), _range(valid_from, range_days).alias("_r"))
    own = F.struct(*[F.col(f"`{c}`") for c in events.columns])
    dealt = events.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), own.alias("_e"), _range(ts, range_days).alias("_r"))

    # the last version of each range, carried to later ranges that have events
    last = versions.groupBy("_k", "_r").agg(F.max("_v").alias("_v"))
    ranges = dealt.groupBy("_k", "_r").agg(F.count(F.lit(1)).alias("_n")).select("_k", "_r")
    nothing = F.lit(None)
    earlier = Window.partitionBy("_k").orderBy("_r").rangeBetween(Window.unboundedPreceding, -1)
    marks = last.unionByName(ranges.withColumn("_v", nothing.cast(last.schema["_v"].dataType)))
    carried = marks.withColumn("_c", F.last("_v", ignorenulls=True).over(earlier)).groupBy("_k", "_r").agg(
        F.max("_c").alias("_c"))

    rows = versions.select("_k", "_r", "_t", "_v", nothing.cast(dealt.schema["_e"].dataType).alias("_e")).unionByName(
        dealt.select("_k", "_r", "_t", nothing.cast(last.schema["_v"].dataType).alias("_v"), "_e"))
    so_far = Window.partitionBy("_k", "_r").orderBy("_t", F.col("_e").isNotNull(), "_v").rowsBetween(
        Window.unboundedPreceding, 0)
    within = rows.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far)).where("_e is not null")
    found = within.alias("w").join(carried.alias("c"), (F.col("w._k") == F.col("c._k")) & (F.col("w._r") == F.col("c._r")), "left")
    return found.select("w._e.*", F.coalesce("w._v", "c._c").alias("_v")).select(
        *[F.col(f"`{c}`") for c in events.columns], *[F.col(f"_v.`{c}`") for c in columns])


def start_asof_sink(stream: DataFrame, history_root: str, out: str, checkpoint: str, drop=(),
                    trigger: dict | None = None) -> StreamingQuery:
    """Every event with its profile, written by micro-batch; each reads the
    profile versions committed by then, and a replayed batch replaces its rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        history = read_dataset(batch.sparkSession, history_root)
        history = history.drop(*[c for c in ("processed_date", "year", "month", "day", *drop) if c in history.columns])
        asof_join(batch, history).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
