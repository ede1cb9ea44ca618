"""Incremental landing intake (A6): only contract files not seen before are
ingested; the risk table, a small snapshot, is ingested as in the batch form.

A Structured Streaming file source over the landing contract files, run with
``trigger(availableNow=True)``: each run processes every file that arrived
since the last run, a bounded number at a time, and stops.  Each micro-batch is
parsed once and kept as typed-by-name text in the intake table, in a folder of
its batch id that a replay overwrites, so retries, executor loss and driver
restarts neither lose nor repeat a line.  The day's bronze partitions are then
split from the intake rows of the day, and replace what an earlier attempt of
the same day has written.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlake.config import LakeConfig
from wattlake.plans import jobs
from wattlake.schemas import CONTRATOS_RAW
from wattlake.session import resolve_run_date
from wattlake.sources.lake import read_dataset
from wattlake.sources.landing import read_first_existing, risk_paths

FILES_PER_TRIGGER = 1000


def intake_path(cfg: LakeConfig) -> str:
    return f"{cfg.bronze}/_intake/contratos"


def start_intake(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date, source_dir: str | None = None,
                 max_files_per_trigger: int = FILES_PER_TRIGGER) -> StreamingQuery:
    """New contract files -> intake rows with the date they came in. The same
    places are looked at as in the batch form, each a file or a folder."""
    source = source_dir or f"{cfg.landing}/{{contratos.csv,contratos}}"
    contratos = (spark.readStream.schema(CONTRATOS_RAW).option("header", True).option("enforceSchema", False)
                 .option("maxFilesPerTrigger", max_files_per_trigger).csv(source))

    def keep(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("intake_date", F.lit(run_date)).write.mode("overwrite")
         .parquet(f"{intake_path(cfg)}/batch_id={batch_id}"))

    return (contratos.writeStream.foreachBatch(keep).queryName("incremental_bronze")
            .option("checkpointLocation", f"{cfg.checkpoints}/incremental_bronze")
            .trigger(availableNow=True).start())


def ingest_bronze_incremental(spark: SparkSession, cfg: LakeConfig, source_dir: str | None = None,
                              run_date: _dt.date | None = None,
                              max_files_per_trigger: int = FILES_PER_TRIGGER) -> list[str]:
    """Run the intake until all currently available files are processed, then
    write the day's bronze partitions."""
    run_date = resolve_run_date(spark, run_date or cfg.run_date)
    q = start_intake(spark, cfg, run_date, source_dir, max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"{q.name} failed: {q.exception()}")
    written = []
    kept = read_dataset(spark, intake_path(cfg), optional=True)
    if kept is not None:
        today = kept.where(F.col("intake_date") == F.lit(run_date)).select(*CONTRATOS_RAW.names)
        written += jobs.write_lines(spark, cfg, today, run_date)
    return written + jobs.write_riesgos(cfg, read_first_existing(spark, risk_paths(cfg.landing)), run_date)
