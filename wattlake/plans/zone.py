"""Zone quality in the jobs (S8): what a day's landing may add to bronze.

Of the landing lines, those with values that do not parse, shifted columns or an
id that the zone has already go to the day's quarantine, whole and with a reason;
bronze gets the others. Of most lines the id decides alone: only ids are shuffled
to find those in question, given twice or accepted on another day. The lines of
these are kept apart and compared whole; all others go to bronze unshuffled. Ids are unique over all days of a delta landing: an index
of accepted ids, a table bucketed by id with a partition a day, is anti-joined by
every intake. The index is never shuffled, only the day's new ids are; and since
each day has a partition of its own, a day that is written again first gives
back its ids.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.config import PARQUET_CODEC, LakeConfig
from wattlake.operators import quality
from wattlake.schemas import QUARANTINE
from wattlake.session import remove_path
from wattlake.sources.catalog import ensure_database

QUARANTINE_DATASET = "cuarentena"

# Fixed value: so many ids in question, 8 bytes each, are sent to every executor;
# more of them meet the lines in a shuffled join.
SENT_IDS = 2_000_000


# ---- index of accepted ids ----------------------------------------------------
def index_table(cfg: LakeConfig) -> str:
    return f"{cfg.bronze_db}.ids_aceptados"


def create_index(spark: SparkSession, cfg: LakeConfig) -> None:
    ensure_database(spark, cfg.bronze_db, cfg.catalog_location(cfg.bronze_db))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {index_table(cfg)} (id_transaccion STRING, dia DATE) USING PARQUET "
              f"OPTIONS (compression '{PARQUET_CODEC}') PARTITIONED BY (dia) CLUSTERED BY (id_transaccion) INTO {cfg.index_buckets} BUCKETS "
              f"LOCATION '{cfg.bronze}/_ids_aceptados'")


def _met(spark: SparkSession, cfg: LakeConfig, rows: DataFrame, day: _dt.date, how: str) -> DataFrame:
    """Rows joined with the ids of all other days (``_other``). The rows are dealt
    as the index is, which then is read bucket by bucket."""
    other = spark.table(index_table(cfg)).where(F.col("dia") != F.lit(day)).select("id_transaccion", F.lit(True).alias("_other"))
    return rows.repartition(cfg.index_buckets, "id_transaccion").join(other, "id_transaccion", how)


def unseen(spark: SparkSession, cfg: LakeConfig, rows: DataFrame, day: _dt.date) -> DataFrame:
    """Rows whose id no other day has."""
    return _met(spark, cfg, rows, day, "left_anti")


def record(spark: SparkSession, cfg: LakeConfig, ids: DataFrame, day: _dt.date) -> None:
    """These are the accepted ids of ``day``: one file a bucket."""
    spark.sql(f"INSERT OVERWRITE TABLE {index_table(cfg)} PARTITION (dia = DATE '{day.isoformat()}') "
              "SELECT id_transaccion FROM {ids}", ids=ids.select("id_transaccion").repartition(cfg.index_buckets, "id_transaccion"))


# ---- ids in question ------------------------------------------------------------
def in_question(spark: SparkSession, cfg: LakeConfig, valid: DataFrame, day: _dt.date) -> DataFrame:
    """Hashes (``_h``, once each) of the ids that several ``valid`` lines have, or
    that another day has accepted. Nothing but ids is shuffled, and of the index
    nothing; ids that share a hash are both in question, which costs only time."""
    ids = valid.groupBy("id_transaccion").agg(F.count(F.lit(1)).alias("_n"))
    if cfg.is_snapshot:
        found = ids.where("_n > 1")
    else:
        found = _met(spark, cfg, ids, day, "left").where(F.col("_other") | (F.col("_n") > 1))
    return found.select(F.xxhash64("id_transaccion").alias("_h")).distinct()


def set_apart(spark: SparkSession, cfg: LakeConfig, lines: DataFrame, day: _dt.date, folder: str) -> tuple[DataFrame, DataFrame]:
    """(lines that are accepted whatever the others are, the other lines with an
    id). The second are written to ``folder``, as they are read several times."""
    lines = lines.where(F.col("id_transaccion").isNotNull())
    clean = quality.transaction_reason().isNull()
    in_question(spark, cfg, lines.where(clean), day).write.mode("overwrite").parquet(f"{folder}/ids", compression=PARQUET_CODEC)
    held = spark.read.parquet(f"{folder}/ids")
    few = held.count() <= SENT_IDS
    held = held.withColumn("_held", F.lit(True))
    tagged = lines.withColumn("_h", F.xxhash64("id_transaccion")).join(F.broadcast(held) if few else held, "_h", "left")
    sure = clean & F.col("_held").isNull()
    tagged.where(~sure).select(*lines.columns).write.mode("overwrite").parquet(f"{folder}/lines", compression=PARQUET_CODEC)
    return tagged.where(sure).select(*lines.columns), spark.read.schema(lines.schema).parquet(f"{folder}/lines")


# ---- intake ---------------------------------------------------------------------
def validated(spark: SparkSession, cfg: LakeConfig, lines: DataFrame, day: _dt.date,
              write) -> list[str]:
    """Validate the landing ``lines`` of ``day`` and hand the datasets to
    ``write(name, frame)``: transactions, providers, quarantine. ``lines`` is read
    several times, so it should be a written table."""
    lines = quality.whole_lines(lines)
    if not cfg.is_snapshot:
        create_index(spark, cfg)
    folder = f"{cfg.bronze}/_staging/in_question/run_date={day.isoformat()}"
    try:
        return _validated(spark, cfg, lines, day, write, folder)
    finally:
        remove_path(spark, folder)


def _validated(spark: SparkSession, cfg: LakeConfig, lines: DataFrame, day: _dt.date, write, folder: str) -> list[str]:
    sure, rest = set_apart(spark, cfg, lines, day, folder)
    accepted, wrong = quality.split_lines(rest)
    providers, wrong_providers = quality.split_provider_lines(lines)
    quarantine = wrong.unionByName(wrong_providers)
    if cfg.is_snapshot:          # every day has all lines again: unique within the day
        write("transacciones", quality.typed_transactions(sure.unionByName(accepted)))
    else:
        fresh = unseen(spark, cfg, accepted, day)
        write("transacciones", quality.typed_transactions(sure.unionByName(fresh)))
        quarantine = quarantine.unionByName(quality.rejected(
            _met(spark, cfg, accepted, day, "left_semi"), "transacciones", quality.REASON_ACCEPTED_BEFORE))
    write("proveedores", providers)
    write(QUARANTINE_DATASET, quarantine.select(*QUARANTINE.names))
    return ["transacciones", "proveedores", QUARANTINE_DATASET]
