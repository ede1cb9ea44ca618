"""Landing intake with a ledger (A6): files not seen before, and files that were
written again under their name.

The ledger has a row a file: path, length, modification time and the day it came
in. An intake lists the landing (no file is opened), reads only files that the
ledger lacks or that differ from it, and keeps their lines, with the file they
come from, by the day the file first came in. A file that was written again is a
restatement: its lines replace the earlier ones of that file, and that day's
bronze datasets are derived again, which also takes gold snapshots made from them
out of use. The ledger is committed last, so an intake that fails is repeated
whole, and repeating it changes nothing. A file that left the landing keeps its
lines. Contents that change without a change of length or time are not noticed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.config import LakeConfig
from wattlake.functions import stamp
from wattlake.plans import jobs
from wattlake.schemas import CONTRATOS_COLUMNS, CONTRATOS_RAW
from wattlake.session import resolve_run_date
from wattlake.sinks import parquet as pq
from wattlake.sources import versions
from wattlake.sources.lake import read_partition
from wattlake.sources.landing import _is_missing_path, contract_paths, read_first_existing, risk_paths

LEDGER = "file string, path string, size bigint, modified timestamp, first_day date"


def ledger_path(cfg: LakeConfig) -> str:
    return f"{cfg.bronze}/_intake/ledger"


def lines_path(cfg: LakeConfig) -> str:
    return f"{cfg.bronze}/_intake/lines"


def landing_files(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """(file, path, size, modified) of the contract files, from their listing."""
    out = None
    for place in (contract_paths(cfg.landing)[0], contract_paths(cfg.landing)[1].rsplit("/", 1)[0]):
        try:
            found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").option(
                "recursiveFileLookup", True).load(place)
        except AnalysisException as exc:
            if not _is_missing_path(exc):
                raise
            continue
        found = found.select(F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("size"),
                             F.col("modificationTime").alias("modified"))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], LEDGER).drop("first_day")


def ledger(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """What has been taken in; of its committed versions the last one counts."""
    past = versions.history(spark, ledger_path(cfg))
    if not past:
        return spark.createDataFrame([], LEDGER)
    last = max(past, key=lambda v: (v.number, v.day))
    return versions.read(spark, ledger_path(cfg), [last]).select("file", "path", "size", "modified", "first_day")


def _commit_ledger(spark: SparkSession, cfg: LakeConfig, rows: DataFrame, run_date: _dt.date) -> None:
    past = versions.history(spark, ledger_path(cfg))
    version = versions.Version(run_date, max((v.number for v in past), default=0) + 1, "ledger", "files")
    rows.write.mode("overwrite").parquet(version.folder(ledger_path(cfg)))
    versions.commit(spark, ledger_path(cfg), version, rows.schema)


def ingest_bronze_ledger(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date | None = None) -> list[str]:
    """Take in new and rewritten contract files, derive the bronze days that they
    touch, and the risk table as in the batch form."""
    run_date = resolve_run_date(spark, run_date or cfg.run_date)
    known = ledger(spark, cfg).select("file", F.col("size").alias("_size"), F.col("modified").alias("_modified"), "first_day")
    files = landing_files(spark, cfg).join(known, "file", "left")
    same = F.col("size").eqNullSafe(F.col("_size")) & F.col(
        "modified").eqNullSafe(F.col("_modified"))
    changed = files.where(~same).select("file", "path", "size", "modified",
                                        F.coalesce("first_day", F.lit(run_date)).alias("first_day"))
    paths = changed.select("path", "first_day").collect()        # one row a new file
    written: list[str] = []
    for day in sorted({r["first_day"] for r in paths}):
        lines = (spark.read.schema(CONTRATOS_RAW).option("header", True).option("enforceSchema", False)
                 .csv([r["path"] for r in paths if r["first_day"] == day])
                 .select(*CONTRATOS_COLUMNS, F.col("_metadata.file_path").alias("file")))
        before = read_partition(spark, lines_path(cfg), day, optional=True)
        if before is not None and versions.current(spark, lines_path(cfg)).get(day):
            # as few as ``paths``: the lines stay where they are, whatever files they came from
            kept = before.join(F.broadcast(changed.select("file")), "file", "left_anti").select(*CONTRATOS_COLUMNS, "file")
            lines = lines.unionByName(kept)
        pq.write_day(stamp(lines, day), lines_path(cfg), day, keep=cfg.keep_versions)
        held = read_partition(spark, lines_path(cfg), day).select(*CONTRATOS_COLUMNS)
        written += [n for n in jobs.write_lines(spark, cfg, held, day) if n not in written]
    if paths:
        rest = ledger(spark, cfg).join(changed.select("file"), "file", "left_anti")
        _commit_ledger(spark, cfg, rest.unionByName(changed), run_date)
    return written + jobs.write_riesgos(cfg, read_first_existing(spark, risk_paths(cfg.landing)), run_date)
