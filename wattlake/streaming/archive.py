"""Event archive with upkeep (S5): batches of events by date, closed dates compacted.

A micro-batch goes to ``batches/event_date=/batch_id=`` and counts once its
marker stands, so a reader never sees half a batch and a replay replaces its own
rows. Each batch adds files to every date that it touches; ``compact`` brings the
batches of closed dates together in a few files sized by bytes, as a committed
version of the date (``sources.versions``) which says up to which batch it
goes. That entry is the swap: before it a reader takes the batches, after it the
version, and later batches of the date (late events) on top of it, until the
next ``compact`` takes them in. ``tidy`` removes what no reader needs any more.

An archive has one stream, with one checkpoint: batch numbers must not begin
again. Events without a time are kept with a null date, which is never closed.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from wattlake.schemas import EVENTS, PARTITION_COLUMNS
from wattlake.session import MB, remove_path
from wattlake.sources import versions
from wattlake.streaming.events import ARCHIVE_FILES_PER_DATE

FILE_BYTES = 128 * MB
DATE, BATCH = "event_date", "batch_id"
#: Of a version's inputs: the last batch that is in it.
THROUGH = "batches"


def _batches(root: str) -> str:
    return f"{root.rstrip('/')}/batches"


def _closed(root: str) -> str:
    return f"{root.rstrip('/')}/closed"


def _marker(root: str, batch: int) -> str:
    return f"{root.rstrip('/')}/finished/{batch:012d}"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = versions._fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def archive_writer(root: str, files_per_date: int = ARCHIVE_FILES_PER_DATE):
    """``foreachBatch`` function. A date's events are dealt to ``files_per_date``
    tasks by event id, so a busy date is not written by one."""
    def write(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn(DATE, F.to_date("ts")).withColumn(BATCH, F.lit(batch_id).cast("long"))
        (dated.repartition(F.col(DATE), F.pmod(F.xxhash64("event_id"), F.lit(files_per_date)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DATE, BATCH).parquet(_batches(root)))
        versions.write_text(batch.sparkSession, _marker(root, batch_id), "")

    return write


def start_archive(stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                  files_per_date: int = ARCHIVE_FILES_PER_DATE) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(archive_writer(root, files_per_date)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _last_finished(spark: SparkSession, root: str) -> int:
    return max((int(n) for n in _names(spark, f"{root.rstrip('/')}/finished") if n.isdigit()), default=-1)


def _folders(spark: SparkSession, root: str) -> dict[_dt.date | None, dict[int, str]]:
    """Date -> batch -> folder, of all that lies there: as many as were written
    since the last ``tidy``."""
    out: dict[_dt.date | None, dict[int, str]] = {}
    for name in _names(spark, _batches(root)):
        if name.startswith(f"{DATE}="):
            value, path = name.split("=", 1)[1], f"{_batches(root)}/{name}"
            day = None if value.startswith("__HIVE") else _dt.date.fromisoformat(value)
            out[day] = {int(n.split("=")[1]): f"{path}/{n}" for n in _names(spark, path) if n.startswith(f"{BATCH}=")}
    return out


def _standing(spark: SparkSession, root: str) -> tuple[int, dict, dict, dict]:
    """(last finished batch, date -> version, date -> its last batch, date -> batch
    -> folder of the finished batches that no version has). The marker is read
    before the folders and these before the versions, so whatever is written,
    committed or removed meanwhile, no event is missed or counted twice."""
    last = _last_finished(spark, root)
    there = _folders(spark, root)
    now = versions.current(spark, _closed(root))
    through = {d: versions.details(spark, _closed(root), now[d])["inputs"][THROUGH] for d in there if d in now}
    loose = {d: {b: p for b, p in found.items() if through.get(d, -1) < b <= last} for d, found in there.items()}
    return last, now, through, {d: found for d, found in loose.items() if found}


def _dated(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(DATE, DateType())])


def _loose_rows(spark: SparkSession, root: str, folders: list[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _dated(schema))
    own = StructType([*_dated(schema).fields, StructField(BATCH, LongType())])
    return spark.read.schema(own).option("basePath", _batches(root)).parquet(*folders).drop(BATCH)


def read_archive(spark: SparkSession, root: str, schema: StructType = EVENTS) -> DataFrame:
    """Every archived event once, with its date: the versions of closed dates and
    the batches that are in none. An archive without events is empty."""
    _, now, _, loose = _standing(spark, root)
    rows = _loose_rows(spark, root, [p for found in loose.values() for p in found.values()], schema)
    return versions.read(spark, _closed(root), list(now.values()), _dated(schema)).unionByName(rows) if now else rows


def compact(spark: SparkSession, root: str, before: _dt.date, schema: StructType = EVENTS,
            file_bytes: int = FILE_BYTES) -> list[_dt.date]:
    """Commit a version of every date before ``before`` that has batches in none,
    with one file for each ``file_bytes``; a date's former version goes into the
    new one. Dates with equally many versions before are written by one job, and
    each is committed for itself; what a lost run has written but not committed
    is never read. Returns the dates."""
    last, now, _, loose = _standing(spark, root)
    days = sorted(d for d in loose if d is not None and d < before)
    closed, written = _closed(root), _dated(schema)
    by_number: dict[int, list[_dt.date]] = {}
    for d in days:
        by_number.setdefault(now[d].number if d in now else 0, []).append(d)
    for some in by_number.values():
        former = [now[d] for d in some if d in now]
        rows = _loose_rows(spark, root, [p for d in some for p in loose[d].values()], schema)
        if former:
            rows = rows.unionByName(versions.read(spark, closed, former, written))
        sizes = {d: sum(_length(spark, p) for p in loose[d].values()) for d in some}
        for v in former:
            sizes[v.day] += _length(spark, v.folder(closed))
        made = {d: versions.following(now.get(d), d, written) for d in some}
        files = {d: max(1, math.ceil(sizes[d] / file_bytes)) for d in some}
        # a row for each date, to tell its files and its version's name
        plan = spark.createDataFrame([(d, files[d], made[d].name) for d in some],
                                     f"{DATE} date, _files long, {versions.VERSION} string")
        dealt = rows.join(plan, DATE).withColumn("_file", F.pmod(F.xxhash64("event_id"), F.col("_files")))
        parts = [F.year(DATE), F.month(DATE), F.dayofmonth(DATE)]
        (dealt.repartition(sum(files.values()), DATE, "_file")
         .select(*written.names, *[p.alias(c) for p, c in zip(parts, PARTITION_COLUMNS)], versions.VERSION)
         .write.mode("append").partitionBy(*PARTITION_COLUMNS, versions.VERSION).parquet(closed))
        for version in made.values():
            versions.commit(spark, closed, version, written, {THROUGH: last})
    return days


def _length(spark: SparkSession, path: str) -> int:
    fs, p = versions._fs(spark, path)
    return fs.getContentSummary(p).getLength()


def tidy(spark: SparkSession, root: str) -> int:
    """Remove batches that a version has, former versions and markers but the last.
    Run it when readers that began before the last ``compact`` are done: they
    fail on a folder that is gone. Returns the number of batch folders removed."""
    last, now, through, _ = _standing(spark, root)
    gone = [p for d, found in _folders(spark, root).items() if d in through
            for b, p in found.items() if b <= through[d]]
    for p in gone:
        remove_path(spark, p)
    versions.expire(spark, _closed(root))
    for n in _names(spark, f"{root.rstrip('/')}/finished"):
        if n.isdigit() and int(n) < last:
            remove_path(spark, _marker(root, int(n)))
    return len(gone)
