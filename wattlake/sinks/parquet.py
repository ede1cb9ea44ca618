"""Parquet dataset sinks (B1 by day and partitioned, B2 full overwrite).

``write_day``, which the jobs use, writes a day to a folder of its own and then
commits it (``sources.versions``): a rerun replaces exactly that day, also by
nothing, and readers see the old rows or the new ones. ``mode="append"``
reproduces the original append behaviour.

``write_partitioned`` is plain dynamic partition overwrite: it replaces the
partitions that the written rows name, so days without rows stay as they were.

No repartition by the partition columns is done before writing: a run writes a
single ``run_date`` partition, and shuffling on it would funnel the whole run
through one task.  Each task writes its own file into the partition instead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from wattlake.config import APPEND, OVERWRITE_PARTITIONS, PARQUET_OPTIONS
from wattlake.schemas import PARTITION_COLUMNS
from wattlake.sources import versions


def write_day(df: DataFrame, root: str, day: _dt.date, mode: str = OVERWRITE_PARTITIONS,
              inputs: dict | None = None, keep: int | None = None) -> versions.Version:
    """Replace ``day`` of the dataset by ``df`` in one step. ``inputs``: the
    versions of other datasets that the rows were made from, by dataset. ``keep``:
    so many versions of the day stay; None: all."""
    if mode not in (APPEND, OVERWRITE_PARTITIONS):
        raise ValueError(f"unknown write mode {mode!r}")
    spark, rows = df.sparkSession, df.drop(*PARTITION_COLUMNS)
    now = versions.current(spark, root).get(day)
    if mode == APPEND and now is not None:
        rows.write.mode("append").options(**PARQUET_OPTIONS).parquet(now.folder(root))
        return now
    version = versions.new_version(spark, root, day, rows.schema)
    rows.write.options(**PARQUET_OPTIONS).parquet(version.folder(root))
    versions.commit(spark, root, version, rows.schema, inputs)
    if keep is not None:
        versions.expire(spark, root, keep, day)
    return version


def write_partitioned(df: DataFrame, path: str, mode: str = OVERWRITE_PARTITIONS,
                      partition_by: list[str] | None = None) -> None:
    cols = partition_by or PARTITION_COLUMNS
    w = df.write.partitionBy(*cols)
    if mode == APPEND:
        w = w.mode("append")
    elif mode == OVERWRITE_PARTITIONS:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        raise ValueError(f"unknown write mode {mode!r}")
    w.options(**PARQUET_OPTIONS).parquet(path)


def write_dataset(df: DataFrame, path: str) -> None:
    """Unpartitioned dataset, replaced as a whole."""
    df.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(path)
