"""Parquet dataset reads with partition discovery (A4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.sources import versions
from wattlake.sources.landing import _is_missing_path


def read_dataset(spark: SparkSession, root: str, schema: StructType | None = None,
                 optional: bool = False) -> DataFrame | None:
    """Read a Hive-partitioned Parquet dataset; ``year/month/day`` come back as
    ints.  With ``optional`` a missing root returns ``None``. Of a dataset with
    committed versions, the current one of each day is read."""
    now = versions.current(spark, root)
    if now:
        return versions.read(spark, root, sorted(now.values()), schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(root)
    except AnalysisException as exc:
        if optional and _is_missing_path(exc):
            return None
        raise


def partition_filter(run_date: _dt.date):
    return ((F.col("year") == run_date.year) & (F.col("month") == run_date.month)
            & (F.col("day") == run_date.day))


def read_partition(spark: SparkSession, root: str, run_date: _dt.date | None,
                   optional: bool = False, schema: StructType | None = None) -> DataFrame | None:
    """Read one processing-date partition (pruned at listing time), or the
    whole dataset when ``run_date`` is ``None``. With a declared ``schema``,
    columns that some days lack come back as NULL for them, and columns that
    only some days have are not lost."""
    now = versions.current(spark, root) if run_date is not None else {}
    if now:
        return versions.read(spark, root, [v for d, v in now.items() if d == run_date], schema)
    df = read_dataset(spark, root, schema, optional)
    if df is None or run_date is None:
        return df
    return df.where(partition_filter(run_date))
