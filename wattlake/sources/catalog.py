"""Catalog registration of lake layers (B7), table gate (A7), ad-hoc SQL."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wattlake.schemas import PARTITION_COLUMNS
from wattlake.sources import versions
from wattlake.sources.landing import _is_missing_path


def _partition_spec(run_date: _dt.date) -> str:
    return f"year={run_date.year}, month={run_date.month}, day={run_date.day}"


def _place_partitions(spark: SparkSession, table: str, root: str, days: dict) -> None:
    """Partitions of these days at the folders of their current versions."""
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}    # one row a day
    new, moved = [], []
    for d, v in sorted(days.items()):
        place = f"PARTITION ({_partition_spec(d)}) LOCATION '{v.folder(root)}'"
        (moved if f"year={d.year}/month={d.month}/day={d.day}" in known else new).append((d, place, v))
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(p for _, p, _ in new)}")
    for d, _, v in moved:
        spark.sql(f"ALTER TABLE {table} PARTITION ({_partition_spec(d)}) SET LOCATION '{v.folder(root)}'")
    spark.sql(f"REFRESH TABLE {table}")


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def register_dataset(spark: SparkSession, db: str, name: str, path: str, schema: StructType,
                     partitioned: bool = True, run_date: _dt.date | None = None,
                     db_location: str | None = None) -> bool:
    """Register the Parquet dataset at ``path`` as external table ``db.name``.

    First time: the table is created over the files with its declared
    ``schema`` and every partition folder is picked up (``MSCK REPAIR``).
    Afterwards, with ``run_date`` given, only that day's partition is added - a
    catalog update, not a listing of years of partition folders.  Returns
    ``False`` when nothing exists at ``path``. Of a dataset with committed
    versions, a partition is the folder of its day's current version, so a rerun
    moves it on."""
    qualified = f"{db}.{name}"
    now = versions.current(spark, path) if partitioned else {}
    if spark.catalog.tableExists(qualified):
        if not partitioned:
            spark.sql(f"REFRESH TABLE {qualified}")
        elif now:
            _place_partitions(spark, qualified, path, now if run_date is None else {
                d: v for d, v in now.items() if d == run_date})
        elif run_date is not None:
            spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS PARTITION ({_partition_spec(run_date)})")
        else:
            spark.sql(f"MSCK REPAIR TABLE {qualified}")
        return True
    if not now:
        try:
            spark.read.schema(schema).parquet(path)
        except AnalysisException as exc:
            if _is_missing_path(exc):
                return False
            raise
    ensure_database(spark, db, db_location)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(PARTITION_COLUMNS)})" if partitioned else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified} ({columns}) USING PARQUET{by} LOCATION '{path}'")
    if now:
        _place_partitions(spark, qualified, path, now)
    elif partitioned:
        spark.sql(f"MSCK REPAIR TABLE {qualified}")
    return True


def register_layer(spark: SparkSession, db: str, root: str, schemas: dict[str, StructType],
                   run_date: _dt.date | None = None, db_location: str | None = None) -> list[str]:
    """Register every dataset of a layer that exists under ``root``."""
    done = []
    for n, schema in schemas.items():
        if register_dataset(spark, db, n, f"{root.rstrip('/')}/{n}", schema, run_date=run_date,
                            db_location=db_location):
            done.append(f"{db}.{n}")
    return done


def require_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    """Fail fast, naming every missing table (no polling)."""
    missing = [t for t in tables if not spark.catalog.tableExists(t)]
    if missing:
        raise LookupError(f"tables not registered: {missing}")


def run_sql(spark: SparkSession, sql: str, database: str | None = None) -> DataFrame:
    """Ad-hoc SQL against the catalog; errors propagate unchanged. Names are
    resolved in ``database`` while the query is analysed; the session's current
    database stays what it was."""
    if not database:
        return spark.sql(sql)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(sql)
    finally:
        spark.catalog.setCurrentDatabase(before)
