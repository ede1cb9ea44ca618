"""Warehouse schemas, typed tables and loads."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.config import PARQUET_OPTIONS, LakeConfig
from wattlake.functions import require_columns
from wattlake.schemas import DWH_AGG_DDL, DWH_PROVEEDORES_DDL, DWH_TRANSACCIONES_DDL


def warehouse_tables(cfg: LakeConfig) -> dict[str, str]:
    """Qualified warehouse table name -> column DDL."""
    return {
        f"{cfg.dwh_gold_db}.transacciones": DWH_TRANSACCIONES_DDL,
        f"{cfg.dwh_analytics_db}.transacciones_agg": DWH_AGG_DDL,
        f"{cfg.dwh_gold_db}.proveedores": DWH_PROVEEDORES_DDL,
    }


LOAD_DATE = "load_date"


def create_warehouse(spark: SparkSession, cfg: LakeConfig) -> list[str]:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` for the two warehouse schemas
    and three typed tables.  ``VARCHAR(n)`` lengths are enforced on write.

    Each table carries one extra partition column, ``load_date``, so a day's
    load can be replaced as a unit: re-running or retrying a load overwrites
    that day instead of appending it twice."""
    for db in (cfg.dwh_gold_db, cfg.dwh_analytics_db):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{cfg.dwh}/{db}'")
    options = ", ".join(f"{k} '{v}'" for k, v in PARQUET_OPTIONS.items())
    names = []
    for name, ddl in warehouse_tables(cfg).items():
        db, tbl = name.split(".")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl.rstrip()}, {LOAD_DATE} DATE) "
                  f"USING PARQUET OPTIONS ({options}) PARTITIONED BY ({LOAD_DATE}) "
                  f"LOCATION '{cfg.dwh}/{db}/{tbl}'")
        names.append(name)
    return names


def _business_columns(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    target = [c for c in spark.table(table).columns if c != LOAD_DATE]
    require_columns(df, target, f"load into {table}")
    return target


def load_table(spark: SparkSession, df: DataFrame, table: str, load_date: _dt.date) -> None:
    """Replace partition ``load_date`` of ``table`` with ``df``, columns
    matched **by name** (extra columns such as stamps are dropped; a missing
    column fails instead of shifting values positionally)."""
    cols = _business_columns(spark, table, df)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_DATE} = DATE '{load_date.isoformat()}') "
              f"SELECT {', '.join(cols)} FROM {{src}}", src=df.select(*cols))


def reload_table(spark: SparkSession, df: DataFrame, table: str, date_col: str = "processed_date") -> None:
    """Replace the whole table with ``df``; each row's ``load_date`` is its
    ``date_col`` (the gold processing date)."""
    cols = _business_columns(spark, table, df)
    df.select(*cols, F.col(date_col).alias(LOAD_DATE)).write.insertInto(table, overwrite=True)
