"""Aggregations: transaction rollup (E1), energy totals (E2), price summary.

All are hash aggregates with a partial (map-side) step, so a hot group key is
reduced on every mapper before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions import exact_avg
from wattlake.schemas import AGG_KEYS


def aggregate_transacciones(tx: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """kWh total and unweighted mean unit price per energy type, city and
    transaction date.  NULL keys form their own group."""
    return tx.groupBy(*AGG_KEYS).agg(
        F.sum("cantidad_kwh").alias("total_kwh"),
        exact_avg("precio_kwh", exact_scale).alias("avg_precio_kwh"),
    )


def energy_totals(agg: DataFrame) -> DataFrame:
    """Second-level rollup of ``total_kwh`` per energy type."""
    return agg.groupBy("tipo_energia").agg(F.sum("total_kwh").alias("total_kwh"))


def price_summary(agg: DataFrame, year: int, year_of: str | Column = "year",
                  exact_scale: int | None = None, limit: int = 50) -> DataFrame:
    """Row count and mean of ``avg_precio_kwh`` per energy type for one year,
    most frequent first, at most ``limit`` rows.

    ``year_of`` defaults to the processing-date partition column (pruned at
    listing time); pass ``F.year("fecha_transaccion")`` for the business year.
    """
    y = F.col(year_of) if isinstance(year_of, str) else year_of
    return (agg.where(y == F.lit(year))
            .groupBy("tipo_energia")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 exact_avg("avg_precio_kwh", exact_scale).alias("avg_price"))
            .orderBy(F.col("cnt").desc(), F.col("tipo_energia").asc_nulls_last())
            .limit(limit))
