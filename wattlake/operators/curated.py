"""Gold-layer curated copies (G2, G4, G5 transforms)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions import safe_date, safe_double
from wattlake.schemas import STAMP_COLUMNS, TRANSACCIONES


def curate_transacciones(bronze: DataFrame) -> DataFrame:
    """The business columns, re-typed as declared (idempotent on typed input); a
    value that does not convert is NULL."""
    return bronze.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TRANSACCIONES.fields])


def curate_proveedores(bronze: DataFrame, distinct: bool = False) -> DataFrame:
    """Providers with capacity/date typed.  The bronze split keeps one row per
    contract line; ``distinct=True`` collapses identical provider rows
    (map-side partial aggregation, so a provider with most of the rows does
    not land in one task unreduced)."""
    df = bronze.drop(*[c for c in STAMP_COLUMNS if c in bronze.columns])
    df = df.withColumn("capacidad_mw", safe_double("capacidad_mw"))
    if "fecha_contrato" in df.columns:
        df = df.withColumn("fecha_contrato", safe_date("fecha_contrato"))
    return df.dropDuplicates() if distinct else df


def dedup_clientes(bronze: DataFrame, key: str = "cliente_proveedor") -> DataFrame:
    """One row per client with a deterministic survivor.

    Survivor: latest ``processed_date`` (when present), then the greatest
    ``tipo_cliente``, then the greatest ``ciudad``; NULLs lose.  Expressed as
    ``max(struct(...))`` per key, aggregated partially on the map side, so a
    client holding a third of all rows is reduced before the shuffle instead
    of being sorted inside one window partition.
    """
    if key not in bronze.columns:
        return bronze
    order = [c for c in ["processed_date", "tipo_cliente", "ciudad"] if c in bronze.columns]
    rest = [c for c in bronze.columns
            if c != key and c not in order and c not in STAMP_COLUMNS]
    payload = [c for c in order + rest]
    # max() over a struct has no fixed-width buffer, so Spark plans a partial
    # + final sort-based aggregate: still reduced per mapper before the
    # shuffle, and spillable.
    best = F.max(F.struct(*[F.col(c) for c in payload])).alias("_best")
    out = bronze.groupBy(key).agg(best)
    keep = [c for c in payload if c not in STAMP_COLUMNS]
    return out.select(key, *[F.col(f"_best.{c}").alias(c) for c in keep])
