"""Bronze split of the wide landing contract frame.

One landing scan feeds up to four typed datasets.  Each split is produced only
when its required columns exist (C3).  Rows are kept when a value does not
parse: it becomes NULL (``try_cast``), it is not dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions import default_if_null, has_columns, safe_date, safe_double
from wattlake.operators.views import UNKNOWN_CLIENT_TYPE
from wattlake.schemas import PROVEEDOR_COLUMNS, TRANSACCION_COLUMNS


def split_transacciones(contratos: DataFrame) -> DataFrame | None:
    """Transaction lines: rows with an id; kWh, price and date typed."""
    if not has_columns(contratos, TRANSACCION_COLUMNS):
        return None
    return (contratos.select(*TRANSACCION_COLUMNS)
            .where(F.col("id_transaccion").isNotNull())
            .withColumns({
                "cantidad_kwh": safe_double("cantidad_kwh"),
                "precio_kwh": safe_double("precio_kwh"),
                "fecha_transaccion": safe_date("fecha_transaccion"),
            }))


def split_proveedores(contratos: DataFrame) -> DataFrame | None:
    """Provider lines: one per contract line with a provider name; capacity
    and contract date typed.  Not deduplicated (see ``curate_proveedores``)."""
    if not has_columns(contratos, PROVEEDOR_COLUMNS):
        return None
    return (contratos.select(*PROVEEDOR_COLUMNS)
            .where(F.col("nombre_proveedor").isNotNull())
            .withColumns({
                "capacidad_mw": safe_double("capacidad_mw"),
                "fecha_contrato": safe_date("fecha_contrato"),
            }))


def split_clientes(contratos: DataFrame) -> DataFrame | None:
    """Client lines: counterparty, its type (default ``desconocido``) and,
    when the landing file has it, the city."""
    if not has_columns(contratos, ["tipo_cliente", "cliente_proveedor"]):
        return None
    cols = [F.col("cliente_proveedor"),
            default_if_null("tipo_cliente", UNKNOWN_CLIENT_TYPE).alias("tipo_cliente")]
    if "ciudad" in contratos.columns:
        cols.append(F.col("ciudad"))
    return contratos.where(F.col("cliente_proveedor").isNotNull()).select(*cols)


def type_riesgos(riesgos: DataFrame) -> DataFrame:
    """Price-risk table: every source column kept, ``riesgo_pct`` typed."""
    if "riesgo_pct" in riesgos.columns:
        return riesgos.withColumn("riesgo_pct", safe_double("riesgo_pct"))
    return riesgos


def split_contratos(contratos: DataFrame) -> dict[str, DataFrame]:
    """All bronze datasets derivable from one landing frame, by name."""
    out = {
        "transacciones": split_transacciones(contratos),
        "proveedores": split_proveedores(contratos),
        "clientes": split_clientes(contratos),
    }
    return {k: v for k, v in out.items() if v is not None}
