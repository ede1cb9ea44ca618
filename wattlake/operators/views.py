"""Logical views (G7, B9 and the warehouse variants of G10).

Each view is stored SQL.  The same text is used two ways:

* ``create_*_views`` stores it in the catalog (``CREATE OR REPLACE VIEW``)
  over registered tables;
* ``view_frame`` evaluates it over DataFrames passed as named arguments
  (``spark.sql(text, tx=df)``), which is how tests and oracle checks run it.

Column lists are pinned so columns added to a table later do not leak in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattlake.schemas import STAMP_COLUMNS, TRANSACCION_COLUMNS

# Transaction-type words (compared lower-cased) and the client
# type reported when none is known.
SALE, PURCHASE = "venta", "compra"
UNKNOWN_CLIENT_TYPE = "desconocido"

_TX = ", ".join(TRANSACCION_COLUMNS)
_TX_STAMPED = ", ".join(TRANSACCION_COLUMNS + STAMP_COLUMNS)

# ---- lake views over bronze transacciones / clientes ----------------------
LAKE_VIEWS = {
    "v_servicio": "SELECT DISTINCT tipo_energia FROM {tx}",
    "v_ventas": f"SELECT {_TX_STAMPED} FROM {{tx}} WHERE lower(tipo_transaccion) = '{SALE}'",
    "v_compras": f"SELECT {_TX_STAMPED} FROM {{tx}} WHERE lower(tipo_transaccion) = '{PURCHASE}'",
    # Every counterparty with its greatest client type (default 'desconocido')
    # and greatest city.  max() is lexicographic: 'residencial' > 'industrial'
    # > 'desconocido' > 'comercial', so a client seen both as 'comercial' and
    # without a type reports 'desconocido'.
    # Both sides are reduced to one row per key before the left join; max()
    # ignores duplication, so the result equals grouping the raw join, without
    # its per-client N x M fan-out (and without one hot client's rows meeting
    # in a single join task).  max() over strings plans as a partial + final
    # sort aggregate (no fixed-width buffer), still reduced per mapper.
    "v_clientes": f"""
        SELECT t.cliente_proveedor AS cliente,
               coalesce(c.tipo_cliente, '{UNKNOWN_CLIENT_TYPE}') AS tipo_cliente,
               t.ciudad AS ciudad
        FROM (SELECT cliente_proveedor, max(ciudad) AS ciudad
              FROM {{tx}} WHERE cliente_proveedor IS NOT NULL
              GROUP BY cliente_proveedor) t
        LEFT JOIN (SELECT cliente_proveedor, max(tipo_cliente) AS tipo_cliente
                   FROM {{cl}} WHERE cliente_proveedor IS NOT NULL
                   GROUP BY cliente_proveedor) c
          ON t.cliente_proveedor = c.cliente_proveedor
    """,
}

# ---- warehouse views over the warehouse transaction table -----------------
DWH_VIEWS = {
    "v_ventas": f"SELECT {_TX} FROM {{tx}} WHERE lower(tipo_transaccion) = '{SALE}'",
    "v_compras": f"SELECT {_TX} FROM {{tx}} WHERE lower(tipo_transaccion) = '{PURCHASE}'",
    # Only counterparties of sales, no client type.
    "v_clientes": f"""
        SELECT cliente_proveedor AS cliente, max(ciudad) AS ciudad
        FROM {{tx}}
        WHERE lower(tipo_transaccion) = '{SALE}' AND cliente_proveedor IS NOT NULL
        GROUP BY cliente_proveedor
    """,
}


def view_frame(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Evaluate view text with ``{name}`` bound to DataFrames."""
    return spark.sql(text, **frames)


def lake_view(spark: SparkSession, name: str, tx: DataFrame, cl: DataFrame | None = None) -> DataFrame:
    frames = {"tx": tx}
    if "{cl}" in LAKE_VIEWS[name]:
        if cl is None:
            raise ValueError(f"{name} needs the clientes frame")
        frames["cl"] = cl
    return view_frame(spark, LAKE_VIEWS[name], **frames)


def dwh_view(spark: SparkSession, name: str, tx: DataFrame) -> DataFrame:
    return view_frame(spark, DWH_VIEWS[name], tx=tx)


def current_rows(table: str, only: str | None) -> str:
    """A table, or its rows that satisfy ``only``, as a FROM item."""
    return f"(SELECT * FROM {table} WHERE {only})" if only else table


def create_lake_views(spark: SparkSession, view_db: str, tx_table: str, cl_table: str,
                      only: str | None = None) -> list[str]:
    """Store the four lake views in ``view_db`` over the given tables, or over
    their rows that satisfy ``only`` (a predicate on the partition columns)."""
    created = []
    for name, text in LAKE_VIEWS.items():
        body = text.format(tx=current_rows(tx_table, only), cl=current_rows(cl_table, only))
        spark.sql(f"CREATE OR REPLACE VIEW {view_db}.{name} AS {body}")
        created.append(f"{view_db}.{name}")
    return created


def create_dwh_views(spark: SparkSession, view_db: str, tx_table: str, only: str | None = None) -> list[str]:
    created = []
    for name, text in DWH_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {view_db}.{name} AS {text.format(tx=current_rows(tx_table, only))}")
        created.append(f"{view_db}.{name}")
    return created
