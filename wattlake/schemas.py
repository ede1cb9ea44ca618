"""Declared schemas of every dataset (one place, by name)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, I = T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType()


def _all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


# ---- landing (all columns are text on read) -------------------------------
# Column names of the landing contract file, in file order.
CONTRATOS_COLUMNS = [
    "id_transaccion", "fecha_transaccion", "tipo_transaccion", "cliente_proveedor",
    "cantidad_kwh", "precio_kwh", "tipo_energia", "hora_transaccion", "ciudad",
    "nombre_proveedor", "capacidad_mw", "fecha_contrato", "tipo_cliente",
]
# Column names of the landing risk file.
RIESGOS_COLUMNS = ["tipo_cliente", "riesgo_pct", "comentario"]

CONTRATOS_RAW = _all_strings(CONTRATOS_COLUMNS)
RIESGOS_RAW = _all_strings(RIESGOS_COLUMNS)

# ---- business column lists ------------------------------------------------
TRANSACCION_COLUMNS = CONTRATOS_COLUMNS[:9]
# The columns of a provider line.
PROVEEDOR_COLUMNS = ["nombre_proveedor", "tipo_energia", "capacidad_mw", "ciudad", "fecha_contrato"]
AGG_KEYS = ["tipo_energia", "ciudad", "fecha_transaccion"]
STAMP_COLUMNS = ["processed_date", "year", "month", "day"]
PARTITION_COLUMNS = ["year", "month", "day"]

# ---- typed datasets -------------------------------------------------------
TRANSACCIONES = T.StructType([
    T.StructField("id_transaccion", S), T.StructField("fecha_transaccion", DT),
    T.StructField("tipo_transaccion", S), T.StructField("cliente_proveedor", S),
    T.StructField("cantidad_kwh", D), T.StructField("precio_kwh", D),
    T.StructField("tipo_energia", S), T.StructField("hora_transaccion", S),
    T.StructField("ciudad", S),
])
PROVEEDORES = T.StructType([
    T.StructField("nombre_proveedor", S), T.StructField("tipo_energia", S),
    T.StructField("capacidad_mw", D), T.StructField("ciudad", S),
    T.StructField("fecha_contrato", DT),
])
CLIENTES = T.StructType([
    T.StructField("cliente_proveedor", S), T.StructField("tipo_cliente", S),
    T.StructField("ciudad", S),
])
RIESGOS = T.StructType([
    T.StructField("tipo_cliente", S), T.StructField("riesgo_pct", D),
    T.StructField("comentario", S),
])
TRANSACCIONES_AGG = T.StructType([
    T.StructField("tipo_energia", S), T.StructField("ciudad", S),
    T.StructField("fecha_transaccion", DT), T.StructField("total_kwh", D),
    T.StructField("avg_precio_kwh", D),
])
TIPO_ENERGIA_TOTALS = T.StructType([
    T.StructField("tipo_energia", S), T.StructField("total_kwh", D),
])
QUARANTINE = T.StructType([T.StructField("dataset", S), T.StructField("reason", S), *CONTRATOS_RAW.fields])
STAMP = T.StructType([
    T.StructField("processed_date", DT), T.StructField("year", I),
    T.StructField("month", I), T.StructField("day", I),
])


def stamped(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + list(STAMP.fields))


# What the lake reads and registers, whatever a day's files happen to hold.
BRONZE_SCHEMAS = {
    "transacciones": stamped(TRANSACCIONES), "proveedores": stamped(PROVEEDORES),
    "clientes": stamped(CLIENTES), "riesgos_precios": stamped(RIESGOS), "cuarentena": stamped(QUARANTINE),
}
GOLD_SCHEMAS = {
    "transacciones_curated": stamped(TRANSACCIONES), "transacciones_agg": stamped(TRANSACCIONES_AGG),
    "proveedores": stamped(PROVEEDORES), "clientes": stamped(CLIENTES), "tipo_energia": TIPO_ENERGIA_TOTALS,
}


# ---- warehouse DDL (fixed values: column types of the warehouse tables) ----
DWH_TRANSACCIONES_DDL = """
  id_transaccion VARCHAR(64),
  fecha_transaccion DATE,
  tipo_transaccion VARCHAR(32),
  cliente_proveedor VARCHAR(256),
  cantidad_kwh DOUBLE,
  precio_kwh DOUBLE,
  tipo_energia VARCHAR(64),
  hora_transaccion VARCHAR(16),
  ciudad VARCHAR(128)
"""
DWH_AGG_DDL = """
  tipo_energia VARCHAR(64),
  ciudad VARCHAR(128),
  fecha_transaccion DATE,
  total_kwh DOUBLE,
  avg_precio_kwh DOUBLE
"""
DWH_PROVEEDORES_DDL = """
  nombre_proveedor VARCHAR(256),
  tipo_energia VARCHAR(64),
  capacidad_mw DOUBLE,
  ciudad VARCHAR(128),
  fecha_contrato DATE
"""

# ---- events stream (driver table) ----------------------------------------
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", S),
    T.StructField("value", D), T.StructField("props", S),
])
EVENT_PROPS = T.StructType([T.StructField("k", I)])

# ---- driver star-schema tables: declared read schemas (used columns only) --
# A declared schema skips footer-based inference at planning time and makes
# the Parquet reader fetch only these columns.
DRIVER_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
