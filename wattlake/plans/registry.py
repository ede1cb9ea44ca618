"""Registered queries over the driver tables, with their oracle SQL.

Every query derives the contract-shaped landing frame from the whole driver
tables (``sources.driver_tables``) and runs the real layer operators on it.
Stamped outputs use the fixed ``RUN_DATE`` so results are reproducible.
Averages use the exact decimal-sum form (``exact_avg``) so Spark and the SQL
oracle agree to the last bit.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions import stamp
from wattlake.session import remove_path, scratch_path, shuffles_freed
from wattlake.operators import aggregates, bronze, curated, detection, exports, quality, sensitive, views
from wattlake.sources.driver_tables import CONTRATOS_SQL, contratos_from_tables, table
from wattlake.sinks import parquet as pq
from wattlake.sinks import text
from wattlake.config import LakeConfig
from wattlake.plans import daily_run, intake, jobs
from wattlake.sources import versions
from wattlake.sources.catalog import run_sql
from wattlake.sources.incremental import ingest_bronze_incremental
from wattlake.sources.lake import read_dataset, read_partition
from wattlake.schemas import BRONZE_SCHEMAS, CONTRATOS_RAW, GOLD_SCHEMAS, PROVEEDOR_COLUMNS, TRANSACCION_COLUMNS
from wattlake.streaming import archive, asof
from wattlake.streaming import events as ev

RUN_DATE = _dt.date(2024, 6, 1)
DAY_2, DAY_3 = RUN_DATE + _dt.timedelta(days=1), RUN_DATE + _dt.timedelta(days=2)
SUMMARY_YEAR = 1998          # business year used by the price summary
AVG_SCALE = 4                # decimal scale of unit prices
AVG_OF_AVG_SCALE = 6         # decimal scale of per-group mean prices
EXPORT_LIMIT = 1000


# ---- frame builders shared by the queries ---------------------------------
def _contratos(spark, d):
    return contratos_from_tables(spark, d)


def _tx(spark, d):
    return bronze.split_transacciones(_contratos(spark, d))


def _tx_stamped(spark, d):
    return stamp(_tx(spark, d), RUN_DATE)


def _pv(spark, d):
    return bronze.split_proveedores(_contratos(spark, d))


def _cl(spark, d):
    return bronze.split_clientes(_contratos(spark, d))


def _agg(spark, d):
    return aggregates.aggregate_transacciones(_tx(spark, d), exact_scale=AVG_SCALE)


def _curated_tx(spark, d):
    return curated.curate_transacciones(_tx_stamped(spark, d))


def _landed(spark, d, path=None):
    """The landing frame written once, for queries that use it more than once.
    ``path``: where, if the query removes it after its last use."""
    path = path or scratch_path(spark, "landed")
    with shuffles_freed(spark):
        pq.write_dataset(_contratos(spark, d), path)
    return spark.read.schema(CONTRATOS_RAW).parquet(path)


def _v_clientes(spark, d):
    c = _landed(spark, d)
    return views.lake_view(spark, "v_clientes",
                           stamp(bronze.split_transacciones(c), RUN_DATE),
                           stamp(bronze.split_clientes(c), RUN_DATE))


def _v_clientes_unmatched(spark, d):
    """The client table lacks clients whose number ends in 7."""
    c = _landed(spark, d)
    return views.lake_view(spark, "v_clientes", bronze.split_transacciones(c),
                           bronze.split_clientes(c).where(~F.col("cliente_proveedor").endswith("7")))


def _price_summary(spark, d):
    """Of one business year: the date range reaches the orders scan."""
    c = contratos_from_tables(spark, d, (f"{SUMMARY_YEAR}-01-01", f"{SUMMARY_YEAR}-12-31"))
    agg = aggregates.aggregate_transacciones(bronze.split_transacciones(c), exact_scale=AVG_SCALE)
    return aggregates.price_summary(agg, SUMMARY_YEAR, F.year("fecha_transaccion"), exact_scale=AVG_OF_AVG_SCALE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "contratos": _contratos,
    "transacciones": _tx,
    "proveedores": _pv,
    "clientes": _cl,
    "stamped_transacciones": _tx_stamped,
    "transacciones_curated": _curated_tx,
    "proveedores_curated": lambda s, d: curated.curate_proveedores(stamp(_pv(s, d), RUN_DATE)),
    "clientes_curated": lambda s, d: curated.dedup_clientes(_cl(s, d)),
    "transacciones_agg": _agg,
    "tipo_energia_totals": lambda s, d: aggregates.energy_totals(_agg(s, d)),
    "v_servicio": lambda s, d: views.lake_view(s, "v_servicio", _tx_stamped(s, d)),
    "v_ventas": lambda s, d: views.lake_view(s, "v_ventas", _tx_stamped(s, d)),
    "v_compras": lambda s, d: views.lake_view(s, "v_compras", _tx_stamped(s, d)),
    "v_clientes": lambda s, d: _v_clientes(s, d),
    "dwh_v_ventas": lambda s, d: views.dwh_view(s, "v_ventas", _curated_tx(s, d)),
    "dwh_v_compras": lambda s, d: views.dwh_view(s, "v_compras", _curated_tx(s, d)),
    "dwh_v_clientes": lambda s, d: views.dwh_view(s, "v_clientes", _curated_tx(s, d)),
    "v_clientes_unmatched": _v_clientes_unmatched,
    "energy_price_summary": _price_summary,
    "export_transacciones": lambda s, d: exports.top_transacciones(curated.curate_transacciones(
        bronze.split_transacciones(_landed(s, d))), EXPORT_LIMIT),
    "export_proveedores": lambda s, d: exports.top_proveedores(curated.curate_proveedores(
        bronze.split_proveedores(_landed(s, d))), EXPORT_LIMIT),
}


# ---- oracle SQL (DuckDB dialect, driver tables pre-registered) ------------
_RD = f"DATE '{RUN_DATE.isoformat()}'"
_STAMP_SQL = (f"{_RD} AS processed_date, {RUN_DATE.year} AS year, "
              f"{RUN_DATE.month} AS month, {RUN_DATE.day} AS day")

_CTE = f"""
WITH contratos AS ({CONTRATOS_SQL}),
tx AS (
  SELECT id_transaccion, try_cast(fecha_transaccion AS DATE) AS fecha_transaccion,
         tipo_transaccion, cliente_proveedor,
         try_cast(cantidad_kwh AS DOUBLE) AS cantidad_kwh,
         try_cast(precio_kwh AS DOUBLE) AS precio_kwh,
         tipo_energia, hora_transaccion, ciudad
  FROM contratos WHERE id_transaccion IS NOT NULL),
txs AS (SELECT *, {_STAMP_SQL} FROM tx),
pv AS (
  SELECT nombre_proveedor, tipo_energia, try_cast(capacidad_mw AS DOUBLE) AS capacidad_mw,
         ciudad, try_cast(fecha_contrato AS DATE) AS fecha_contrato
  FROM contratos WHERE nombre_proveedor IS NOT NULL),
cl AS (
  SELECT cliente_proveedor, coalesce(tipo_cliente, 'desconocido') AS tipo_cliente, ciudad
  FROM contratos WHERE cliente_proveedor IS NOT NULL),
agg AS (
  SELECT tipo_energia, ciudad, fecha_transaccion, sum(cantidad_kwh) AS total_kwh,
         cast(sum(cast(precio_kwh AS DECIMAL(18,{AVG_SCALE}))) AS DOUBLE) / count(precio_kwh)
           AS avg_precio_kwh
  FROM tx GROUP BY tipo_energia, ciudad, fecha_transaccion)
"""

_TXCOLS = ("id_transaccion, fecha_transaccion, tipo_transaccion, cliente_proveedor, "
           "cantidad_kwh, precio_kwh, tipo_energia, hora_transaccion, ciudad")
_TXS_COLS = _TXCOLS + ", processed_date, year, month, day"

ORACLE_SQL: dict[str, str] = {
    "contratos": f"{_CTE} SELECT * FROM contratos",
    "transacciones": f"{_CTE} SELECT * FROM tx",
    "proveedores": f"{_CTE} SELECT * FROM pv",
    "clientes": f"{_CTE} SELECT * FROM cl",
    "stamped_transacciones": f"{_CTE} SELECT {_TXS_COLS} FROM txs",
    "transacciones_curated": f"{_CTE} SELECT {_TXCOLS} FROM tx",
    "proveedores_curated": f"{_CTE} SELECT * FROM pv",
    "clientes_curated": f"""{_CTE}
        SELECT cliente_proveedor, tipo_cliente, ciudad FROM (
          SELECT *, row_number() OVER (PARTITION BY cliente_proveedor
                     ORDER BY tipo_cliente DESC NULLS LAST, ciudad DESC NULLS LAST) AS rn
          FROM cl) WHERE rn = 1""",
    "transacciones_agg": f"{_CTE} SELECT * FROM agg",
    "tipo_energia_totals": f"{_CTE} SELECT tipo_energia, sum(total_kwh) AS total_kwh FROM agg GROUP BY tipo_energia",
    "v_servicio": f"{_CTE} SELECT DISTINCT tipo_energia FROM txs",
    "v_ventas": f"{_CTE} SELECT {_TXS_COLS} FROM txs WHERE lower(tipo_transaccion) = 'venta'",
    "v_compras": f"{_CTE} SELECT {_TXS_COLS} FROM txs WHERE lower(tipo_transaccion) = 'compra'",
    "v_clientes": f"""{_CTE}
        SELECT cliente, coalesce((SELECT max(tipo_cliente) FROM cl WHERE cl.cliente_proveedor = k.cliente), 'desconocido')
                 AS tipo_cliente,
               (SELECT max(ciudad) FROM tx WHERE tx.cliente_proveedor = k.cliente) AS ciudad
        FROM (SELECT DISTINCT cliente_proveedor AS cliente FROM tx WHERE cliente_proveedor IS NOT NULL) k""",
    "v_clientes_unmatched": f"""{_CTE}
        SELECT cliente, coalesce((SELECT max(tipo_cliente) FROM cl WHERE cl.cliente_proveedor = k.cliente
                                  AND right(cl.cliente_proveedor, 1) <> '7'), 'desconocido') AS tipo_cliente,
               (SELECT max(ciudad) FROM tx WHERE tx.cliente_proveedor = k.cliente) AS ciudad
        FROM (SELECT DISTINCT cliente_proveedor AS cliente FROM tx WHERE cliente_proveedor IS NOT NULL) k""",
    "dwh_v_ventas": f"{_CTE} SELECT {_TXCOLS} FROM tx WHERE lower(tipo_transaccion) = 'venta'",
    "dwh_v_compras": f"{_CTE} SELECT {_TXCOLS} FROM tx WHERE lower(tipo_transaccion) = 'compra'",
    "dwh_v_clientes": f"""{_CTE}
        SELECT cliente_proveedor AS cliente, max(ciudad) AS ciudad FROM tx
        WHERE lower(tipo_transaccion) = 'venta' AND cliente_proveedor IS NOT NULL
        GROUP BY cliente_proveedor""",
    "energy_price_summary": f"""{_CTE}
        SELECT tipo_energia, count(*) AS cnt,
               cast(sum(cast(avg_precio_kwh AS DECIMAL(18,{AVG_OF_AVG_SCALE}))) AS DOUBLE)
                 / count(avg_precio_kwh) AS avg_price
        FROM agg WHERE year(fecha_transaccion) = {SUMMARY_YEAR}
        GROUP BY tipo_energia ORDER BY cnt DESC, tipo_energia ASC NULLS LAST LIMIT 50""",
    "export_transacciones": f"""{_CTE}
        SELECT {_TXCOLS} FROM tx
        ORDER BY {', '.join(f"{c} ASC NULLS LAST" for c in ["fecha_transaccion", "id_transaccion", *[
            c for c in TRANSACCION_COLUMNS if c not in ("fecha_transaccion", "id_transaccion")]])}
        LIMIT {EXPORT_LIMIT}""",
    "export_proveedores": f"""{_CTE}
        SELECT * FROM pv
        ORDER BY nombre_proveedor ASC NULLS LAST, fecha_contrato ASC NULLS LAST,
                 ciudad ASC NULLS LAST, tipo_energia ASC NULLS LAST, capacidad_mw ASC NULLS LAST
        LIMIT {EXPORT_LIMIT}""",
}


# ---- stream, quality and sensitive-data queries ---------------------------
ALERT_THRESHOLD = 5.0


def event_score():
    """Score of the registered stream queries: value of the event for each
    order of the user, this one included."""
    return F.coalesce("value", F.lit(0.0)) / (F.coalesce("n_orders", F.lit(0)) + 1)


def _profiles(spark, d):
    return ev.user_profiles(table(spark, d, "customer"), table(spark, d, "orders"))


def _quality_tagged(spark, d):
    return quality.split_provider_quality(_contratos(spark, d))


QUERIES.update({
    "stream_enriched_alerts": lambda s, d: ev.enriched_alerts(
        table(s, d, "events"), _profiles(s, d), event_score(), ALERT_THRESHOLD),
    "flattened_events": lambda s, d: ev.flatten_events(table(s, d, "events")),
    "quarantined_providers": lambda s, d: _quality_tagged(s, d)[1],
    "provider_quality": lambda s, d: quality.provider_quality_counts(_contratos(s, d)),
    "transaction_quality": lambda s, d: quality.transaction_quality_counts(_contratos(s, d)),
    "transacciones_validated": lambda s, d: quality.split_transaction_quality(_contratos(s, d))[0],
    "pii_counts": lambda s, d: sensitive.sensitive_counts(table(s, d, "documents")),
})


def _dual_sink(spark: SparkSession, d: str) -> str:
    """S1-S4 + S6 on the streaming engine: the events file is consumed as a
    stream (``availableNow``), each micro-batch is enriched against the
    materialised profile table and written flat; scored alerts are derived
    from that by the ``foreachBatch`` dual sink."""
    out = scratch_path(spark, "alerts")
    profiles = ev.materialize_profiles(_profiles(spark, d), f"{out}/profiles")
    q = ev.start_dual_sink(ev.event_stream(spark, f"{d.rstrip('/')}/events.parquet"),
                           f"{out}/flat", f"{out}/ops", profiles, f"{out}/_checkpoint", event_score(), ALERT_THRESHOLD)
    q.awaitTermination()
    return out


def _streamed_alerts(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{_dual_sink(spark, d)}/ops").drop("batch_id")


def _streamed_flat(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{_dual_sink(spark, d)}/flat").drop("batch_id")


def _profile_history(spark: SparkSession, d: str) -> DataFrame:
    """Profile versions: each order of a user, some hours into the events' month,
    makes its price and priority the user's current ones."""
    hours = F.col("o_orderkey") % 700
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours.cast("int"))).alias("valid_from"),
        F.col("o_totalprice").alias("last_price"), F.col("o_orderpriority").alias("last_priority"))


def _events_asof_profile(spark: SparkSession, d: str) -> DataFrame:
    """S2 on the streaming engine: each event with the profile of its time, from
    a profile table that comes in on two days."""
    out = scratch_path(spark, "asof")
    history = _profile_history(spark, d)
    first = F.col("valid_from") < F.lit("2024-01-15").cast("timestamp_ntz")
    for day, part in ((RUN_DATE, history.where(first)), (DAY_2, history.where(~first))):
        pq.write_day(stamp(part, day), f"{out}/history", day)
    q = asof.start_asof_sink(ev.event_stream(spark, f"{d.rstrip('/')}/events.parquet"), f"{out}/history", f"{out}/rows",
                             f"{out}/_checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("batch_id", "props")


def _archived_events(spark: SparkSession, d: str) -> DataFrame:
    """S5 on the streaming engine: every event archived by date."""
    out = scratch_path(spark, "archive")
    q = ev.archive_events(ev.event_stream(spark, f"{d.rstrip('/')}/events.parquet"),
                          f"{out}/archive", f"{out}/_checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{out}/archive")


def _archive_compacted(spark: SparkSession, d: str) -> DataFrame:
    """S5 with upkeep: each date's first half of the day comes in by three batches
    and the dates up to the month's middle are compacted; the other half comes late,
    by three more, and the dates up to the 20th are compacted again."""
    out, events = scratch_path(spark, "archive"), table(spark, d, "events")
    early = F.coalesce(F.hour("ts") < 12, F.lit(False))
    for part, before in ((events.where(early), 15), (events.where(~early), 20)):
        part.repartition(3).write.mode("append").parquet(f"{out}/in")
        archive.start_archive(ev.event_stream(spark, f"{out}/in", 1), f"{out}/archive", f"{out}/_checkpoint",
                              files_per_date=1).awaitTermination()
        archive.compact(spark, f"{out}/archive", _dt.date(2024, 1, before))
    archive.tidy(spark, f"{out}/archive")
    return archive.read_archive(spark, f"{out}/archive")


def _exported_v_ventas(spark: SparkSession, d: str) -> DataFrame:
    """B3 round trip: the sales view written as gzip text without header by
    the view-export sink, read back with the view's schema."""
    view = QUERIES["v_ventas"](spark, d)
    path = f"{scratch_path(spark, 'export')}/v_ventas"
    text.export_text(view, path)
    return spark.read.schema(view.schema).option("header", False).csv(path)


def _exported_transacciones_csv(spark: SparkSession, d: str) -> DataFrame:
    """B4 round trip: the bounded, ordered transaction export written as one
    CSV file with header, read back with its schema."""
    top = QUERIES["export_transacciones"](spark, d)
    path = f"{scratch_path(spark, 'export')}/transacciones"
    text.export_bounded_csv(top, path)
    return spark.read.schema(top.schema).option("header", True).csv(path)


def _lake_transacciones(spark: SparkSession, d: str) -> DataFrame:
    """B1 + A4 round trip: bronze transactions written by the partitioned
    sink (dynamic partition overwrite, ``year/month/day``) and read back
    through partition discovery, pruned to the run's partition."""
    path = f"{scratch_path(spark, 'lake')}/transacciones"
    pq.write_partitioned(_tx_stamped(spark, d), path)
    return read_partition(spark, path, RUN_DATE)


def _lake(spark: SparkSession, name: str, **options) -> LakeConfig:
    """A lake in the shared folder, with databases of its own."""
    root = scratch_path(spark, name)
    tag = root.rsplit("-", 1)[-1]
    return LakeConfig(root=root, run_date=RUN_DATE, bronze_db=f"bronze_{tag}", gold_db=f"lake_{tag}",
                      dwh_gold_db=f"gold_{tag}", dwh_analytics_db=f"analytics_{tag}", **options)


def _riesgos(spark: SparkSession, d: str) -> DataFrame:
    """A landing risk table, as text: one line per customer segment."""
    return table(spark, d, "customer").groupBy(F.lower("c_mktsegment").alias("tipo_cliente")).agg(
        F.concat(F.count(F.lit(1)) % 97, F.lit(".5")).alias("riesgo_pct"),
        F.concat(F.lit("clientes "), F.count(F.lit(1))).alias("comentario"))


def _write_landing(df: DataFrame, path: str) -> None:
    """Landing lines as compressed CSV text with a header, a file a task."""
    (df.write.mode("overwrite").option("header", True).option("compression", "gzip")
       .option("zlib.compress.level", "BEST_SPEED").csv(path))


def _landing_lake(spark: SparkSession, d: str, name: str, contracts: str = "contratos.csv", **options) -> LakeConfig:
    """A lake whose landing holds the derived contract and risk lines as CSV
    text with a header."""
    cfg = _lake(spark, name, **options)
    for df, file in ((_contratos(spark, d), contracts), (_riesgos(spark, d), "riesgos_precios.csv")):
        _write_landing(df, f"{cfg.landing}/{file}")
    return cfg


def _ingested(name: str, contracts: str = "contratos.csv"):
    """A1 + A2 + G1: the bronze job reads the landing text (all columns as
    strings; the first place that exists), splits, types and writes the bronze
    datasets; the day's partition of one is read back."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        cfg = _landing_lake(spark, d, "ingest", contracts)
        jobs.ingest_bronze(spark, cfg, RUN_DATE)
        return read_partition(spark, cfg.bronze_path(name), RUN_DATE)
    return query


def _incremental(name: str):
    """The same landing text consumed by the exactly-once intake."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        cfg = _landing_lake(spark, d, "incremental", intake="incremental")
        ingest_bronze_incremental(spark, cfg, run_date=RUN_DATE)
        return read_partition(spark, cfg.bronze_path(name), RUN_DATE)
    return query


# ---- the jobs users run daily, each read back from what it wrote ----------


def _bronze_lake(spark: SparkSession, d: str, name: str, **options) -> LakeConfig:
    cfg = _lake(spark, name, **options)
    jobs.ingest_bronze(spark, cfg, RUN_DATE, contratos=_contratos(spark, d))
    return cfg


def _gold(job, dataset: str, columns: list[str]):
    """One gold job over the day's bronze partition."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        cfg = _bronze_lake(spark, d, "gold")
        job(spark, cfg, RUN_DATE)
        return read_partition(spark, cfg.gold_path(dataset), RUN_DATE, schema=GOLD_SCHEMAS[dataset]).select(*columns)
    return query


def _job_agg(spark: SparkSession, d: str) -> DataFrame:
    """G3 with the default (floating) mean, to nine digits."""
    df = _gold(jobs.aggregate_transacciones, "transacciones_agg", [
        "tipo_energia", "ciudad", "fecha_transaccion", "total_kwh", "avg_precio_kwh"])(spark, d)
    return df.withColumn("avg_precio_kwh", F.round("avg_precio_kwh", 9))


def _energy_totals_two_days(spark: SparkSession, d: str) -> DataFrame:
    """G9 + B2: the same landing ingested on two days counts once."""
    cfg = _lake(spark, "totals")
    landed = _landed(spark, d)
    for day in (RUN_DATE, DAY_2):
        jobs.ingest_bronze(spark, cfg, day, contratos=landed, is_table=True)
        jobs.aggregate_transacciones(spark, cfg, day)
        jobs.energy_totals(spark, cfg, day)
    return read_dataset(spark, cfg.gold_path("analytics/tipo_energia"))


def _energy_totals_delta(spark: SparkSession, d: str) -> DataFrame:
    """G9 over a delta landing: two days with half of the lines each add up."""
    cfg = _lake(spark, "totals", landing_content="delta")
    landed = _landed(spark, d)
    first = F.coalesce(F.col("id_transaccion"), F.lit("")) < "3"
    for day, part in ((RUN_DATE, landed.where(first)), (DAY_2, landed.where(~first))):
        jobs.ingest_bronze(spark, cfg, day, contratos=part, is_table=True)
        jobs.aggregate_transacciones(spark, cfg, day)
        jobs.energy_totals(spark, cfg, day)
    return read_dataset(spark, cfg.gold_path("analytics/tipo_energia"))


def _clients_ending(*digits: str):
    """Contract lines of clients whose number ends so; those without a client go
    with 0. The days of a scenario share out all ten digits."""
    return F.right(F.coalesce("cliente_proveedor", F.lit("0")), F.lit(1)).isin(*digits)


def _clientes_restated_day(spark: SparkSession, d: str) -> DataFrame:
    """The first day is written again, with clients it lacked, after gold
    snapshots of two days were made; the third day's snapshot has all clients."""
    cfg = _lake(spark, "restated")
    landed = _landed(spark, d)
    for day, digits, gold in ((RUN_DATE, "01", True), (DAY_2, "234", True), (RUN_DATE, "0156", False), (DAY_3, "789", True)):
        jobs.ingest_bronze(spark, cfg, day, contratos=landed.where(_clients_ending(*digits)), is_table=True)
        if gold:
            jobs.curate_clientes(spark, cfg, day)
    return read_partition(spark, cfg.gold_path("clientes"), DAY_3).select("cliente_proveedor", "tipo_cliente", "ciudad")


def _clientes_latest_day(spark: SparkSession, d: str) -> DataFrame:
    """E4 in the job: what the latest day says of a client wins, although the
    day before had a greater type."""
    cfg = _lake(spark, "latest")
    landed = _landed(spark, d)
    later = landed.where(_clients_ending(*"13579")).withColumn("tipo_cliente", F.lit("agente"))
    for day, df in ((RUN_DATE, landed), (DAY_2, later)):
        jobs.ingest_bronze(spark, cfg, day, contratos=df, is_table=True)
        jobs.curate_clientes(spark, cfg, day)
    return read_partition(spark, cfg.gold_path("clientes"), DAY_2).select("cliente_proveedor", "tipo_cliente", "ciudad")


def _clientes_schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """A4 + B7 + C3: the first day's landing has no city (so no transactions
    either); the next day's has, and it reaches gold and the catalog."""
    cfg = _lake(spark, "drift")
    landed = _landed(spark, d)
    for day, df in ((RUN_DATE, landed.where(_clients_ending(*"01234")).drop("ciudad")),
                    (DAY_2, landed.where(_clients_ending(*"56789")))):
        jobs.ingest_bronze(spark, cfg, day, contratos=df, is_table=True)
        jobs.curate_clientes(spark, cfg, day)
        jobs.register_layers(spark, cfg, day)
    return spark.table(f"{cfg.gold_db}.clientes").where(F.col("day") == DAY_2.day).select(
        "cliente_proveedor", "tipo_cliente", "ciudad")


def _proveedores_type_drift(spark: SparkSession, d: str) -> DataFrame:
    """A4 + B7: three days of providers whose files hold the capacity as text, as
    a whole number and as declared; together they are read as declared."""
    root = f"{scratch_path(spark, 'types')}/proveedores"
    pv = bronze.split_proveedores(_landed(spark, d))
    share = F.pmod(F.xxhash64("nombre_proveedor", "fecha_contrato"), F.lit(3))
    for k, (day, kind) in enumerate(((RUN_DATE, "string"), (DAY_2, "int"), (DAY_3, "double"))):
        # whole kilowatts, so that every type holds the same value
        kw = F.round(F.col("capacidad_mw") * 10).cast("int").cast(kind)
        pq.write_day(stamp(pv.where(share == k).withColumn("capacidad_mw", kw), day), root, day)
    return read_dataset(spark, root, BRONZE_SCHEMAS["proveedores"]).select(*PROVEEDOR_COLUMNS)


def _rerun_empty_day(spark: SparkSession, d: str) -> DataFrame:
    """B1: of two days, the second is run again on a landing without lines; the
    lake and the catalog then hold the first day only."""
    cfg = _lake(spark, "rerun", landing_content="delta")
    landed = _landed(spark, d)
    late = F.coalesce("id_transaccion", F.lit("")) >= "3"
    for day, df in ((RUN_DATE, landed.where(~late)), (DAY_2, landed.where(late)), (DAY_2, landed.limit(0))):
        jobs.ingest_bronze(spark, cfg, day, contratos=df, is_table=True)
        jobs.curate_transacciones(spark, cfg, day)
        jobs.register_layers(spark, cfg, day)
    return spark.table(f"{cfg.gold_db}.transacciones_curated").select(*TRANSACCION_COLUMNS)


def _optional_riesgos(spark: SparkSession, d: str) -> DataFrame:
    """A3: a landing without the risk file; rows of each bronze dataset that the
    day then has."""
    cfg = _lake(spark, "optional")
    _contratos(spark, d).write.option("header", True).csv(f"{cfg.landing}/contratos.csv")
    jobs.ingest_bronze(spark, cfg, RUN_DATE)
    found = [n for n in ("transacciones", "proveedores", "clientes", "riesgos_precios")
             if versions.current(spark, cfg.bronze_path(n))]
    rows = [read_partition(spark, cfg.bronze_path(n), RUN_DATE, schema=BRONZE_SCHEMAS[n]).select(
        F.lit(n).alias("dataset")) for n in found]
    return reduce(DataFrame.unionByName, rows).groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"))


def _gated_warehouse(spark: SparkSession, d: str) -> DataFrame:
    """The first day is loaded; on the second, with other amounts, the load is
    disabled, so the warehouse and its views stay as they were."""
    cfg = _lake(spark, "gate")
    landed = _landed(spark, d)
    for day, lines, enabled in ((RUN_DATE, landed, True),
                                (DAY_2, landed.withColumn("cantidad_kwh", F.lit("0")), False)):
        jobs.ingest_bronze(spark, cfg, day, contratos=lines, is_table=True)
        jobs.curate_transacciones(spark, cfg, day)
        jobs.load_warehouse(spark, replace(cfg, warehouse_enabled=enabled), day)
    return spark.table(f"{cfg.dwh_gold_db}.transacciones").drop("load_date")


def _two_halves(spark: SparkSession, d: str, name: str, days, **options) -> LakeConfig:
    """A delta lake with validation: purchases come in on the first day, all other
    lines on the second; ids given twice fall on both. ``days``: in what order."""
    cfg = _lake(spark, name, landing_content="delta", quarantine=True, **options)
    landed = _landed(spark, d)
    bought = F.col("tipo_transaccion") == "Compra"
    for day in days:
        jobs.ingest_bronze(spark, cfg, day, contratos=landed.where(bought if day == RUN_DATE else ~bought), is_table=True)
    return cfg


def _daily_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """S8 in the bronze job: what two days' landings leave in quarantine."""
    cfg = _two_halves(spark, d, "quarantine", (RUN_DATE, DAY_2))
    return read_dataset(spark, cfg.bronze_path("cuarentena"), BRONZE_SCHEMAS["cuarentena"]).drop(
        "processed_date", "year", "month")


def _zone_unique_ids(spark: SparkSession, d: str) -> DataFrame:
    """S8 across days: bronze transactions of both days, the first day run again
    after the second; no id twice."""
    cfg = _two_halves(spark, d, "unique", (RUN_DATE, DAY_2, RUN_DATE))
    return read_dataset(spark, cfg.bronze_path("transacciones"), BRONZE_SCHEMAS["transacciones"]).select(
        *TRANSACCION_COLUMNS, "day")


def _incremental_restated_file(spark: SparkSession, d: str) -> DataFrame:
    """Landing files, one for each range of lines that a task reads, come in
    with wrong amounts and are written again under their names; the next intake
    restates the first day. Nobody else reads this lake, so what was restated need
    not stay."""
    cfg = _lake(spark, "ledger", landing_content="delta", intake="ledger", keep_versions=1)
    path = scratch_path(spark, "landed")
    landed = _landed(spark, d, path)
    sold = landed.where("tipo_transaccion = 'VENTA'")
    rest = landed.where("tipo_transaccion <> 'VENTA'")
    _write_landing(sold, f"{cfg.landing}/contratos/ventas")
    _write_landing(rest.withColumn("cantidad_kwh", F.lit("0")), f"{cfg.landing}/contratos/otros")
    intake.ingest_bronze_ledger(spark, cfg, RUN_DATE)
    _write_landing(rest, f"{cfg.root}/again")
    remove_path(spark, path)                     # all of it is landing text by now
    _replace_files(spark, f"{cfg.root}/again", f"{cfg.landing}/contratos/otros")
    intake.ingest_bronze_ledger(spark, cfg, DAY_2)
    return read_dataset(spark, cfg.bronze_path("transacciones"), BRONZE_SCHEMAS["transacciones"])


def _replace_files(spark: SparkSession, new: str, old: str) -> None:
    """Move each file of one folder over that of another with the same part number.
    Every file must find its fellow: one left behind would keep its lines twice."""
    sc = spark.sparkContext
    fs = (path := sc._jvm.org.apache.hadoop.fs.Path)(old).getFileSystem(sc._jsc.hadoopConfiguration())
    parts = lambda at: {f.getPath().getName()[:10]: f.getPath() for f in fs.listStatus(path(at))
                        if f.getPath().getName().startswith("part-")}
    found, names = parts(new), parts(old)
    if found.keys() != names.keys():
        raise ValueError(f"{new} and {old} have different part files")
    for part, target in names.items():
        fs.delete(target, False)
        fs.rename(found[part], target)


def _registered(spark: SparkSession, d: str, name: str) -> LakeConfig:
    """Two days of bronze, registered, with the stored views of the second."""
    cfg = _lake(spark, name)
    landed = _landed(spark, d)
    for day in (RUN_DATE, DAY_2):
        jobs.ingest_bronze(spark, cfg, day, contratos=landed, is_table=True)
        jobs.register_layers(spark, cfg, day)
        jobs.create_views(spark, cfg, day)
    return cfg


def _job_view(name: str):
    """A7 + B7 + G7: a stored lake view."""
    return lambda spark, d: spark.table(f"{_registered(spark, d, 'views').bronze_db}.{name}")


def _job_view_export(name: str):
    """B3 + G8: a stored view exported by the job, read back."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        cfg = _registered(spark, d, "exports")
        path, = jobs.export_views(spark, cfg, [name], DAY_2)
        schema = spark.table(f"{cfg.bronze_db}.{name}").schema
        return spark.read.schema(schema).option("header", False).csv(path)
    return query


def _adhoc_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary as ad-hoc SQL on the registered aggregate, pruned by
    the processing year."""
    cfg = _bronze_lake(spark, d, "adhoc", avg_scale=AVG_SCALE)
    jobs.aggregate_transacciones(spark, cfg, RUN_DATE)
    jobs.register_layers(spark, cfg, RUN_DATE)
    return run_sql(spark, f"""
        SELECT tipo_energia, count(*) AS cnt, round(sum(total_kwh), 3) AS kwh FROM transacciones_agg
        WHERE year = {RUN_DATE.year} GROUP BY tipo_energia""", database=cfg.gold_db)


def _pruned_days(spark: SparkSession, d: str) -> DataFrame:
    """A4 + C12: one of three partitions, by a predicate on their columns."""
    path = f"{scratch_path(spark, 'lake')}/transacciones"
    tx = bronze.split_transacciones(_landed(spark, d))
    for day, kind in ((RUN_DATE, "compra"), (DAY_2, "venta"), (DAY_3, "ajuste")):
        pq.write_partitioned(stamp(tx.where(F.lower("tipo_transaccion") == kind), day), path)
    return read_dataset(spark, path).where(F.col("day") == DAY_2.day).select(*TRANSACCION_COLUMNS)


def _warehouse_two_days(spark: SparkSession, d: str) -> LakeConfig:
    """B6 on two days and a re-run, over the same landing. Nobody else reads this
    lake, so what the re-run replaces need not stay."""
    cfg = _lake(spark, "warehouse", export_limit=EXPORT_LIMIT, keep_versions=1)
    landed = _landed(spark, d)
    for day in (RUN_DATE, DAY_2, DAY_2):
        jobs.ingest_bronze(spark, cfg, day, contratos=landed, is_table=True)
        jobs.curate_transacciones(spark, cfg, day)
        jobs.curate_proveedores(spark, cfg, day)
        jobs.load_warehouse(spark, cfg, day)
    return cfg


def _job_warehouse_view(spark: SparkSession, d: str) -> DataFrame:
    return spark.table(f"{_warehouse_two_days(spark, d).dwh_gold_db}.v_compras")


def _job_warehouse_export(name: str):
    """B4 + G11: the bounded CSV of one warehouse table, read back."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        cfg = _warehouse_two_days(spark, d)
        jobs.export_warehouse(spark, cfg, DAY_2)
        schema = spark.table(f"{cfg.dwh_gold_db}.{name}").drop("load_date").schema
        return spark.read.schema(schema).option("header", True).csv(f"{cfg.exports}/warehouse/{name}")
    return query


def _daily_run(spark: SparkSession, d: str) -> DataFrame:
    """The whole run, from landing text to the warehouse aggregate."""
    cfg = _landing_lake(spark, d, "daily", "contratos/contratos.csv", avg_scale=AVG_SCALE)
    daily_run.run_all(spark, cfg, RUN_DATE)
    return spark.table(f"{cfg.dwh_analytics_db}.transacciones_agg").drop("load_date")


def _warehouse_lake(spark: SparkSession, gold: dict[str, DataFrame]) -> LakeConfig:
    """The given gold datasets of ``RUN_DATE`` written to a lake in the shared
    folder, then loaded by the warehouse job (which loads whichever gold
    datasets exist) into warehouse schemas of its own."""
    cfg = _lake(spark, "warehouse")
    for name, df in gold.items():
        pq.write_day(stamp(df, RUN_DATE), cfg.gold_path(name), RUN_DATE)
    jobs.load_warehouse(spark, cfg, RUN_DATE)
    return cfg


def _warehouse_transacciones_agg(spark: SparkSession, d: str) -> DataFrame:
    """B5 + B6 + G10: typed warehouse table loaded by column name into its
    ``load_date`` partition, read back without the partition column."""
    cfg = _warehouse_lake(spark, {"transacciones_agg": _agg(spark, d)})
    return spark.table(f"{cfg.dwh_analytics_db}.transacciones_agg").drop("load_date")


def _warehouse_v_clientes(spark: SparkSession, d: str) -> DataFrame:
    """B9 + G10: the stored warehouse client view over the loaded table."""
    cfg = _warehouse_lake(spark, {"transacciones_curated": _curated_tx(spark, d)})
    return spark.table(f"{cfg.dwh_gold_db}.v_clientes")


QUERIES.update({
    "events_asof_profile": _events_asof_profile,
    "sensitive_validated": lambda s, d: detection.validated_counts(table(s, d, "documents")),
    "warehouse_transacciones_agg": _warehouse_transacciones_agg,
    "warehouse_v_clientes": _warehouse_v_clientes,
    "ingested_transacciones": _ingested("transacciones"),
    "ingested_riesgos": _ingested("riesgos_precios"),
    "ingested_from_fallback_path": _ingested("clientes", "contratos/contratos.csv"),
    "incremental_transacciones": _incremental("transacciones"),
    "incremental_riesgos": _incremental("riesgos_precios"),
    "job_transacciones_curated": _gold(jobs.curate_transacciones, "transacciones_curated", TRANSACCION_COLUMNS),
    "job_transacciones_agg": _job_agg,
    "job_proveedores_curated": _gold(jobs.curate_proveedores, "proveedores", PROVEEDOR_COLUMNS),
    "job_clientes_curated": _gold(jobs.curate_clientes, "clientes", ["cliente_proveedor", "tipo_cliente", "ciudad"]),
    "energy_totals_two_days": _energy_totals_two_days,
    "energy_totals_delta": _energy_totals_delta,
    "clientes_restated_day": _clientes_restated_day,
    "clientes_schema_drift": _clientes_schema_drift,
    "clientes_latest_day": _clientes_latest_day,
    "proveedores_type_drift": _proveedores_type_drift,
    "rerun_empty_day": _rerun_empty_day,
    "daily_quarantine": _daily_quarantine,
    "zone_unique_ids": _zone_unique_ids,
    "incremental_restated_file": _incremental_restated_file,
    "job_v_servicio": _job_view("v_servicio"),
    "job_v_clientes": _job_view("v_clientes"),
    "job_export_v_clientes": _job_view_export("v_clientes"),
    "job_export_v_compras": _job_view_export("v_compras"),
    "adhoc_summary": _adhoc_summary,
    "pruned_days": _pruned_days,
    "job_warehouse_v_compras": _job_warehouse_view,
    "job_export_transacciones": _job_warehouse_export("transacciones"),
    "job_export_proveedores": _job_warehouse_export("proveedores"),
    "daily_run_transacciones_agg": _daily_run,
    "lake_transacciones": _lake_transacciones,
    "streamed_alerts": _streamed_alerts,
    "streamed_flat": _streamed_flat,
    "archived_events": _archived_events,
    "archive_compacted": _archive_compacted,
    "optional_riesgos": _optional_riesgos,
    "gated_warehouse": _gated_warehouse,
    "exported_v_ventas": _exported_v_ventas,
    "exported_transacciones_csv": _exported_transacciones_csv,
})


_PROFILES_SQL = """
portfolio AS (
  SELECT o_custkey, count(*) AS n_orders,
         CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS BIGINT) AS spent_units
  FROM orders GROUP BY o_custkey),
prof AS (
  SELECT c_custkey AS user_id, c_name, c_mktsegment, c_acctbal,
         coalesce(n_orders, 0) AS n_orders, coalesce(spent_units, 0) AS spent_units
  FROM customer LEFT JOIN portfolio ON c_custkey = o_custkey)"""

ORACLE_SQL.update({
    "stream_enriched_alerts": f"""
WITH {_PROFILES_SQL},
sc AS (
  SELECT e.*, p.c_name, p.c_mktsegment, p.c_acctbal, p.n_orders,
         coalesce(e.value, 0.0) / (coalesce(p.n_orders, 0) + 1) AS score
  FROM events e LEFT JOIN prof p ON e.user_id = p.user_id)
SELECT event_id, ts, user_id, event_type, value, c_name, c_mktsegment, n_orders, score,
       CASE WHEN coalesce(c_acctbal, 0.0) >= 0 THEN 'COMPRAR' ELSE 'VENDER' END AS action
FROM sc WHERE score > {ALERT_THRESHOLD}""",
    "streamed_flat": f"""
WITH {_PROFILES_SQL}
SELECT e.user_id, event_id, ts, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k,
       c_name, c_mktsegment, c_acctbal, n_orders, spent_units
FROM events e LEFT JOIN prof p ON e.user_id = p.user_id""",
    "archived_events": """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS event_date
FROM events""",
    "flattened_events": """
SELECT event_id, ts, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS INTEGER) AS props_k
FROM events""",
})

ORACLE_SQL["archive_compacted"] = ORACLE_SQL["archived_events"]
ORACLE_SQL["gated_warehouse"] = ORACLE_SQL["transacciones_curated"]
ORACLE_SQL["optional_riesgos"] = f"""{_CTE}
SELECT 'transacciones' AS dataset, count(*) AS n_rows FROM tx
UNION ALL SELECT 'proveedores', count(*) FROM pv
UNION ALL SELECT 'clientes', count(*) FROM cl"""
ORACLE_SQL["streamed_alerts"] = ORACLE_SQL["stream_enriched_alerts"]
ORACLE_SQL["exported_v_ventas"] = ORACLE_SQL["v_ventas"]
ORACLE_SQL["lake_transacciones"] = ORACLE_SQL["stamped_transacciones"]
ORACLE_SQL["ingested_transacciones"] = ORACLE_SQL["stamped_transacciones"]
ORACLE_SQL["warehouse_transacciones_agg"] = ORACLE_SQL["transacciones_agg"]
ORACLE_SQL["warehouse_v_clientes"] = ORACLE_SQL["dwh_v_clientes"]
ORACLE_SQL["incremental_transacciones"] = ORACLE_SQL["stamped_transacciones"]
ORACLE_SQL["exported_transacciones_csv"] = ORACLE_SQL["export_transacciones"]

_RIESGOS_SQL = f"""
SELECT lower(c_mktsegment) AS tipo_cliente, CAST(count(*) % 97 + 0.5 AS DOUBLE) AS riesgo_pct,
       'clientes ' || count(*) AS comentario, {_STAMP_SQL}
FROM customer GROUP BY lower(c_mktsegment)"""
_CLIENTS_SQL = """
SELECT cliente_proveedor, max(tipo_cliente) AS tipo_cliente, {city} AS ciudad
FROM cl a WHERE {which}
  AND tipo_cliente = (SELECT max(tipo_cliente) FROM cl b WHERE a.cliente_proveedor = b.cliente_proveedor)
GROUP BY cliente_proveedor"""

ORACLE_SQL.update({
    "ingested_riesgos": _RIESGOS_SQL,
    "incremental_riesgos": _RIESGOS_SQL,
    "ingested_from_fallback_path": f"{_CTE} SELECT cl.*, {_STAMP_SQL} FROM cl",
    "job_transacciones_curated": ORACLE_SQL["transacciones_curated"],
    "job_transacciones_agg": f"""{_CTE}
        SELECT tipo_energia, ciudad, fecha_transaccion, sum(cantidad_kwh) AS total_kwh,
               round(avg(precio_kwh), 9) AS avg_precio_kwh
        FROM tx GROUP BY tipo_energia, ciudad, fecha_transaccion""",
    "job_proveedores_curated": ORACLE_SQL["proveedores_curated"],
    "job_clientes_curated": ORACLE_SQL["clientes_curated"],
    "energy_totals_two_days": f"{_CTE} SELECT tipo_energia, sum(cantidad_kwh) AS total_kwh FROM tx GROUP BY tipo_energia",
    "energy_totals_delta": f"{_CTE} SELECT tipo_energia, sum(cantidad_kwh) AS total_kwh FROM tx GROUP BY tipo_energia",
    "clientes_restated_day": _CTE + _CLIENTS_SQL.format(city="max(ciudad)", which="true"),
    "clientes_schema_drift": f"""{_CTE}
        {_CLIENTS_SQL.format(city="CAST(NULL AS VARCHAR)", which="right(cliente_proveedor, 1) < '5'")} UNION ALL
        {_CLIENTS_SQL.format(city="max(ciudad)", which="right(cliente_proveedor, 1) >= '5'")}""",
    "clientes_latest_day": f"""{_CTE}
        SELECT cliente_proveedor, 'agente' AS tipo_cliente, max(ciudad) AS ciudad FROM cl
        WHERE ascii(right(cliente_proveedor, 1)) % 2 = 1 GROUP BY cliente_proveedor UNION ALL
        {_CLIENTS_SQL.format(city="max(ciudad)", which="ascii(right(cliente_proveedor, 1)) % 2 = 0")}""",
    "proveedores_type_drift": f"""{_CTE}
        SELECT nombre_proveedor, tipo_energia, CAST(round(capacidad_mw * 10) AS DOUBLE) AS capacidad_mw, ciudad,
               fecha_contrato FROM pv""",
    "rerun_empty_day": f"{_CTE} SELECT * FROM tx WHERE id_transaccion < '3'",
    "job_v_servicio": ORACLE_SQL["v_servicio"],
    "job_v_clientes": ORACLE_SQL["v_clientes"],
    "job_export_v_clientes": ORACLE_SQL["v_clientes"],
    "job_export_v_compras": ORACLE_SQL["v_compras"].replace(_RD, f"DATE '{DAY_2.isoformat()}'")
    .replace(f"{RUN_DATE.day} AS day", f"{DAY_2.day} AS day"),
    "adhoc_summary": f"""{_CTE}
        SELECT tipo_energia, count(*) AS cnt, round(sum(total_kwh), 3) AS kwh FROM agg GROUP BY tipo_energia""",
    "pruned_days": f"{_CTE} SELECT * FROM tx WHERE lower(tipo_transaccion) = 'venta'",
    "job_warehouse_v_compras": ORACLE_SQL["dwh_v_compras"],
    "job_export_transacciones": ORACLE_SQL["export_transacciones"],
    "job_export_proveedores": ORACLE_SQL["export_proveedores"],
    "daily_run_transacciones_agg": ORACLE_SQL["transacciones_agg"],
})

# a provider name that is only a number, as RE2 finds it
_NUMBER_ONLY = "^[ \\t\\n\\r\\f\\v]*-?\\d+(?:[.]\\d+)?[ \\t\\n\\r\\f\\v]*$"
_QREASON = f"""
CASE WHEN regexp_matches(nombre_proveedor, '{_NUMBER_ONLY}')
          AND try_cast(capacidad_mw AS DOUBLE) IS NULL THEN '{quality.REASON_SHIFTED}'
     WHEN capacidad_mw IS NOT NULL AND trim(capacidad_mw) <> ''
          AND try_cast(capacidad_mw AS DOUBLE) IS NULL THEN '{quality.REASON_BAD_CAPACITY}'
     WHEN fecha_contrato IS NOT NULL AND trim(fecha_contrato) <> ''
          AND try_cast(fecha_contrato AS DATE) IS NULL THEN '{quality.REASON_BAD_DATE}'
END"""

ORACLE_SQL.update({
    "quarantined_providers": f"""{_CTE}
SELECT * FROM (
  SELECT nombre_proveedor, tipo_energia, capacidad_mw, ciudad, fecha_contrato, {_QREASON} AS reason
  FROM contratos WHERE nombre_proveedor IS NOT NULL) WHERE reason IS NOT NULL""",
    "provider_quality": f"""{_CTE}
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM (
  SELECT {_QREASON} AS reason FROM contratos WHERE nombre_proveedor IS NOT NULL)
GROUP BY coalesce(reason, 'accepted')""",
})

_TREASON = f"""
CASE WHEN cantidad_kwh IS NOT NULL AND trim(cantidad_kwh) <> ''
          AND try_cast(cantidad_kwh AS DOUBLE) IS NULL THEN '{quality.REASON_BAD_KWH}'
     WHEN precio_kwh IS NOT NULL AND trim(precio_kwh) <> ''
          AND try_cast(precio_kwh AS DOUBLE) IS NULL THEN '{quality.REASON_BAD_PRICE}'
     WHEN fecha_transaccion IS NOT NULL AND trim(fecha_transaccion) <> ''
          AND try_cast(fecha_transaccion AS DATE) IS NULL THEN '{quality.REASON_BAD_TX_DATE}'
END"""

ORACLE_SQL.update({
    "transaction_quality": f"""{_CTE},
tagged AS (SELECT id_transaccion, {_TREASON} AS reason FROM contratos WHERE id_transaccion IS NOT NULL)
SELECT reason, count(*) AS n FROM tagged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'accepted' AS reason, count(DISTINCT id_transaccion) AS n FROM tagged WHERE reason IS NULL
UNION ALL SELECT '{quality.REASON_DUPLICATE}' AS reason,
                 count(*) - count(DISTINCT id_transaccion) AS n FROM tagged WHERE reason IS NULL""",
    "transacciones_validated": f"""{_CTE},
clean AS (SELECT * FROM contratos WHERE id_transaccion IS NOT NULL AND ({_TREASON}) IS NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id_transaccion ORDER BY
           fecha_transaccion DESC NULLS LAST, tipo_transaccion DESC NULLS LAST,
           cliente_proveedor DESC NULLS LAST, cantidad_kwh DESC NULLS LAST,
           precio_kwh DESC NULLS LAST, tipo_energia DESC NULLS LAST,
           hora_transaccion DESC NULLS LAST, ciudad DESC NULLS LAST) AS rn
  FROM clean)
SELECT id_transaccion, try_cast(fecha_transaccion AS DATE) AS fecha_transaccion, tipo_transaccion,
       cliente_proveedor, try_cast(cantidad_kwh AS DOUBLE) AS cantidad_kwh,
       try_cast(precio_kwh AS DOUBLE) AS precio_kwh, tipo_energia, hora_transaccion, ciudad
FROM ranked WHERE rn = 1""",
})

_TX_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in [*TRANSACCION_COLUMNS[1:], *CONTRATOS_RAW.names[9:]])
_TWO_DAYS = f"""{_CTE},
dealt AS (SELECT *, if(tipo_transaccion = 'Compra', {RUN_DATE.day}, {DAY_2.day}) AS day FROM contratos),
judged AS (SELECT *, {_TREASON} AS reason FROM dealt WHERE id_transaccion IS NOT NULL),
nth AS (SELECT *, row_number() OVER (PARTITION BY day, id_transaccion ORDER BY {_TX_ORDER}) AS rn
        FROM judged WHERE reason IS NULL),
first_day AS (SELECT id_transaccion FROM nth WHERE day = {RUN_DATE.day}),
late AS (SELECT *, day = {DAY_2.day} AND id_transaccion IN (SELECT id_transaccion FROM first_day) AS again
         FROM nth WHERE rn = 1)"""
_LINE = ", ".join(CONTRATOS_RAW.names)
ORACLE_SQL.update({
    "daily_quarantine": f"""{_TWO_DAYS}
SELECT 'transacciones' AS dataset, reason, {_LINE}, day FROM judged WHERE reason IS NOT NULL UNION ALL
SELECT 'transacciones', '{quality.REASON_DUPLICATE}', {_LINE}, day FROM nth WHERE rn > 1 UNION ALL
SELECT 'transacciones', '{quality.REASON_ACCEPTED_BEFORE}', {_LINE}, day FROM late WHERE again UNION ALL
SELECT 'proveedores', r, {_LINE}, day FROM (
  SELECT *, {_QREASON} AS r FROM dealt WHERE nombre_proveedor IS NOT NULL) WHERE r IS NOT NULL""",
    "zone_unique_ids": f"""{_TWO_DAYS}
SELECT id_transaccion, try_cast(fecha_transaccion AS DATE) AS fecha_transaccion, tipo_transaccion,
       cliente_proveedor, try_cast(cantidad_kwh AS DOUBLE) AS cantidad_kwh,
       try_cast(precio_kwh AS DOUBLE) AS precio_kwh, tipo_energia, hora_transaccion, ciudad, day
FROM late WHERE NOT again""",
    "incremental_restated_file": ORACLE_SQL["stamped_transacciones"],
})

# Stated apart from the operator's patterns, for an engine without look-around:
# what may not stand next to a number is matched as a neighbour, in a text whose
# other characters are doubled so that two numbers can share none.
_PII = {
    "emails": ("text", r"[\w.%+-]+@(?:[0-9A-Za-z-]+[.])+[A-Za-z][A-Za-z]+"),
    "phones": ("wide", r"[+][+]\d\d?\d?  [(][(]\d{3}[)][)]  \d{3}--\d{4}(?:\D|$)"),
    "cards": ("wide", r"(?:^|\D)\d{4}(?:  |--)?\d{4}(?:  |--)?\d{4}(?:  |--)?\d{4}(?:\D|$)"),
    "ipv4s": ("wide", r"(?:^|\D)\d{1,3}[.][.]\d{1,3}[.][.]\d{1,3}[.][.]\d{1,3}(?:\D|$)"),
    "secrets": ("text", r'(?i)(?:api_key|password|secret|token)[ \t\n\v\f\r]*=[ \t\n\v\f\r]*"[^"]+"'),
}
_PII_COUNTS = ",\n  ".join(
    f"CAST(coalesce(len(regexp_extract_all({column}, '{p}')), 0) AS BIGINT) AS {k}" for k, (column, p) in _PII.items())
_PII_FLAG = " OR ".join(f"{k} > 0" for k in _PII)
_PII_SUMS = ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in _PII)
ORACLE_SQL["pii_counts"] = f"""
SELECT lang, count(*) AS n_docs, count(*) FILTER (WHERE {_PII_FLAG}) AS n_flagged, {_PII_SUMS}
FROM (SELECT lang,
  {_PII_COUNTS}
  FROM (SELECT lang, text, regexp_replace(text, '([^0-9])', '\\1\\1', 'g') AS wide FROM documents))
GROUP BY lang"""

ORACLE_SQL["events_asof_profile"] = """
WITH versions AS (
  SELECT o_custkey AS user_id, TIMESTAMP '2024-01-01' + to_hours(CAST(o_orderkey % 700 AS INTEGER)) AS valid_from,
         o_totalprice AS last_price, o_orderpriority AS last_priority FROM orders),
one AS (
  SELECT * FROM versions QUALIFY row_number() OVER (
    PARTITION BY user_id, valid_from ORDER BY last_price DESC NULLS LAST, last_priority DESC NULLS LAST) = 1)
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, o.valid_from, o.last_price, o.last_priority
FROM events e ASOF LEFT JOIN one o ON e.user_id = o.user_id AND e.ts >= o.valid_from"""

_DIGIT = "CAST(substr(x, CAST(i AS INTEGER), 1) AS INTEGER)"
_LUHN = f"""list_sum(list_transform(range(1, 17), lambda i: if(i % 2 = 0, {_DIGIT},
  if({_DIGIT} > 4, 2 * {_DIGIT} - 9, 2 * {_DIGIT})))) % 10 = 0 AND substr(x, 1, 1) BETWEEN '2' AND '6'"""
_FOUND = {k: f"regexp_extract_all({column}, '{p}')" for k, (column, p) in _PII.items()}
_FOUND["cards"] = (f"list_filter(list_transform({_FOUND['cards']}, lambda m: regexp_replace(m, '[^0-9]', '', 'g')), "
                   f"lambda x: {_LUHN})")
_FOUND["ipv4s"] = (f"list_filter({_FOUND['ipv4s']}, lambda m: len(list_filter(regexp_extract_all(m, '[0-9]+'), "
                   "lambda x: CAST(x AS INTEGER) > 255)) = 0)")
ORACLE_SQL["sensitive_validated"] = f"""
SELECT doc_id, {", ".join(f"CAST(coalesce(len({v}), 0) AS BIGINT) AS {k}" for k, v in _FOUND.items())}
FROM (SELECT doc_id, text, regexp_replace(text, '([^0-9])', '\\1\\1', 'g') AS wide FROM documents)"""
