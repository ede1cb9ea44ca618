"""Layer jobs: each reads its inputs, applies operators and writes one or
more datasets (G1-G11).  Every job takes the run's fixed ``run_date``.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.config import PARQUET_CODEC, LakeConfig
from wattlake.functions import stamp
from wattlake.operators import aggregates, bronze, curated, exports, views
from wattlake.plans import zone
from wattlake.schemas import BRONZE_SCHEMAS, GOLD_SCHEMAS
from wattlake.session import remove_path, resolve_run_date
from wattlake.sinks import parquet as pq
from wattlake.sinks import text, warehouse
from wattlake.sources import catalog, versions
from wattlake.sources.lake import partition_filter, read_partition
from wattlake.sources.landing import contract_paths, read_first_existing, risk_paths

log = logging.getLogger(__name__)

GOLD_DATASETS = ["transacciones_curated", "transacciones_agg", "proveedores", "clientes"]
EXPORTED_VIEWS = ["v_clientes", "v_ventas", "v_compras"]
# Order of the lines within each bronze file. A provider has many lines, and its
# name, capacity and city go together: side by side they take little space, also
# in the gold and warehouse files that are made from them.
SORTED_BY = {"proveedores": ["nombre_proveedor", "fecha_contrato"]}


def _scope(cfg: LakeConfig, run_date: _dt.date) -> _dt.date | None:
    """The bronze partition a gold job reads; None: all of them. A snapshot
    landing's partitions hold the same lines again, so only the latest counts."""
    return run_date if cfg.is_snapshot or cfg.source_scope == "run_date" else None


def _current(cfg: LakeConfig, run_date: _dt.date) -> str | None:
    """Predicate of the lake rows that count, on the partition columns."""
    d = run_date
    return f"year = {d.year} AND month = {d.month} AND day = {d.day}" if cfg.is_snapshot else None


# ---- G1 bronze ------------------------------------------------------------
def ingest_bronze(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date | None = None,
                  contratos: DataFrame | None = None, riesgos: DataFrame | None = None,
                  is_table: bool = False) -> list[str]:
    """Landing contract/risk text -> typed bronze datasets for ``run_date``.

    ``is_table``: the given ``contratos`` is read from a written table, by column,
    so no staging copy is made of it.

    A missing landing file skips its datasets; a contract file lacking the
    columns of a split skips that split.
    """
    run_date = resolve_run_date(spark, run_date or cfg.run_date)
    if contratos is None:
        contratos = read_first_existing(spark, contract_paths(cfg.landing))
    if riesgos is None:
        riesgos = read_first_existing(spark, risk_paths(cfg.landing))
    written: list[str] = []
    if contratos is not None:
        cached, staged = False, None
        shared = not is_table and len(bronze.split_contratos(contratos)) > 1   # schema-only check
        if shared and cfg.landing_staging == "parquet":
            staged = f"{cfg.bronze}/_staging/contratos/run_date={run_date.isoformat()}"
            contratos.write.mode("overwrite").parquet(staged, compression=PARQUET_CODEC)
            contratos = spark.read.parquet(staged)
        elif shared and cfg.landing_staging == "persist":
            contratos.persist(StorageLevel.MEMORY_AND_DISK)
            cached = True
        try:
            written += write_lines(spark, cfg, contratos, run_date)
        finally:
            if cached:
                contratos.unpersist()
            if staged:
                remove_path(spark, staged)
    else:
        log.warning("no contract file under %s; bronze contract datasets skipped", cfg.landing)
    return written + write_riesgos(cfg, riesgos, run_date)


def write_lines(spark: SparkSession, cfg: LakeConfig, contratos: DataFrame, run_date: _dt.date) -> list[str]:
    """The bronze datasets of a day's contract lines; with ``cfg.quarantine``,
    only lines that pass the zone's rules reach transactions and providers."""
    written: list[str] = []

    def write(name: str, df: DataFrame) -> None:
        if name in SORTED_BY:       # within each task: nothing is shuffled
            df = df.sortWithinPartitions(*SORTED_BY[name])
        pq.write_day(stamp(df, run_date), cfg.bronze_path(name), run_date, cfg.write_mode, keep=cfg.keep_versions)
        written.append(name)

    splits = bronze.split_contratos(contratos)
    if cfg.quarantine:
        zone.validated(spark, cfg, contratos, run_date, write)
        if not cfg.is_snapshot:
            zone.record(spark, cfg, read_partition(spark, cfg.bronze_path("transacciones"), run_date,
                                                   schema=BRONZE_SCHEMAS["transacciones"]), run_date)
    for name, df in splits.items():
        if name not in written:
            write(name, df)
    return written


def write_riesgos(cfg: LakeConfig, riesgos: DataFrame | None, run_date: _dt.date) -> list[str]:
    """The risk table, a small snapshot, as the bronze partition of the day."""
    if riesgos is None:
        return []
    pq.write_day(stamp(bronze.type_riesgos(riesgos), run_date), cfg.bronze_path("riesgos_precios"), run_date,
                 cfg.write_mode, keep=cfg.keep_versions)
    return ["riesgos_precios"]


# ---- G2-G5 gold ------------------------------------------------------------
def _bronze(spark, cfg, name, run_date):
    """The bronze rows that a gold job reads, and the versions that they are."""
    root, scope = cfg.bronze_path(name), _scope(cfg, run_date)
    now = versions.current(spark, root)
    if not now:
        return None, {}
    now = {d: v for d, v in now.items() if scope is None or d == scope}
    return versions.read(spark, root, list(now.values()), BRONZE_SCHEMAS[name]), {f"bronze/{name}": versions.names(now)}


def _write_gold(df, cfg, name, run_date, inputs):
    pq.write_day(stamp(df, run_date), cfg.gold_path(name), run_date, cfg.write_mode, inputs, cfg.keep_versions)
    return True


def curate_transacciones(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date) -> bool:
    df, inputs = _bronze(spark, cfg, "transacciones", run_date)
    if df is None:
        return False
    return _write_gold(curated.curate_transacciones(df), cfg, "transacciones_curated", run_date, inputs)


def aggregate_transacciones(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date) -> bool:
    df, inputs = _bronze(spark, cfg, "transacciones", run_date)
    if df is None:
        return False
    agg = aggregates.aggregate_transacciones(df, exact_scale=cfg.avg_scale)
    return _write_gold(agg, cfg, "transacciones_agg", run_date, inputs)


def curate_proveedores(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date) -> bool:
    df, inputs = _bronze(spark, cfg, "proveedores", run_date)
    if df is None:
        return False
    return _write_gold(curated.curate_proveedores(df, distinct=cfg.distinct_providers), cfg, "proveedores", run_date,
                       inputs)


def _base_snapshot(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date, now: dict) -> versions.Version | None:
    """The latest client snapshot before ``run_date`` that still stands: it was
    made from the versions of all bronze days up to it that are current. ``now``:
    bronze day -> version."""
    root = cfg.gold_path("clientes")
    gold = versions.current(spark, root)
    for day in sorted((d for d in gold if d < run_date), reverse=True):
        made_from = versions.details(spark, root, gold[day])["inputs"].get("bronze/clientes")
        if made_from == versions.names({d: v for d, v in now.items() if d <= day}):
            return gold[day]
    return None


def curate_clientes(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date) -> bool:
    """One row per client.

    With ``source_scope="run_date"`` each gold partition is a full snapshot: the
    latest earlier snapshot that still stands is merged with every bronze day
    after it up to ``run_date`` - normally just the day's - and deduplicated again.
    The survivor rule is a ``max``, which is associative, so this equals
    deduplicating the whole bronze history while reading one snapshot.  Each
    snapshot records the bronze versions that are in it, those that its base was
    made from included. A day whose gold step never ran is caught up by the next
    run; a bronze day that is written again, also while a snapshot is being made,
    takes the snapshots without it out of use, and the next run rebuilds from the
    last one before it.
    """
    root = cfg.bronze_path("clientes")
    now = {d: v for d, v in versions.current(spark, root).items() if d <= run_date}
    if not now:
        return False
    base = _base_snapshot(spark, cfg, run_date, now) if cfg.source_scope == "run_date" else None
    later = [v for d, v in now.items() if base is None or d > base.day]
    df = versions.read(spark, root, later, BRONZE_SCHEMAS["clientes"])
    if base is not None:
        df = df.unionByName(versions.read(spark, cfg.gold_path("clientes"), [base], GOLD_SCHEMAS["clientes"]))
    return _write_gold(curated.dedup_clientes(df), cfg, "clientes", run_date, {"bronze/clientes": versions.names(now)})


# ---- G9 analytics ------------------------------------------------------------
def energy_totals(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date) -> bool:
    """kWh per energy type, each contract line counted once. Where the run's
    aggregate already covers all lines (a snapshot landing, or a delta landing
    re-read whole) that partition alone is summed; otherwise the partitions of
    all days up to it add up."""
    whole = cfg.is_snapshot or cfg.source_scope == "all"
    agg = read_partition(spark, cfg.gold_path("transacciones_agg"), run_date if whole else None, optional=True,
                         schema=GOLD_SCHEMAS["transacciones_agg"])
    if agg is None:
        return False
    agg = agg.where(F.make_date("year", "month", "day") <= F.lit(run_date))
    pq.write_dataset(aggregates.energy_totals(agg), cfg.gold_path("analytics/tipo_energia"))
    return True


# ---- catalog, G7 views, G8 view export --------------------------------------
def register_layers(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date | None = None) -> list[str]:
    """Register every lake dataset that exists; for tables already registered
    add the ``run_date`` partition (or re-list all partitions without one)."""
    done = catalog.register_layer(spark, cfg.bronze_db, cfg.bronze, BRONZE_SCHEMAS, run_date=run_date,
                                  db_location=cfg.catalog_location(cfg.bronze_db))
    done += catalog.register_layer(spark, cfg.gold_db, cfg.gold, {n: GOLD_SCHEMAS[n] for n in GOLD_DATASETS},
                                   run_date=run_date, db_location=cfg.catalog_location(cfg.gold_db))
    if catalog.register_dataset(spark, cfg.gold_db, "tipo_energia", cfg.gold_path("analytics/tipo_energia"),
                                GOLD_SCHEMAS["tipo_energia"], partitioned=False,
                                db_location=cfg.catalog_location(cfg.gold_db)):
        done.append(f"{cfg.gold_db}.tipo_energia")
    return done


def create_views(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date | None = None) -> list[str]:
    """The lake views; over a snapshot landing, of the partition of ``run_date``
    (each run moves them on)."""
    run_date = resolve_run_date(spark, run_date or cfg.run_date)
    tx, cl = f"{cfg.bronze_db}.transacciones", f"{cfg.bronze_db}.clientes"
    catalog.require_tables(spark, [tx, cl])
    return views.create_lake_views(spark, cfg.bronze_db, tx, cl, _current(cfg, run_date))


def export_views(spark: SparkSession, cfg: LakeConfig, names=EXPORTED_VIEWS,
                 run_date: _dt.date | None = None) -> list[str]:
    """Each view as delimited text.  With ``cfg.incremental_exports`` and a
    ``run_date``, views carrying the processing-date columns export only that
    partition (pruned through the view) into its own folder; views without
    them (``v_clientes`` aggregates all history) are exported whole."""
    out = []
    for v in names:
        df = spark.table(f"{cfg.bronze_db}.{v}")
        path = f"{cfg.exports}/{v}"
        if cfg.incremental_exports and run_date is not None and "year" in df.columns:
            df = df.where(partition_filter(run_date))
            path = f"{path}/year={run_date.year}/month={run_date.month}/day={run_date.day}"
        text.export_text(df, path)
        out.append(path)
    return out


# ---- G10 warehouse -------------------------------------------------------------
def load_warehouse(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date,
                   reload: bool = False) -> list[str]:
    """Create the warehouse tables and load gold into them.

    Default: the gold rows of ``run_date`` replace the ``load_date =
    run_date`` partition (idempotent on re-run or retry).  ``reload=True``
    replaces each table with the whole gold dataset.  Over a snapshot landing
    each load holds all lines, and the views show the latest.
    """
    if not cfg.warehouse_enabled:
        log.info("warehouse load disabled; skipped")
        return []
    warehouse.create_warehouse(spark, cfg)
    scope = None if reload else run_date
    sources = {
        f"{cfg.dwh_gold_db}.transacciones": "transacciones_curated",
        f"{cfg.dwh_analytics_db}.transacciones_agg": "transacciones_agg",
        f"{cfg.dwh_gold_db}.proveedores": "proveedores",
    }
    loaded = []
    for table, ds in sources.items():
        df = read_partition(spark, cfg.gold_path(ds), scope, optional=True, schema=GOLD_SCHEMAS[ds])
        if df is None:
            continue
        if reload:
            warehouse.reload_table(spark, df, table)
        else:
            warehouse.load_table(spark, df, table, run_date)
        loaded.append(table)
    only = f"{warehouse.LOAD_DATE} = DATE '{run_date.isoformat()}'" if cfg.is_snapshot else None
    views.create_dwh_views(spark, cfg.dwh_gold_db, f"{cfg.dwh_gold_db}.transacciones", only)
    return loaded


# ---- G11 warehouse export --------------------------------------------------------
def export_warehouse(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date | None = None) -> list[str]:
    """Bounded exports of the warehouse tables (over a snapshot landing, of the
    load of ``run_date``). A table that was never created is left out; any
    other error ends the job."""
    run_date = resolve_run_date(spark, run_date or cfg.run_date)
    out = []
    for name, select in (("transacciones", exports.top_transacciones), ("proveedores", exports.top_proveedores)):
        table = f"{cfg.dwh_gold_db}.{name}"
        if not spark.catalog.tableExists(table):
            log.warning("no table %s; its export is skipped", table)
            continue
        df = spark.table(table)
        if cfg.is_snapshot:
            df = df.where(F.col(warehouse.LOAD_DATE) == F.lit(run_date))
        path = f"{cfg.exports}/warehouse/{name}"
        text.export_bounded_csv(select(df, cfg.export_limit), path)
        out.append(path)
    return out
