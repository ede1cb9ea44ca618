"""End-to-end run on a temporary lake: bronze -> gold -> warehouse -> exports."""

import datetime as dt
import glob
import os

import pytest

from tests.sample_data import write_landing
from wattlake.config import APPEND, LakeConfig
from wattlake.plans import daily_run, jobs
from wattlake.sources.lake import read_dataset

RD = dt.date(2024, 6, 1)


def _cfg(root, **kw):
    n = os.path.basename(root.rstrip("/")).replace("-", "_").lower()
    return LakeConfig(root=root, run_date=RD, bronze_db=f"b_{n}", gold_db=f"g_{n}",
                      dwh_gold_db=f"dg_{n}", dwh_analytics_db=f"da_{n}", **kw)


def test_full_run(spark, tmp_root):
    write_landing(tmp_root)
    cfg = _cfg(tmp_root)
    rep = daily_run.run_all(spark, cfg)
    assert set(rep["bronze"]) == {"transacciones", "proveedores", "clientes", "riesgos_precios"}
    assert all(rep["gold"].values())
    assert read_dataset(spark, cfg.bronze_path("transacciones")).count() == 8
    assert read_dataset(spark, cfg.gold_path("clientes")).count() == 5
    assert read_dataset(spark, cfg.gold_path("transacciones_agg")).count() == 5
    assert read_dataset(spark, cfg.gold_path("analytics/tipo_energia")).count() == 2
    risks = read_dataset(spark, cfg.bronze_path("riesgos_precios"))
    assert dict(risks.dtypes)["riesgo_pct"] == "double" and risks.count() == 2
    # catalog views
    assert spark.table(f"{cfg.bronze_db}.v_clientes").count() == 5
    assert spark.table(f"{cfg.bronze_db}.v_servicio").count() == 2
    # partition pruning of the sample query on the processing-date partition
    q = spark.sql(f"SELECT tipo_energia, count(*) AS cnt FROM {cfg.gold_db}.transacciones_agg "
                  f"WHERE year = {RD.year} GROUP BY tipo_energia")
    assert q.count() == 2
    # ad-hoc SQL against the catalog (A8): the summary query on the aggregate
    from wattlake.operators import aggregates
    from wattlake.sources.catalog import run_sql
    adhoc = run_sql(spark, f"""
        SELECT tipo_energia, COUNT(*) AS cnt, AVG(avg_precio_kwh) AS avg_price
        FROM transacciones_agg WHERE year = {RD.year}
        GROUP BY tipo_energia ORDER BY cnt DESC LIMIT 50""", database=cfg.gold_db)
    framed = aggregates.price_summary(spark.table(f"{cfg.gold_db}.transacciones_agg"), RD.year)
    a = {r.tipo_energia: (r.cnt, round(r.avg_price, 12)) for r in adhoc.collect()}
    b = {r.tipo_energia: (r.cnt, round(r.avg_price, 12)) for r in framed.collect()}
    assert a == b and len(a) == 2
    with pytest.raises(Exception):
        run_sql(spark, "SELECT no_such_column FROM transacciones_agg", database=cfg.gold_db)
    assert spark.catalog.currentDatabase() == "default"
    # warehouse: typed tables, by-name load (avg/total not swapped)
    agg = spark.table(f"{cfg.dwh_analytics_db}.transacciones_agg")
    assert agg.columns == ["tipo_energia", "ciudad", "fecha_transaccion", "total_kwh", "avg_precio_kwh",
                           "load_date"]
    assert agg.where("total_kwh < 1").count() == 0
    assert spark.table(f"{cfg.dwh_gold_db}.transacciones").count() == 8
    assert spark.table(f"{cfg.dwh_gold_db}.v_clientes").count() == 2
    # exports
    for v in ["v_clientes", "v_ventas", "v_compras"]:
        assert glob.glob(f"{cfg.exports}/{v}/part-*.csv.gz")
    files = glob.glob(f"{cfg.exports}/warehouse/transacciones/part-*.csv")
    assert len(files) == 1
    lines = open(files[0], encoding="utf-8").read().splitlines()
    assert lines[0].startswith("id_transaccion,") and len(lines) == 9
    assert [ln.split(",")[0] for ln in lines[1:]] == ["K1", "K2", "K3", "K5", "K4", "K6", "K7", "K8"]
    assert glob.glob(f"{cfg.exports}/warehouse/proveedores/part-*.csv")

    # rerun of the same day: partition overwrite changes nothing, lake or warehouse
    daily_run.run_all(spark, cfg, export=False)
    assert read_dataset(spark, cfg.bronze_path("transacciones")).count() == 8
    assert read_dataset(spark, cfg.gold_path("transacciones_agg")).count() == 5
    assert spark.table(f"{cfg.dwh_gold_db}.transacciones").count() == 8
    assert spark.table(f"{cfg.dwh_analytics_db}.transacciones_agg").count() == 5
    # a full reload rebuilds the same content
    jobs.load_warehouse(spark, cfg, RD, reload=True)
    assert spark.table(f"{cfg.dwh_gold_db}.transacciones").count() == 8
    assert spark.table(f"{cfg.dwh_gold_db}.proveedores").count() == 10


def test_append_mode_duplicates_like_the_original(spark, tmp_root):
    write_landing(tmp_root)
    cfg = _cfg(tmp_root, write_mode=APPEND)
    jobs.ingest_bronze(spark, cfg, RD)
    jobs.ingest_bronze(spark, cfg, RD)
    assert read_dataset(spark, cfg.bronze_path("transacciones")).count() == 16


def test_nested_path_fallback_and_missing_risks(spark, tmp_root):
    write_landing(tmp_root, riesgos=None, nested=True)
    cfg = _cfg(tmp_root)
    written = jobs.ingest_bronze(spark, cfg, RD)
    assert set(written) == {"transacciones", "proveedores", "clientes"}


def test_no_landing_is_tolerated(spark, tmp_root):
    cfg = _cfg(tmp_root)
    assert jobs.ingest_bronze(spark, cfg, RD) == []


def test_missing_optional_columns(spark, tmp_root):
    csv = "id_transaccion,cliente_proveedor,tipo_cliente\nT1,A,\nT2,B,industrial\n"
    write_landing(tmp_root, contratos=csv, riesgos=None)
    cfg = _cfg(tmp_root)
    assert jobs.ingest_bronze(spark, cfg, RD) == ["clientes"]
    cl = read_dataset(spark, cfg.bronze_path("clientes"))
    assert "ciudad" not in cl.columns
    assert sorted(r.tipo_cliente for r in cl.collect()) == ["desconocido", "industrial"]


def test_views_require_registered_tables(spark, tmp_root):
    cfg = _cfg(tmp_root)
    with pytest.raises(LookupError):
        jobs.create_views(spark, cfg)


def test_parquet_staging_and_client_snapshots(spark, tmp_root):
    write_landing(tmp_root)
    cfg = _cfg(tmp_root, landing_staging="parquet")
    d1, d2 = dt.date(2024, 6, 1), dt.date(2024, 6, 2)
    assert len(jobs.ingest_bronze(spark, cfg, d1)) == 4
    assert read_dataset(spark, cfg.bronze_path("proveedores")).count() == 10
    jobs.curate_clientes(spark, cfg, d1)
    # day 2: one known client changes type, one new client appears
    csv = ("id_transaccion,fecha_transaccion,tipo_transaccion,cliente_proveedor,cantidad_kwh,"
           "precio_kwh,tipo_energia,hora_transaccion,ciudad,nombre_proveedor,capacidad_mw,"
           "fecha_contrato,tipo_cliente\n"
           "K90,2024-02-01,venta,Ñu,1.0,0.1,solar,10:00:00,Cali,P,1.0,2023-01-01,"
           "residencial\n"
           "K91,2024-02-01,venta,Nuevo,1.0,0.1,solar,10:00:00,Cali,P,1.0,2023-01-01,comercial\n")
    write_landing(tmp_root, contratos=csv, riesgos=None)
    jobs.ingest_bronze(spark, cfg, d2)
    jobs.curate_clientes(spark, cfg, d2)
    snap = read_dataset(spark, cfg.gold_path("clientes")).where("day = 2")
    rows = {r.cliente_proveedor: r for r in snap.collect()}
    assert len(rows) == 6                       # 5 from day 1 + 1 new
    assert rows["Ñu"].tipo_cliente == "residencial"     # latest day wins
    assert rows["Yate"].tipo_cliente == "industrial"    # carried over
    # equals a dedup of the whole bronze history
    from wattlake.operators import curated
    full = curated.dedup_clientes(read_dataset(spark, cfg.bronze_path("clientes")))
    assert sorted(tuple(r) for r in full.collect()) == sorted(
        tuple(r) for r in snap.select(*full.columns).collect())


def test_fallback_only_skips_missing_paths(spark, tmp_root, monkeypatch):
    from pyspark.errors import AnalysisException

    from wattlake.sources import landing
    assert landing.read_first_existing(spark, [f"{tmp_root}/nope.csv", f"{tmp_root}/nope2.csv"]) is None
    os.makedirs(f"{tmp_root}/x")
    with open(f"{tmp_root}/x/a.csv", "w") as f:
        f.write("a,b\n1,2\n")
    df = landing.read_first_existing(spark, [f"{tmp_root}/nope.csv", f"{tmp_root}/x/a.csv"])
    assert df.columns == ["a", "b"] and df.count() == 1

    # any other analysis error (here: an unreadable first candidate) propagates
    def broken(*_a, **_k):
        raise AnalysisException("[UNSUPPORTED_DATA_SOURCE] broken reader")
    monkeypatch.setattr(landing, "read_landing_csv", broken)
    with pytest.raises(AnalysisException):
        landing.read_first_existing(spark, [f"{tmp_root}/x/a.csv", f"{tmp_root}/nope.csv"])


def test_registration_adds_new_day_partition(spark, tmp_root):
    write_landing(tmp_root)
    cfg = _cfg(tmp_root)
    d1, d2 = dt.date(2024, 6, 1), dt.date(2024, 6, 2)
    jobs.ingest_bronze(spark, cfg, d1)
    jobs.register_layers(spark, cfg, d1)
    t = f"{cfg.bronze_db}.transacciones"
    assert spark.table(t).count() == 8
    jobs.ingest_bronze(spark, cfg, d2)
    jobs.register_layers(spark, cfg, d2)
    assert spark.table(t).count() == 16
    assert spark.sql(f"SHOW PARTITIONS {t}").count() == 2
    assert spark.table(t).where("day = 2").count() == 8


def test_incremental_intake_and_exports_in_daily_run(spark, tmp_root):
    from tests.sample_data import CONTRATOS_CSV, RIESGOS_CSV
    cfg = _cfg(tmp_root, intake="incremental", incremental_exports=True)
    inbox = f"{cfg.landing}/contratos"
    os.makedirs(inbox)
    with open(f"{inbox}/batch1.csv", "w", encoding="utf-8") as f:
        f.write(CONTRATOS_CSV)
    with open(f"{cfg.landing}/riesgos_precios.csv", "w", encoding="utf-8") as f:
        f.write(RIESGOS_CSV)
    rep = daily_run.run_all(spark, cfg, RD)
    assert set(rep["bronze"]) == {"transacciones", "proveedores", "clientes", "riesgos_precios"}
    assert read_dataset(spark, cfg.gold_path("transacciones_agg")).count() == 5
    day = f"year={RD.year}/month={RD.month}/day={RD.day}"
    assert glob.glob(f"{cfg.exports}/v_ventas/{day}/part-*.csv.gz")
    assert glob.glob(f"{cfg.exports}/v_clientes/part-*.csv.gz")
    ventas = spark.read.csv(f"{cfg.exports}/v_ventas/{day}")
    assert ventas.count() == 4


def test_base_snapshot_is_the_last_that_still_stands(spark, tmp_root):
    from wattlake.plans.jobs import _base_snapshot
    from wattlake.sources import versions
    cfg = _cfg(tmp_root)
    write_landing(tmp_root, riesgos=None)
    days = [dt.date(2024, 1, 5), dt.date(2024, 2, 1), dt.date(2024, 3, 9)]

    def base(run_date):
        now = versions.current(spark, cfg.bronze_path("clientes"))
        found = _base_snapshot(spark, cfg, run_date, {d: v for d, v in now.items() if d <= run_date})
        return found and found.day

    assert base(days[0]) is None
    for d in days:
        jobs.ingest_bronze(spark, cfg, d)
        jobs.curate_clientes(spark, cfg, d)
    assert base(dt.date(2024, 4, 1)) == days[2]
    assert base(days[2]) == days[1]
    assert base(days[0]) is None
    jobs.ingest_bronze(spark, cfg, days[1])              # written again
    assert base(dt.date(2024, 4, 1)) == days[0]


def test_totals_do_not_grow_on_an_unchanged_landing(spark, tmp_root):
    write_landing(tmp_root)
    for options in ({}, {"source_scope": "all"}):
        cfg = _cfg(tmp_root, **options)
        for d in (RD, RD + dt.timedelta(days=1), RD + dt.timedelta(days=2)):
            daily_run.run_all(spark, cfg, d, export=False)
            totals = read_dataset(spark, cfg.gold_path("analytics/tipo_energia"))
            assert sum(r.total_kwh for r in totals.collect()) == pytest.approx(171.25)
            assert spark.table(f"{cfg.bronze_db}.v_ventas").count() == 4
            assert spark.table(f"{cfg.dwh_gold_db}.v_ventas").count() == 4


def test_warehouse_gate_and_missing_table(spark, tmp_root):
    cfg = _cfg(tmp_root, warehouse_enabled=False)
    assert jobs.load_warehouse(spark, cfg, RD) == []
    assert jobs.export_warehouse(spark, cfg, RD) == []
    assert not spark.catalog.databaseExists(cfg.dwh_gold_db)


def test_no_staging_is_left(spark, tmp_root):
    write_landing(tmp_root)
    cfg = _cfg(tmp_root)
    jobs.ingest_bronze(spark, cfg, RD)
    assert not glob.glob(f"{cfg.bronze}/_staging/contratos/*")


def test_queries_leave_nothing_after_release(spark):
    from tests.conftest import SF_SMALL
    from wattlake.plans.registry import QUERIES
    from wattlake.session import release_scratch, shared_folder

    def held():
        return sorted(os.listdir(shared_folder(spark).removeprefix("file:"))), {d.name for d in spark.catalog.listDatabases()}

    release_scratch(spark)
    before = held()
    for _ in range(2):
        for name in ("job_warehouse_v_compras", "streamed_flat", "job_v_servicio"):
            QUERIES[name](spark, SF_SMALL).count()
        release_scratch(spark)
        assert held() == before


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from wattlake import session

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:  # noqa: N801
            @staticmethod
            def get(*_):
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)


def test_client_snapshot_catches_up_a_missed_day(spark, tmp_root):
    from wattlake.operators import curated
    cfg = _cfg(tmp_root)
    header = ("id_transaccion,fecha_transaccion,tipo_transaccion,cliente_proveedor,cantidad_kwh,"
              "precio_kwh,tipo_energia,hora_transaccion,ciudad,nombre_proveedor,capacidad_mw,"
              "fecha_contrato,tipo_cliente\n")
    days = [dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 6, 3)]
    for i, d in enumerate(days):
        write_landing(tmp_root, riesgos=None, contratos=header +
                      f"T{i},2024-01-01,venta,Client{i},1.0,0.1,solar,10:00:00,Cali,P,1.0,2023-01-01,"
                      "comercial\n")
        jobs.ingest_bronze(spark, cfg, d)
        if i != 1:                      # the gold step of day 2 never ran
            jobs.curate_clientes(spark, cfg, d)
    snap = read_dataset(spark, cfg.gold_path("clientes")).where("day = 3")
    assert sorted(r.cliente_proveedor for r in snap.collect()) == ["Client0", "Client1", "Client2"]
    full = curated.dedup_clientes(read_dataset(spark, cfg.bronze_path("clientes")))
    assert sorted(tuple(r) for r in full.collect()) == sorted(
        tuple(r) for r in snap.select(*full.columns).collect())
