"""Quarantine and unique ids in the jobs (S8), landing ledger (A6), resumed runs."""

import datetime as dt
import os

import pytest

from tests.sample_data import CONTRATOS_CSV, write_landing
from wattlake.config import LakeConfig
from wattlake.operators import quality
from wattlake.plans import daily_run, intake, jobs, zone
from wattlake.schemas import CONTRATOS_COLUMNS, CONTRATOS_RAW
from wattlake.sources import versions
from wattlake.sources.lake import read_dataset, read_partition

D1, D2, D3 = (dt.date(2024, 6, k) for k in (1, 2, 3))


def config(root, **options):
    n = os.path.basename(root.rstrip("/")).replace("-", "_").lower()
    return LakeConfig(root=root, bronze_db=f"b_{n}", gold_db=f"g_{n}", dwh_gold_db=f"dg_{n}", dwh_analytics_db=f"da_{n}",
                      **options)


def line(i, kwh="1", **more):
    values = {"id_transaccion": i, "cantidad_kwh": kwh, "cliente_proveedor": "c", **more}
    return tuple(values.get(c) for c in CONTRATOS_COLUMNS)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), CONTRATOS_RAW)


def ids(spark, cfg, day=None):
    df = read_dataset(spark, cfg.bronze_path("transacciones"))
    return sorted((r["day"], r["id_transaccion"]) for r in df.collect() if day is None or r["day"] == day.day)


# ---- S8 -------------------------------------------------------------------
def test_quarantine_and_unique_ids_across_days(spark, tmp_root):
    cfg = config(tmp_root, landing_content="delta", quarantine=True, index_buckets=4)
    jobs.ingest_bronze(spark, cfg, D1, contratos=lines(
        spark, line("a"), line("a"), line("a", "2"), line("b", "x"), line("c"),
        line(None, nombre_proveedor="3.5", capacidad_mw="2020-01-01")))
    assert ids(spark, cfg) == [(1, "a"), (1, "c")]
    assert read_partition(spark, cfg.bronze_path("transacciones"), D1).where("id_transaccion = 'a'").first().cantidad_kwh == 2
    assert len(held_rows := read_dataset(spark, cfg.bronze_path("cuarentena")).collect()) == 4
    assert {(r.dataset, r.reason, r.id_transaccion) for r in held_rows} == {
        ("transacciones", quality.REASON_DUPLICATE, "a"), ("transacciones", quality.REASON_BAD_KWH, "b"),
        ("proveedores", quality.REASON_SHIFTED, None)}
    jobs.ingest_bronze(spark, cfg, D2, contratos=lines(spark, line("c"), line("d")))
    assert ids(spark, cfg, D2) == [(2, "d")]
    # the first day again, without c: its id is free for a rerun of the second
    jobs.ingest_bronze(spark, cfg, D1, contratos=lines(spark, line("a"), line("d")))
    assert ids(spark, cfg) == [(1, "a"), (2, "d")]
    jobs.ingest_bronze(spark, cfg, D2, contratos=lines(spark, line("c"), line("d")))
    assert ids(spark, cfg) == [(1, "a"), (2, "c"), (2, "d")]
    # an empty rerun gives back all ids of the day
    jobs.ingest_bronze(spark, cfg, D2, contratos=lines(spark, line("z")).limit(0))
    assert ids(spark, cfg) == [(1, "a")]
    # in the anti-join only the new rows are shuffled, not the index
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = zone.unseen(spark, cfg, lines(spark, line("q")), D3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_a_snapshot_landing_is_unique_within_the_day(spark, tmp_root):
    cfg = config(tmp_root, quarantine=True)
    for day in (D1, D2):
        jobs.ingest_bronze(spark, cfg, day, contratos=lines(spark, line("a"), line("a"), line("b")))
    assert ids(spark, cfg) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
    assert read_dataset(spark, cfg.bronze_path("cuarentena")).count() == 2


# ---- A6 -------------------------------------------------------------------
def put(cfg, name, *rows):
    folder = f"{cfg.landing}/contratos"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join([CONTRATOS_CSV.splitlines()[0], *(",".join(v or "" for v in r) for r in rows)]) + "\n")


def test_rewritten_files_restate_their_day(spark, tmp_root, monkeypatch):
    cfg = config(tmp_root, landing_content="delta", intake="ledger")
    put(cfg, "one.csv", line("a"), line("b"))
    put(cfg, "with space.csv", line("c"))
    assert set(intake.ingest_bronze_ledger(spark, cfg, D1)) == {"transacciones", "proveedores", "clientes"}
    assert intake.ingest_bronze_ledger(spark, cfg, D2) == []            # nothing new
    put(cfg, "two.csv", line("d"))
    put(cfg, "one.csv", line("a", "7"), line("extra"))                   # b goes, extra comes, on the first day
    before = versions.current(spark, cfg.bronze_path("transacciones"))
    assert "transacciones" in intake.ingest_bronze_ledger(spark, cfg, D2)
    want = [(1, "a"), (1, "c"), (1, "extra"), (2, "d")]
    assert ids(spark, cfg) == want
    assert versions.current(spark, cfg.bronze_path("transacciones"))[D1] > before[D1]
    # an intake that fails before its ledger is repeated, and repeating changes nothing
    put(cfg, "three.csv", line("e"))
    monkeypatch.setattr(intake, "_commit_ledger", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        intake.ingest_bronze_ledger(spark, cfg, D3)
    monkeypatch.undo()
    intake.ingest_bronze_ledger(spark, cfg, D3)
    assert ids(spark, cfg) == want + [(3, "e")]
    os.remove(f"{cfg.landing}/contratos/two.csv")                        # a file that left keeps its lines
    intake.ingest_bronze_ledger(spark, cfg, D3)
    assert ids(spark, cfg) == want + [(3, "e")]


def test_no_landing_at_all(spark, tmp_root):
    assert intake.ingest_bronze_ledger(spark, config(tmp_root, intake="ledger"), D1) == []


# ---- G12 ------------------------------------------------------------------
def test_a_run_goes_on_where_it_failed(spark, tmp_root, monkeypatch):
    write_landing(tmp_root)
    cfg = config(tmp_root)
    ran = []
    for name, job in list(daily_run.GOLD_JOBS.items()):
        def counted(*args, name=name, job=job):
            ran.append(name)
            return job(*args)
        monkeypatch.setitem(daily_run.GOLD_JOBS, name, counted)
    real = jobs.load_warehouse
    fails = [True]

    def broken(*args, **kw):
        ran.append("warehouse")
        if fails[0]:
            raise OSError("no warehouse")
        return real(*args, **kw)

    monkeypatch.setattr(jobs, "load_warehouse", broken)
    with pytest.raises(OSError):
        daily_run.run_all(spark, cfg, D1, resume=True, export=False)
    assert sorted(ran) == sorted([*daily_run.GOLD_JOBS, "warehouse"])
    ran.clear()
    fails[0] = False
    report = daily_run.run_all(spark, cfg, D1, resume=True, export=False)
    assert ran == ["warehouse"] and "bronze" in report["skipped"] and len(report["warehouse"]) == 3
    # all done: nothing runs; a changed landing redoes bronze and what reads it
    ran.clear()
    daily_run.run_all(spark, cfg, D1, resume=True, export=False)
    assert ran == []
    write_landing(tmp_root, contratos=CONTRATOS_CSV + CONTRATOS_CSV.splitlines()[1].replace("K1,", "K77,") + "\n")
    daily_run.run_all(spark, cfg, D1, resume=True, export=False)
    assert sorted(ran) == sorted([*daily_run.GOLD_JOBS, "warehouse"])
    assert read_partition(spark, cfg.gold_path("transacciones_curated"), D1).count() == 9
    # without resume, every step runs
    ran.clear()
    daily_run.run_all(spark, cfg, D1, export=False)
    assert len(ran) == 5


def test_a_step_is_tried_again(spark, tmp_root, monkeypatch):
    write_landing(tmp_root)
    tries = []

    def flaky(*args):
        tries.append(1)
        if len(tries) == 1:
            raise OSError("once")
        return True

    monkeypatch.setitem(daily_run.GOLD_JOBS, "clientes", flaky)
    daily_run.run_all(spark, config(tmp_root), D1, retries=1, export=False)
    assert len(tries) == 2
