"""What stays on disk: one version of a day where that is asked for, no shuffle
files of a landing that is written, lines in an order that compresses (F1, F2 of
round 4)."""

import datetime as dt
import glob
import time

import pyarrow.parquet as parquet
import pytest

from tests.conftest import SF_SMALL
from tests.test_zone_intake_resume import config, line, lines, put
from wattlake.plans import intake, jobs, registry
from wattlake.session import FREE_SHUFFLES
from wattlake.sinks import parquet as pq
from wattlake.sources import versions
from wattlake.sources.driver_tables import contratos_from_tables
from wattlake.sources.lake import read_dataset, read_partition

D1, D2 = dt.date(2024, 6, 1), dt.date(2024, 6, 2)


def _folders(root):
    return sorted(x.split("/day=")[1].split("/")[0] for x in glob.glob(f"{root}/year=*/month=*/day=*/version=*"))


@pytest.mark.parametrize("keep, left", [(None, ["1", "2", "2"]), (1, ["1", "2"])])
def test_a_rerun_leaves_as_many_versions_as_asked(spark, tmp_root, keep, left):
    cfg = config(tmp_root, keep_versions=keep)
    for day, kwh in ((D1, "1"), (D2, "2"), (D2, "3")):
        jobs.ingest_bronze(spark, cfg, day, contratos=lines(spark, line("a", kwh, nombre_proveedor="p")))
        jobs.curate_transacciones(spark, cfg, day)
        jobs.curate_proveedores(spark, cfg, day)
        jobs.load_warehouse(spark, cfg, day)
    for root in (*map(cfg.bronze_path, ("transacciones", "proveedores", "clientes")),
                 *map(cfg.gold_path, ("transacciones_curated", "proveedores"))):
        assert _folders(root) == left, root
    assert sorted((r.day, r.cantidad_kwh) for r in read_dataset(spark, cfg.gold_path("transacciones_curated")).collect()) == [
        (1, 1), (2, 3)]
    assert [r.cantidad_kwh for r in spark.table(f"{cfg.dwh_gold_db}.transacciones").orderBy("load_date").collect()] == [1, 3]


def test_only_the_written_day_expires_and_never_its_current_version(spark, tmp_root):
    root = f"{tmp_root}/ds"
    for day, n in ((D1, 1), (D1, 2), (D2, 3), (D2, 4)):
        pq.write_day(spark.createDataFrame([(n,)], "n long"), root, day, keep=None if day == D1 else 1)
    assert _folders(root) == ["1", "1", "2"]
    assert sorted(r.n for r in read_dataset(spark, root).collect()) == [2, 4]
    with pytest.raises(ValueError, match="current version"):
        versions.expire(spark, root, 0)


def test_a_written_landing_leaves_no_shuffle_files(spark):
    def files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in disk.getAllBlocks().mkString(" ").split() if f.startswith("shuffle_")}
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        before, was = files(), spark.conf.get(FREE_SHUFFLES, None)
        landed = registry._landed(spark, SF_SMALL)
        assert landed.count() > 5000
        until = time.time() + 20          # Spark removes them beside what runs next
        while (left := {f for f in files() - before if f.endswith("data")}) and time.time() < until:
            time.sleep(0.2)
        # of the landing's six shuffles none, of the count's one
        assert len({f.split("_")[1] for f in left}) <= 1
        assert spark.conf.get(FREE_SHUFFLES, None) == was
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_narrow_rows_are_shuffled_first(spark):
    """By part, then by order, then by supplier: the wide rows are shuffled last."""
    plan = contratos_from_tables(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    at = [plan.index(f"Join Inner, ({k}") for k in ("l_suppkey", "l_orderkey", "l_partkey")]
    assert at == sorted(at)               # the topmost join comes first


def test_provider_lines_of_a_file_are_sorted(spark, tmp_root):
    cfg = config(tmp_root)
    day = [line(f"{k}", nombre_proveedor=f"p{k * 7 % 10}", fecha_contrato=f"2024-01-{k % 20 + 1:02d}") for k in range(60)]
    jobs.ingest_bronze(spark, cfg, D1, contratos=lines(spark, *day).repartition(2))
    files = glob.glob(f"{cfg.bronze}/proveedores/**/*.parquet", recursive=True)
    got = [parquet.read_table(f, partitioning=None).select(["nombre_proveedor", "fecha_contrato"]).to_pylist() for f in files]
    assert sum(map(len, got)) == 60
    for rows in got:
        assert [tuple(r.values()) for r in rows] == sorted(tuple(r.values()) for r in rows)
    # of ids, only what differs from the one before is kept
    name, = {f for f in glob.glob(f"{cfg.bronze}/transacciones/**/*.parquet", recursive=True)} & set(
        glob.glob(f"{cfg.bronze}/transacciones/**/part-00000*.parquet", recursive=True))
    assert "PLAIN_DICTIONARY" not in parquet.ParquetFile(name).metadata.row_group(0).column(0).encodings


def test_a_restated_file_leaves_no_earlier_lines(spark, tmp_root):
    cfg = config(tmp_root, landing_content="delta", intake="ledger", keep_versions=1)
    put(cfg, "one.csv", line("a"), line("b"))
    put(cfg, "two.csv", line("c"))
    intake.ingest_bronze_ledger(spark, cfg, D1)
    put(cfg, "one.csv", line("a", "7"), line("b", "7"), line("d", "7"))
    intake.ingest_bronze_ledger(spark, cfg, D2)
    for root in (intake.lines_path(cfg), cfg.bronze_path("transacciones"), cfg.bronze_path("clientes")):
        assert _folders(root) == ["1"], root
    got = read_partition(spark, cfg.bronze_path("transacciones"), D1).collect()
    assert sorted((r.id_transaccion, r.cantidad_kwh) for r in got) == [("a", 7), ("b", 7), ("c", 1), ("d", 7)]
    assert intake.ingest_bronze_ledger(spark, cfg, D2) == []
