"""What the jobs write and shuffle: compressed files, no second copy of a table,
ids instead of whole lines (F1-F9 of round 3)."""

import datetime as dt
import glob

import pytest

from tests.test_zone_intake_resume import config, line, lines
from wattlake.plans import intake, jobs, registry, zone
from wattlake.operators import quality
from wattlake.sources.lake import read_dataset, read_partition

D1, D2 = dt.date(2024, 6, 1), dt.date(2024, 6, 2)


def test_files_are_zstd_and_a_table_is_not_staged(spark, tmp_root, monkeypatch):
    cfg = config(tmp_root)
    lines(spark, line("a", fecha_transaccion="2024-01-01"), line("b")).write.parquet(f"{tmp_root}/in")
    staged = []
    monkeypatch.setattr(jobs, "remove_path", lambda s, path: staged.append(path))
    jobs.ingest_bronze(spark, cfg, D1, contratos=spark.read.parquet(f"{tmp_root}/in"), is_table=True)
    assert staged == [] and not glob.glob(f"{cfg.bronze}/_staging/**/*.parquet", recursive=True)
    jobs.curate_transacciones(spark, cfg, D1)
    jobs.load_warehouse(spark, cfg, D1)
    for layer in (cfg.bronze, cfg.gold, cfg.dwh):
        files = glob.glob(f"{layer}/**/*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize("sent", [zone.SENT_IDS, 0])
def test_only_lines_in_question_are_set_apart(spark, tmp_root, monkeypatch, sent):
    monkeypatch.setattr(zone, "SENT_IDS", sent)
    cfg = config(tmp_root, landing_content="delta", quarantine=True, index_buckets=4)
    jobs.ingest_bronze(spark, cfg, D1, contratos=lines(spark, line("old")))
    day = lines(spark, line("one"), line("two"), line("two", "3"), line("two", "3"), line("old"), line("bad", "x"),
                line("half"), line("half", "x"), line(None))
    sure, rest = zone.set_apart(spark, cfg, quality.whole_lines(day), D2, f"{tmp_root}/apart")
    assert sorted(r.id_transaccion for r in sure.collect()) == ["half", "one"]
    assert sorted(r.id_transaccion for r in rest.collect()) == ["bad", "half", "old", "two", "two", "two"]
    jobs.ingest_bronze(spark, cfg, D2, contratos=day)
    got = read_partition(spark, cfg.bronze_path("transacciones"), D2).collect()
    assert sorted((r.id_transaccion, r.cantidad_kwh) for r in got) == [("half", 1), ("one", 1), ("two", 3)]
    wrong = read_dataset(spark, cfg.bronze_path("cuarentena")).where(f"day = {D2.day}").collect()
    assert sorted((r.id_transaccion, r.cantidad_kwh, r.reason) for r in wrong) == [
        ("bad", "x", quality.REASON_BAD_KWH), ("half", "x", quality.REASON_BAD_KWH),
        ("old", "1", quality.REASON_ACCEPTED_BEFORE),
        ("two", "1", quality.REASON_DUPLICATE), ("two", "3", quality.REASON_DUPLICATE)]
    assert not glob.glob(f"{cfg.bronze}/_staging/in_question/*")


def test_ids_meet_the_index_without_shuffling_it(spark, tmp_root):
    cfg = config(tmp_root, landing_content="delta", quarantine=True, index_buckets=4)
    zone.create_index(spark, cfg)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = zone.in_question(spark, cfg, quality.whole_lines(lines(spark, line("a"))), D1)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    # the ids, dealt as the index is, and the hashes in question; the index not
    assert plan.count("Exchange hashpartitioning(id_transaccion") == 2
    assert plan.count("Exchange") == 3


def test_kept_lines_stay_where_they_are(spark, tmp_root, monkeypatch):
    """A restated file does not shuffle the lines of all others by their file."""
    cfg = config(tmp_root, landing_content="delta", intake="ledger")
    path = f"{cfg.landing}/contratos/part"
    registry._write_landing(lines(spark, line("a"), line("b")).repartition(2, "id_transaccion"), path)
    plans = []
    write = intake.pq.write_day
    monkeypatch.setattr(intake.pq, "write_day", lambda df, root, *a, **k: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()) if root == intake.lines_path(cfg) else None,
        write(df, root, *a, **k))[1])
    intake.ingest_bronze_ledger(spark, cfg, D1)
    registry._write_landing(lines(spark, line("c", "7")), f"{cfg.landing}/contratos/more")
    intake.ingest_bronze_ledger(spark, cfg, D1)
    assert "strategy=broadcast" in plans[-1]
    got = read_dataset(spark, cfg.bronze_path("transacciones")).collect()
    assert sorted((r.id_transaccion, r.cantidad_kwh) for r in got) == [("a", 1), ("b", 1), ("c", 7)]


def test_landing_text_is_compressed_and_replaced_file_by_file(spark, tmp_root):
    old, new = f"{tmp_root}/old", f"{tmp_root}/new"
    two = lines(spark, line("a"), line("b")).repartition(2)
    registry._write_landing(two, old)
    assert glob.glob(f"{old}/part-*.csv.gz")
    registry._write_landing(two.withColumn("cantidad_kwh", two.precio_kwh), new)
    registry._replace_files(spark, new, old)
    assert spark.read.option("header", True).csv(old).where("cantidad_kwh IS NULL").count() == 2
    registry._write_landing(two.coalesce(1), new)
    if len(glob.glob(f"{old}/part-*")) == 2:
        with pytest.raises(ValueError, match="different part files"):
            registry._replace_files(spark, new, old)
