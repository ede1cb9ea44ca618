"""Streams: incremental intake exactly-once, stream == batch for the alert
chain, archive and dual sinks, flattening."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.sample_data import CONTRATOS_CSV
from wattlake.config import LakeConfig
from wattlake.plans.registry import ALERT_THRESHOLD, event_score
from wattlake.sources.driver_tables import table
from wattlake.sources.incremental import ingest_bronze_incremental
from wattlake.sources.lake import read_dataset
from wattlake.streaming import events as ev

RD = dt.date(2024, 6, 1)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_intake_only_new_files(spark, tmp_root):
    cfg = LakeConfig(root=tmp_root, run_date=RD)
    inbox = f"{cfg.landing}/contratos"
    os.makedirs(inbox)
    with open(f"{inbox}/day1.csv", "w", encoding="utf-8") as f:
        f.write(CONTRATOS_CSV)
    assert set(ingest_bronze_incremental(spark, cfg)) == {"transacciones", "proveedores", "clientes"}
    assert read_dataset(spark, cfg.bronze_path("transacciones")).count() == 8
    # rerun without new files adds nothing
    ingest_bronze_incremental(spark, cfg)
    assert read_dataset(spark, cfg.bronze_path("transacciones")).count() == 8
    # a new file adds only its rows
    header = CONTRATOS_CSV.splitlines()[0]
    with open(f"{inbox}/day2.csv", "w", encoding="utf-8") as f:
        f.write(header + "\nK11,2024-01-18,venta,Nuevo Cliente,10.0,0.2,solar,10:00:00,Cali,"
                         "Solar Santander,95.8,2023-04-18,\n")
    ingest_bronze_incremental(spark, cfg)
    tx = read_dataset(spark, cfg.bronze_path("transacciones"))
    assert tx.count() == 9
    assert read_dataset(spark, cfg.bronze_path("clientes")).where(
        "cliente_proveedor = 'Nuevo Cliente'").first().tipo_cliente == "desconocido"


def test_stream_alerts_equal_batch(spark, tmp_root):
    src = f"{tmp_root}/events_in"
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/events.parquet", f"{src}/part-0.parquet")
    profiles = ev.user_profiles(table(spark, SF_SMALL, "customer"), table(spark, SF_SMALL, "orders"))
    stream = ev.event_stream(spark, src)
    out = f"{tmp_root}/alerts"
    q = (ev.enriched_alerts(stream, profiles, event_score(), ALERT_THRESHOLD).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_root}/ck_alerts").trigger(availableNow=True).start(out))
    q.awaitTermination()
    batch = ev.enriched_alerts(table(spark, SF_SMALL, "events"), profiles, event_score(), ALERT_THRESHOLD)
    streamed = spark.read.parquet(out)
    assert streamed.count() == batch.count() > 0
    assert _rows(streamed.select(*batch.columns)) == _rows(batch)
    assert set(r.action for r in batch.select("action").distinct().collect()) <= {"COMPRAR", "VENDER"}


def test_archive_and_dual_sink(spark, tmp_root):
    src = f"{tmp_root}/events_in"
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/events.parquet", f"{src}/part-0.parquet")
    profiles = ev.user_profiles(table(spark, SF_SMALL, "customer"), table(spark, SF_SMALL, "orders"))
    n = table(spark, SF_SMALL, "events").count()
    q = ev.archive_events(ev.event_stream(spark, src), f"{tmp_root}/archive", f"{tmp_root}/ck_arch")
    q.awaitTermination()
    arch = spark.read.parquet(f"{tmp_root}/archive")
    assert arch.count() == n and "event_date" in arch.columns
    profiles = ev.materialize_profiles(profiles, f"{tmp_root}/profiles")
    q = ev.start_dual_sink(ev.event_stream(spark, src), f"{tmp_root}/flat", f"{tmp_root}/ops",
                           profiles, f"{tmp_root}/ck_dual", event_score(), ALERT_THRESHOLD)
    q.awaitTermination()
    flat = spark.read.parquet(f"{tmp_root}/flat")
    assert flat.count() == n and "props_k" in flat.columns and "c_mktsegment" in flat.columns
    ops = spark.read.parquet(f"{tmp_root}/ops")
    assert ops.count() == ev.enriched_alerts(table(spark, SF_SMALL, "events"), profiles, event_score(), ALERT_THRESHOLD).count()
    # replaying a batch id overwrites its own partition only
    w = ev.dual_sink_writer(f"{tmp_root}/flat", f"{tmp_root}/ops", profiles, event_score(), ALERT_THRESHOLD)
    w(table(spark, SF_SMALL, "events"), 0)
    assert spark.read.parquet(f"{tmp_root}/flat").count() == n


def test_flatten_nested_and_arrays(spark):
    df = spark.createDataFrame(
        [(1, {"a": {"b": 2, "c": "x"}, "d": [1, 2]}), (2, None)],
        "id int, p struct<a: struct<b: int, c: string>, d: array<int>>")
    out = ev.flatten(df, explode_arrays=True)
    assert out.columns == ["id", "p_a_b", "p_a_c", "p_d"]
    assert out.count() == 3
    flat = ev.flatten_events(table(spark, SF_SMALL, "events"))
    assert "props_k" in flat.columns and flat.where(F.col("props_k").isNull()).count() == 0


def test_pluggable_model_scorer_matches_expression(spark):
    profiles = ev.user_profiles(table(spark, SF_SMALL, "customer"), table(spark, SF_SMALL, "orders"))
    enriched = ev.enrich_events(table(spark, SF_SMALL, "events"), profiles)
    scorer = ev.model_scorer(lambda x: x["value"].fillna(0.0) / (x["n_orders"].fillna(0) + 1), ["value", "n_orders"])
    a = {r.event_id: (r.score, r.action) for r in ev.score_events(enriched, event_score(), ALERT_THRESHOLD).collect()}
    b = {r.event_id: (r.score, r.action) for r in ev.score_events(enriched, scorer, ALERT_THRESHOLD).collect()}
    assert a == b and len({x for _, x in a.values()}) == 3


def test_archive_adds_few_files_to_a_date(spark, tmp_root):
    import glob
    src = f"{tmp_root}/events_in"
    os.makedirs(src)
    table(spark, SF_SMALL, "events").repartition(40).write.mode("append").parquet(f"{src}/in")
    q = ev.archive_events(ev.event_stream(spark, f"{src}/in"), f"{tmp_root}/archive", f"{tmp_root}/ck", files_per_date=2)
    q.awaitTermination()
    files = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{tmp_root}/archive/event_date=*")]
    assert len(files) > 5 and max(files) <= 2


def test_salted_enrichment_equals_plain(spark, tmp_root):
    profiles = ev.user_profiles(table(spark, SF_SMALL, "customer"), table(spark, SF_SMALL, "orders"))
    events = table(spark, SF_SMALL, "events")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7))
                            .otherwise(F.col("user_id")))          # a third of events: one user
    plain = _rows(ev.enriched_alerts(hot, profiles, event_score(), ALERT_THRESHOLD))
    salted = _rows(ev.enriched_alerts(hot, profiles, event_score(), ALERT_THRESHOLD, salt_buckets=8))
    assert plain == salted and len(plain) > 0
    # and as a stream
    src = f"{tmp_root}/events_in"
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/events.parquet", f"{src}/part-0.parquet")
    q = (ev.enriched_alerts(ev.event_stream(spark, src), profiles, event_score(), ALERT_THRESHOLD, salt_buckets=4).writeStream
         .format("parquet").option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True)
         .start(f"{tmp_root}/out"))
    q.awaitTermination()
    assert _rows(spark.read.parquet(f"{tmp_root}/out")) == _rows(ev.enriched_alerts(events, profiles, event_score(), ALERT_THRESHOLD))
