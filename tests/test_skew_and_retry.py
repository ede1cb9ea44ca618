"""A key holding a third of all rows, and task failures during writes."""

import datetime as dt
import os
import subprocess
import sys
import textwrap

import pandas as pd
import pytest

from wattlake.operators import aggregates, curated, views

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30_000
    rows = []
    for i in range(n):
        hot = i % 3 == 0                        # a third of all rows: one client, one city
        client = "HOT" if hot else f"C{i % 997}"
        rows.append((f"T{i}", dt.date(2024, 1, 1 + i % 28), "venta" if i % 2 else "compra",
                     client, float(i % 50), (i % 7) / 100.0, f"e{i % 4}", "12:00:00",
                     "Bogotá" if hot else f"city{i % 13}"))
    cols = ["id_transaccion", "fecha_transaccion", "tipo_transaccion", "cliente_proveedor",
            "cantidad_kwh", "precio_kwh", "tipo_energia", "hora_transaccion", "ciudad"]
    pdf = pd.DataFrame(rows, columns=cols)
    tx = spark.createDataFrame(pdf).repartition(8)
    types = ["comercial", "industrial", "residencial", "desconocido"]
    cl_pdf = pd.DataFrame({"cliente_proveedor": pdf.cliente_proveedor,
                           "tipo_cliente": [types[i % 4] for i in range(n)],
                           "ciudad": pdf.ciudad})
    cl = spark.createDataFrame(cl_pdf).repartition(8)
    return pdf, tx, cl_pdf, cl


def test_aggregate_with_hot_key(skewed):
    pdf, tx, _, _ = skewed
    got = aggregates.aggregate_transacciones(tx, exact_scale=4).toPandas()
    exp = pdf.groupby(["tipo_energia", "ciudad", "fecha_transaccion"]).agg(
        total_kwh=("cantidad_kwh", "sum"), avg_precio_kwh=("precio_kwh", "mean")).reset_index()
    m = got.merge(exp, on=["tipo_energia", "ciudad", "fecha_transaccion"], suffixes=("", "_e"))
    assert len(m) == len(exp) == len(got)
    assert (m.total_kwh - m.total_kwh_e).abs().max() < 1e-9
    assert (m.avg_precio_kwh - m.avg_precio_kwh_e).abs().max() < 1e-12


def test_dedup_and_client_view_with_hot_key(spark, skewed):
    pdf, tx, cl_pdf, cl = skewed
    got = {r.cliente_proveedor: (r.tipo_cliente, r.ciudad) for r in curated.dedup_clientes(cl).collect()}
    exp = (cl_pdf.sort_values(["tipo_cliente", "ciudad"], ascending=False)
           .drop_duplicates("cliente_proveedor"))
    assert got == {r.cliente_proveedor: (r.tipo_cliente, r.ciudad) for r in exp.itertuples()}
    vc = {r.cliente: (r.tipo_cliente, r.ciudad)
          for r in views.lake_view(spark, "v_clientes", tx, cl).collect()}
    t = pdf.groupby("cliente_proveedor").ciudad.max()
    c = cl_pdf.groupby("cliente_proveedor").tipo_cliente.max()
    assert vc == {k: (c.get(k, "desconocido"), t[k]) for k in t.index}
    assert vc["HOT"] == ("residencial", "Bogotá")


RETRY_SCRIPT = textwrap.dedent('''
    import datetime as dt, sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession, functions as F, types as T
    from pyspark import TaskContext
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="wl-wh-"))
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from tests.sample_data import write_landing
    from wattlake.config import LakeConfig
    from wattlake.plans import jobs
    from wattlake.sources.landing import read_landing_csv
    from wattlake.sources.lake import read_dataset

    @F.udf(T.StringType())
    def flaky(v):
        ctx = TaskContext.get()
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return v

    root = tempfile.mkdtemp(prefix="wl-retry-")
    landing = write_landing(root)
    c = read_landing_csv(spark, landing + "/contratos.csv").repartition(4)
    c = c.withColumn("id_transaccion", flaky("id_transaccion"))
    cfg = LakeConfig(root=root, run_date=dt.date(2024, 6, 1))
    jobs.ingest_bronze(spark, cfg, contratos=c)
    tx = read_dataset(spark, cfg.bronze_path("transacciones"))
    print("RESULT", tx.count(), tx.select("id_transaccion").distinct().count(),
          read_dataset(spark, cfg.bronze_path("proveedores")).count())
''')


def test_writes_survive_task_retries(tmp_root):
    script = os.path.join(tmp_root, "retry.py")
    with open(script, "w") as f:
        f.write(RETRY_SCRIPT.format(root=ROOT))
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600,
                         cwd=ROOT)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-3000:]
    assert line[0].split()[1:] == ["8", "8", "10"]

