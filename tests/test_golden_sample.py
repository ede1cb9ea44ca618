"""Expected values of the contract sample (bronze split -> gold)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.sample_data import write_landing
from wattlake.operators import aggregates, bronze, curated, views
from wattlake.sources.landing import read_landing_csv


@pytest.fixture(scope="module")
def contratos(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("golden"))
    landing = write_landing(root)
    return read_landing_csv(spark, f"{landing}/contratos.csv")


def test_landing_is_all_text(contratos):
    assert contratos.count() == 10
    assert all(t == "string" for _, t in contratos.dtypes)
    assert len(contratos.columns) == 13


def test_bronze_transacciones(contratos):
    tx = bronze.split_transacciones(contratos)
    assert {r.id_transaccion for r in tx.collect()} == {f"K{i}" for i in range(1, 9)}
    assert dict(tx.dtypes)["cantidad_kwh"] == "double"
    assert dict(tx.dtypes)["fecha_transaccion"] == "date"


def test_bronze_proveedores_keeps_shifted_rows(contratos):
    pv = bronze.split_proveedores(contratos).collect()
    assert len(pv) == 10
    shifted = [r for r in pv if r.capacidad_mw is None]
    assert sorted((r.nombre_proveedor, r.ciudad) for r in shifted) == [("-3", "Centro"), ("7.5", "Oeste")]
    assert all(r.fecha_contrato is None for r in shifted)


def test_bronze_clientes(contratos):
    cl = bronze.split_clientes(contratos).collect()
    assert len(cl) == 8 and len({r.cliente_proveedor for r in cl}) == 5
    assert [r.cliente_proveedor for r in cl if r.tipo_cliente == "desconocido"] == ["Wanda"]


def test_aggregate_and_totals(contratos):
    tx = bronze.split_transacciones(contratos)
    agg = aggregates.aggregate_transacciones(tx)
    rows = {(r.tipo_energia, r.ciudad, str(r.fecha_transaccion)): r for r in agg.collect()}
    assert set(rows) == {("hidro", "Oslo", "2040-01-01"), ("hidro", "Oslo", "2040-01-02"), ("hidro", "Ærø", "2040-01-01"),
                         ("solar", "Ærø", "2040-02-29"), ("solar", "Łódź", "2040-03-01")}
    three = rows["hidro", "Oslo", "2040-01-01"]
    assert three.total_kwh == pytest.approx(60) and three.avg_precio_kwh == pytest.approx(0.2)
    tot = {r.tipo_energia: r.total_kwh for r in aggregates.energy_totals(agg).collect()}
    assert tot == pytest.approx({"hidro": 70.0, "solar": 101.25})
    assert sum(tot.values()) == pytest.approx(tx.agg(F.sum("cantidad_kwh")).first()[0])


def test_exact_avg_matches_plain_avg_on_sample(contratos):
    tx = bronze.split_transacciones(contratos)
    a = {(r.tipo_energia, r.ciudad, r.fecha_transaccion): r.avg_precio_kwh
         for r in aggregates.aggregate_transacciones(tx).collect()}
    b = {(r.tipo_energia, r.ciudad, r.fecha_transaccion): r.avg_precio_kwh
         for r in aggregates.aggregate_transacciones(tx, exact_scale=4).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_views(spark, contratos):
    tx = bronze.split_transacciones(contratos)
    cl = bronze.split_clientes(contratos)
    assert {r.tipo_energia for r in views.lake_view(spark, "v_servicio", tx).collect()} == {"hidro", "solar"}
    from wattlake.functions import stamp
    txs = stamp(tx, dt.date(2024, 6, 1))
    sold = {r.id_transaccion for r in views.lake_view(spark, "v_ventas", txs).collect()}
    bought = {r.id_transaccion for r in views.lake_view(spark, "v_compras", txs).collect()}
    assert sold == {"K1", "K2", "K4", "K8"} and bought == {"K3", "K5", "K7"}
    clients = {r.cliente: (r.tipo_cliente, r.ciudad) for r in views.lake_view(spark, "v_clientes", txs, cl).collect()}
    assert clients == {"Zoo": ("residencial", "Oslo"), "Yate": ("industrial", "Oslo"), "Xilófono": ("industrial", "Ærø"),
                       "Wanda": ("desconocido", "Ærø"), "Ñu": ("comercial", "Łódź")}
    dwh = views.dwh_view(spark, "v_clientes", curated.curate_transacciones(tx)).collect()
    assert {(r.cliente, r.ciudad) for r in dwh} == {("Zoo", "Oslo"), ("Ñu", "Łódź")}
