"""Hand-typed edge cases of the layer operators."""

import datetime as dt

import pytest

from wattlake.functions import exact_avg, has_columns, require_columns, stamp
from wattlake.operators import aggregates, bronze, curated, exports, views
from wattlake.schemas import CONTRATOS_COLUMNS


def _contratos(spark, rows, cols=CONTRATOS_COLUMNS):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def _row(**kw):
    return tuple(kw.get(c) for c in CONTRATOS_COLUMNS)


def test_bad_values_become_null_not_errors(spark):
    df = _contratos(spark, [_row(id_transaccion="T1", cantidad_kwh="abc", precio_kwh="2023-05-20",
                                 fecha_transaccion="85.0", nombre_proveedor="P",
                                 capacidad_mw="2023-05-20", fecha_contrato="x",
                                 cliente_proveedor="C")])
    tx = bronze.split_transacciones(df).first()
    assert tx.cantidad_kwh is None and tx.precio_kwh is None and tx.fecha_transaccion is None
    pv = bronze.split_proveedores(df).first()
    assert pv.capacidad_mw is None and pv.fecha_contrato is None


def test_required_columns_guard(spark):
    df = _contratos(spark, [("a", "b")], ["cliente_proveedor", "tipo_cliente"])
    assert bronze.split_transacciones(df) is None
    assert bronze.split_proveedores(df) is None
    cl = bronze.split_clientes(df)
    assert cl.columns == ["cliente_proveedor", "tipo_cliente"]  # ciudad optional
    assert set(bronze.split_contratos(df)) == {"clientes"}
    assert has_columns(df, ["tipo_cliente"]) and not has_columns(df, ["ciudad"])
    with pytest.raises(ValueError):
        require_columns(df, ["ciudad"])


def test_null_client_type_defaults(spark):
    df = _contratos(spark, [_row(cliente_proveedor="A", tipo_cliente=None, ciudad="X"),
                            _row(cliente_proveedor=None, tipo_cliente="comercial")])
    rows = bronze.split_clientes(df).collect()
    assert [(r.cliente_proveedor, r.tipo_cliente, r.ciudad) for r in rows] == [("A", "desconocido", "X")]


def test_stamp_unpadded_parts(spark):
    df = stamp(spark.range(1), dt.date(2024, 3, 5))
    r = df.first()
    assert (r.processed_date, r.year, r.month, r.day) == (dt.date(2024, 3, 5), 2024, 3, 5)
    assert dict(df.dtypes)["month"] == "int"
    # restamping replaces, does not duplicate
    assert stamp(df, dt.date(2025, 1, 1)).columns.count("year") == 1


def test_aggregate_null_key_is_a_group(spark):
    tx = spark.createDataFrame(
        [("solar", None, dt.date(2024, 1, 1), 1.0, 0.1), ("solar", None, dt.date(2024, 1, 1), 2.0, 0.3)],
        "tipo_energia string, ciudad string, fecha_transaccion date, cantidad_kwh double, precio_kwh double")
    rows = aggregates.aggregate_transacciones(tx, exact_scale=4).collect()
    assert len(rows) == 1 and rows[0].total_kwh == 3.0
    assert rows[0].avg_precio_kwh == pytest.approx(0.2)


def test_exact_avg_all_null_is_null(spark):
    df = spark.createDataFrame([(1, None)], "k int, v double")
    assert df.groupBy("k").agg(exact_avg("v", 4).alias("a")).first().a is None


def test_dedup_clientes_deterministic(spark):
    cl = spark.createDataFrame(
        [("A", "comercial", "X", dt.date(2024, 1, 1)),
         ("A", "industrial", None, dt.date(2024, 1, 1)),
         ("A", "comercial", "Z", dt.date(2023, 1, 1)),
         ("B", "desconocido", "Y", dt.date(2024, 1, 1))],
        "cliente_proveedor string, tipo_cliente string, ciudad string, processed_date date")
    rows = {r.cliente_proveedor: r for r in curated.dedup_clientes(cl).collect()}
    assert (rows["A"].tipo_cliente, rows["A"].ciudad) == ("industrial", None)
    assert rows["B"].tipo_cliente == "desconocido"
    # latest processing date wins over a greater value of an older load
    cl2 = spark.createDataFrame(
        [("A", "residencial", "Q", dt.date(2023, 1, 1)), ("A", "comercial", "X", dt.date(2024, 1, 1))],
        "cliente_proveedor string, tipo_cliente string, ciudad string, processed_date date")
    assert curated.dedup_clientes(cl2).first().tipo_cliente == "comercial"


def test_v_clientes_defaults_and_lexicographic_max(spark):
    tx = spark.createDataFrame(
        [("T1", "venta", "A", "X"), ("T2", "compra", "A", "Y"), ("T3", "Venta", "B", "Z"),
         ("T4", "venta", None, "Q")],
        "id_transaccion string, tipo_transaccion string, cliente_proveedor string, ciudad string")
    cl = spark.createDataFrame([("A", "comercial"), ("A", "desconocido")],
                               "cliente_proveedor string, tipo_cliente string")
    rows = {r.cliente: r for r in views.lake_view(spark, "v_clientes", tx, cl).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"].tipo_cliente == "desconocido"   # 'desconocido' > 'comercial'
    assert rows["A"].ciudad == "Y"
    assert rows["B"].tipo_cliente == "desconocido"   # no client row -> default


def test_lower_case_type_filter(spark):
    from wattlake.schemas import TRANSACCION_COLUMNS
    rows = [tuple(["T1" if c == "id_transaccion" else ("VeNtA" if c == "tipo_transaccion" else None)
                   for c in TRANSACCION_COLUMNS])]
    tx = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in TRANSACCION_COLUMNS))
    assert views.dwh_view(spark, "v_ventas", tx).count() == 1
    assert views.dwh_view(spark, "v_compras", tx).count() == 0


def test_export_order_and_bound(spark):
    from wattlake.schemas import TRANSACCIONES
    rows = [(f"T{i:03d}", dt.date(2024, 1, 1 + i % 3), "venta", "c", 1.0, 1.0, "e", "h", "x")
            for i in range(30)]
    tx = spark.createDataFrame(rows, TRANSACCIONES)
    out = exports.top_transacciones(tx, 5).collect()
    assert [r.id_transaccion for r in out] == ["T000", "T003", "T006", "T009", "T012"]


def test_price_summary_partition_year(spark):
    agg = spark.createDataFrame(
        [("solar", 0.1, 2024), ("solar", 0.3, 2024), ("eólica", 0.2, 2024), ("solar", 9.0, 2023)],
        "tipo_energia string, avg_precio_kwh double, year int")
    rows = aggregates.price_summary(agg, 2024, exact_scale=6).collect()
    assert [(r.tipo_energia, r.cnt) for r in rows] == [("solar", 2), ("eólica", 1)]
    assert rows[0].avg_price == pytest.approx(0.2)

