"""Randomised equivalence checks of the rewrites that matter for scale."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattlake.operators import curated, views

def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((v is None, str(v)) for v in t))


CLIENTS = st.sampled_from(["A", "B", "C", "D", None])
CITIES = st.sampled_from(["Cali", "Bogotá", "Medellín", None])
TYPES = st.sampled_from(["comercial", "industrial", "residencial", "desconocido", None])

def expected_clients(tx, cl):
    """client -> (greatest type of its client lines, greatest city), by hand."""
    out = {}
    for client, city in tx:
        if client is not None:
            types = [t for c, t in cl if c == client and t is not None]
            cities = [x for c, x in tx if c == client and x is not None]
            out[client] = (max(types, default="desconocido"), max(cities, default=None))
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(tx=st.lists(st.tuples(CLIENTS, CITIES), min_size=0, max_size=30),
       cl=st.lists(st.tuples(CLIENTS, TYPES), min_size=0, max_size=30))
def test_v_clientes_by_hand(spark, tx, cl):
    t = spark.createDataFrame(tx, "cliente_proveedor string, ciudad string")
    c = spark.createDataFrame(cl, "cliente_proveedor string, tipo_cliente string")
    got = views.lake_view(spark, "v_clientes", t, c).collect()
    assert {r.cliente: (r.tipo_cliente, r.ciudad) for r in got} == expected_clients(tx, cl)
    assert len(got) == len(expected_clients(tx, cl))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(CLIENTS, TYPES, CITIES, st.sampled_from([1, 2, 3])),
                     min_size=0, max_size=30))
def test_dedup_equals_window_form(spark, rows):
    import datetime as dt
    data = [(k, t, c, dt.date(2024, 1, d)) for k, t, c, d in rows]
    df = spark.createDataFrame(
        data, "cliente_proveedor string, tipo_cliente string, ciudad string, processed_date date")
    got = _sorted(curated.dedup_clientes(df).collect())
    df.createOrReplaceTempView("dedup_in")
    exp = _sorted(spark.sql("""
        SELECT cliente_proveedor, tipo_cliente, ciudad FROM (
          SELECT *, row_number() OVER (PARTITION BY cliente_proveedor ORDER BY
            processed_date DESC NULLS LAST, tipo_cliente DESC NULLS LAST, ciudad DESC NULLS LAST) rn
          FROM dedup_in) WHERE rn = 1""").collect())
    assert got == exp


@pytest.fixture(scope="module", autouse=True)
def _quiet(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
