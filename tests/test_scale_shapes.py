"""Plan shapes that must hold when nothing is small enough to broadcast
(the large-cluster case): exchanges per operator, partial aggregation."""

import pytest

from wattlake.operators import aggregates, views


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _physical(spark, df):
    df.createOrReplaceTempView("shape_probe")
    return spark.sql("EXPLAIN SELECT * FROM shape_probe").first()[0]


def test_client_view_one_exchange_per_side(no_broadcast):
    spark = no_broadcast
    tx = spark.createDataFrame([("A", "X"), ("A", "Y"), ("B", "Z")], "cliente_proveedor string, ciudad string")
    cl = spark.createDataFrame([("A", "comercial")], "cliente_proveedor string, tipo_cliente string")
    plan = _physical(spark, views.lake_view(spark, "v_clientes", tx, cl))
    assert "SortMergeJoin" in plan and "LeftOuter" in plan
    assert plan.count("Exchange hashpartitioning(cliente_proveedor") == 2
    assert plan.count("Exchange") == 2          # nothing added under the join
    assert plan.count("partial_max") == 2       # both sides reduced before the shuffle


def test_aggregate_one_exchange_partial_first(no_broadcast):
    spark = no_broadcast
    tx = spark.createDataFrame(
        [("solar", "Cali", None, 1.0, 0.1)],
        "tipo_energia string, ciudad string, fecha_transaccion date, cantidad_kwh double, precio_kwh double")
    plan = _physical(spark, aggregates.aggregate_transacciones(tx, exact_scale=4))
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan and "partial_count" in plan


@pytest.mark.parametrize("partitions", [8, 128, 2048])
@pytest.mark.parametrize("hot", [False, True])
def test_rows_that_an_export_sorts_do_not_grow(spark, partitions, hot):
    """At most (1 + SLACK) x n rows pass the cut-off, whatever the partitions and
    also when a third of all rows share the first key."""
    from pyspark.sql import functions as F

    from wattlake.operators import exports
    n = 5
    k = (F.col("id") * 7919 % 20_000).cast("int")
    df = spark.range(0, 20_000, 1, partitions).select(
        (F.when(F.col("id") % 3 == 0, 0).otherwise(k) if hot else k).alias("k"), F.col("id").cast("string").alias("name"), "id")
    rows, repeated, _ = exports.candidates(df, ["k", "name", "id"], n)
    assert repeated is None and n <= rows.count() <= (1 + exports.SLACK) * n
    want = sorted((r.k, r.name, r.id) for r in df.collect())[:n]
    assert [tuple(r) for r in exports.first_rows(df, ["k"], n).collect()] == want


def test_export_of_identical_rows_counts_them(spark):
    from wattlake.operators import exports
    df = spark.range(0, 9000, 1, 16).selectExpr("if(id % 3 = 0, 'a', concat('b', id % 7)) AS name", "1.5D AS mw")
    rows, repeated, copies = exports.candidates(df, ["name", "mw"], 10)
    assert rows.count() == 0 and repeated.count() == 3000 and copies == 10
    assert [tuple(r) for r in exports.first_rows(df, ["name"], 10).collect()] == [("a", 1.5)] * 10


def test_export_order_of_awkward_values(spark):
    """Against a plain ordered limit: nulls, NaN, infinities, long numbers, text
    that begins alike."""
    import random

    from pyspark.sql import functions as F

    from wattlake.operators import exports
    rng = random.Random(4)
    doubles = [None, float("nan"), float("inf"), -float("inf"), 0.0, 1e-320, -1e300, 1e300, 2.5, 2.5000001, -7.0]
    longs = [None, 2 ** 53, 2 ** 53 + 1, -2 ** 62, 2 ** 62, 2 ** 62 + 1, 0]
    texts = [None, "", "Customer#000000012", "Customer#000000021", "Customer#0000", "é", "漢", "Z", "a"]
    rows = [(rng.choice(doubles), rng.choice(longs), rng.choice(texts)) for _ in range(700)]
    df = spark.createDataFrame(rows, "d double, l long, t string").repartition(9)
    for order in (["d", "l", "t"], ["t", "d", "l"], ["l", "t", "d"]):
        for n in (1, 3, 20, 60, 150, 800):
            got = [str(tuple(r)) for r in exports.first_rows(df.select(*order), order, n).collect()]
            want = df.select(*order).orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n).collect()
            assert got == [str(tuple(r)) for r in want], (order, n)


def test_landing_is_executed_once_for_the_client_view(spark):
    from tests.conftest import SF_SMALL
    from wattlake.plans.registry import QUERIES
    plan = _physical(spark, QUERIES["v_clientes"](spark, SF_SMALL))
    assert "l_orderkey" not in plan and plan.count("FileScan") == 2      # the landed table, per side


def test_business_year_reaches_the_scan(spark):
    from tests.conftest import SF_SMALL
    from wattlake.plans.registry import QUERIES
    plan = _physical(spark, QUERIES["energy_price_summary"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
