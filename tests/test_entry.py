"""Driver contract of ``__spark_entry__``."""

import re

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["tipo_energia", "ciudad", "fecha_transaccion", "total_kwh", "avg_precio_kwh"]
    assert df.count() > 0


def test_every_query_has_an_oracle_and_clean_names():
    from wattlake.plans.registry import ORACLE_SQL, QUERIES

    q, o = E.queries(), E.oracle_sql()
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(q) and set(ORACLE_SQL) <= set(o)
    for name in QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert not re.match(r"op\d+_", name) and name != "pipeline"
        assert callable(q[name]) and o[name].strip()
