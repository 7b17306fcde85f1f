"""Every registered query against its DuckDB oracle (the driver's check,
at the smallest scale)."""

import __spark_entry__ as E
from ordersentry import catalog, oracle
from tests.conftest import SF_SMALL
from tools.compare_oracle import compare


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL)
    bad = {k: v for k, v in res.items() if not (v[1] and v[2] == v[3])}
    assert not bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_date", "saved_amount", "fraud_attempts"]
    assert df.count() > 0


def test_dirty_stream_is_dirty(spark):
    q = catalog.queries()
    assert q["fct_quarantine"](spark, SF_SMALL).count() > 0
    assert 0 < q["fct_orders_dirty"](spark, SF_SMALL).count() < q["stg_orders"](spark, SF_SMALL).count()
    assert q["fraud_verdict_dirty"](spark, SF_SMALL).select("partition").distinct().count() == 3
