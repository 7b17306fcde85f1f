"""Warehouse model cases of FIXTURES.md §3, on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordersentry.plans import warehouse as wh

T0 = dt.datetime(2025, 3, 1, 12, 0, 0)


def orders(spark, rows):
    """rows: (order_id, user_id, product_id, quantity, amount, status)"""
    data = [(o, u, p, q, f"Rp.{a}", a, "ID", s, T0, T0 + dt.timedelta(minutes=i), "streaming", T0)
            for i, (o, u, p, q, a, s) in enumerate(rows)]
    return spark.createDataFrame(data, "order_id string, user_id string, product_id string, quantity long, "
                                       "amount string, amount_numeric long, country string, status string, "
                                       "created_date timestamp, event_ts timestamp, source string, "
                                       "ingestion_ts timestamp")


def users(spark, ids):
    return wh.dim_users(spark.createDataFrame(
        [(i, f"user {i}", f"{i}@x", None, T0, T0, "batch") for i in ids],
        "user_id long, name string, email string, phone_number string, created_date timestamp, "
        "ingestion_ts timestamp, source string"))


def products(spark, rows):
    """rows: (product_id, cost)"""
    return wh.dim_products(spark.createDataFrame(
        [(p, f"product {p}", "b", "c", "s", "IDR", 100, cost, T0, T0, "batch") for p, cost in rows],
        "product_id long, product_name string, brand string, category string, sub_category string, "
        "currency string, price long, cost long, created_date timestamp, ingestion_ts timestamp, source string"))


def test_fact_keeps_only_known_users_and_products(spark):
    o = orders(spark, [("O1", "U1", "P1", 1, 100, "Genuine"), ("O2", "U99", "P1", 1, 100, "Genuine"),
                       ("O3", "U1", "P99", 1, 100, "Genuine")])
    fct = wh.fct_orders(o, users(spark, [1]), products(spark, [(1, 10)]))
    assert [(r.order_id, r.user_id, r.product_id, r.fraud_status) for r in fct.collect()] == \
        [("O1", 1, 1, "Genuine")]


def test_bad_key_fails_strict_and_is_quarantined_lenient(spark):
    o = orders(spark, [("O1", "U1", "P1", 1, 100, "Genuine"), ("O2", "12a", "P1", 1, 100, "Genuine")])
    u, p = users(spark, [1]), products(spark, [(1, 10)])
    with pytest.raises(Exception):
        wh.fct_orders(o, u, p).collect()
    assert [r.order_id for r in wh.fct_orders(o, u, p, lenient=True).collect()] == ["O1"]
    assert [r.order_id for r in wh.fct_quarantine(o).collect()] == ["O2"]


def test_profit_is_null_without_genuine_orders(spark):
    o = orders(spark, [("O1", "U1", "P1", 2, 300, "Genuine"), ("O2", "U1", "P2", 1, 100, "Fraud")])
    p = products(spark, [(1, 50), (2, 40), (3, 30)])
    fct = wh.fct_orders(o, users(spark, [1]), p)
    got = {r.product_id: (r.revenue, r.profit) for r in wh.mart_products_revenue_profit(fct, p).collect()}
    assert got == {1: (300, 300 - 50 * 2), 2: (None, None), 3: (None, None)}


def test_high_risk_lists_only_products_with_frauds(spark):
    o = orders(spark, [("O1", "U1", "P1", 1, 100, "Fraud"), ("O2", "U1", "P1", 1, 100, "Fraud"),
                       ("O3", "U1", "P2", 1, 100, "Genuine")])
    p = products(spark, [(1, 10), (2, 10)])
    fct = wh.fct_orders(o, users(spark, [1]), p)
    assert [(r.product_id, r.fraud_attempts) for r in wh.mart_high_risk_products(fct, p).collect()] == [(1, 2)]


def test_top10_allows_zero_counts_and_breaks_ties_by_id(spark):
    u = users(spark, range(1, 13))
    o = orders(spark, [("O1", "U5", "P1", 1, 100, "Genuine"), ("O2", "U5", "P1", 1, 100, "Genuine"),
                       ("O3", "U9", "P1", 1, 100, "Genuine"), ("O4", "U2", "P1", 1, 100, "Fraud")])
    fct = wh.fct_orders(o, u, products(spark, [(1, 10)]))
    top = [(r.user_id, r.orders_count) for r in wh.mart_top10_active_users(fct, u).collect()]
    assert top == [(5, 2), (9, 1), (1, 0), (2, 0), (3, 0), (4, 0), (6, 0), (7, 0), (8, 0), (10, 0)]
    fraud_top = wh.mart_top10_users_fraud(fct, u).collect()
    assert (fraud_top[0].user_id, fraud_top[0].fraud_attempts, fraud_top[0].last_fraud_ts) == \
        (2, 1, T0 + dt.timedelta(minutes=3))
    assert fraud_top[1].last_fraud_ts is None


def test_daily_marts_count_and_sum_frauds_by_event_date(spark):
    o = orders(spark, [("O1", "U1", "P1", 1, 100, "Fraud"), ("O2", "U1", "P1", 1, 250, "Fraud"),
                       ("O3", "U1", "P1", 1, 999, "Genuine"), ("O4", "U1", "P1", 1, 5, "pending")])
    fct = wh.fct_orders(o, users(spark, [1]), products(spark, [(1, 10)]))
    saved = wh.mart_fraud_daily_saved_amount(fct).collect()
    assert [(r.event_date, r.saved_amount, r.fraud_attempts) for r in saved] == [(T0.date(), 350, 2)]
    trends = wh.mart_fraud_attempt_trends(fct).select(F.col("total_fraud_attempts")).collect()
    assert [r[0] for r in trends] == [2]


@pytest.mark.parametrize("n_users,active", [(12, [5, 9]), (30, list(range(3, 30, 2))), (8, [])])
def test_top10_candidate_path_equals_full_join(spark, n_users, active):
    u = users(spark, range(1, n_users + 1))
    rows = [(f"O{i}-{k}", f"U{uid}", "P1", 1, 100, "Genuine" if k % 3 else "Fraud")
            for i, uid in enumerate(active) for k in range(1 + uid % 4)]
    fct = wh.fct_orders(orders(spark, rows) if rows else orders(spark, [("O0", "U1", "P9", 1, 1, "Genuine")]),
                        u, products(spark, [(1, 10)]))
    for mart in (wh.mart_top10_active_users, wh.mart_top10_users_fraud):
        full = [tuple(r) for r in mart(fct, u).collect()]
        fast = [tuple(r) for r in mart(fct, u, unique_keys=True).collect()]
        assert fast == full
