import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersentry.operators import fraud
from tests import brute

SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("seq", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("amount_numeric", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_date", T.TimestampType()),
    T.StructField("event_ts", T.TimestampType()),
])


def ts(s):
    return dt.datetime.fromisoformat(s)


# (order, user, product, qty, event_ts, extra, verdict, first rule) from FIXTURES.md §2
FIXTURE_ROWS = [
    ("O1", "U1", "P1", 1, "2025-03-01 12:00:00", {}, "Genuine", None),
    ("O2", "U2", "P2", 3, "2025-03-01 12:00:01", {}, "Genuine", None),
    ("O3", "U1", "P1", 2, "2025-03-01 12:00:05", {}, "Fraud", "bot_a"),
    ("O4", "U1", "P1", 1, "2025-03-01 12:00:15", {}, "Genuine", None),
    ("O5", "U9", "P7", 1, "2025-03-01 12:01:00", {}, "Genuine", None),
    ("O6", "U3", "P7", 1, "2025-03-01 12:01:02", {}, "Fraud", "bot_c"),
    ("O7", "U4", "P8", 2, "2025-03-01 12:02:00", {}, "Genuine", None),
    ("O8", "U5", "P8", 2, "2025-03-01 12:02:01", {}, "Fraud", "bot_b"),
    ("O9", "U6", "P8", 1, "2025-03-01 12:02:02", {}, "Genuine", None),
    ("O10", "UX", "P9", 1, "2025-03-01 12:03:00", {}, "Genuine", None),
    ("O11", "U7", "P9", 1, "2025-03-01 12:03:01", {}, "Fraud", "bot_c"),
    ("O12", "U80", "P80", 1, "2025-03-01 12:04:00", {"country": "SG"}, "Fraud", "country"),
    ("O13", "U80", "P80", 1, "2025-03-01 12:04:02", {}, "Fraud", "bot_a"),
    ("O14", "U81", "P81", 1, "2025-03-01 12:05:00", {"country": None}, "Fraud", "country"),
    ("O15", "U20", "P20", 101, "2025-03-02 03:59:59", {}, "Fraud", "night_quantity"),
    ("O16", "U21", "P21", 101, "2025-03-03 04:00:00", {}, "Genuine", None),
    ("O17", "U22", "P22", 100, "2025-03-04 02:00:00", {}, "Genuine", None),
    ("O18", "U23", "P23", 1, "2025-03-05 01:00:00", {"amount_numeric": 100000000}, "Genuine", None),
    ("O19", "U24", "P24", 1, "2025-03-06 01:00:00", {"amount_numeric": 100000001}, "Fraud", "night_amount"),
    ("O20", "U1", "P50", 1, "2025-03-07 12:00:00", {}, "Genuine", None),
    ("O21", "U1", "P50", 1, "2025-03-07 01:00:00", {}, "Fraud", "bot_a"),
    ("O22", "U1", "P50", 1, "2025-03-07 12:00:20", {}, "Genuine", None),
]


def make_orders(rows):
    out = []
    for i, r in enumerate(rows):
        o = {"partition": 0, "seq": i, "order_id": r["order_id"], "user_id": r["user_id"],
             "product_id": r["product_id"], "quantity": r["quantity"],
             "amount_numeric": r.get("amount_numeric", 1000), "country": r.get("country", "ID"),
             "created_date": r["event_ts"], "event_ts": r["event_ts"]}
        out.append(o)
    return out


def fixture_orders():
    rows = []
    for oid, u, p, q, t, extra, _, _ in FIXTURE_ROWS:
        r = {"order_id": oid, "user_id": u, "product_id": p, "quantity": q, "event_ts": ts(t)}
        r.update(extra)
        rows.append(r)
    return make_orders(rows)


def run(spark, orders, **kw):
    df = spark.createDataFrame([tuple(o[f.name] for f in SCHEMA.fields) for o in orders], SCHEMA)
    out = fraud.screen(df, **kw).select("seq", "status", "first_rule").orderBy("seq").collect()
    return [(r.status, r.first_rule) for r in out]


def test_fixture_verdicts(spark):
    got = run(spark, fixture_orders())
    want = [(v, f) for *_, v, f in FIXTURE_ROWS]
    assert got == want


def test_brute_oracle_agrees_with_fixture():
    assert brute.screen(fixture_orders()) == [(v, f) for *_, v, f in FIXTURE_ROWS]


@pytest.mark.parametrize("n_fill,last", [(198, ("Fraud", "bot_a")), (199, ("Genuine", None))])
def test_buffer_cap(spark, n_fill, last):
    t0 = ts("2025-03-08 12:00:00")
    rows = [{"order_id": "C0", "user_id": "U70", "product_id": "P70", "quantity": 1, "event_ts": t0}]
    rows += [{"order_id": f"F{i}", "user_id": f"U{1000 + i}", "product_id": f"P{1000 + i}",
              "quantity": 1, "event_ts": t0 + dt.timedelta(seconds=1)} for i in range(n_fill)]
    rows.append({"order_id": "C1", "user_id": "U70", "product_id": "P70", "quantity": 1,
                 "event_ts": t0 + dt.timedelta(seconds=2)})
    got = run(spark, make_orders(rows))
    assert got[-1] == last
    assert got == brute.screen(make_orders(rows))


def random_stream(seed, n, users, products, back_dated):
    rnd = random.Random(seed)
    t = ts("2025-03-01 00:00:00")
    rows = []
    for i in range(n):
        t += dt.timedelta(milliseconds=rnd.choice([0, 0, 100, 400, 900, 2500, 7000]))
        ev = t - dt.timedelta(seconds=rnd.randint(1, 3600)) if rnd.random() < back_dated else t
        u = rnd.choice(["UX", "u3"]) if rnd.random() < 0.03 else f"U{rnd.randint(1, users)}"
        rows.append({"order_id": f"O{i}", "user_id": u,
                     "product_id": f"P{rnd.randint(1, products)}", "quantity": rnd.choice([1, 1, 1, 2, 150]),
                     "amount_numeric": rnd.choice([1000, 200_000_000]),
                     "country": rnd.choice(["ID"] * 30 + ["SG", None]), "event_ts": ev})
    return make_orders(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), n=st.integers(1, 700), users=st.integers(1, 6),
       products=st.integers(1, 3), back=st.sampled_from([0.0, 0.05, 0.3]))
def test_block_window_matches_deque(spark, seed, n, users, products, back):
    orders = random_stream(seed, n, users, products, back)
    assert run(spark, orders) == brute.screen(orders)


def test_small_buffer_param_matches_deque(spark):
    orders = random_stream(7, 300, 3, 2, 0.1)
    got = run(spark, orders, params=fraud.FraudParams(buffer_size=7, window_seconds=30))
    assert got == brute.screen(orders, window=dt.timedelta(seconds=30), cap=7)


def test_partitions_are_separate_buffers(spark):
    orders = fixture_orders()
    # Interleave the same orders as a second stream partition: verdicts repeat.
    second = [dict(o, partition=1, order_id=o["order_id"] + "b") for o in orders]
    both = orders + second
    df = spark.createDataFrame([tuple(o[f.name] for f in SCHEMA.fields) for o in both], SCHEMA)
    out = fraud.screen(df).groupBy("partition").agg(F.sum((F.col("status") == "Fraud").cast("int")).alias("n"))
    n_fraud = sum(1 for *_, v, _ in FIXTURE_ROWS if v == "Fraud")
    assert {r.partition: r.n for r in out.collect()} == {0: n_fraud, 1: n_fraud}


def test_dense_sequence_fills_gaps(spark):
    rows = [(0, 5), (0, 9), (0, 40), (1, 3), (1, 1000), (0, 41)]
    df = spark.createDataFrame(rows, "partition int, offset long")
    out = fraud.dense_sequence(df, "offset", block=8).orderBy("partition", "offset").collect()
    assert [(r.partition, r.offset, r.seq) for r in out] == [
        (0, 5, 0), (0, 9, 1), (0, 40, 2), (0, 41, 3), (1, 3, 0), (1, 1000, 1)]


@pytest.mark.parametrize("seed,back,cap,window", [(1, 0.1, 200, 10), (2, 0.4, 200, 60), (3, 0.4, 20, 60), (4, 0.0, 5, 30), (5, 0.5, 2, 30)])
def test_one_product_bursts_with_back_dated_times(spark, seed, back, cap, window):
    """bot_b where nearly every recent order shares product and quantity, ids
    mostly rise and times fall by less than the window."""
    rnd = random.Random(seed)
    t, n, rows = ts("2025-03-01 06:00:00"), 0, []
    for i in range(450):
        t += dt.timedelta(milliseconds=rnd.choice([0, 50, 400, 3000, 15000]))
        n += rnd.choice([0, 1, 1, 1, 1, 1, 1, -1])
        late = dt.timedelta(seconds=rnd.choice([1, 5, window - 1, window, 3 * window])) if rnd.random() < back else dt.timedelta(0)
        rows.append({"order_id": f"O{i}", "user_id": "UX" if rnd.random() < 0.01 else f"U{n}", "product_id": "P1",
                     "quantity": 2 if rnd.random() < 0.01 else 1, "event_ts": t - late})
    orders = make_orders(rows)
    want = brute.screen(orders, window=dt.timedelta(seconds=window), cap=cap)
    assert run(spark, orders, params=fraud.FraudParams(buffer_size=cap, window_seconds=window)) == want
    assert {r for _, r in want} >= {"bot_b"} and any(r == "bot_c" for _, r in want) == (cap > 2 or back > 0)


def test_missing_times_products_and_quantities(spark):
    """Orders without a time are never recent; missing products or quantities equal each other."""
    t = ts("2025-03-01 06:00:00")
    rows = [(None, None, t), (None, None, t), ("U1", None, None), ("U2", "P1", t), ("U2", "P1", None), ("U3", "P1", t)]
    orders = make_orders([{"order_id": f"O{i}", "user_id": u, "product_id": p, "quantity": None, "event_ts": e} for i, (u, p, e) in enumerate(rows)])
    got = run(spark, [dict(o, created_date=t) for o in orders])
    assert [r for _, r in got] == [None, "bot_a", None, None, None, None]


def test_buffer_of_one_order_has_no_bots(spark):
    orders = random_stream(9, 120, 1, 1, 0.1)
    got = run(spark, orders, params=fraud.FraudParams(buffer_size=1))
    assert got == brute.screen(orders, cap=1) and not {r for _, r in got} & {"bot_a", "bot_b", "bot_c"}


def test_no_buffer_is_materialized(spark):
    import contextlib
    import io
    df = spark.createDataFrame([tuple(o[f.name] for f in SCHEMA.fields) for o in fixture_orders()], SCHEMA)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        fraud.screen(df, keep_flags=True).explain("formatted")
    plan = out.getvalue()
    assert "collect_list" not in plan and "aggregate(" not in plan
    assert plan.count("Exchange (") == 1           # one shuffle, on (partition, block)


def test_verdict_without_attribution(spark):
    orders = random_stream(21, 500, 3, 2, 0.2)
    df = spark.createDataFrame([tuple(o[f.name] for f in SCHEMA.fields) for o in orders], SCHEMA)
    out = fraud.screen(df, attribution=False)
    assert "first_rule" not in out.columns
    assert [r.status for r in out.orderBy("seq").collect()] == [s for s, _ in brute.screen(orders)]


def test_a_verdict_copies_few_orders(spark):
    """Only the end of a block is context for the next one; the verdict alone takes wide blocks."""
    n = 10_000
    orders = spark.range(n).selectExpr("0 AS partition", "id AS seq", "CONCAT('U', id % 3) AS user_id", "'P1' AS product_id",
                                       "1 AS quantity", "timestamp_micros(id) AS event_ts")
    for size in (1, 7, 200, 5000):
        params = fraud.FraudParams(buffer_size=size)
        for width in (size, fraud.block_width(params)):
            blocks = fraud.with_blocks(orders, params=params, width=width)
            own, copies = blocks.filter("_own"), blocks.filter("NOT _own")
            assert own.count() == n and own.filter(f"_blk <> seq div {width}").isEmpty()
            # A copy goes to the next block's first order's buffer, and nothing else does.
            assert copies.filter(f"_blk * {width} - seq NOT BETWEEN 1 AND {size - 1}").isEmpty()
            assert copies.count() == sum(i % width > width - size for i in range(n))
    plan = fraud.screen(orders.selectExpr("*", "'ID' AS country", "CAST(event_ts AS timestamp) AS created_date", "1L AS amount_numeric"),
                        attribution=False)
    assert f"div {fraud.block_width()}" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert fraud.block_width() + 199 < 4096 and n // fraud.block_width() * 199 < n / 10


@pytest.mark.parametrize("size", [3, 200])
def test_wide_blocks_give_the_same_verdicts(spark, monkeypatch, size):
    """Many blocks, with falling times, against blocks of one buffer."""
    orders = spark.range(3000).selectExpr(
        "CAST(id % 2 AS INT) AS partition", "id div 2 AS seq", "CONCAT('U', id % 5) AS user_id", "CONCAT('P', id * id % 7 div 3) AS product_id",
        "1 + id % 11 div 9 AS quantity", "'ID' AS country", "1L AS amount_numeric", "TIMESTAMP '2024-01-01 12:00:00' AS created_date",
        "timestamp_seconds(1700000000 + id * 3 - IF(id % 13 = 0, 40, 0)) AS event_ts")
    params = fraud.FraudParams(buffer_size=size)
    verdicts = lambda: fraud.screen(orders, params=params, attribution=False).select("partition", "seq", "status").orderBy("partition", "seq").collect()
    monkeypatch.setattr(fraud, "BLOCK_ROWS", 800)
    wide = verdicts()
    monkeypatch.setattr(fraud, "BLOCK_ROWS", 1)
    assert wide == verdicts() and {r.status for r in wide} == {"Fraud", "Genuine"}
