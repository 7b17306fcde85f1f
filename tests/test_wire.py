import json

from pyspark.sql import functions as F

from ordersentry.streaming.screening import decode_orders, encode_orders, typed_orders

MSG = {"order_id": "O1", "user_id": "U1", "product_id": "P1", "quantity": 2, "amount": "Rp.30.000",
       "amount_numeric": 30000, "country": "ID", "status": "pending",
       "created_date": "2025-03-01T02:00:00+07:00", "event_ts": "2025-03-01T12:00:00.120000+00:00",
       "source": "streaming"}


def test_decode_quarantines_bad_messages_and_round_trips(spark):
    raw = spark.createDataFrame(
        [(0, 10, json.dumps(MSG).encode()), (0, 11, b"not json")],
        "partition int, offset long, value binary")
    ok, bad = decode_orders(raw)
    rows = ok.collect()
    assert len(rows) == 1 and rows[0].seq == 10 and rows[0].quantity == 2
    assert bad.select("value").first()[0] == "not json"
    typed = typed_orders(ok).first()
    assert typed.created_hour == 2  # hour as written in the text, not converted
    back = json.loads(encode_orders(ok).first().value)
    assert back == MSG


def test_encode_uses_order_id_as_key(spark):
    df = spark.createDataFrame([MSG]).select(*MSG.keys())
    assert encode_orders(df).select(F.col("key")).first()[0] == "O1"


def test_encode_keeps_microseconds_of_typed_timestamps(spark):
    raw = spark.createDataFrame([(0, 10, json.dumps(MSG).encode())], "partition int, offset long, value binary")
    ok, _ = decode_orders(raw)
    back = json.loads(encode_orders(typed_orders(ok)).first().value)
    assert back["event_ts"] == "2025-03-01T12:00:00.120000Z"
    assert back["created_date"] == "2025-02-28T19:00:00.000000Z"  # 02:00 at +07:00


def test_routing_puts_frauds_on_both_topics(spark):
    rows = [dict(MSG, order_id=f"O{i}", status=s) for i, s in enumerate(["Fraud", "Genuine", "Fraud"])]
    df = spark.createDataFrame(rows).select(*MSG.keys())
    from ordersentry.streaming.screening import routed_messages
    got = sorted((r.topic, r.key) for r in routed_messages(df).collect())
    assert got == [("fraud_alerts", "O0"), ("fraud_alerts", "O2"), ("processed_orders", "O0"),
                   ("processed_orders", "O1"), ("processed_orders", "O2")]
