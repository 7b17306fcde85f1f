import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordersentry.functions import (digits_only, hour_of_iso_text, rupiah, strip_prefix_id, title_words,
                                   trim_text, user_number)
from ordersentry.operators import quality
from ordersentry.operators import tables as ops
from ordersentry.schemas import RAW_USERS


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_dim_cleaning(spark):
    df = one_col(spark, ["  Nike Shoes Pro ", "\tTabbed ", None])
    got = [r[0] for r in df.select(trim_text("v")).collect()]
    assert got == ["Nike Shoes Pro", "Tabbed", None]
    cats = one_col(spark, [" men's shoes ", "tv, audio & cameras"])
    assert [r[0] for r in cats.select(title_words(trim_text("v"))).collect()] == \
        ["Men's Shoes", "Tv, Audio & Cameras"]


def test_phone_digits(spark):
    got = [r[0] for r in one_col(spark, ["+62 (0) 81-2", None]).select(digits_only("v")).collect()]
    assert got == ["620812", None]


def test_rupiah(spark):
    got = [r[0] for r in one_col(spark, [0, 999, 1234567, -1234], "long").select(rupiah("v")).collect()]
    assert got == ["Rp.0", "Rp.999", "Rp.1.234.567", "Rp.-1.234"]


def test_prefix_ids(spark):
    df = one_col(spark, ["U12", "P7", "12a"])
    lenient = [r[0] for r in df.select(strip_prefix_id("v", "U", lenient=True)).collect()]
    assert lenient == [12, None, None]
    with pytest.raises(Exception):
        one_col(spark, ["U12a"]).select(strip_prefix_id("v", "U")).collect()
    nums = [r[0] for r in one_col(spark, ["U5", "uU7", "UX", None, " U8"]).select(user_number("v")).collect()]
    assert nums == [5, 7, None, None, None]


def test_hour_as_written(spark):
    df = one_col(spark, ["2025-03-01T02:30:00+07:00", "2025-03-01T23:00:00+00:00"])
    assert [r[0] for r in df.select(hour_of_iso_text("v")).collect()] == [2, 23]


# ------------------------------------------------------------ raw tables
def users(spark, rows):
    now = dt.datetime(2025, 1, 1)
    return spark.createDataFrame(
        [(uid, name, email, None, now, now, "batch") for uid, name, email in rows], RAW_USERS)


def test_insert_ignore_first_wins_and_skips_existing(spark):
    target = users(spark, [(1, "A", "a@x")])
    incoming = spark.createDataFrame(
        [(0, "A new", "a@x"), (1, "B first", "b@x"), (2, "B second", "b@x")],
        "ord long, name string, email string")
    incoming = incoming.withColumn("phone_number", F.lit(None).cast("string")) \
        .withColumn("created_date", F.lit(dt.datetime(2025, 1, 2)))
    out = ops.insert_ignore(target, incoming, "email", "ord", surrogate="user_id",
                            defaults={"ingestion_ts": F.current_timestamp(), "source": "batch"})
    rows = {r.email: (r.user_id, r.name) for r in out.collect()}
    assert rows == {"a@x": (1, "A"), "b@x": (2, "B first")}
    # Running the same batch again changes nothing.
    again = ops.insert_ignore(out, incoming, "email", "ord", surrogate="user_id",
                              defaults={"ingestion_ts": F.current_timestamp(), "source": "batch"})
    assert sorted(again.select("user_id", "email").collect()) == sorted(out.select("user_id", "email").collect())


def test_upsert_last_wins(spark):
    cols = "order_id string, status string, quantity long, ingestion_ts timestamp"
    t0 = dt.datetime(2025, 1, 1)
    target = spark.createDataFrame([("O1", "Genuine", 1, t0)], cols)
    batch = spark.createDataFrame(
        [(1, "O1", "Fraud", 1), (2, "O1", "Genuine", 9), (3, "O2", "Genuine", 2)],
        "ord long, order_id string, status string, quantity long")
    now = F.lit(dt.datetime(2025, 2, 1))
    out = {r.order_id: r for r in ops.upsert(target, batch, "order_id", "ord", now=now).collect()}
    assert (out["O1"].status, out["O1"].quantity, out["O1"].ingestion_ts) == ("Genuine", 9, dt.datetime(2025, 2, 1))
    assert out["O2"].quantity == 2
    empty = batch.limit(0)
    assert ops.upsert(target, empty, "order_id", "ord", now=now).collect() == target.collect()


def test_high_water(spark):
    df = one_col(spark, ["O2", "O10", "O9"]).withColumnRenamed("v", "order_id")
    assert ops.high_water(df).collect()[0].max_counter == 10
    assert ops.high_water(df.limit(0)).collect()[0].max_counter == 0


def test_assign_keys_dense_in_order(spark):
    df = spark.createDataFrame([(o,) for o in [50, 3, 7, 1000, 8]], "ord long")
    out = ops.assign_keys(df, "k", "ord", 100, block=4).orderBy("ord").collect()
    assert [(r.ord, r.k) for r in out] == [(3, 101), (7, 102), (8, 103), (50, 104), (1000, 105)]


def test_read_table_limit(spark):
    df = users(spark, [(i, f"n{i}", f"{i}@x") for i in (5, 3, 9, 1)])
    got = ops.read_table(df, ["user_id", "email"], order_by="user_id", limit=2).collect()
    assert [r.user_id for r in got] == [1, 3]
    assert ops.read_table(df, ["user_id"], order_by="user_id", limit=0).count() == 4


# --------------------------------------------------------------- quality
def test_quality_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    assert [(r.k, r.n_rows) for r in quality.duplicate_keys(df, "k").collect()] == [(1, 2)]
    assert quality.null_keys(df, "k").count() == 2


def test_required_columns(spark):
    bad = spark.createDataFrame([(1, None, "e", None, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1), "b")],
                                RAW_USERS.simpleString().replace("struct<", "").rstrip(">").replace(":", " "))
    with pytest.raises(quality.RequiredColumnError):
        quality.assert_required(bad, RAW_USERS)


# ------------------------------------------------------- table writers
def test_upsert_table_key_ranges(spark, tmp_path):
    from ordersentry.sources.tables import key_range, read_table, upsert_table
    path = str(tmp_path / "orders")
    cols = "seq long, order_id string, status string, quantity long"
    part = key_range(width=10)
    upsert_table(spark, path, spark.createDataFrame(
        [(1, "O1", "Genuine", 1), (2, "O2", "Genuine", 1), (3, "O15", "Genuine", 1)], cols), "order_id", "seq",
        partition_of=part)
    upsert_table(spark, path, spark.createDataFrame(
        [(4, "O2", "Fraud", 5), (5, "O2", "Genuine", 7), (6, "O31", "Fraud", 1)], cols), "order_id", "seq",
        partition_of=part)
    rows = {r.order_id: (r.status, r.quantity, r.key_range) for r in read_table(spark, path).collect()}
    assert rows == {"O1": ("Genuine", 1, 0), "O2": ("Genuine", 7, 0), "O15": ("Genuine", 1, 1),
                    "O31": ("Fraud", 1, 3)}


def test_upsert_table_survives_a_crash_before_publishing(spark, tmp_path, monkeypatch):
    import os

    from ordersentry.sources import tables
    path = str(tmp_path / "orders")
    part = tables.key_range(width=10)

    def upsert(*rows):
        tables.upsert_table(spark, path, spark.createDataFrame(list(rows), "seq long, order_id string, v long"), "order_id", "seq", partition_of=part)

    def stored():
        return sorted((r.order_id, r.v) for r in tables.read_table(spark, path).collect())

    upsert((1, "O1", 1), (2, "O15", 1))
    publish = tables._publish

    def crash(*args):
        raise OSError("lost")

    monkeypatch.setattr(tables, "_publish", crash)
    with pytest.raises(OSError):
        upsert((3, "O1", 2), (4, "O25", 2))
    assert stored() == [("O1", 1), ("O15", 1)]          # the old table is whole
    monkeypatch.setattr(tables, "_publish", publish)
    upsert((3, "O1", 2), (4, "O25", 2))                  # the replayed batch
    assert stored() == [("O1", 2), ("O15", 1), ("O25", 2)]
    open_reader = tables.read_table(spark, path)
    upsert((5, "O2", 3))
    assert open_reader.count() == 3                      # its files are still there
    upsert((6, "O3", 4))
    assert stored() == [("O1", 2), ("O15", 1), ("O2", 3), ("O25", 2), ("O3", 4)]
    held = sorted(f"{v}/{k}" for v in os.listdir(f"{path}/data") for k in os.listdir(f"{path}/data/{v}") if k.startswith("key_range"))
    assert held == ["version=0/key_range=1", "version=1/key_range=2", "version=2/key_range=0", "version=3/key_range=0"]
    upsert()
    assert len(stored()) == 5


def test_insert_ignore_table_appends_only_new_rows(spark, tmp_path):
    from ordersentry.sources.tables import insert_ignore_table
    path = str(tmp_path / "users")
    users(spark, [(1, "A", "a@x")]).write.parquet(path)
    batch = spark.createDataFrame([(0, "A2", "a@x"), (1, "B", "b@x"), (2, "B2", "b@x")],
                                  "ord long, name string, email string") \
        .withColumn("phone_number", F.lit(None).cast("string")) \
        .withColumn("created_date", F.lit(dt.datetime(2025, 1, 2)))
    defaults = {"ingestion_ts": F.lit(dt.datetime(2025, 1, 3)), "source": "batch"}
    added = insert_ignore_table(spark, path, batch, "email", "ord", surrogate="user_id", defaults=defaults)
    assert [(r.user_id, r.name) for r in added.collect()] == [(2, "B")]
    insert_ignore_table(spark, path, batch, "email", "ord", surrogate="user_id", defaults=defaults)
    assert sorted((r.user_id, r.email) for r in spark.read.parquet(path).collect()) == [(1, "a@x"), (2, "b@x")]


def test_title_words_with_delimiters(spark):
    df = one_col(spark, ["t-shirt (big)/small", "MEN'S SHOES", None, ""])
    got = [r[0] for r in df.select(title_words("v", delimiters=" -/(")).collect()]
    assert got == ["T-Shirt (Big)/Small", "Men's Shoes", None, ""]
    assert [r[0] for r in df.select(title_words("v")).collect()][:2] == ["T-shirt (big)/small", "Men's Shoes"]


def test_insert_ignore_null_key_policy(spark):
    target = users(spark, [(1, "A", "a@x")])
    incoming = spark.createDataFrame([(0, "N", None), (1, "B", "b@x")], "ord long, name string, email string") \
        .withColumn("phone_number", F.lit(None).cast("string")) \
        .withColumn("created_date", F.lit(dt.datetime(2025, 1, 2)))
    defaults = {"ingestion_ts": F.lit(dt.datetime(2025, 1, 3)), "source": "batch"}
    with pytest.raises(Exception):
        ops.insert_ignore(target, incoming, "email", "ord", "user_id", defaults).collect()
    out = ops.insert_ignore(target, incoming, "email", "ord", "user_id", defaults, on_null_key="skip")
    assert sorted(r.email for r in out.collect()) == ["a@x", "b@x"]
