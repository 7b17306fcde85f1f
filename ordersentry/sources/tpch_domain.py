"""The order platform's raw data, derived from the driver's TPC-H-like tables.

The test tables carry no e-commerce orders, so they are mapped:

* products  <- ``part``      (prices in integer rupiah)
* users     <- ``customer``  (e-mail and phone text made from the row)
* orders    <- ``events`` joined to the products for the price

Every column is a deterministic expression of the source row, so the same
mapping is written once more in SQL for the DuckDB oracle
(``ordersentry.oracle``).  The ``dense`` variant gives every user a fixed
product and quantity 1 so the same-product bot rules fire.  The ``dirty``
variant adds what real streams bring: several stream partitions, missing
countries and quantities, malformed ids, users and products that do not
exist, and back-dated events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import PENDING
from ..functions import line_amount, rupiah, with_prefix
from ..operators.fraud import dense_sequence

# Fixed values of the mapping (shared with the oracle SQL).
EPOCH = "2023-12-01 00:00:00"      # created_date base of users and products
PRODUCT_STEP, PRODUCT_SHIFT = 7919, 13   # base variant: product = (event * step + shift) % number of parts
BOT_PRODUCT_MOD = 20               # dense variant: product = user_id % 20
DIRTY_PARTITIONS = 3               # dirty variant: stream partitions
HOME_COUNTRY = "ID"
FOREIGN_COUNTRY = "SG"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(base: str, days: Column, seconds: Column) -> Column:
    return (F.lit(base).cast("timestamp_ntz")
            + F.make_dt_interval(days.cast("long"), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_products`` rows from ``part``."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    created = _ntz(EPOCH, key % 28, key % 86400)
    name = F.when(key % 9 == 0, F.concat(F.lit(" "), F.col("p_name"), F.lit("  "))).otherwise(F.col("p_name"))
    category = F.concat(F.lower(F.col("p_type")), F.lit(" goods"))
    category = F.when(key % 5 == 0, F.concat(F.lit(" "), category)).otherwise(category)
    sub = (F.when(F.col("p_size") < 10, "compact")
           .when(F.col("p_size") < 30, "standard").otherwise("bulk"))
    return p.select(
        key.alias("product_id"),
        name.alias("product_name"),
        F.col("p_brand").alias("brand"),
        category.alias("category"),
        sub.alias("sub_category"),
        F.lit("IDR").alias("currency"),
        F.round(F.col("p_retailprice") * 1000).cast("long").alias("price"),
        F.floor(F.col("p_retailprice") * 700).cast("long").alias("cost"),
        created.alias("created_date"),
        (created + F.expr("INTERVAL 1 DAY")).alias("ingestion_ts"),
        F.lit("batch").alias("source"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_users`` rows from ``customer``."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    created = _ntz(EPOCH, key % 28, (key * 37) % 86400)
    name = F.when(key % 7 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).otherwise(F.col("c_name"))
    email = F.concat(F.lower(F.regexp_replace(F.col("c_name"), "#", ".")), F.lit("@example.id"))
    phone = F.when(key % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("+62 ("), F.col("c_nationkey").cast("string"), F.lit(") 81-"), key.cast("string")))
    return c.select(
        key.alias("user_id"),
        name.alias("name"),
        email.alias("email"),
        phone.alias("phone_number"),
        created.alias("created_date"),
        (created + F.expr("INTERVAL 1 DAY")).alias("ingestion_ts"),
        F.lit("batch").alias("source"),
    )


def order_events(spark: SparkSession, sf_dir: str, variant: str = "base",
                 products: DataFrame | None = None) -> DataFrame:
    """Unscreened order messages (status ``pending``) in arrival order ``seq``.

    ``seq`` is the event id: dense, one stream partition (``partition`` 0);
    in the dirty variant each of three partitions is numbered by itself.
    The amount is priced by a lookup join on the products (J4 / C11).
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    partition, event_ts = F.lit(0), F.col("ts")
    uid, user_id, product_id = F.col("user_id"), with_prefix(F.col("user_id"), "U"), with_prefix(F.col("_pnum"), "P")
    if variant == "base":
        # Orders spread over the whole product table; its size is a one-row aggregate.
        n_parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n")).scalar()
        pnum = (eid * PRODUCT_STEP + PRODUCT_SHIFT) % n_parts
        qty = F.when(eid % 50 == 0, 101 + eid % 200).otherwise(1 + eid % 2)
    elif variant == "dense":
        pnum = F.col("user_id") % BOT_PRODUCT_MOD
        qty = F.lit(1).cast("long")
    elif variant == "dirty":
        partition = (uid % DIRTY_PARTITIONS).cast("int")
        pnum = F.when(eid % 73 == 0, -1 - eid).otherwise(uid % BOT_PRODUCT_MOD)          # unknown products
        qty = F.when(eid % 53 == 0, F.lit(None)).when(eid % 50 == 0, 101 + eid % 200).otherwise(F.lit(1))
        user_id = (F.when(eid % 83 == 0, F.lit("guest"))
                   .when(eid % 71 == 0, with_prefix(-1 - uid, "U")).otherwise(user_id))  # unknown users
        product_id = F.when(F.col("seq") % 89 == 0, F.concat(F.lit("P?"), F.col("_pnum"))).otherwise(product_id)
        event_ts = F.when(eid % 59 == 0, F.col("ts") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
    else:
        raise ValueError(f"unknown variant {variant!r}")
    country = F.when((F.col("event_type") == "error") & (eid % 4 == 0), FOREIGN_COUNTRY).otherwise(HOME_COUNTRY)
    if variant == "dirty":
        country = F.when(eid % 61 != 0, country)
    created = F.col("ts") - F.make_dt_interval(
        secs=(F.unix_micros(F.col("ts").cast("timestamp")) % 1_000_000 / 1_000_000).cast("decimal(18,6)"))
    orders = e.select(
        partition.alias("partition"),
        eid.alias("seq"),
        with_prefix(eid, "O").alias("order_id"),
        user_id.alias("user_id"),
        pnum.alias("_pnum"),
        qty.cast("long").alias("quantity"),
        country.alias("country"),
        F.lit(PENDING).alias("status"),
        created.alias("created_date"),
        event_ts.alias("event_ts"),
        F.lit("streaming").alias("source"),
    )
    prices = (products if products is not None else raw_products(spark, sf_dir)) \
        .select(F.col("product_id").alias("_pnum"), "price")
    priced = enrich_amount(orders, prices, key="_pnum").select(
        "partition", "seq", "order_id", "user_id", product_id.alias("product_id"),
        "quantity", "amount", "amount_numeric", "country", "status",
        "created_date", "event_ts", "source")
    if variant == "dirty":
        return dense_sequence(priced.withColumnRenamed("seq", "_offset"), "_offset").drop("_offset").select(*priced.columns)
    return priced


def enrich_amount(orders: DataFrame, prices: DataFrame, key: str) -> DataFrame:
    """Price lookup (J4) and line amount.

    A plain equi-join: the optimizer broadcasts the price side only when its
    measured size is under ``autoBroadcastJoinThreshold`` and otherwise
    shuffles both sides, so a product table of any size is safe.  Orders
    without a known product keep a NULL amount (left join).
    """
    amount = line_amount(F.col("price"), F.col("quantity"))
    keep = [c for c in orders.columns if c not in ("amount_numeric", "amount")]
    return orders.join(prices, on=key, how="left").select(
        *keep, amount.alias("amount_numeric"), rupiah(amount).alias("amount"))


def raw_orders(screened: DataFrame) -> DataFrame:
    """``raw_orders`` as the loader stores screened orders: ingestion_ts is
    fixed to five seconds after the order here so results are repeatable."""
    return screened.select(
        "order_id", "user_id", "product_id", "quantity", "amount", "amount_numeric", "country",
        "status", "created_date", "event_ts", "source",
        (F.col("created_date") + F.expr("INTERVAL 5 SECONDS")).alias("ingestion_ts"))
