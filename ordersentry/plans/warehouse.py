"""Warehouse models: staging (C1), dimensions (D1, D2), fact (D3), marts (M1-M7).

Each model is a function ``DataFrame(s) -> DataFrame``; the call graph is
the model graph.  Plan notes:

* The fact joins orders to both dimensions only to keep orders whose ids
  exist (inner joins, no dimension column is selected).  Catalyst prunes the
  dimension sides to their key; a dimension under the broadcast threshold is
  broadcast, a larger one is sort-merge joined with AQE splitting hot keys.
* Marts that join a dimension to the fact aggregate the fact by key first
  (partial + final hash aggregation, so a hot product or user costs one
  row per task), then join the small aggregate to the dimension and
  re-group by the model's grouping columns.  The re-group keeps the result
  exact even when a dimension key repeats, and it needs no extra shuffle
  after a join on the same key.
* Top-10 marts end in ``orderBy().limit()`` -> ``TakeOrderedAndProject``:
  each task keeps ten rows.  Ties are broken by id, then name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import FRAUD, GENUINE
from ..functions import digits_only, event_date, strip_prefix_id, title_words, trim_text


# ------------------------------------------------------------------ staging
def stg_users(raw_users: DataFrame) -> DataFrame:
    return raw_users.select("user_id", "name", "email", "phone_number", "created_date",
                            "ingestion_ts", "source")


def stg_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.select("product_id", "product_name", "brand", "category", "sub_category",
                               "currency", "price", "cost", "created_date", "ingestion_ts", "source")


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select("order_id", "user_id", "product_id", "quantity", "amount",
                             "amount_numeric", "country", "status", "created_date", "event_ts",
                             "source", "ingestion_ts")


# ---------------------------------------------------------------- dimensions
def dim_users(stg: DataFrame) -> DataFrame:
    return stg.select(
        "user_id",
        trim_text("name").alias("user_name"),
        "email",
        "phone_number",
        digits_only("phone_number").alias("phone_number_numeric"),
        "created_date",
        "ingestion_ts",
    )


def dim_products(stg: DataFrame) -> DataFrame:
    return stg.select(
        "product_id",
        trim_text("product_name").alias("product_name"),
        trim_text("brand").alias("brand"),
        title_words(trim_text("category")).alias("category"),
        trim_text("sub_category").alias("sub_category"),
        "currency",
        "price",
        "cost",
        "created_date",
        "ingestion_ts",
    )


# --------------------------------------------------------------------- fact
def fct_orders(stg: DataFrame, users: DataFrame, products: DataFrame,
               lenient: bool = False) -> DataFrame:
    """Orders whose user and product exist, ids as integers.

    ``lenient=False`` casts like the warehouse (a malformed id fails the
    query under ANSI mode); ``lenient=True`` turns it into NULL, which the
    inner join then drops (see :func:`fct_quarantine`).
    """
    o = stg.select(
        "order_id",
        strip_prefix_id("user_id", "U", lenient).alias("user_id"),
        strip_prefix_id("product_id", "P", lenient).alias("product_id"),
        "quantity",
        F.col("amount_numeric").alias("amount"),
        "country",
        F.col("status").alias("fraud_status"),
        "created_date",
        "event_ts",
        "ingestion_ts",
    )
    return (o.join(users.select("user_id"), on="user_id", how="inner")
             .join(products.select("product_id"), on="product_id", how="inner")
             .select("order_id", "user_id", "product_id", "quantity", "amount", "country",
                     "fraud_status", "created_date", "event_ts", "ingestion_ts"))


def fct_quarantine(stg: DataFrame) -> DataFrame:
    """Orders whose user or product id is not ``U<n>`` / ``P<n>``."""
    u = strip_prefix_id("user_id", "U", lenient=True)
    p = strip_prefix_id("product_id", "P", lenient=True)
    return stg.filter(u.isNull() | p.isNull())


# -------------------------------------------------------------------- marts
def _by_status(fct: DataFrame, status: str) -> DataFrame:
    return fct.filter(F.col("fraud_status") == status)


def mart_fraud_attempt_trends(fct: DataFrame) -> DataFrame:
    return (_by_status(fct, FRAUD)
            .groupBy(event_date("event_ts").alias("event_date"))
            .agg(F.count("order_id").alias("total_fraud_attempts")))


def mart_fraud_daily_saved_amount(fct: DataFrame) -> DataFrame:
    return (_by_status(fct, FRAUD)
            .groupBy(event_date("event_ts").alias("event_date"))
            .agg(F.sum("amount").alias("saved_amount"),
                 F.count("order_id").alias("fraud_attempts")))


_PRODUCT_KEYS = ["product_id", "product_name", "category", "sub_category"]
_USER_KEYS = ["user_id", "user_name"]


def mart_high_risk_products(fct: DataFrame, products: DataFrame) -> DataFrame:
    """Products with at least one fraud attempt.  The model's left join with
    ``HAVING count > 0`` keeps only matched products, so it is an inner join."""
    per_product = _by_status(fct, FRAUD).groupBy("product_id").agg(F.count("order_id").alias("_n"))
    return (products.select(*_PRODUCT_KEYS).join(per_product, "product_id", "inner")
            .groupBy(*_PRODUCT_KEYS).agg(F.sum("_n").alias("fraud_attempts"))
            .filter(F.col("fraud_attempts") > 0))


def mart_products_revenue_profit(fct: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and profit of genuine orders per product; NULL (not 0) for a
    product without genuine orders.

    ``sum(amount - cost * quantity)`` over a product's orders equals
    ``sum(amount) - cost * sum(quantity)`` over the orders where both are
    present, so the fact is reduced to three sums per product before the join.
    """
    both = F.col("amount").isNotNull() & F.col("quantity").isNotNull()
    per_product = (_by_status(fct, GENUINE).groupBy("product_id").agg(
        F.sum("amount").alias("_rev"),
        F.sum(F.when(both, F.col("amount"))).alias("_amt"),
        F.sum(F.when(both, F.col("quantity"))).alias("_qty")))
    joined = products.select(*_PRODUCT_KEYS, "cost").join(per_product, "product_id", "left")
    return (joined.groupBy(*_PRODUCT_KEYS)
            .agg(F.sum("_rev").alias("revenue"),
                 F.sum(F.col("_amt") - F.col("cost") * F.col("_qty")).alias("profit")))


def _top10(df: DataFrame, metric: str, keys: list[str]) -> DataFrame:
    return df.orderBy(F.col(metric).desc(), *[F.col(k).asc() for k in keys]).limit(10)


def _ranked_rows(dim: DataFrame, keys: list[str], per_key: DataFrame, unique_keys: bool) -> DataFrame:
    """The dimension rows a top-10 mart has to rank.

    In general every row (dim LEFT JOIN per-key counts).  With unique
    dimension ids whose fact ids all exist in the dimension (both hold after
    the key-test gate, the fact being an inner join) the top ten can only
    be among the ten best-counted ids and, when fewer than ten ids have
    orders, the ten smallest dimension rows: at most twenty ids, so the
    dimension is only scanned and filtered, never shuffled.
    """
    rows = dim.select(*keys)
    if not unique_keys:
        return rows
    id_col = keys[0]
    best = per_key.orderBy(F.col("_n").desc(), F.col(id_col).asc()).limit(10).select(id_col)
    first = rows.orderBy(*keys).limit(10).select(id_col)
    return rows.join(best.unionByName(first), id_col, "left_semi")


def mart_top10_active_users(fct: DataFrame, users: DataFrame, unique_keys: bool = False) -> DataFrame:
    per_user = _by_status(fct, GENUINE).groupBy("user_id").agg(F.count("order_id").alias("_n"))
    counted = (_ranked_rows(users, _USER_KEYS, per_user, unique_keys).join(per_user, "user_id", "left")
               .groupBy(*_USER_KEYS).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orders_count")))
    return _top10(counted, "orders_count", _USER_KEYS)


def mart_top10_selling_products(fct: DataFrame, products: DataFrame, unique_keys: bool = False) -> DataFrame:
    per_product = _by_status(fct, GENUINE).groupBy("product_id").agg(F.count("order_id").alias("_n"))
    counted = (_ranked_rows(products, _PRODUCT_KEYS, per_product, unique_keys)
               .join(per_product, "product_id", "left")
               .groupBy(*_PRODUCT_KEYS).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_orders")))
    return _top10(counted, "total_orders", _PRODUCT_KEYS)


def mart_top10_users_fraud(fct: DataFrame, users: DataFrame, unique_keys: bool = False) -> DataFrame:
    per_user = _by_status(fct, FRAUD).groupBy("user_id").agg(
        F.count("order_id").alias("_n"), F.max("event_ts").alias("_last"))
    counted = (_ranked_rows(users, _USER_KEYS, per_user, unique_keys).join(per_user, "user_id", "left")
               .groupBy(*_USER_KEYS).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("fraud_attempts"),
                                         F.max("_last").alias("last_fraud_ts")))
    return _top10(counted, "fraud_attempts", _USER_KEYS)


MARTS = {
    "mart_fraud_attempt_trends": lambda fct, users, products, unique_keys=False: mart_fraud_attempt_trends(fct),
    "mart_fraud_daily_saved_amount":
        lambda fct, users, products, unique_keys=False: mart_fraud_daily_saved_amount(fct),
    "mart_high_risk_products":
        lambda fct, users, products, unique_keys=False: mart_high_risk_products(fct, products),
    "mart_products_revenue_profit":
        lambda fct, users, products, unique_keys=False: mart_products_revenue_profit(fct, products),
    "mart_top10_active_users":
        lambda fct, users, products, unique_keys=False: mart_top10_active_users(fct, users, unique_keys),
    "mart_top10_selling_products":
        lambda fct, users, products, unique_keys=False: mart_top10_selling_products(fct, products, unique_keys),
    "mart_top10_users_fraud":
        lambda fct, users, products, unique_keys=False: mart_top10_users_fraud(fct, users, unique_keys),
}
