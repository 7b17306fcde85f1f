"""Table and message schemas of the order platform.

Money is integer rupiah (``long``); timestamps are UTC.  Nullability marks
the columns the raw tables require (``False``) or allow to be missing.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _TS, _B = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType(), T.BooleanType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


RAW_USERS = T.StructType([
    _f("user_id", _L, False),
    _f("name", _S, False),
    _f("email", _S, False),
    _f("phone_number", _S),
    _f("created_date", _TS, False),
    _f("ingestion_ts", _TS, False),
    _f("source", _S, False),
])

RAW_PRODUCTS = T.StructType([
    _f("product_id", _L, False),
    _f("product_name", _S, False),
    _f("brand", _S),
    _f("category", _S),
    _f("sub_category", _S),
    _f("currency", _S),
    _f("price", _L, False),
    _f("cost", _L, False),
    _f("created_date", _TS, False),
    _f("ingestion_ts", _TS, False),
    _f("source", _S, False),
])

RAW_ORDERS = T.StructType([
    _f("order_id", _S, False),
    _f("user_id", _S, False),
    _f("product_id", _S, False),
    _f("quantity", _L, False),
    _f("amount", _S, False),
    _f("amount_numeric", _L, False),
    _f("country", _S, False),
    _f("status", _S, False),
    _f("created_date", _TS, False),
    _f("event_ts", _TS, False),
    _f("source", _S, False),
    _f("ingestion_ts", _TS, False),
])

# One JSON message on the order topic: the raw order without ingestion_ts,
# both timestamps as ISO-8601 text.
ORDER_EVENT = T.StructType([
    _f("order_id", _S),
    _f("user_id", _S),
    _f("product_id", _S),
    _f("quantity", _I),
    _f("amount", _S),
    _f("amount_numeric", _L),
    _f("country", _S),
    _f("status", _S),
    _f("created_date", _S),
    _f("event_ts", _S),
    _f("source", _S),
])

DIM_USERS_COLUMNS = ["user_id", "user_name", "email", "phone_number",
                     "phone_number_numeric", "created_date", "ingestion_ts"]
DIM_PRODUCTS_COLUMNS = ["product_id", "product_name", "brand", "category", "sub_category",
                        "currency", "price", "cost", "created_date", "ingestion_ts"]
FCT_ORDERS_COLUMNS = ["order_id", "user_id", "product_id", "quantity", "amount", "country",
                      "fraud_status", "created_date", "event_ts", "ingestion_ts"]

# Ingestion ledger: one event per state change (append only); the
# current state of a (run, table) is derived, see operators.ledger.
LEDGER = T.StructType([
    _f("dag_id", _S, False),
    _f("run_id", _S, False),
    _f("run_status", _S, False),
    _f("source_table", _S),
    _f("row_ingested", _L),
    _f("destination_table", _S),
    _f("row_loaded", _L),
    _f("start_time", T.TimestampNTZType()),
    _f("end_time", T.TimestampNTZType()),
    _f("execution_date", T.TimestampNTZType(), False),
    _f("is_consistent", _B),
    _f("event_seq", _L, False),
])

# Warehouse load schemas: the same columns as the raw tables, and which
# of them the load must find non-NULL (REQUIRED mode).
WAREHOUSE = {
    "raw_users": RAW_USERS,
    "raw_products": RAW_PRODUCTS,
    "raw_orders": RAW_ORDERS,
}


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
