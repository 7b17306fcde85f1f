"""DuckDB SQL that computes each registered query independently.

The SQL follows the original models literally (left joins, ``HAVING``,
``count`` over the joined rows) while the Spark plans are rewritten for
scale, so a match checks the rewrite.  The rolling buffer is a plain
``ROWS BETWEEN 199 PRECEDING`` window over the whole stream.

Views available: the driver's tables (``part``, ``customer``, ``events``, ...).
"""

from __future__ import annotations

# Fixed values of the mapping, the same as ordersentry.sources.tpch_domain.
_PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 9 = 0 THEN ' ' || p_name || '  ' ELSE p_name END AS product_name,
         p_brand AS brand,
         CASE WHEN p_partkey % 5 = 0 THEN ' ' || lower(p_type) || ' goods'
              ELSE lower(p_type) || ' goods' END AS category,
         CASE WHEN p_size < 10 THEN 'compact' WHEN p_size < 30 THEN 'standard' ELSE 'bulk' END AS sub_category,
         'IDR' AS currency,
         CAST(round(p_retailprice * 1000) AS BIGINT) AS price,
         CAST(floor(p_retailprice * 700) AS BIGINT) AS cost,
         TIMESTAMP '2023-12-01 00:00:00' + to_days(CAST(p_partkey % 28 AS INTEGER))
             + to_seconds(p_partkey % 86400) AS created_date,
         TIMESTAMP '2023-12-01 00:00:00' + to_days(CAST(p_partkey % 28 AS INTEGER))
             + to_seconds(p_partkey % 86400) + INTERVAL 1 DAY AS ingestion_ts,
         'batch' AS source
  FROM part)"""

_USERS = """
users AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 7 = 0 THEN '  ' || c_name || ' ' ELSE c_name END AS name,
         lower(replace(c_name, '#', '.')) || '@example.id' AS email,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              ELSE '+62 (' || CAST(c_nationkey AS VARCHAR) || ') 81-' || CAST(c_custkey AS VARCHAR) END AS phone_number,
         TIMESTAMP '2023-12-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER))
             + to_seconds((c_custkey * 37) % 86400) AS created_date,
         TIMESTAMP '2023-12-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER))
             + to_seconds((c_custkey * 37) % 86400) + INTERVAL 1 DAY AS ingestion_ts,
         'batch' AS source
  FROM customer)"""


def _events(variant: str) -> str:
    part, seq, ts, country = "0", "event_id", "ts", "CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'SG' ELSE 'ID' END"
    uid, pid = "'U' || CAST(user_id AS VARCHAR)", "'P' || CAST(ev.pnum AS VARCHAR)"
    if variant == "base":
        pnum = "(event_id * 7919 + 13) % (SELECT count(*) FROM part)"
        qty = "CASE WHEN event_id % 50 = 0 THEN 101 + event_id % 200 ELSE 1 + event_id % 2 END"
    elif variant == "dirty":
        part = "CAST(user_id % 3 AS INTEGER)"
        seq = "row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1"
        ts = "CASE WHEN event_id % 59 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END"
        country = f"CASE WHEN event_id % 61 = 0 THEN NULL ELSE {country} END"
        uid = ("CASE WHEN event_id % 83 = 0 THEN 'guest' WHEN event_id % 71 = 0 THEN 'U' || CAST(-1 - user_id AS VARCHAR) "
               f"ELSE {uid} END")
        pid = f"CASE WHEN ev.event_id % 89 = 0 THEN 'P?' || CAST(ev.pnum AS VARCHAR) ELSE {pid} END"
        pnum = "CASE WHEN event_id % 73 = 0 THEN -1 - event_id ELSE user_id % 20 END"
        qty = "CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 101 + event_id % 200 ELSE 1 END"
    else:
        pnum = "user_id % 20"
        qty = "1"
    return f"""
ev AS (
  SELECT {part} AS partition, {seq} AS seq, event_id,
         'O' || CAST(event_id AS VARCHAR) AS order_id,
         {uid} AS user_id,
         {pnum} AS pnum,
         CAST({qty} AS BIGINT) AS quantity,
         {country} AS country,
         'pending' AS status,
         date_trunc('second', ts) AS created_date,
         {ts} AS event_ts,
         'streaming' AS source
  FROM events),
order_events AS (
  SELECT ev.partition, ev.seq, ev.order_id, ev.user_id,
         {pid} AS product_id, ev.quantity,
         'Rp.' || replace(format('{{:,}}', pr.price * ev.quantity), ',', '.') AS amount,
         pr.price * ev.quantity AS amount_numeric,
         ev.country, ev.status, ev.created_date, ev.event_ts, ev.source
  FROM ev LEFT JOIN products pr ON pr.product_id = ev.pnum)"""


def _screen(window_seconds: float = 10.0, buffer_size: int = 200) -> str:
    micros = int(round(window_seconds * 1_000_000))
    return f"""
buffered AS (
  SELECT *,
         list(struct_pack(u := user_id, p := product_id, q := quantity,
                          n := TRY_CAST(regexp_replace(user_id, '^[Uu]+', '') AS BIGINT),
                          t := epoch_us(event_ts)))
           OVER (PARTITION BY partition ORDER BY seq
                 ROWS BETWEEN {buffer_size - 1} PRECEDING AND CURRENT ROW) AS buf
  FROM order_events),
recent AS (
  SELECT *, list_filter(buf, lambda x: x.t > epoch_us(event_ts) - {micros}) AS rec
  FROM buffered),
flagged AS (
  SELECT *,
         country IS DISTINCT FROM 'ID' AS f_country,
         COALESCE(hour(created_date) >= 0 AND hour(created_date) < 4
                  AND COALESCE(quantity, 0) > 100, false) AS f_night_quantity,
         COALESCE(hour(created_date) >= 0 AND hour(created_date) < 4
                  AND COALESCE(amount_numeric, 0) > 100000000, false) AS f_night_amount,
         len(list_filter(rec, lambda x: x.u IS NOT DISTINCT FROM user_id
                                       AND x.p IS NOT DISTINCT FROM product_id)) >= 2 AS bot_a,
         len(rec) >= 2
           AND len(list_filter(rec, lambda x: NOT (x.p IS NOT DISTINCT FROM product_id
                                                  AND x.q IS NOT DISTINCT FROM quantity))) = 0 AS bot_c,
         len(list_filter(rec, lambda x: x.n IS NULL)) = 0
           AND list_transform(rec, lambda x: x.n) = list_sort(list_transform(rec, lambda x: x.n)) AS ids_rise
  FROM recent),
screened AS (
  SELECT *, bot_c AND ids_rise AS bot_b,
         CASE WHEN f_country OR f_night_quantity OR f_night_amount OR bot_a OR bot_c
              THEN 'Fraud' ELSE 'Genuine' END AS verdict,
         CASE WHEN f_country THEN 'country' WHEN f_night_quantity THEN 'night_quantity'
              WHEN f_night_amount THEN 'night_amount' WHEN bot_a THEN 'bot_a'
              WHEN bot_c AND ids_rise THEN 'bot_b' WHEN bot_c THEN 'bot_c' END AS first_rule
  FROM flagged)"""


_RAW_ORDERS = """
raw_orders AS (
  SELECT order_id, user_id, product_id, quantity, amount, amount_numeric, country,
         verdict AS status, created_date, event_ts, source,
         created_date + INTERVAL 5 SECOND AS ingestion_ts
  FROM screened)"""

_MODELS = """
stg_users AS (
  SELECT user_id, name, email, phone_number, created_date, ingestion_ts, source FROM users),
stg_products AS (
  SELECT product_id, product_name, brand, category, sub_category, currency, price, cost,
         created_date, ingestion_ts, source FROM products),
stg_orders AS (
  SELECT order_id, user_id, product_id, quantity, amount, amount_numeric, country, status,
         created_date, event_ts, source, ingestion_ts FROM raw_orders),
dim_users AS (
  SELECT user_id, trim(name) AS user_name, email, phone_number,
         regexp_replace(phone_number, '[^0-9]', '', 'g') AS phone_number_numeric,
         created_date, ingestion_ts FROM stg_users),
dim_products AS (
  SELECT product_id, trim(product_name) AS product_name, trim(brand) AS brand,
         array_to_string(list_transform(string_split(lower(trim(category)), ' '),
                         lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS category,
         trim(sub_category) AS sub_category, currency, price, cost, created_date, ingestion_ts
  FROM stg_products),
fct_orders AS (
  SELECT o.order_id,
         CAST(regexp_replace(o.user_id, '^U', '') AS BIGINT) AS user_id,
         CAST(regexp_replace(o.product_id, '^P', '') AS BIGINT) AS product_id,
         o.quantity, o.amount_numeric AS amount, o.country, o.status AS fraud_status,
         o.created_date, o.event_ts, o.ingestion_ts
  FROM stg_orders o
  JOIN dim_users u ON CAST(regexp_replace(o.user_id, '^U', '') AS BIGINT) = u.user_id
  JOIN dim_products p ON CAST(regexp_replace(o.product_id, '^P', '') AS BIGINT) = p.product_id)"""


def prelude(variant: str = "base", window_seconds: float = 10.0, models: bool = True) -> str:
    parts = [_PRODUCTS, _USERS, _events(variant), _screen(window_seconds)]
    if models:
        # The dirty stream has malformed ids: the fact leaves them out instead of failing.
        parts += [_RAW_ORDERS, _MODELS.replace("CAST(regexp", "TRY_CAST(regexp") if variant == "dirty" else _MODELS]
    return "WITH " + ",".join(parts)


def _q(body: str, **kw) -> str:
    return prelude(**kw) + "\n" + body


MARTS_SQL = {
    "mart_fraud_attempt_trends": """
SELECT CAST(event_ts AS DATE) AS event_date, count(order_id) AS total_fraud_attempts
FROM fct_orders WHERE fraud_status = 'Fraud' GROUP BY 1""",
    "mart_fraud_daily_saved_amount": """
SELECT CAST(event_ts AS DATE) AS event_date, CAST(sum(amount) AS BIGINT) AS saved_amount,
       count(order_id) AS fraud_attempts
FROM fct_orders WHERE fraud_status = 'Fraud' GROUP BY 1""",
    "mart_high_risk_products": """
SELECT p.product_id, p.product_name, p.category, p.sub_category, count(f.order_id) AS fraud_attempts
FROM dim_products p
LEFT JOIN (SELECT * FROM fct_orders WHERE fraud_status = 'Fraud') f ON p.product_id = f.product_id
GROUP BY p.product_id, p.product_name, p.category, p.sub_category
HAVING count(f.order_id) > 0""",
    "mart_products_revenue_profit": """
SELECT p.product_id, p.product_name, p.category, p.sub_category,
       CAST(sum(g.amount) AS BIGINT) AS revenue,
       CAST(sum(g.amount - (p.cost * g.quantity)) AS BIGINT) AS profit
FROM dim_products p
LEFT JOIN (SELECT * FROM fct_orders WHERE fraud_status = 'Genuine') g ON p.product_id = g.product_id
GROUP BY p.product_id, p.product_name, p.category, p.sub_category""",
    "mart_top10_active_users": """
SELECT u.user_id, u.user_name, count(g.order_id) AS orders_count
FROM dim_users u
LEFT JOIN (SELECT * FROM fct_orders WHERE fraud_status = 'Genuine') g ON u.user_id = g.user_id
GROUP BY u.user_id, u.user_name
ORDER BY orders_count DESC, u.user_id, u.user_name LIMIT 10""",
    "mart_top10_selling_products": """
SELECT p.product_id, p.product_name, p.category, p.sub_category, count(g.order_id) AS total_orders
FROM dim_products p
LEFT JOIN (SELECT * FROM fct_orders WHERE fraud_status = 'Genuine') g ON p.product_id = g.product_id
GROUP BY p.product_id, p.product_name, p.category, p.sub_category
ORDER BY total_orders DESC, p.product_id, p.product_name, p.category, p.sub_category LIMIT 10""",
    "mart_top10_users_fraud": """
SELECT u.user_id, u.user_name, count(f.order_id) AS fraud_attempts, max(f.event_ts) AS last_fraud_ts
FROM dim_users u
LEFT JOIN (SELECT * FROM fct_orders WHERE fraud_status = 'Fraud') f ON u.user_id = f.user_id
GROUP BY u.user_id, u.user_name
ORDER BY fraud_attempts DESC, u.user_id, u.user_name LIMIT 10""",
}


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["stg_users"] = _q("SELECT * FROM stg_users")
    q["stg_products"] = _q("SELECT * FROM stg_products")
    q["stg_orders"] = _q("SELECT * FROM stg_orders")
    q["dim_users"] = _q("SELECT * FROM dim_users")
    q["dim_products"] = _q("SELECT * FROM dim_products")
    q["fct_orders"] = _q("SELECT * FROM fct_orders")
    for name, body in MARTS_SQL.items():
        q[name] = _q(body)
    q["fraud_row_rules"] = _q(
        "SELECT order_id, f_country, f_night_quantity, f_night_amount FROM screened", models=False)
    q["fraud_bot_rules"] = _q(
        "SELECT order_id, bot_a, bot_b, bot_c FROM screened", variant="dense", models=False)
    q["fraud_bot_rules_wide_window"] = _q(
        "SELECT order_id, bot_a, bot_b, bot_c FROM screened", variant="dense", window_seconds=600.0, models=False)
    q["fraud_verdict"] = _q(
        "SELECT order_id, verdict AS status, first_rule FROM screened", models=False)
    q["fraud_verdict_dense"] = _q(
        "SELECT order_id, verdict AS status, first_rule FROM screened", variant="dense", models=False)
    q["fraud_first_rule"] = _q(
        "SELECT first_rule, count(*) AS n_orders FROM screened GROUP BY first_rule", models=False)
    q["fct_quarantine"] = _q("""SELECT * FROM stg_orders
WHERE TRY_CAST(regexp_replace(user_id, '^U', '') AS BIGINT) IS NULL
   OR TRY_CAST(regexp_replace(product_id, '^P', '') AS BIGINT) IS NULL""", variant="dirty")
    q["fraud_verdict_dirty"] = _q(
        "SELECT order_id, partition, seq, verdict AS status, first_rule, bot_a, bot_b, bot_c FROM screened",
        variant="dirty", models=False)
    q["fct_orders_dirty"] = _q("SELECT * FROM fct_orders", variant="dirty")
    q["mart_products_revenue_profit_dirty"] = _q(MARTS_SQL["mart_products_revenue_profit"], variant="dirty")
    q.update(_more())
    return q


# Fixed values of the registered scenarios, the same as ordersentry.catalog.
_LOAD_TS = "TIMESTAMP '2024-02-01 00:00:00'"
_FIRST_LOAD_END = "TIMESTAMP '2023-12-15 00:00:00'"
_DAY = "DATE '2024-01-14'"     # run date 2024-01-15 minus one day

_RAW_COLS = ("order_id, user_id, product_id, quantity, amount, amount_numeric, country, status, "
             "created_date, event_ts, source")

MORE_SQL = {
    "fraud_alerts": """
SELECT order_id, user_id, product_id, quantity, amount, amount_numeric, country, verdict AS status,
       created_date, event_ts, source
FROM screened WHERE verdict = 'Fraud'""",
    "insert_ignore": f"""
, target AS (SELECT * FROM users WHERE created_date < {_FIRST_LOAD_END}),
incoming AS (
  SELECT user_id * 2 AS ord, upper(name) AS name, email, phone_number, created_date FROM users
  UNION ALL
  SELECT user_id * 2 + 1 AS ord, lower(name) AS name, email, phone_number, created_date FROM users),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY ord) AS rn FROM incoming)
  WHERE rn = 1 AND email IS NOT NULL),
fresh AS (SELECT f.* FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.email = f.email))
SELECT user_id, name, email, phone_number, created_date, ingestion_ts, source FROM target
UNION ALL
SELECT (SELECT coalesce(max(user_id), 0) FROM target) + row_number() OVER (ORDER BY ord) AS user_id,
       name, email, phone_number, created_date, {_LOAD_TS} AS ingestion_ts, 'batch' AS source
FROM fresh""",
    "insert_ignore_products": f"""
, target AS (SELECT * FROM products WHERE created_date < {_FIRST_LOAD_END}),
incoming AS (
  SELECT product_id * 2 AS ord, * FROM products
  UNION ALL
  SELECT product_id * 2 + 1 AS ord, * REPLACE (price + 1 AS price) FROM products),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_name ORDER BY ord) AS rn FROM incoming) WHERE rn = 1),
fresh AS (SELECT f.* FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.product_name = f.product_name))
SELECT * FROM target
UNION ALL
SELECT (SELECT coalesce(max(product_id), 0) FROM target) + row_number() OVER (ORDER BY ord) AS product_id,
       product_name, brand, category, sub_category, 'IDR' AS currency, price, cost, created_date,
       {_LOAD_TS} AS ingestion_ts, 'batch' AS source
FROM fresh""",
    "upsert_latest": f"""
, incoming AS (
  SELECT seq * 2 AS ord, {_RAW_COLS.replace('status', 'verdict AS status')} FROM screened WHERE verdict = 'Fraud'
  UNION ALL
  SELECT seq * 2 + 1 AS ord, {_RAW_COLS.replace('status', "'Genuine' AS status")}
  FROM screened WHERE verdict = 'Fraud'),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ord DESC) AS rn FROM incoming)
  WHERE rn = 1)
SELECT {_RAW_COLS}, ingestion_ts FROM raw_orders r
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.order_id = r.order_id)
UNION ALL
SELECT {_RAW_COLS}, {_LOAD_TS} AS ingestion_ts FROM latest""",
    "order_high_water": """
SELECT CAST(coalesce(max(CAST(regexp_replace(order_id, '^O', '') AS BIGINT)), 0) AS BIGINT) AS max_counter
FROM raw_orders""",
    "extract_day": f"SELECT * FROM raw_orders WHERE CAST(created_date AS DATE) = {_DAY}",
    "read_users_ordered": """
SELECT user_id, name, email, phone_number, created_date FROM users ORDER BY user_id LIMIT 100""",
    "read_products_ordered": """
SELECT product_id, product_name, brand, category, sub_category, currency, price, cost, created_date FROM products""",
    "dq_unique": """
SELECT 'raw_users' AS table_name, 'user_id' AS column_name, CAST(user_id AS VARCHAR) AS key_value,
       count(*) AS n_rows FROM users WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'raw_users', 'email', email, count(*) FROM users WHERE email IS NOT NULL
GROUP BY email HAVING count(*) > 1
UNION ALL
SELECT 'raw_products', 'product_id', CAST(product_id AS VARCHAR), count(*) FROM products
WHERE product_id IS NOT NULL GROUP BY product_id HAVING count(*) > 1
UNION ALL
SELECT 'raw_products', 'product_name', product_name, count(*) FROM products
WHERE product_name IS NOT NULL GROUP BY product_name HAVING count(*) > 1
UNION ALL
SELECT 'raw_orders', 'order_id', order_id, count(*) FROM raw_orders WHERE order_id IS NOT NULL
GROUP BY order_id HAVING count(*) > 1""",
    "dq_not_null": """
SELECT 'raw_users' AS table_name, 'user_id' AS column_name, count(*) AS n_rows,
       count(*) FILTER (WHERE user_id IS NULL) AS null_rows FROM users
UNION ALL
SELECT 'raw_users', 'phone_number', count(*), count(*) FILTER (WHERE phone_number IS NULL) FROM users
UNION ALL
SELECT 'raw_products', 'product_id', count(*), count(*) FILTER (WHERE product_id IS NULL) FROM products
UNION ALL
SELECT 'raw_orders', 'order_id', count(*), count(*) FILTER (WHERE order_id IS NULL) FROM raw_orders""",
    "reconcile_counts": """
, pairs AS (
  SELECT 'raw_users' AS table_name, s.day, s.n AS row_ingested, t.n AS row_loaded FROM
    (SELECT CAST(created_date AS DATE) AS day, count(*) AS n FROM users GROUP BY 1) s
    FULL OUTER JOIN (SELECT CAST(created_date AS DATE) AS day, count(*) AS n FROM dim_users GROUP BY 1) t
    ON s.day = t.day
  UNION ALL
  SELECT 'raw_products', coalesce(s.day, t.day), s.n, t.n FROM
    (SELECT CAST(created_date AS DATE) AS day, count(*) AS n FROM products GROUP BY 1) s
    FULL OUTER JOIN (SELECT CAST(created_date AS DATE) AS day, count(*) AS n FROM dim_products GROUP BY 1) t
    ON s.day = t.day
  UNION ALL
  SELECT 'raw_orders', coalesce(s.day, t.day), s.n, t.n FROM
    (SELECT CAST(created_date AS DATE) AS day, count(*) AS n FROM raw_orders GROUP BY 1) s
    FULL OUTER JOIN (SELECT CAST(created_date AS DATE) AS day, count(*) AS n FROM fct_orders GROUP BY 1) t
    ON s.day = t.day)
SELECT table_name, day, row_ingested, row_loaded,
       row_ingested IS NOT DISTINCT FROM row_loaded AS is_consistent FROM pairs""",
    "ingest_ledger": f"""
, counts AS (
  SELECT 'raw_users' AS source_table,
         (SELECT count(*) FROM users WHERE CAST(created_date AS DATE) = {_DAY}) AS row_ingested,
         (SELECT count(*) FROM dim_users WHERE CAST(created_date AS DATE) = {_DAY}) AS row_loaded
  UNION ALL
  SELECT 'raw_products',
         (SELECT count(*) FROM products WHERE CAST(created_date AS DATE) = {_DAY}),
         (SELECT count(*) FROM dim_products WHERE CAST(created_date AS DATE) = {_DAY})
  UNION ALL
  SELECT 'raw_orders',
         (SELECT count(*) FROM raw_orders WHERE CAST(created_date AS DATE) = {_DAY}),
         (SELECT count(*) FROM fct_orders WHERE CAST(created_date AS DATE) = {_DAY}))
SELECT 'raw_tables_daily' AS dag_id, 'scheduled__2024-01-15' AS run_id, source_table,
       'SUCCESS' AS run_status, row_ingested, source_table AS destination_table, row_loaded,
       TIMESTAMP '2024-01-15 01:00:00' AS start_time, TIMESTAMP '2024-01-15 01:05:00' AS end_time,
       TIMESTAMP '2024-01-15 00:00:00' AS execution_date,
       row_ingested IS NOT DISTINCT FROM row_loaded AS is_consistent
FROM counts""",
    "load_day_orders": f"SELECT * FROM raw_orders WHERE CAST(created_date AS DATE) = {_DAY}",
    "ledger_double_load": """
, counts AS (
  SELECT 'raw_users' AS source_table, count(*) AS n FROM users WHERE CAST(created_date AS DATE) = DATE '2023-12-10'
  UNION ALL
  SELECT 'raw_products', count(*) FROM products WHERE CAST(created_date AS DATE) = DATE '2023-12-10')
SELECT source_table, 'SUCCESS' AS run_status, n AS row_ingested, 2 * n AS row_loaded, n = 2 * n AS is_consistent FROM counts""",
    "ledger_failed_run": """
, counts AS (
  SELECT 'raw_users' AS source_table, count(*) AS n FROM users WHERE CAST(created_date AS DATE) = DATE '2023-12-10'
  UNION ALL
  SELECT 'raw_products', count(*) FROM products WHERE CAST(created_date AS DATE) = DATE '2023-12-10')
SELECT source_table, 'FAILED' AS run_status, n AS row_ingested,
       CASE WHEN source_table = 'raw_users' THEN n END AS row_loaded,
       CASE WHEN source_table = 'raw_users' THEN true END AS is_consistent FROM counts""",
    "extract_changes": """
, stored AS (
  SELECT order_id, status, quantity, amount_numeric FROM raw_orders WHERE created_date < TIMESTAMP '2024-01-08 00:00:00'),
sent AS (
  SELECT order_id, CASE WHEN created_date < TIMESTAMP '2024-01-08 00:00:00' AND status = 'Fraud' THEN 'Genuine' ELSE status END AS status,
         quantity, amount_numeric FROM raw_orders),
changed AS (SELECT * FROM sent EXCEPT SELECT * FROM stored)
SELECT order_id, CASE WHEN order_id IN (SELECT order_id FROM stored) THEN 'update' ELSE 'insert' END AS change,
       status, quantity, amount_numeric FROM changed""",
    "changes_loaded": f"""
SELECT {_RAW_COLS.replace('status', "CASE WHEN created_date < TIMESTAMP '2024-01-08 00:00:00' AND status = 'Fraud' THEN 'Genuine' ELSE status END AS status")}
FROM raw_orders""",
    "stream_verdict": "SELECT order_id, verdict AS status FROM screened",
    "stream_keyed_verdict": "SELECT order_id, verdict AS status, first_rule FROM screened",
    "stream_offsets": """
, topic AS (
  SELECT partition, seq * 3 AS "offset", order_id FROM order_events
  UNION ALL
  SELECT partition, seq * 3 + 1, NULL FROM order_events WHERE seq % 97 = 0
  UNION ALL
  SELECT partition, seq * 3 + 2, 'X' || seq FROM order_events WHERE seq % 101 = 0),
steps AS (SELECT *, floor("offset" * 3.0 / (max("offset") OVER () + 1)) AS step FROM topic)
SELECT 'earliest' AS starting, CAST(partition AS INTEGER) AS partition, CAST("offset" AS BIGINT) AS "offset", order_id FROM steps
UNION ALL
SELECT 'latest', CAST(partition AS INTEGER), CAST("offset" AS BIGINT), order_id FROM steps WHERE step > 0""",
    "stream_quarantine": """
SELECT event_id * 3 + 1 AS seq, '{"order_id": O' || event_id AS value FROM events WHERE event_id % 97 = 0
UNION ALL
SELECT event_id * 3 + 2, '{"order_id":"X' || event_id || '","event_ts":"not a time"}' FROM events WHERE event_id % 101 = 0""",
    "models_rebuilt": "SELECT * FROM fct_orders WHERE fraud_status = 'Fraud'",
    "stream_alerts": """
SELECT order_id, user_id, product_id, quantity, amount, amount_numeric, country, verdict AS status,
       created_date, event_ts, source
FROM screened WHERE verdict = 'Fraud'""",
    "stream_messages": """
SELECT order_id AS key, verdict AS status, amount_numeric, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_ts,
       ['web', 'app', 'shop'][CAST(seq % 3 + 1 AS INTEGER)] AS channel, seq + 1 AS second_click, 'note ' || seq AS note, 13 AS n_fields
FROM screened""",
    "stream_loaded_orders": f"SELECT {_RAW_COLS} FROM raw_orders",
    "stream_alerted_rows": f"SELECT {_RAW_COLS} FROM raw_orders WHERE status = 'Fraud'",
    "rupiah_format": """
SELECT order_id, amount_numeric,
       'Rp.' || replace(format('{:,}', amount_numeric), ',', '.') AS amount_text FROM raw_orders""",
    "amount_enrich": """
SELECT order_id, product_id, quantity, amount_numeric, amount FROM order_events""",
}


def _more() -> dict[str, str]:
    out = {}
    for name, body in MORE_SQL.items():
        if body.lstrip().startswith(","):
            out[name] = prelude() + body
        else:
            out[name] = prelude() + "\n" + body
    out["insert_ignore_indexed"] = out["insert_ignore"]     # the same rows from a stored table
    return out
