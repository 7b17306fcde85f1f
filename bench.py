"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  A warm-up pass (JIT,
file listing) precedes the timed runs; each query's time is the best of
``BENCH_RUNS`` (default 2) runs, which damps the noise of a shared host.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "fraud_verdict",            # block-window screening of the whole order stream
    "fraud_verdict_dense",      # same, with the bot rules firing
    "fct_orders",               # screening + staging + dimension joins
    "mart_fraud_attempt_trends",
    "mart_fraud_daily_saved_amount",
    "mart_high_risk_products",
    "mart_products_revenue_profit",
    "mart_top10_active_users",
    "mart_top10_selling_products",
    "mart_top10_users_fraud",
    "upsert_latest",
    "insert_ignore",
    "reconcile_counts",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stream_screening(spark, sf_dir: str, n_batches: int = 10) -> float:
    """Replay the order stream as ``n_batches`` JSON files through the
    streaming screener (one file per micro-batch); returns seconds.  The
    input files are staged before the clock starts, in a new folder under
    the session's checkpoint folder."""
    import uuid

    from pyspark.sql import functions as F

    from ordersentry.plans.domain import Domain
    from ordersentry.schemas import ORDER_EVENT
    from ordersentry.session import checkpoint_dir
    from ordersentry.streaming.screening import BufferedScreening, parquet_sink
    from pyspark.sql import types as T

    root = f"{checkpoint_dir(spark).rstrip('/')}/bench-stream-{uuid.uuid4().hex}"
    orders = Domain(spark, sf_dir).order_events
    n = orders.count()
    text = (orders.withColumn("_file", F.floor(F.col("seq") * n_batches / F.lit(max(n, 1))))
            .withColumn("created_date", F.date_format("created_date", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
            .withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")))
    # One file per micro-batch, written in arrival order (the file source
    # takes files by modification time).
    for i in range(n_batches):
        text.filter(F.col("_file") == i).drop("_file").coalesce(1).write.mode("append").json(f"{root}/src")
        time.sleep(0.05)
    schema = T.StructType(list(ORDER_EVENT.fields) + [T.StructField("partition", T.IntegerType()),
                                                      T.StructField("seq", T.LongType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{root}/src")
    fn = BufferedScreening(f"{root}/state", parquet_sink(f"{root}/processed"), parquet_sink(f"{root}/alerts"))
    t0 = time.perf_counter()
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ordersentry import catalog
    from ordersentry.session import get_session
    os.environ.setdefault("SPARK_DRIVER_MEMORY", "16g")
    spark = get_session(app="ordersentry-bench", master=f"local[{cpus}]",
                        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 4 * int(cpus))))
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = [n for n in sys.argv[1:] if n in qs]
    for n in names[:3]:  # warm-up: JIT and file listing
        run(qs[n](spark, sf_dir))
    times = {}
    for n in names:
        best = float("inf")
        for _ in range(RUNS):
            t0 = time.perf_counter()
            run(qs[n](spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        times[n] = round(best, 3)
    if len(sys.argv) == 1 or "stream_screening" in sys.argv[1:]:
        times["stream_screening"] = round(stream_screening(spark, sf_dir), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
