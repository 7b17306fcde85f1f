"""Micro-batch loader (T3, C10): processed orders -> raw_orders upsert.

A batch is flushed at 100 rows or after 5 seconds, whichever comes first: on
Kafka, ``FLUSH`` (source options) with back-to-back triggers; other sources
have the 5 seconds.  Each batch is upserted by ``order_id`` (last message wins,
``ingestion_ts`` = load time) as a run of a merge-on-read table, so its cost
does not grow with the table; full tiers of runs are merged after a batch.  Offsets are committed by the checkpoint only after the batch is
written, and the upsert is idempotent by key, so a replayed batch leaves
the same rows, only with a newer ``ingestion_ts`` (at-least-once delivery,
exactly-once rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import PENDING
from ..operators.tables import with_defaults
from ..schemas import RAW_ORDERS
from ..sources import merge_table

#: Kafka source options: a batch starts at 100 new messages or 5 seconds after the last one.
FLUSH = {"minOffsetsPerTrigger": "100", "maxTriggerDelay": "5s"}


def coerce_orders(df: DataFrame) -> DataFrame:
    """Ids as text, quantity / amount_numeric as integers (missing or
    not a number -> 0), timestamps as timestamps.  A NULL id stays NULL (the
    loader quarantines or rejects it) instead of becoming the text ``None``."""
    def as_long(c):
        return F.coalesce(F.col(c).cast("string").try_cast("long"), F.lit(0)).alias(c)
    out = df
    for c in ("order_id", "user_id", "product_id"):
        out = out.withColumn(c, F.col(c).cast("string"))
    out = out.withColumn("quantity", as_long("quantity")).withColumn("amount_numeric", as_long("amount_numeric"))
    for c in ("created_date", "event_ts"):
        if dict(out.dtypes)[c] == "string":
            out = out.withColumn(c, F.col(c).try_cast("timestamp"))
    return out


DEFAULTS = {"status": PENDING}      # raw_orders columns with a default (ingestion_ts is set by the upsert)


class UpsertLoader:
    """``foreachBatch`` function upserting each batch into a merge-on-read table
    (:mod:`ordersentry.sources.merge_table`; ``sources.tables.read_table`` reads it).

    An order with a NULL in a required column of ``raw_orders`` (those that
    have no default) cannot be stored: with a ``quarantine`` sink it is
    written there and the rest is loaded; without one the batch fails, as the
    original insert does.
    """

    def __init__(self, table_path: str, key: str = "order_id", order_col: str = "seq",
                 quarantine=None, compaction: bool = True):
        self.table_path, self.key, self.order_col = table_path, key, order_col
        self.quarantine, self.compaction = quarantine, compaction

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        rows = coerce_orders(batch)
        key = F.col(self.key)
        rows = with_defaults(rows, DEFAULTS)
        required = [f.name for f in RAW_ORDERS.fields if not f.nullable and f.name in rows.columns]
        missing = F.lit(False)
        for c in {self.key, *required}:
            missing = missing | F.col(c).isNull()
        if self.quarantine is not None:
            self.quarantine(rows.filter(missing), batch_id)
            rows = rows.filter(~missing)
        else:
            rows = rows.withColumn(self.key, F.when(missing, F.raise_error(F.concat(
                F.lit(f"order with a NULL in a required column in batch {batch_id}; {self.key}: "),
                F.coalesce(key.cast("string"), F.lit("NULL"))))).otherwise(key))
        # Exactly the raw_orders columns (ingestion_ts is set by the upsert),
        # plus the arrival order that decides which version of a key wins.
        cols = [c for c in RAW_ORDERS.fieldNames() if c in rows.columns and c != "ingestion_ts"]
        # Not cached: it is read whole once, by the write; the check for emptiness stops at a first row.
        merge_table.upsert(spark, self.table_path, rows.select(*cols, self.order_col), self.key, self.order_col)
        if self.compaction:
            merge_table.compact(spark, self.table_path, self.key)


def start_loader(processed: DataFrame, table_path: str, checkpoint: str,
                 trigger: dict | None = None, order_col: str = "seq", quarantine=None):
    """Start the loader query.  The default trigger is every 5 seconds; with
    ``FLUSH`` on a Kafka source, pass ``trigger={"processingTime": "0 seconds"}``."""
    loader = UpsertLoader(table_path, order_col=order_col, quarantine=quarantine)
    return (processed.writeStream.foreachBatch(loader)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
