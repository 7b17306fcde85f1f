"""Streaming screening (S1-S3, T1, T2) on Structured Streaming.

Source: Kafka (``partition`` and ``offset`` give the arrival order) or, in
tests, JSON files carrying ``partition`` and ``seq``.  Each micro-batch is
read once, decoded into a cache (the whole message beside the order columns),
screened with the same block-window plan as batch data, prefixed by the
buffer carried over from the previous batch: the last ``buffer_size - 1``
orders of every stream partition (the "tail").

The tail is the only state.  It is small (``buffer_size - 1`` rows per
stream partition), stamped with its batch id and written to one of two
alternating slots in the query's state folder on shared storage, so

* a replayed batch (after a failure or restart) reads the tail of the
  previous batch id and produces the same verdicts;
* no stream partition is pinned to one task: inside a batch the work is
  split by (partition, block) exactly like the batch plan, so a hot
  partition does not overload a task.

Verdicts are identical to :func:`ordersentry.operators.fraud.screen` on the
concatenated stream (tested).
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ALERTS_TOPIC, FRAUD, ORDERS_TOPIC, PROCESSED_TOPIC
from ..functions import hour_of_iso_text
from ..operators import fraud
from ..schemas import ORDER_EVENT
from ..sources.tables import exists, publish, read_if_exists

Sink = Callable[[DataFrame, int], None]

_TAIL_COLS = ["partition", "seq", "user_id", "product_id", "quantity", "event_ts"]
OFFSET_BLOCK = 1 << 15        # offsets of a stream partition that one task decodes and numbers together
FILE_ROWS, LEAST_FILES = 250_000, 8       # orders of a written file; files of a small batch


# ------------------------------------------------------------------ S1 / S2
def read_orders(spark: SparkSession, servers: str, topic: str = ORDERS_TOPIC,
                starting: str = "latest", max_offsets: int | None = None,
                options: dict | None = None) -> DataFrame:
    """The order topic as a stream (needs the Kafka connector on the
    classpath).  ``starting`` is ``latest`` or ``earliest``; once the query
    has a checkpoint it resumes from its committed offsets."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def _decoded(raw: DataFrame, schema: T.StructType, keep_message: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw messages as ``partition, seq, _json`` (the text of broken ones),
    ``_broken``, the order columns and, with ``keep_message``, ``message``;
    columns in ``keep`` come along."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    parsed = raw.select(
        *keep,
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("seq"),
        F.col("value").cast("string").alias("_json"),
    ).withColumn("_o", F.from_json("_json", with_corrupt, {"mode": "PERMISSIVE",
                                                           "columnNameOfCorruptRecord": "_corrupt"}))
    broken = F.col("_o").isNull() | F.col("_o._corrupt").isNotNull()
    for name in (f.name for f in schema.fields if f.name in ("created_date", "event_ts")):
        text = F.col(f"_o.{name}")
        broken = broken | (text.isNotNull() & text.try_cast("timestamp").isNull())
    message = []
    if keep_message:
        parsed = parsed.withColumn("message", F.try_parse_json("_json"))
        broken = broken | F.col("message").isNull()
        message = ["message"]
    # Only the quarantine needs the text; a cached order shall not hold it beside what was read from it.
    text = F.when(broken, F.col("_json")).alias("_json")
    return parsed.select(*keep, "partition", "seq", text, broken.alias("_broken"),
                         *[F.col(f"_o.{f.name}") for f in schema.fields], *message)


def decode_orders(raw: DataFrame, schema: T.StructType = ORDER_EVENT, keep_message: bool = False) -> tuple[DataFrame, DataFrame]:
    """UTF-8 JSON ``value`` -> order columns + ``partition``/``seq``.

    Returns ``(orders, quarantine)``: messages that are not a JSON object, or
    whose timestamps are not timestamps, land in the quarantine frame
    instead of stopping the stream (a replayed batch would meet them again).
    With ``keep_message`` the orders carry the whole message as a VARIANT
    column ``message``, with every field that is no order column, nested ones
    included; :func:`encode_orders` writes it out again.
    """
    rows = _decoded(raw, schema, keep_message)
    return rows.filter("NOT _broken").drop("_json", "_broken"), _quarantined(rows)


def _quarantined(rows: DataFrame) -> DataFrame:
    return rows.filter("_broken").select("partition", "seq", F.col("_json").alias("value"))


def typed_orders(df: DataFrame) -> DataFrame:
    """Cast the JSON text timestamps (ISO-8601, any offset) to timestamps;
    ``created_hour`` keeps the hour as written for the night rules."""
    return (df.withColumn("created_hour", hour_of_iso_text("created_date"))
              .withColumn("created_date", F.col("created_date").try_cast("timestamp"))
              .withColumn("event_ts", F.col("event_ts").try_cast("timestamp")))


def encode_orders(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """S3 wire format: one JSON object per order in ``value``, keyed by order id.

    Orders that carry their ``message`` become that message again with its
    ``status`` replaced and everything else as it came; others (or with
    ``cols``) are written from their columns."""
    key = F.col("order_id").cast("string").alias("key")
    # Typed timestamps are written as ISO-8601 with microseconds and offset.
    iso = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    columns = F.to_json(F.struct(*[F.col(c) for c in cols or [f.name for f in ORDER_EVENT.fields]]), iso)
    if cols or "message" not in df.columns:
        return df.select(key, columns.alias("value"))
    fields = F.expr("map_concat(map_filter(CAST(message AS MAP<STRING, VARIANT>), (k, v) -> k <> 'status'), "
                    "map('status', CAST(status AS VARIANT)))")
    return df.select(key, F.coalesce(F.to_json(fields), columns).alias("value"))


# --------------------------------------------------------------- sinks (S3)
def kafka_sink(servers: str, topic: str) -> Sink:
    def write(df: DataFrame, batch_id: int) -> None:
        (encode_orders(df).write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
    return write


def routed_messages(df: DataFrame, processed_topic: str = PROCESSED_TOPIC,
                    alerts_topic: str = ALERTS_TOPIC) -> DataFrame:
    """S3 as one frame of ``topic, key, value``: every order to the processed
    topic and frauds to the alert topic as well."""
    every = encode_orders(df).withColumn("topic", F.lit(processed_topic))
    frauds = encode_orders(df.filter(F.col("status") == FRAUD)).withColumn("topic", F.lit(alerts_topic))
    return every.unionByName(frauds)


def kafka_route_sink(servers: str, processed_topic: str = PROCESSED_TOPIC,
                     alerts_topic: str = ALERTS_TOPIC) -> Sink:
    """Both topics in one write job (the Kafka sink takes the topic per row).
    Pass it as ``processed`` with ``alerts=None``."""
    def write(df: DataFrame, batch_id: int) -> None:
        (routed_messages(df, processed_topic, alerts_topic).write.format("kafka")
         .option("kafka.bootstrap.servers", servers).save())
    return write


def parquet_sink(path: str) -> Sink:
    """Idempotent file sink: batch ``k`` (re)writes ``path/batch_id=k``."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


class RoutedSink:
    """S3 on files: a batch's orders go to ``path/processed`` and its frauds to
    ``path/alerts``, and become visible together when ``path/commits/<batch>.json``
    is renamed into place.  Pass it as ``processed`` with ``alerts=None``.

    A batch that failed anywhere before that leaves folders that no reader
    sees; its replay writes new ones.  A committed batch is not written again.
    Files hold up to about ``FILE_ROWS`` orders, whatever the number of tasks
    that screened them, so a reader opens no more than the orders need.
    Read with :func:`read_routed`.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        commits = f"{self.path}/commits"
        if exists(spark, f"{commits}/{batch_id}.json"):
            return
        attempt = f"a-{uuid.uuid4().hex}"
        for route, rows in (("processed", df), ("alerts", df.filter(F.col("status") == FRAUD))):
            self.write(rows, f"{self.path}/{route}/batch_id={batch_id}/attempt={attempt}")
        publish(spark, commits, f"{batch_id}.json", json.dumps({"batch_id": batch_id, "attempt": attempt}))

    def write(self, rows: DataFrame, folder: str) -> None:
        # Counted first: what is cached is then made by all tasks, not by the fewer that write.
        files = max(LEAST_FILES, math.ceil(rows.count() / FILE_ROWS))
        rows.coalesce(files).write.parquet(folder)


def read_routed(spark: SparkSession, path: str, route: str) -> DataFrame:
    """``processed`` or ``alerts`` of a :class:`RoutedSink`, committed batches only."""
    commits = spark.read.schema("batch_id long, attempt string").json(f"{path}/commits")
    rows = spark.read.parquet(f"{path}/{route}")
    return rows.join(commits, ["batch_id", "attempt"], "left_semi").drop("batch_id", "attempt")


# ---------------------------------------------------------------- T1 / T2
class BufferedScreening:
    """``foreachBatch`` function: screen a micro-batch with the carried tail,
    route all verdicts to ``processed`` and frauds to ``alerts`` (S3)."""

    def __init__(self, state_dir: str, processed: Sink, alerts: Sink | None = None,
                 params: fraud.FraudParams = fraud.DEFAULT, prepare: Callable[[DataFrame], DataFrame] | None = None,
                 dense_offsets: bool = False, quarantine: Sink | None = None):
        """By default the batch is renumbered 0, 1, 2, ... per partition,
        continuing after the carried tail: offsets skip values on compacted
        or transactional topics, and wherever a message is quarantined.
        ``dense_offsets=True`` promises ``seq`` without gaps and saves that.

        A batch of raw messages (``partition, offset, value``) is decoded
        here and needs ``quarantine``, the sink of what is not an order."""
        self.quarantine = quarantine
        self.state_dir = state_dir.rstrip("/")
        self.processed, self.alerts = processed, alerts
        self.params = params
        self.prepare = prepare or typed_orders
        self.dense_offsets = dense_offsets

    @staticmethod
    def _renumber(cur: DataFrame, tail: DataFrame | None, seen: list) -> DataFrame:
        """``seq`` 0, 1, 2, ... per partition, after the tail's.  ``seen`` (one
        row per stream partition) tells whether the offsets have gaps; without
        any, a subtraction numbers them."""
        cur = cur.withColumnRenamed("seq", "offset")
        dense = all(r["last"] - r["first"] + 1 == r["n"] for r in seen if r["n"])
        firsts = cur.sparkSession.createDataFrame([(r["partition"], r["first"]) for r in seen], "partition int, _first long")
        if tail is not None:
            ends = tail.groupBy("partition").agg((F.max("seq") + 1).alias("_base"))
            firsts = firsts.join(ends, "partition", "left")
        else:
            firsts = firsts.withColumn("_base", F.lit(None).cast("long"))
        # One row per stream partition: bounded by the topic's partition count.
        if dense:
            local = cur.join(F.broadcast(firsts), "partition").withColumn("_local", F.col("offset") - F.col("_first"))
        else:
            local = fraud.dense_sequence(cur, "offset", out_col="_local", block_col="_ob").join(F.broadcast(firsts), "partition")
        return local.withColumn("seq", F.coalesce("_base", F.lit(0)) + F.col("_local")).drop("_local", "_base", "_first")

    def _tail_path(self, batch_id: int) -> str:
        # Two alternating slots keep the state bounded: batch N reads slot
        # (N - 1) % 2 and overwrites slot N % 2.  Only the last, uncommitted
        # batch can be replayed, and the slot it reads is still intact then.
        return f"{self.state_dir}/tail/slot={batch_id % 2}"

    def _read_tail(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The tail written by the previous batch.  Every batch writes one
        (also when it is empty), so only batch 0 starts without; a missing
        tail later means lost state and stops the query rather than
        screening without the buffer."""
        if batch_id <= 0:
            return None
        path = self._tail_path(batch_id - 1)
        tail = read_if_exists(spark, path)
        if tail is None:
            raise RuntimeError(f"buffer tail of batch {batch_id - 1} not found at {path}")
        return tail.filter(F.col("_tail_of") == batch_id - 1).drop("_tail_of")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        raw = "value" in batch.columns
        if raw and self.quarantine is None:
            raise ValueError("raw messages need a quarantine sink")
        # The source is read once: all that follows reads the decoded batch.  It lies by blocks of
        # offsets, which are numbered where they lie: a file's row group grows far larger decoded.
        block = F.expr(f"CAST(`{'offset' if raw else 'seq'}` AS LONG) div {OFFSET_BLOCK}")
        if raw:
            batch = batch.withColumn("partition", F.col("partition").cast("int"))
        batch = batch.withColumn("_ob", block).repartition("partition", "_ob")
        rows = _decoded(batch, ORDER_EVENT, keep_message=True, keep=("_ob",)) if raw else batch.withColumn("_broken", F.lit(False))
        rows = rows.persist()
        good = F.col("seq").isNotNull() & ~F.col("_broken")
        try:
            # One row per stream partition; this fills the cache.
            seen = rows.groupBy("partition").agg(
                F.min(F.when(good, F.col("seq"))).alias("first"), F.max(F.when(good, F.col("seq"))).alias("last"),
                F.count(F.when(good, 1)).alias("n"), F.count(F.when(F.col("_broken"), 1)).alias("broken")).collect()
            # The first batch writes the quarantine even if it is empty, so that it can be read.
            if raw and (batch_id == 0 or any(r["broken"] for r in seen)):
                self.quarantine(_quarantined(rows), batch_id)
            cur = rows.filter("NOT _broken").drop("_broken", "_json")
            self._screen(self.prepare(cur), seen, spark, batch_id)
        finally:
            rows.unpersist()

    def _screen(self, cur: DataFrame, seen: list, spark: SparkSession, batch_id: int) -> None:
        tail = self._read_tail(spark, batch_id)
        if not self.dense_offsets:
            cur = self._renumber(cur, tail, seen)
        cur = cur.withColumn("_ctx", F.lit(False))
        both = cur if tail is None else cur.unionByName(
            tail.select(*_TAIL_COLS).withColumn("_ctx", F.lit(True)), allowMissingColumns=True)
        screened = fraud.screen(both, params=self.params, attribution=False).persist()
        try:
            out = screened.filter(~F.col("_ctx")).drop("_ctx", "_ob", "created_hour", "offset")
            self.processed(out, batch_id)
            if self.alerts is not None:
                self.alerts(out.filter(F.col("status") == FRAUD), batch_id)
            self._write_tail(screened, batch_id)
        finally:
            screened.unpersist()

    def _write_tail(self, rows: DataFrame, batch_id: int) -> None:
        keep = self.params.buffer_size - 1
        last = rows.groupBy("partition").agg(F.max("seq").alias("_last"))
        # One row per stream partition: bounded by the topic's partition count.
        tail = (rows.join(F.broadcast(last), "partition")
                .filter(F.col("seq") > F.col("_last") - keep)
                .select(*_TAIL_COLS, F.lit(batch_id).cast("long").alias("_tail_of")))
        tail.write.mode("overwrite").parquet(self._tail_path(batch_id))


def start_screening(orders: DataFrame, checkpoint: str, state_dir: str, processed: Sink,
                    alerts: Sink | None = None, params: fraud.FraudParams = fraud.DEFAULT,
                    trigger: dict | None = None, prepare=None, dense_offsets: bool = False,
                    quarantine: Sink | None = None):
    """Start the continuous screening query.  ``orders`` is the raw topic
    (``partition, offset, value``; then ``quarantine`` is required) or decoded orders."""
    if "value" in orders.columns and quarantine is None:
        raise ValueError("raw messages need a quarantine sink")
    fn = BufferedScreening(state_dir, processed, alerts, params, prepare, dense_offsets, quarantine)
    w = orders.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return w.start()
