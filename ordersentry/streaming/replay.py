"""The order stream replayed end to end over the driver's tables.

The mapped orders become raw messages (``partition, offset, value``) whose
offsets have gaps, with malformed messages and messages with unreadable
timestamps between them.  They are staged in ``PARTS`` steps; after each step
the screening query runs over what is new and stops, so every step but the
first is a restart from the checkpoint that continues with the carried
buffer.  The loader then stores what the screening query has processed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.domain import Domain
from ..schemas import ORDER_EVENT
from ..session import checkpoint_dir
from .keyed import start_keyed
from .loader import start_loader
from .screening import RoutedSink, decode_orders, parquet_sink, read_routed, start_screening, typed_orders
from .staged import read_staged, stage

# Fixed values of the scenario (shared with the oracle SQL).
OFFSET_STEP = 3               # offsets of orders: 0, 3, 6, ...
MALFORMED_EVERY, UNREADABLE_EVERY = 97, 101
PARTS = 3
LOAD_FILES = 8                # files of a loader batch, so that the table has several runs
CHANNELS = ("web", "app", "shop")
MESSAGE = "partition int, offset long, value string"


def messages(orders: DataFrame) -> DataFrame:
    """Raw messages of ``orders`` and the broken ones between them."""
    iso = {"created_date": "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "event_ts": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"}
    fields = [F.date_format(f.name, iso[f.name]).alias(f.name) if f.name in iso else F.col(f.name) for f in ORDER_EVENT.fields]
    seq = F.col("seq")
    number = seq.cast("string")
    # Fields that are no order columns, one of them nested.
    extra = [F.struct(F.element_at(F.array(*map(F.lit, CHANNELS)), (seq % len(CHANNELS) + 1).cast("int")).alias("channel"),
                      F.array(seq, seq + 1).alias("clicks")).alias("client"), F.concat(F.lit("note "), number).alias("note")]
    good = F.struct((seq * OFFSET_STEP).alias("offset"), F.to_json(F.struct(*fields, *extra)).alias("value"))
    malformed = F.when(seq % MALFORMED_EVERY == 0, F.struct(
        (seq * OFFSET_STEP + 1).alias("offset"), F.concat(F.lit('{"order_id": O'), number).alias("value")))
    unreadable = F.when(seq % UNREADABLE_EVERY == 0, F.struct(
        (seq * OFFSET_STEP + 2).alias("offset"),
        F.concat(F.lit('{"order_id":"X'), number, F.lit('","event_ts":"not a time"}')).alias("value")))
    return (orders.select(F.col("partition").cast("int").alias("partition"), F.explode(F.array(good, malformed, unreadable)).alias("m"))
            .filter("m IS NOT NULL").select("partition", "m.offset", "m.value"))


def replay(spark: SparkSession, sf_dir: str) -> str:
    """Screen the whole stream; returns the folder with ``out`` (processed, alerts) and ``quarantine``."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/replay-{uuid.uuid4().hex}"
    every = messages(Domain(spark, sf_dir).order_events)
    every.write.parquet(f"{root}/all")
    every = spark.read.schema(MESSAGE).parquet(f"{root}/all")
    last = every.agg(F.max("offset")).first()[0] or 0
    for part in range(PARTS):
        step = F.floor(F.col("offset") * PARTS / F.lit(last + 1))
        every.filter(step == part).write.mode("append").parquet(f"{root}/topic")
        query = start_screening(spark.readStream.schema(MESSAGE).parquet(f"{root}/topic"), f"{root}/checkpoint", f"{root}/state",
                                RoutedSink(f"{root}/out"), quarantine=parquet_sink(f"{root}/quarantine"),
                                trigger={"availableNow": True})
        query.awaitTermination()
    return root


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same topic in the same steps, screened with keyed state; every step
    but the first is a restart that finds the buffers in the state store."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}"
    messages(Domain(spark, sf_dir).order_events).write.parquet(f"{root}/all")
    every = spark.read.schema(MESSAGE).parquet(f"{root}/all")
    last = every.agg(F.max("offset")).first()[0] or 0
    for part in range(PARTS):
        step = F.floor(F.col("offset") * PARTS / F.lit(last + 1))
        every.filter(step == part).write.mode("append").parquet(f"{root}/topic")
        orders, _ = decode_orders(spark.readStream.schema(MESSAGE).parquet(f"{root}/topic"))
        start_keyed(typed_orders(orders), f"{root}/checkpoint", f"{root}/out", trigger={"availableNow": True}, state_partitions=PARTS).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def processed(spark: SparkSession, root: str) -> DataFrame:
    return read_routed(spark, f"{root}/out", "processed")


def alerts(spark: SparkSession, root: str) -> DataFrame:
    return read_routed(spark, f"{root}/out", "alerts")


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two consumers of one topic, which arrives in ``PARTS`` steps.  Both start
    when the first step is there, one at ``earliest``, the other at
    ``latest``, and are stopped; they resume when all steps are there.
    Returns what each has read: ``starting, partition, offset, value``."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/offsets-{uuid.uuid4().hex}"
    messages(Domain(spark, sf_dir).order_events).write.parquet(f"{root}/all")
    every = spark.read.schema(MESSAGE).parquet(f"{root}/all")
    last = every.agg(F.max("offset")).first()[0] or 0
    for part in range(PARTS):
        stage(every.filter(F.floor(F.col("offset") * PARTS / F.lit(last + 1)) == part), f"{root}/topic", part)
        if part in (0, PARTS - 1):
            for starting in ("earliest", "latest"):
                at = f"{root}/{starting}"
                stream = read_staged(spark, f"{root}/topic", starting, f"{at}/start.json")
                stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint") \
                    .trigger(availableNow=True).start().awaitTermination()
    read = [spark.read.schema(MESSAGE).parquet(f"{root}/{s}/out").withColumn("starting", F.lit(s)) for s in ("earliest", "latest")]
    return read[0].unionByName(read[1])


def load(spark: SparkSession, root: str) -> str:
    """Run the loader over the processed orders, a few files at a time; returns the raw_orders table's path."""
    schema = spark.read.parquet(f"{root}/out/processed").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", LOAD_FILES).parquet(f"{root}/out/processed").drop("batch_id", "attempt", "message")
    start_loader(stream, f"{root}/raw_orders", f"{root}/load-checkpoint", trigger={"availableNow": True}).awaitTermination()
    return f"{root}/raw_orders"
