"""Screening with keyed state (T2), beside the carried tail of :mod:`.screening`.

The state store holds each stream partition's buffer as list state, so a
micro-batch needs no tail table, no renumbering and no driver-side step: it
suits topics of many small stream partitions.  A partition's rows of one
micro-batch meet in one task, whose Python holds ``STRETCH`` offsets of them at
a time: the others wait in files of a stretch each in the task's temp folder.
For few partitions with heavy traffic use
:func:`.screening.start_screening`, which splits them by blocks.

The stateful operator only sees what the buffer rules compare, as columns
without NULLs, and the order as one JSON text it hands through.  Row rules and
the verdict are columns before and after it.  Buffers are counted in
arrivals, so offsets may have gaps; a partition that appears later starts with
an empty buffer.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..constants import FRAUD, GENUINE
from ..functions import micros, user_number
from ..operators import fraud

NO_TIME = -(1 << 63)
BUFFER = "same_order string, same_user string, number long, numbered boolean, time long"
_COLUMNS = [c.split()[0] for c in BUFFER.split(", ")]
ROW_FLAGS = ("f_country", "f_night_quantity", "f_night_amount")
_ROWS_AT_ONCE = 2048
STRETCH = 1 << 15             # offsets that a task's Python sorts and flags at once
_ISO = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def bot_flags(orders: pd.DataFrame, first: int, params: fraud.FraudParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``bot_a``, ``bot_b``, ``bot_c`` of the rows from ``first`` on; ``orders``
    (columns of ``BUFFER``) in arrival order, earlier rows are context."""
    user, same = pd.factorize(orders["same_user"])[0], pd.factorize(orders["same_order"])[0]
    number, numbered, time = (orders[c].to_numpy() for c in ("number", "numbered", "time"))
    back = np.arange(params.buffer_size - 1, -1, -1)
    parts = []
    for lo in range(first, len(orders), _ROWS_AT_ONCE):
        i = np.arange(lo, min(lo + _ROWS_AT_ONCE, len(orders)))[:, None]
        at = i - back
        recent = (at >= 0) & (time[i] != NO_TIME)
        at = np.maximum(at, 0)
        recent &= (time[at] != NO_TIME) & (time[at] > time[i] - params.window_micros)
        a = (recent & (user[at] == user[i])).sum(1) >= 2
        c = (recent.sum(1) >= 2) & ~(recent & (same[at] != same[i])).any(1)
        ids = np.where(recent, number[at], NO_TIME)
        highest = np.maximum.accumulate(ids, axis=1)
        falls = (recent[:, 1:] & (ids[:, 1:] < highest[:, :-1])).any(1)
        parts.append((a, c & ~falls & ~(recent & ~numbered[at]).any(1), c))
    return tuple(np.concatenate(x) for x in zip(*parts))


def by_stretch(rows: Iterable[pd.DataFrame], folder: str, size: int = 0) -> Iterator[pd.DataFrame]:
    """``rows`` in the order of ``seq``, a stretch of ``size`` offsets at a time."""
    size, stretches = size or STRETCH, set()
    for part in rows:
        for stretch, some in part.groupby(part["seq"] // size):
            table = pa.Table.from_pandas(some, preserve_index=False)
            with open(f"{folder}/{stretch}", "ab") as f, pa.ipc.new_stream(f, table.schema) as out:
                out.write_table(table)
            stretches.add(stretch)
    for stretch in sorted(stretches):
        parts = []
        with open(f"{folder}/{stretch}", "rb") as f:
            while f.peek(1):
                parts.append(pa.ipc.open_stream(f).read_pandas())
        yield pd.concat(parts, ignore_index=True).sort_values("seq", ignore_index=True)


class RecentOrders(StatefulProcessor):
    """Keeps a stream partition's last orders and flags the new ones."""

    def __init__(self, params: fraud.FraudParams):
        self.params = params

    def init(self, handle) -> None:
        self.buffer = handle.getListState("buffer", BUFFER)

    def handleInputRows(self, key, rows, timerValues):
        keep = self.params.buffer_size - 1
        carried = pd.DataFrame(list(self.buffer.get()) if self.buffer.exists() else [], columns=_COLUMNS)
        with tempfile.TemporaryDirectory(prefix="stretches-") as folder:
            for new in by_stretch(rows, folder):
                carried = carried.astype({c: new[c].dtype for c in _COLUMNS})
                every = pd.concat([carried, new[_COLUMNS]], ignore_index=True)
                a, b, c = bot_flags(every, len(carried), self.params)
                carried = every.tail(keep)
                yield pd.DataFrame({"order": new["order"], **{f: new[f] for f in ROW_FLAGS}, "bot_a": a, "bot_b": b, "bot_c": c})
        if len(carried):
            self.buffer.put(list(carried.itertuples(index=False, name=None)))

    def close(self) -> None:
        pass


def screen_keyed(orders: DataFrame, params: fraud.FraudParams = fraud.DEFAULT) -> DataFrame:
    """A stream of typed orders (``partition, seq`` and the order columns) with
    ``status`` and ``first_rule``; its session needs the RocksDB state store."""
    # A missing and an empty value differ in JSON, so equal texts mean equal values, NULL included.
    told = fraud.row_rules(orders, params).select(
        "partition", "seq", F.to_json(F.struct(*[F.col(f"`{c}`") for c in orders.columns]), _ISO).alias("order"), *ROW_FLAGS,
        F.to_json(F.struct("product_id", F.col("quantity").cast("long").alias("quantity"))).alias("same_order"),
        F.to_json(F.struct("user_id", "product_id")).alias("same_user"),
        F.coalesce(user_number("user_id"), F.lit(0)).alias("number"), user_number("user_id").isNotNull().alias("numbered"),
        F.coalesce(micros(F.col("event_ts")), F.lit(NO_TIME)).alias("time"))
    flags = ", ".join(f"{f} boolean" for f in fraud.RULES_FLAGS)
    out = told.groupBy("partition").transformWithStateInPandas(RecentOrders(params), f"order string, {flags}", "append", "none")
    out = out.select(F.from_json("order", orders.schema, _ISO).alias("_o"), *fraud.RULES_FLAGS)
    status = F.expr(f"IF({' OR '.join(fraud.RULES_FLAGS)}, '{FRAUD}', '{GENUINE}')").alias("status")
    rule = F.expr("CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r in zip(fraud.RULES_FLAGS, fraud.RULES)) + " END").alias("first_rule")
    return out.select(*[F.col(f"_o.`{c}`") for c in orders.columns if c != "status"], status, rule)


def start_keyed(orders: DataFrame, checkpoint: str, path: str, params: fraud.FraudParams = fraud.DEFAULT,
                trigger: dict | None = None, state_partitions: int = 16):
    """T1 with keyed state: screened orders are appended to ``path`` (Parquet) by
    Spark's file sink, whose log shows each micro-batch whole and once.

    Every micro-batch runs ``state_partitions`` tasks, each with a state store of its
    own: as many as stream partitions shall be worked on at once, never more
    than there are.  The checkpoint keeps the number."""
    spark = orders.sparkSession
    settings = {_PROVIDER: ROCKSDB, "spark.sql.shuffle.partitions": str(state_partitions)}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():                  # a query keeps the settings it started with
        spark.conf.set(k, v)
    try:
        return (screen_keyed(orders, params).writeStream.format("parquet").option("path", path)
                .option("checkpointLocation", checkpoint).outputMode("append")
                .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
