"""Ingestion ledger and reconciliation.

The original ledger is one mutable row per (dag, run, table) that each step
updates in place.  Here every step appends one event row, and the current
state is derived:

* ``start``    RUNNING, row_ingested (count of the source slice)
* ``running``  RUNNING, no count yet: the export counts while it writes
* ``ingested`` row_ingested, as the export's write observed it
* ``finish``   SUCCESS, row_loaded (count of the whole target day)
* ``validate`` is_consistent = (row_ingested <=> row_loaded); a missing count
  compares false, two missing compare true, as Python ``==`` with None does
* ``fail``     a run-level FAILED event (no table): every table of the run
  shows FAILED, and a run without any entry shows one FAILED row with
  is_consistent = false.

Each event is a one-row DataFrame built from a distributed count, so the
driver never sees table data.  ``state`` takes, per (dag, run, table) and
per field, the value of the latest event that set it (``max_by``).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import on_day, previous_day
from ..schemas import LEDGER

_FIELDS = ["run_status", "row_ingested", "destination_table", "row_loaded", "start_time",
           "end_time", "execution_date", "is_consistent"]


def count_rows(df: DataFrame, day: dt.date | None = None, col: str = "created_date") -> DataFrame:
    """``SELECT COUNT(*) [WHERE DATE(col) = day]`` as a one-row DataFrame (``n``)."""
    if day is not None:
        df = df.filter(on_day(col, day))
    return df.agg(F.count(F.lit(1)).alias("n"))


def _event(base: DataFrame, dag_id: str, run_id: str, seq: int, **cols: Column | object) -> DataFrame:
    """One ledger event per row of ``base``; fields not given are NULL."""
    values = {"dag_id": dag_id, "run_id": run_id, "event_seq": seq, **cols}
    out = []
    for f in LEDGER.fields:
        v = values.get(f.name)
        v = v if isinstance(v, Column) else F.lit(v)
        out.append(v.cast(f.dataType).alias(f.name))
    return base.select(*out)


def _ts(value: dt.datetime | str | None) -> Column:
    if value is None:
        return F.localtimestamp()
    return F.lit(str(value)).cast("timestamp_ntz")


def start(source_slice: DataFrame, dag_id: str, run_id: str, source_table: str,
          destination_table: str, execution_date: str, seq: int = 1,
          start_time: dt.datetime | str | None = None) -> DataFrame:
    """Q3: RUNNING event with the number of rows about to be ingested."""
    n = source_slice.agg(F.count(F.lit(1)).alias("n"))
    return _event(n, dag_id, run_id, seq, run_status="RUNNING", source_table=source_table,
                  row_ingested=F.col("n"), destination_table=destination_table,
                  start_time=_ts(start_time), execution_date=_ts(execution_date))


def running(spark: SparkSession, dag_id: str, run_id: str, source_table: str, destination_table: str,
            execution_date: str, seq: int = 1, start_time: dt.datetime | str | None = None) -> DataFrame:
    """Q3 without a count of its own: RUNNING event before the export starts."""
    return _event(spark.range(1), dag_id, run_id, seq, run_status="RUNNING", source_table=source_table,
                  destination_table=destination_table, start_time=_ts(start_time), execution_date=_ts(execution_date))


def ingested(spark: SparkSession, dag_id: str, run_id: str, source_table: str, execution_date: str,
             rows: int, seq: int = 2) -> DataFrame:
    """Q3: the number of rows that the finished export wrote."""
    return _event(spark.range(1), dag_id, run_id, seq, source_table=source_table, row_ingested=rows,
                  execution_date=_ts(execution_date))


def finish(target_slice: DataFrame, dag_id: str, run_id: str, source_table: str,
           execution_date: str, seq: int = 2, end_time: dt.datetime | str | None = None) -> DataFrame:
    """Q4: SUCCESS event with the number of rows found in the target day."""
    n = target_slice.agg(F.count(F.lit(1)).alias("n"))
    return _event(n, dag_id, run_id, seq, run_status="SUCCESS", source_table=source_table,
                  row_loaded=F.col("n"), end_time=_ts(end_time), execution_date=_ts(execution_date))


def validate(ledger: DataFrame, dag_id: str, run_id: str, source_table: str, seq: int = 3) -> DataFrame:
    """Q5: consistency event for one table of a run (empty when the run has
    no entry for the table: a warning, nothing is written)."""
    cur = state(ledger).filter((F.col("dag_id") == dag_id) & (F.col("run_id") == run_id)
                               & (F.col("source_table") == source_table))
    return _event(cur, dag_id, run_id, seq, source_table=source_table,
                  execution_date=F.col("execution_date"),
                  is_consistent=F.col("row_ingested").eqNullSafe(F.col("row_loaded")))


def validate_run(ledger: DataFrame, dag_id: str, run_id: str, seq: int = 3) -> DataFrame:
    """Q5 for every table of a run in one pass over the log."""
    cur = state(ledger).filter((F.col("dag_id") == dag_id) & (F.col("run_id") == run_id)
                               & F.col("source_table").isNotNull())
    return _event(cur, dag_id, run_id, seq, source_table=F.col("source_table"),
                  execution_date=F.col("execution_date"),
                  is_consistent=F.col("row_ingested").eqNullSafe(F.col("row_loaded")))


def fail(spark: SparkSession, dag_id: str, run_id: str, execution_date: str, seq: int = 9,
         end_time: dt.datetime | str | None = None) -> DataFrame:
    """Q6: run-level FAILED event."""
    one = spark.range(1)
    return _event(one, dag_id, run_id, seq, run_status="FAILED", end_time=_ts(end_time),
                  execution_date=_ts(execution_date))


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def state(ledger: DataFrame) -> DataFrame:
    """Q7: current ledger rows, one per (dag_id, run_id, source_table).

    A run-level failure marks every table of the run FAILED unless the
    table's own status was written after it; a failed run without any table
    entry is one FAILED row with is_consistent = false.
    """
    tables = ledger.filter(F.col("source_table").isNotNull())
    latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("event_seq"))).alias(c)
              for c in _FIELDS]
    status_seq = F.max(F.when(F.col("run_status").isNotNull(), F.col("event_seq"))).alias("_status_seq")
    per_table = tables.groupBy("dag_id", "run_id", "source_table").agg(*latest, status_seq)
    failures = (ledger.filter(F.col("source_table").isNull() & (F.col("run_status") == "FAILED"))
                .groupBy("dag_id", "run_id")
                .agg(F.max("event_seq").alias("_fail_seq"),
                     F.max_by("end_time", "event_seq").alias("_fail_end"),
                     F.max_by("execution_date", "event_seq").alias("_fail_exec")))
    failed = F.col("_fail_seq").isNotNull() & (F.col("_fail_seq") > F.col("_status_seq"))
    marked = (per_table.join(failures, ["dag_id", "run_id"], "left")
              .withColumn("run_status", F.when(failed, F.lit("FAILED")).otherwise(F.col("run_status")))
              .withColumn("end_time", F.when(failed, F.col("_fail_end")).otherwise(F.col("end_time")))
              .drop("_status_seq", "_fail_seq", "_fail_end", "_fail_exec"))
    lone = failures.join(per_table.select("dag_id", "run_id"), ["dag_id", "run_id"], "left_anti")
    lone = lone.select(
        "dag_id", "run_id", F.lit(None).cast("string").alias("source_table"),
        F.lit("FAILED").alias("run_status"), F.lit(None).cast("long").alias("row_ingested"),
        F.lit(None).cast("string").alias("destination_table"), F.lit(None).cast("long").alias("row_loaded"),
        F.col("_fail_end").alias("start_time"), F.col("_fail_end").alias("end_time"),
        F.col("_fail_exec").alias("execution_date"), F.lit(False).alias("is_consistent"))
    return marked.unionByName(lone)


def reconcile(source: DataFrame, target: DataFrame, day_col_source: str,
              day_col_target: str | None = None) -> DataFrame:
    """Row counts per day of a source and a target:
    ``day, row_ingested, row_loaded, is_consistent`` (a day missing on one
    side has a NULL count and is inconsistent)."""
    day_col_target = day_col_target or day_col_source
    s = source.groupBy(F.to_date(day_col_source).alias("day")).agg(F.count(F.lit(1)).alias("row_ingested"))
    t = target.groupBy(F.to_date(day_col_target).alias("day")).agg(F.count(F.lit(1)).alias("row_loaded"))
    return (s.join(t, "day", "full")
            .withColumn("is_consistent", F.col("row_ingested").eqNullSafe(F.col("row_loaded"))))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


__all__ = ["count_rows", "start", "running", "ingested", "finish", "validate", "validate_run", "fail", "state", "reconcile", "empty",
           "union_all", "previous_day"]
