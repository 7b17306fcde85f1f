"""Incremental daily ELT of one raw table with reconciliation.

    start -> extract day -> NDJSON (counted by its own write) -> ingested
    -> load day partition -> finish (count target day) -> validate;
    any error -> run-level FAILED

The source is scanned once: the export's write observes its rows, and a write
that fails leaves no count.  The target's count comes from the files' footers.
Ledger events are appended to a Parquet log (append-only, so a retried step
only adds an event).

:func:`ingest_changes` moves what changed since the last run instead of a day:
orders that were upserted after their day was exported reach the warehouse too.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import previous_day
from ..operators import ledger
from ..operators.quality import require_not_null
from ..session import checkpoint_dir
from ..sources import merge_table, ndjson
from ..sources.tables import read_if_exists


class IngestFailed(RuntimeError):
    """A daily run in which at least one table's chain failed."""


@dataclass
class IngestPaths:
    export_dir: str      # NDJSON staging folder (shared storage)
    warehouse_dir: str   # day-partitioned Parquet tables
    ledger_path: str     # append-only ledger log

    def export(self, table: str, ds: str) -> str:
        return f"{self.export_dir}/{table}_{ds}.json"

    def target(self, table: str) -> str:
        return f"{self.warehouse_dir}/{table}"


def _append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    log = read_if_exists(spark, paths.ledger_path)
    return ledger.empty(spark) if log is None else log      # None: no event written yet


def ingest_day(spark: SparkSession, table: str, source: DataFrame, schema: T.StructType,
               ds: str, paths: IngestPaths, dag_id: str = "raw_tables_daily",
               run_id: str | None = None, mode: str = "replace_day") -> DataFrame:
    """Run the daily chain for one table; returns the table's ledger state."""
    run_id = run_id or f"scheduled__{ds}"
    day: dt.date = previous_day(ds)
    # Event order: this attempt's start time in microseconds, so events of a
    # retried run (same run id) come after those of the failed attempt.
    base = time.time_ns() // 1000 * 10
    try:
        src_slice = ndjson.extract_day(source, ds)
        _append(ledger.running(spark, dag_id, run_id, table, table, ds, seq=base + 1), paths.ledger_path)
        written = ndjson.write_ndjson(src_slice, paths.export(table, ds))
        _append(ledger.ingested(spark, dag_id, run_id, table, ds, written, seq=base + 2), paths.ledger_path)
        ndjson.load_day(spark, paths.export(table, ds), schema, paths.target(table), mode=mode, only_day=day)
        day_col = ndjson.day_column("created_date")
        target_slice = ndjson.read_days(spark, paths.target(table), schema).filter(F.col(day_col) == F.lit(day))
        _append(ledger.finish(target_slice, dag_id, run_id, table, ds, seq=base + 3), paths.ledger_path)
        # Validation reads the log it appends to: cut the lineage by
        # materializing the event before writing it.
        checkpoint_dir(spark)
        check = ledger.validate(read_ledger(spark, paths), dag_id, run_id, table, seq=base + 4).checkpoint()
        _append(check, paths.ledger_path)
    except Exception:
        _append(ledger.fail(spark, dag_id, run_id, ds, seq=base + 5), paths.ledger_path)
        raise
    return ledger.state(read_ledger(spark, paths)).filter(
        (F.col("dag_id") == dag_id) & (F.col("run_id") == run_id) & (F.col("source_table") == table))


def ingest_tables(spark: SparkSession, tables: dict[str, tuple[DataFrame, T.StructType]], ds: str,
                  paths: IngestPaths, dag_id: str = "raw_tables_daily", run_id: str | None = None,
                  mode: str = "replace_day") -> DataFrame:
    """One daily run over several tables (``name -> (source, schema)``).

    Every table's chain runs even when another fails, as independent chains
    do.  If any failed, a run-level FAILED event is appended after all of
    them, so every table of the run reports FAILED (also those that loaded),
    and :class:`IngestFailed` names the tables, with the first error as its
    cause.  Returns the run's ledger state.
    """
    run_id = run_id or f"scheduled__{ds}"
    errors = {}
    for name, (source, schema) in tables.items():
        try:
            ingest_day(spark, name, source, schema, ds, paths, dag_id, run_id, mode)
        except Exception as exc:  # keep going: the other chains are independent
            errors[name] = exc
    if errors:
        _append(ledger.fail(spark, dag_id, run_id, ds, seq=time.time_ns() // 1000 * 10 + 9), paths.ledger_path)
        raise IngestFailed(f"{run_id}: {', '.join(errors)}") from next(iter(errors.values()))
    return ledger.state(read_ledger(spark, paths)).filter(
        (F.col("dag_id") == dag_id) & (F.col("run_id") == run_id))


def ingest_changes(spark: SparkSession, table: str, source_path: str, schema: T.StructType, paths: IngestPaths,
                   consumer: str, key: str = "order_id", dag_id: str = "raw_tables_changes") -> str | None:
    """Move the rows of a merge-on-read table that changed since ``consumer``'s
    bookmark to the warehouse copy ``paths.target(table)``, a merge-on-read
    table as well, through an NDJSON export.  Returns the export's folder,
    None when nothing was published since.

    The bookmark advances last.  A run that fails before is repeated from the
    same bookmark: it overwrites its export or replaces the same keys with the
    same rows, so no change is lost and none counts twice.
    """
    since = merge_table.bookmark(spark, source_path, consumer)
    until = merge_table.version(spark, source_path)
    if until <= since:
        return None
    run_id, ds = f"{consumer}__{since}_{until}", dt.date.today().isoformat()
    base = time.time_ns() // 1000 * 10
    try:
        _append(ledger.running(spark, dag_id, run_id, table, table, ds, seq=base + 1), paths.ledger_path)
        export = paths.export(table, f"{since}_{until}")
        written = ndjson.write_ndjson(merge_table.changes(spark, source_path, since, until, key), export)
        _append(ledger.ingested(spark, dag_id, run_id, table, ds, written, seq=base + 2), paths.ledger_path)
        rows = require_not_null(ndjson.read_ndjson(spark, export, schema), schema).withColumn("_order", F.lit(0))
        merge_table.upsert(spark, paths.target(table), rows, key, "_order", stamp_col=None)   # one row per key
        loaded = merge_table.lookup(spark, paths.target(table), rows, key) if written else rows
        _append(ledger.finish(loaded, dag_id, run_id, table, ds, seq=base + 3), paths.ledger_path)
        checkpoint_dir(spark)
        check = ledger.validate(read_ledger(spark, paths), dag_id, run_id, table, seq=base + 4).checkpoint()
        _append(check, paths.ledger_path)
    except Exception:
        _append(ledger.fail(spark, dag_id, run_id, ds, seq=base + 5), paths.ledger_path)
        raise
    merge_table.advance(spark, source_path, consumer, until)
    return export
