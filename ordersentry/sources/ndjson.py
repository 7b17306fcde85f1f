"""Daily slice export and warehouse load.

``extract_day`` keeps the rows created the day before the run date; the
predicate ``to_date(created_date) = day`` is rewritten by Catalyst into a
``>= / <`` range that reaches the Parquet reader as pushed filters.
``load_day`` reads NDJSON with an explicit schema (no inference, malformed
records fail the load), checks REQUIRED columns while writing (one pass)
and writes a Parquet table partitioned by day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import on_day, previous_day
from ..operators.quality import require_not_null

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def extract_day(df: DataFrame, ds: str | dt.date, col: str = "created_date") -> DataFrame:
    """``WHERE DATE(col) = DATE(ds - 1 day)``: the slice an incremental run
    for ``ds`` exports."""
    return df.filter(on_day(col, previous_day(ds)))


def write_ndjson(df: DataFrame, path: str) -> int:
    """One JSON object per line; timestamps as ISO-8601 text with offset.

    Returns the rows written, observed by the write itself, so the source is
    scanned once.  The observation stands at the top of the plan, in the stage
    that writes, where a task counts once however often it was retried."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("timestampFormat", ISO_TS) \
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    # A plan that is empty from the start is optimized away together with its observation.
    return written.get.get("n", 0)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with an explicit schema; a malformed line fails the read."""
    return (spark.read.schema(schema).option("mode", "FAILFAST")
            .option("timestampFormat", ISO_TS)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))


def day_column(col: str = "created_date") -> str:
    return col.replace("_date", "") + "_day" if col.endswith("_date") else col + "_day"


def load_day(spark: SparkSession, ndjson_path: str, schema: T.StructType, target_path: str,
             mode: str = "replace_day", partition_col: str = "created_date",
             only_day: dt.date | None = None) -> DataFrame:
    """Load one NDJSON export into a day-partitioned Parquet table.

    ``mode="append"`` appends like the original warehouse load (a second load
    of the same day duplicates it); ``mode="replace_day"`` (default) replaces
    exactly the day partitions present in the file (dynamic partition
    overwrite), so a rerun is idempotent.  With ``only_day`` the file is the
    export of that day: its partition is replaced also when the export is
    empty, and a row of another day fails the load.  Returns the loaded rows.
    """
    if mode not in ("append", "replace_day"):
        raise ValueError(f"mode must be 'append' or 'replace_day', not {mode!r}")
    rows = require_not_null(read_ndjson(spark, ndjson_path, schema), schema)
    day = day_column(partition_col)
    out = rows.withColumn(day, F.to_date(F.col(partition_col)))
    if only_day is not None:
        other = F.raise_error(F.concat(F.lit(f"row outside {only_day}: "), F.col(day).cast("string")))
        own = out.withColumn(partition_col, F.when(F.col(day) == F.lit(only_day), F.col(partition_col)).otherwise(
            other.cast(schema[partition_col].dataType))).drop(day)
        own.write.mode("append" if mode == "append" else "overwrite").parquet(f"{target_path}/{day}={only_day.isoformat()}")
        return rows
    (out.write.mode("append" if mode == "append" else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day).parquet(target_path))
    return rows


def read_days(spark: SparkSession, target_path: str, schema: T.StructType, partition_col: str = "created_date") -> DataFrame:
    """The day-partitioned table by its known schema, so days without rows read as such."""
    return spark.read.schema(T.StructType(schema.fields + [T.StructField(day_column(partition_col), T.DateType())])).parquet(target_path)
