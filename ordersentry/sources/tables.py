"""Writing models and raw tables (S11, S12, and the S5/S6 table writes).

``materialize`` turns a model DataFrame into a temp view (staging) or a
Parquet table (dimensions, fact, marts), optionally partitioned by the day
of a timestamp column and clustered in Z-order of the cluster columns, with a
manifest of what each file holds (:mod:`.layout`).

``upsert_table`` / ``insert_ignore_table`` apply the raw-table operators to
a Parquet table on shared storage.  An upserted table is versioned: a batch
writes the key-range partitions it touches into a folder of its own
(``data/version=N``), then publishes ``current/N.json``, the version that
holds each key range.  Until that one file is renamed into place readers see
the state before, so a crash at any point leaves the old table or the new one;
a replayed batch overwrites what the crash left unpublished.  One writer at a
time; read with :func:`read_table`.  Insert-if-absent only appends.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables as ops
from ..session import checkpoint_dir
from . import layout


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none yet; any
    other failure to read is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def materialize(df: DataFrame, name: str, kind: str = "table", path: str | None = None,
                partition_by: str | None = None, cluster_by: list[str] | None = None,
                partition_granularity: str = "day") -> DataFrame:
    """``kind='view'`` registers a temp view; ``kind='table'``
    rewrites the table at ``path`` and returns a DataFrame reading it."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table" or not path:
        raise ValueError("a table needs kind='table' and a path")
    out, parts = df, []
    if partition_by and dict(df.dtypes)[partition_by] == "date":
        parts = [partition_by]
    elif partition_by:
        pcol = f"{partition_by}_{partition_granularity}"
        out = out.withColumn(pcol, F.to_date(F.col(partition_by)))
        parts = [pcol]
    if cluster_by:
        out = layout.clustered(out, parts, cluster_by)
    # The whole table is rebuilt: partitions that no longer have rows must go,
    # whatever overwrite mode the session has.
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    if cluster_by:
        layout.write_manifest(df.sparkSession, path, cluster_by)
    return df.sparkSession.read.parquet(path)


def key_range(prefix: str = "O", width: int = 1_000_000, buckets: int = 1024):
    """Partition function for prefixed sequential ids: ``floor(n / width)`` of
    the numeric part, so recent orders share a few partitions and a key's
    partition never changes.  Ids without a number go to negative hash
    buckets ``-1 .. -buckets``."""
    def part(key: Column) -> Column:
        num = F.regexp_replace(key, "^" + prefix, "").try_cast("long")
        return F.coalesce(F.floor(num / F.lit(width)),
                          -1 - F.pmod(F.xxhash64(key), F.lit(buckets))).cast("long")
    return part


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a folder on shared storage."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def _published(spark: SparkSession, path: str) -> list[int]:
    """Published version numbers, ascending."""
    fs, folder = _folder(spark, f"{path}/current")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _ranges(spark: SparkSession, path: str, version: int) -> dict[str, int]:
    """Key range -> version that holds it.  One entry per key range (a million orders)."""
    return json.loads(spark.read.text(f"{path}/current/{version}.json", wholetext=True).first()[0])


def exists(spark: SparkSession, path: str) -> bool:
    fs, file = _folder(spark, path)
    return fs.exists(file)


def publish(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write ``folder/name`` in one step: readers see all of it or nothing.
    An error when the name is there already."""
    jvm = spark._jvm
    fs, target = _folder(spark, folder)
    new = jvm.org.apache.hadoop.fs.Path(target, f".{name}-{uuid.uuid4().hex}.tmp")
    out = fs.create(new, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    # FileContext's rename refuses an existing target on every file system.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(new), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target, name)), options)
    except Exception as exc:
        fs.delete(new, False)
        raise RuntimeError(f"{name} in {folder} is already published; there is one writer at a time") from exc


def _publish(spark: SparkSession, path: str, version: int, ranges: dict[str, int]) -> None:
    publish(spark, f"{path}/current", f"{version}.json", json.dumps(ranges))


def _read_ranges(spark: SparkSession, path: str, part_col: str, ranges: dict[str, int]) -> DataFrame:
    folders = [f"{path}/data/version={v}/{part_col}={k}" for k, v in sorted(ranges.items())]
    return spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("version")


def read_table(spark: SparkSession, path: str, part_col: str = "key_range", key: str = "order_id") -> DataFrame:
    """The upserted table at ``path``, as last published, copy-on-write
    (:func:`upsert_table`) or merge-on-read (:mod:`.merge_table`)."""
    versions = _published(spark, path)
    if not versions:
        raise FileNotFoundError(f"no published table at {path}")
    current = _ranges(spark, path, versions[-1])
    if "runs" in current:
        from . import merge_table
        return merge_table.read(spark, path, key)
    return _read_ranges(spark, path, part_col, current)


def _remove_superseded(spark: SparkSession, path: str, part_col: str, old: dict[str, int],
                       current: dict[str, int], version: int) -> None:
    """Drop what the version before last held and the last two do not need;
    the version just replaced stays for readers that have it open."""
    versions = [v for v in _published(spark, path) if v < version]
    for v in versions[:-1]:
        for k, held in _ranges(spark, path, v).items():
            if held not in (old.get(k), current.get(k)):
                fs, folder = _folder(spark, f"{path}/data/version={held}/{part_col}={k}")
                fs.delete(folder, True)
        fs, file = _folder(spark, f"{path}/current/{v}.json")
        fs.delete(file, False)


def upsert_table(spark: SparkSession, path: str, incoming: DataFrame, key: str, order_col: str,
                 part_col: str = "key_range", partition_of=None, now=None) -> None:
    """S6 on a Parquet table partitioned by a (whole-number) function of the key.

    Because a key's partition is computable from the key, the partitions a
    batch touches are known without looking into the table: only they are
    read, merged and rewritten.  Their numbers reach the driver; a batch has
    at most as many as it has orders, and sequential order numbers keep it to
    one or two.  The first batch creates the table; an empty batch changes nothing.
    """
    partition_of = partition_of or key_range()
    batch = incoming.withColumn(part_col, partition_of(F.col(key)))
    touched = [str(r[0]) for r in batch.select(part_col).distinct().collect()]
    if not touched:
        return
    now = now if now is not None else F.current_timestamp()
    versions = _published(spark, path)
    old = _ranges(spark, path, versions[-1]) if versions else {}
    version = versions[-1] + 1 if versions else 0
    stored = {k: old[k] for k in touched if k in old}
    batch = batch.drop(part_col)
    if stored:
        merged = ops.upsert(_read_ranges(spark, path, part_col, stored).drop(part_col), batch, key, order_col, now=now)
    else:
        merged = ops.last_per_key(batch, key, order_col).drop(order_col).withColumn("ingestion_ts", now)
    # Nothing reads this version's folder before it is published, so a retry may overwrite it.
    merged.withColumn(part_col, partition_of(F.col(key))).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy(part_col).parquet(f"{path}/data/version={version}")
    current = {**old, **dict.fromkeys(touched, version)}
    _publish(spark, path, version, current)
    _remove_superseded(spark, path, part_col, old, current, version)


def insert_ignore_table(spark: SparkSession, path: str, incoming: DataFrame, key: str,
                        order_col: str, surrogate: str | None = None,
                        defaults: dict | None = None) -> DataFrame:
    """S5 on a Parquet table: existing rows never change, so only the new
    rows are appended (one job commit).  The natural-key check reads just
    the key column of the table.  Returns the appended rows."""
    existing = spark.read.parquet(path)
    fresh = ops.new_rows(existing, incoming, key, order_col, surrogate, defaults)
    checkpoint_dir(spark)
    fresh = fresh.checkpoint(eager=True)  # cut the lineage to the files being appended to
    fresh.write.mode("append").parquet(path)
    return fresh
