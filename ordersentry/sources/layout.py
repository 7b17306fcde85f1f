"""Clustered tables (S12): rows in Z-order of several columns, and a manifest
of what each file holds.

A sort by (c1, c2, ...) lets a reader skip files by c1 alone.  Here every
cluster column becomes a rank of eight bits (its place among bounds taken from
a sample, so skewed and rare values spread over all ranks) and the ranks' bits
are interleaved, so files are narrow in every column.  The key only places
rows; results never depend on the sample.

The input is computed once: it is written to the shared folder, and the sample
and Spark's range partitioner read that copy.  The manifest (``<path>_files``,
one row per file) has the smallest and largest value of every cluster column;
:func:`read_where` opens only the files that may hold a match.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

RANK_BITS = 8
SAMPLE_ROWS = 20_000          # about as many rows are looked at to place the bounds


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _comparable(df: DataFrame, c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp")) if dict(df.dtypes)[c].startswith(("timestamp", "date")) else F.col(c)


def rank_bounds(df: DataFrame, columns: list[str], seed: int = 7) -> dict[str, list]:
    """Per column, ascending values that cut it into at most 2^RANK_BITS ranks:
    all sampled values where they are few, else evenly spaced ones."""
    rows = df.count()
    sample = df.select(*[_comparable(df, c).alias(c) for c in columns]).sample(min(1.0, SAMPLE_ROWS / max(rows, 1)), seed).collect()
    most, out = (1 << RANK_BITS) - 1, {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None and r[c] == r[c])
        several = sorted(set(values))
        if len(several) > most + 1:
            several = sorted({values[len(values) * i // (most + 1)] for i in range(1, most + 1)})
            out[c] = several
        else:
            out[c] = several[1:]
    return out


def _rank(value: Column, bounds: list) -> Column:
    """How many bounds are not above the value (a binary search), stretched to RANK_BITS bits; NULL first."""
    n = len(bounds)
    if not n:
        return F.lit(0)
    steps = [1 << b for b in reversed(range(n.bit_length()))]
    array = F.array(*[F.lit(b) for b in bounds])
    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(array, at + step - 1) <= value), at + step).otherwise(at))
    return F.coalesce(F.floor(place * ((1 << RANK_BITS) - 1) / n).cast("int"), F.lit(0))


def z_order(df: DataFrame, columns: list[str]) -> Column:
    """The interleaved bits of the columns' ranks, the first column leading."""
    if len(columns) * RANK_BITS > 62:
        raise ValueError(f"at most {62 // RANK_BITS} cluster columns")
    bounds = rank_bounds(df, columns)
    ranks = [_rank(_comparable(df, c), bounds[c]).cast("long") for c in columns]
    out = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for j, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - j))
    return out


def clustered(df: DataFrame, parts: list[str], columns: list[str], files: int | None = None) -> DataFrame:
    """The rows of ``df`` (computed once) dealt by ``parts`` and the Z-order of
    ``columns`` and sorted by them inside each task."""
    copy = staged(df)
    keyed = copy.withColumn("_z", z_order(copy, columns))
    # A row hash as the last range key lets the partitioner split a hot cluster value over several tasks.
    keys = [*[F.col(c) for c in parts], F.col("_z"), F.xxhash64(*[F.col(c) for c in df.columns])]
    dealt = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*parts, "_z").drop("_z")


def write_manifest(spark: SparkSession, path: str, columns: list[str]) -> None:
    """One row per file of the table: rows and, per cluster column, smallest
    and largest value and whether it has NULLs."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *columns)
    stats = [f(c).alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "min"), (F.max, "max"))]
    rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *stats).write.mode("overwrite").parquet(f"{path}_files")


def files_where(spark: SparkSession, path: str, where: dict[str, tuple]) -> DataFrame:
    """Manifest rows of the files that may hold rows with ``lo <= column <= hi``
    for every (column: (lo, hi)); None is no bound."""
    files = spark.read.parquet(f"{path}_files")
    for c, (lo, hi) in where.items():
        if lo is not None:
            files = files.filter(F.col(f"max_{c}") >= lo)
        if hi is not None:
            files = files.filter(F.col(f"min_{c}") <= hi)
    return files


def read_where(spark: SparkSession, path: str, where: dict[str, tuple]) -> DataFrame:
    """The table's rows with ``lo <= column <= hi``.  The names of the files to
    open (no others) reach the driver."""
    names = [r["file"] for r in files_where(spark, path, where).select("file").collect()]
    whole = spark.read.parquet(path)
    rows = spark.read.schema(whole.schema).option("basePath", path).parquet(*names) if names else whole.limit(0)
    for c, (lo, hi) in where.items():
        rows = rows.filter((F.col(c) >= lo if lo is not None else F.lit(True)) & (F.col(c) <= hi if hi is not None else F.lit(True)))
    return rows
