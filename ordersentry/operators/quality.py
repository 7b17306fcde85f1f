"""Data quality checks (Q1, Q2, Q9).

Checks return the failing rows (or a per-column summary) as DataFrames, so
they run distributed and can gate a model build or be written as a report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class RequiredColumnError(ValueError):
    """A REQUIRED column holds NULL."""


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """``unique`` test: every non-NULL key value that occurs more than once,
    with its count (``key``, ``n_rows``).  Partial aggregation keeps a hot
    key to one row per task before the shuffle."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """``not_null`` test: the rows whose ``key`` is NULL."""
    return df.filter(F.col(key).isNull())


def unique_report(checks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Union of :func:`duplicate_keys` over ``(table_name, df, column)``:
    ``table_name, column_name, key_value, n_rows``."""
    parts = [duplicate_keys(df, col).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
        F.col(col).cast("string").alias("key_value"), "n_rows") for table, df, col in checks]
    return reduce(DataFrame.unionByName, parts)


def null_report(checks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """NULL count per ``(table_name, df, column)``: one row per check, one
    scan per table (checks on the same DataFrame share an aggregation)."""
    by_table: dict[int, tuple[str, DataFrame, list[str]]] = {}
    for table, df, col in checks:
        by_table.setdefault(id(df), (table, df, []))[2].append(col)
    parts = []
    for table, df, cols in by_table.values():
        counts = df.agg(F.count(F.lit(1)).alias("n_rows"),
                        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("null_rows"))
                                   for i, c in enumerate(cols)])).alias("_c")
        parts.append(counts.select(F.lit(table).alias("table_name"), "n_rows", rows)
                     .select("table_name", "_c.column_name", "n_rows", "_c.null_rows"))
    return reduce(DataFrame.unionByName, parts)


def required_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with a NULL in any column the schema marks as not nullable."""
    req = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    if not req:
        return df.limit(0)
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in req])
    return df.filter(cond)


def require_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same rows, with every REQUIRED column checked as it is read: a
    NULL raises an error in the task (``raise_error``), so a write of the
    result fails without a separate pass over the data."""
    req = {f.name for f in schema.fields if not f.nullable}
    return df.select(*[
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in REQUIRED column {c}")))
         .otherwise(F.col(c)).alias(c) if c in req else F.col(c)
        for c in df.columns])


def assert_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail (like a REQUIRED load) when a required column holds NULL.

    Spark file readers relax nullability, so this runs one distributed
    existence check (``limit 1`` on the violations).
    """
    bad = required_violations(df, schema)
    if bad.limit(1).count() > 0:
        raise RequiredColumnError("NULL in a REQUIRED column: "
                                  + ", ".join(f.name for f in schema.fields if not f.nullable))
    return df
