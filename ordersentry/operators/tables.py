"""Raw table maintenance.

All operators are DataFrame -> DataFrame; writing is left to
:mod:`ordersentry.sources.tables` so the same logic serves batch loads and
streaming ``foreachBatch`` loads.

Skew: "first row per key" and "last row per key" are ``min_by`` /
``max_by`` aggregations, not a ``row_number`` window, so Spark combines
them map-side and a key holding a third of the batch still leaves one row
per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


# ---------------------------------------------------------------- S4 read
def read_table(df: DataFrame, columns: list[str], order_by: str | list[str] | None = None,
               limit: int | None = None) -> DataFrame:
    """Fixed projection, optional order, optional limit (0 / None: no limit).

    ``orderBy + limit`` plans as ``TakeOrderedAndProject`` (ten rows per task,
    merged on one); without a limit the sort is a range-partitioned sort.
    """
    out = df.select(*columns)
    if order_by:
        out = out.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    if limit:
        out = out.limit(int(limit))
    return out


# ------------------------------------------------------ per-key reductions
def _pick_per_key(df: DataFrame, key: str | list[str], order_col: str, latest: bool) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    pick = (F.max_by if latest else F.min_by)(row, F.col(order_col))
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, key: str | list[str], order_col: str) -> DataFrame:
    """The earliest row (smallest ``order_col``) of every key."""
    return _pick_per_key(df, key, order_col, latest=False)


def last_per_key(df: DataFrame, key: str | list[str], order_col: str) -> DataFrame:
    """The latest row (largest ``order_col``) of every key."""
    return _pick_per_key(df, key, order_col, latest=True)


# -------------------------------------------------------------- S7 defaults
def with_defaults(df: DataFrame, defaults: dict[str, Column | object]) -> DataFrame:
    """Fill missing columns / NULL values with column defaults
    (``coalesce(col, default)``); absent columns are added."""
    out = df
    for name, value in defaults.items():
        v = value if isinstance(value, Column) else F.lit(value)
        out = out.withColumn(name, F.coalesce(F.col(name), v) if name in df.columns else v)
    return out


#: Blocks whose counts are summed together by :func:`assign_keys`.
SPAN = 1 << 12


def assign_keys(df: DataFrame, key_col: str, order_col: str, start: Column | int,
                block: int = 1 << 20) -> DataFrame:
    """Surrogate keys ``start + 1, start + 2, ...`` in ``order_col`` order.

    Rows are numbered without a global window: rows are ranked inside their
    own block of ``order_col``, block counts get a running sum inside spans of
    ``SPAN`` blocks, and the spans (one row per ``block * SPAN`` order values,
    so few also for sparse order columns) get one over all.  Numbers are
    deterministic, so a recomputed partition gets the same keys.  ``start``
    may be a Column holding one value (e.g. the current maximum key).
    """
    b = F.expr(f"`{order_col}` div {block}")
    with_b = df.withColumn("_kb", b)
    counts = with_b.groupBy("_kb").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_ks", F.expr(f"_kb div {SPAN}"))
    before = (Window.unboundedPreceding, -1)
    spans = counts.groupBy("_ks").agg(F.sum("_n").alias("_sn")).select(
        "_ks", F.coalesce(F.sum("_sn").over(Window.orderBy("_ks").rowsBetween(*before)), F.lit(0)).alias("_sbase"))
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_ks").orderBy("_kb").rowsBetween(*before)), F.lit(0))
    starts = (counts.select("_kb", "_ks", inside.alias("_inside")).join(spans, "_ks")
                    .select("_kb", (F.col("_sbase") + F.col("_inside")).alias("_base")))
    rank = F.row_number().over(Window.partitionBy("_kb").orderBy(order_col))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (with_b.join(starts, "_kb")
                  .withColumn(key_col, (start_col + F.col("_base") + rank).cast("long"))
                  .drop("_kb", "_base"))


def max_key(df: DataFrame, key_col: str) -> DataFrame:
    """One row, ``_max``: the largest key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long").alias("_max"))


# ---------------------------------------------------------- S5 insert-ignore
def new_rows(target: DataFrame, incoming: DataFrame, key: str, order_col: str,
             surrogate: str | None = None, defaults: dict | None = None,
             on_null_key: str = "fail") -> DataFrame:
    """The rows ``INSERT ... ON CONFLICT (key) DO NOTHING`` adds.

    The first incoming row per natural key wins (``order_col`` = input order)
    and keys already in ``target`` are skipped.  The key is NOT NULL: a NULL
    key fails the query (``on_null_key="fail"``, as the original insert
    does) or, with ``"skip"``, the row is left out.  With ``surrogate`` the
    new rows get ``max(target.surrogate) + 1, ...`` in input order.  Columns
    are the target's.  The deduplicated new rows are checkpointed before they
    are numbered, so the batch and the target are read for them only once.
    """
    k = F.col(key)
    if on_null_key == "fail":
        checked = incoming.withColumn(key, F.when(k.isNull(), F.raise_error(
            F.lit(f"NULL {key} in an insert batch"))).otherwise(k))
    elif on_null_key == "skip":
        checked = incoming.filter(k.isNotNull())
    else:
        raise ValueError("on_null_key must be 'fail' or 'skip'")
    fresh = first_per_key(checked, key, order_col)
    # Keys of the batch that the table already has: the table is scanned and
    # filtered by the batch's keys (a small batch is broadcast, the table is
    # not shuffled), then the batch drops those few keys.
    present = target.select(key).join(fresh.select(key), on=key, how="left_semi")
    fresh = fresh.join(present, on=key, how="left_anti")
    if surrogate:
        checkpoint_dir(target.sparkSession)
        fresh = fresh.checkpoint()
        # The current maximum key as a scalar subquery (computed once, no join).
        fresh = assign_keys(fresh, surrogate, order_col, max_key(target, surrogate).scalar())
    if defaults:
        fresh = with_defaults(fresh, defaults)
    return fresh.select(*target.columns)


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str, order_col: str,
                  surrogate: str | None = None, defaults: dict | None = None,
                  on_null_key: str = "fail") -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``: the whole new table,
    ``target`` plus :func:`new_rows`."""
    return target.unionByName(new_rows(target, incoming, key, order_col, surrogate, defaults, on_null_key))


# ----------------------------------------------------------------- S6 upsert
def upsert(target: DataFrame, incoming: DataFrame, key: str, order_col: str,
           now: Column | None = None, stamp_col: str | None = "ingestion_ts") -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE`` with a full-row replace.

    The last incoming row per key wins; it replaces the stored row (or is
    inserted) with ``stamp_col = now``.  An empty batch changes nothing.
    Returns the whole new table.
    """
    latest = last_per_key(incoming, key, order_col)
    if stamp_col:
        latest = latest.withColumn(stamp_col, now if now is not None else F.current_timestamp())
    kept = target.join(latest.select(key), on=key, how="left_anti")
    return kept.unionByName(latest.select(*target.columns))


# ------------------------------------------------------------ S8 high water
def high_water(df: DataFrame, col: str = "order_id", prefix: str = "O") -> DataFrame:
    """``max`` of the numeric part of a prefixed id; 0 for an empty table."""
    num = F.regexp_replace(F.col(col), "^" + prefix, "").cast("long")
    return df.agg(F.coalesce(F.max(num), F.lit(0)).cast("long").alias("max_counter"))
