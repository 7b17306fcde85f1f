"""Build every warehouse model in dependency order (the model DAG run).

    DQ gate (unique / not_null on the raw keys) -> staging views ->
    dim_users, dim_products -> fct_orders -> 7 marts

Differences from a template-compiled run, by design:

* the key tests run *before* the dimensions and fact are rebuilt, because
  the fact's joins are only correct on unique dimension keys; a failure
  stops the build, with all failing keys in a table of their own;
* the fact is written once and every mart reads the written table, so the
  raw orders are scanned once per build, not once per mart.

Layouts: dimensions partitioned by the day of ``created_date``, the fact by
the day of ``event_ts``, the two daily marts by ``event_date``; cluster
columns become a Z-order (``sources.layout``), so a filter on any of them skips
files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import quality
from ..sources.tables import materialize
from . import warehouse as wh


class QualityGateError(RuntimeError):
    """The key tests failed; ``path`` holds every failing key as a table."""

    def __init__(self, path: str, n_failing: int):
        super().__init__(f"key tests failed: {n_failing} keys, listed at {path}")
        self.path, self.n_failing = path, n_failing


@dataclass
class Layout:
    partition_by: str | None = None
    cluster_by: list[str] | None = None


LAYOUTS = {
    "dim_users": Layout("created_date", ["user_id"]),
    "dim_products": Layout("created_date", ["brand", "category", "sub_category"]),
    "fct_orders": Layout("event_ts", ["user_id", "product_id", "country", "fraud_status"]),
    "mart_fraud_attempt_trends": Layout("event_date"),
    "mart_fraud_daily_saved_amount": Layout("event_date"),
    "mart_high_risk_products": Layout(None, ["product_id", "category", "sub_category"]),
    "mart_products_revenue_profit": Layout(None, ["product_id", "category", "sub_category"]),
    "mart_top10_active_users": Layout(),
    "mart_top10_selling_products": Layout(),
    "mart_top10_users_fraud": Layout(),
}


def key_tests(raw_users: DataFrame, raw_products: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """The six key tests as one report of failing keys (empty = pass)."""
    checks = [("raw_users", raw_users, "user_id"), ("raw_products", raw_products, "product_id"),
              ("raw_orders", raw_orders, "order_id")]
    dup = quality.unique_report(checks)
    nulls = quality.null_report(checks).filter("null_rows > 0").selectExpr(
        "table_name", "column_name", "CAST(NULL AS STRING) AS key_value", "null_rows AS n_rows")
    return dup.unionByName(nulls)


def build_models(raw_users: DataFrame, raw_products: DataFrame, raw_orders: DataFrame,
                 out_dir: str, gate: bool = True) -> dict[str, DataFrame]:
    """Rebuild all models under ``out_dir``; returns name -> DataFrame."""
    if gate:
        path = f"{out_dir}/key_test_failures"
        key_tests(raw_users, raw_products, raw_orders).write.mode("overwrite").parquet(path)
        failing = raw_users.sparkSession.read.parquet(path)
        if not failing.isEmpty():
            raise QualityGateError(path, failing.count())
    out: dict[str, DataFrame] = {}
    out["stg_users"] = materialize(wh.stg_users(raw_users), "stg_users", kind="view")
    out["stg_products"] = materialize(wh.stg_products(raw_products), "stg_products", kind="view")
    out["stg_orders"] = materialize(wh.stg_orders(raw_orders), "stg_orders", kind="view")

    def table(name: str, df: DataFrame) -> DataFrame:
        lay = LAYOUTS[name]
        saved = materialize(df, name, kind="table", path=f"{out_dir}/{name}",
                            partition_by=lay.partition_by, cluster_by=lay.cluster_by)
        return saved.drop(*[c for c in saved.columns if c.endswith("_day") and c not in df.columns])

    out["dim_users"] = table("dim_users", wh.dim_users(out["stg_users"]))
    out["dim_products"] = table("dim_products", wh.dim_products(out["stg_products"]))
    out["fct_orders"] = table("fct_orders", wh.fct_orders(out["stg_orders"], out["dim_users"],
                                                            out["dim_products"]))
    for name, build in wh.MARTS.items():
        # Past the gate the dimension ids are unique: top-10 marts rank
        # candidates only instead of joining whole dimensions.
        out[name] = table(name, build(out["fct_orders"], out["dim_users"], out["dim_products"],
                                      unique_keys=gate))
    return out
