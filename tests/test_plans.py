"""Plan shape checks: the properties the design relies on at scale."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from ordersentry import catalog
from ordersentry.operators import fraud
from ordersentry.sources.tpch_domain import order_events
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_screening_has_one_shuffle_on_partition_and_block(spark):
    # The registered stream has one constant partition, which the optimizer drops from the keys.
    one = plan(catalog.queries()["fraud_verdict"](spark, SF_SMALL))
    assert [k.split("#")[0] for k in re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", one)] == ["_blk"]
    events = order_events(spark, SF_SMALL).withColumn("partition", F.col("seq") % 3)
    text = plan(fraud.screen(events).select("order_id", "status", "first_rule"))
    shuffles = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text)
    assert len(shuffles) == 1 and "partition" in shuffles[0] and "_blk" in shuffles[0]
    assert "Window" in text and "SortMergeJoin" not in text
    # Column pruning: the unused event value column is never read.
    events_schema = [line for line in text.splitlines() if line.startswith("ReadSchema") and "event_id" in line]
    assert events_schema and all("value" not in line for line in events_schema)


def test_screening_reads_and_prices_the_stream_once(spark):
    for name in ("fraud_verdict", "fraud_verdict_dense"):
        text = plan(catalog.queries()[name](spark, SF_SMALL))
        main = text.split("===== Subqueries =====")[0]
        schemas = [line for line in main.splitlines() if line.startswith("ReadSchema")]
        assert sum("event_id" in line for line in schemas) == 1, name
        assert sum("p_partkey" in line for line in schemas) == 1, name


def test_marts_aggregate_fact_before_dimension_join(spark):
    text = plan(catalog.queries()["mart_products_revenue_profit"](spark, SF_SMALL))
    lines = text.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "HashJoin" in line or "SortMergeJoin" in line)
    # In the tree (top first) a partial aggregation by product appears below the join.
    below = "\n".join(lines[join_at:lines.index("") if "" in lines else len(lines)])
    assert "HashAggregate" in below


def test_top10_is_take_ordered(spark):
    text = plan(catalog.queries()["mart_top10_active_users"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_upsert_picks_last_row_by_aggregation_not_window(spark):
    text = plan(catalog.queries()["upsert_latest"](spark, SF_SMALL))
    assert "max_by" in text


def test_no_query_plans_a_cross_join(spark):
    for name, fn in catalog.queries().items():
        text = plan(fn(spark, SF_SMALL))
        assert "NestedLoopJoin" not in text and "CartesianProduct" not in text, name
