import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from ordersentry.operators import ledger
from ordersentry.plans.ingest import IngestPaths, ingest_day, read_ledger
from ordersentry.schemas import RAW_USERS
from ordersentry.sources import ndjson


def user_rows(spark, created):
    t = dt.datetime(2025, 3, 5)
    rows = [(i + 1, f"n{i}", f"{i}@x", None, c, t, "batch") for i, c in enumerate(created)]
    return spark.createDataFrame(rows, RAW_USERS)


BOUNDARY = [dt.datetime(2025, 3, 1, 0, 0, 0), dt.datetime(2025, 3, 1, 23, 59, 59, 999999),
            dt.datetime(2025, 3, 2, 0, 0, 0)]


def paths():
    root = tempfile.mkdtemp(prefix="ingest-")
    return IngestPaths(f"{root}/export", f"{root}/wh", f"{root}/ledger")


def test_extract_day_boundaries(spark):
    got = ndjson.extract_day(user_rows(spark, BOUNDARY), "2025-03-02").select("user_id").collect()
    assert sorted(r.user_id for r in got) == [1, 2]


def test_extract_day_pushes_range_filter(spark, tmp_path):
    user_rows(spark, BOUNDARY).write.parquet(str(tmp_path / "u"))
    plan = ndjson.extract_day(spark.read.parquet(str(tmp_path / "u")), "2025-03-02") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "created_date" in plan


def test_required_null_rejected(spark, tmp_path):
    path = str(tmp_path / "bad.json")
    with open(path, "w") as f:
        f.write('{"user_id": 1, "name": null, "email": "a@x", "created_date": "2025-03-01T00:00:00.000000Z",'
                ' "ingestion_ts": "2025-03-01T00:00:00.000000Z", "source": "batch"}\n')
    with pytest.raises(Exception):
        ndjson.load_day(spark, path, RAW_USERS, str(tmp_path / "wh"))


def test_ndjson_round_trip(spark, tmp_path):
    src = user_rows(spark, BOUNDARY)
    ndjson.write_ndjson(src, str(tmp_path / "x.json"))
    back = ndjson.read_ndjson(spark, str(tmp_path / "x.json"), RAW_USERS)
    assert sorted(back.collect()) == sorted(src.collect())


def _state(spark, p, run):
    return {r.source_table: r for r in ledger.state(read_ledger(spark, p))
            .filter(F.col("run_id") == run).collect()}


def test_replace_day_is_idempotent(spark):
    p = paths()
    src = user_rows(spark, BOUNDARY)
    for run in ("r1", "r2"):
        ingest_day(spark, "raw_users", src, RAW_USERS, "2025-03-02", p, run_id=run, mode="replace_day")
    st = _state(spark, p, "r2")["raw_users"]
    assert (st.row_ingested, st.row_loaded, st.is_consistent, st.run_status) == (2, 2, True, "SUCCESS")


def test_double_append_is_inconsistent(spark):
    p = paths()
    src = user_rows(spark, BOUNDARY)
    for run in ("r1", "r2"):
        ingest_day(spark, "raw_users", src, RAW_USERS, "2025-03-02", p, run_id=run, mode="append")
    st = _state(spark, p, "r2")["raw_users"]
    assert (st.row_ingested, st.row_loaded, st.is_consistent) == (2, 4, False)


def test_missing_finish_is_inconsistent(spark):
    log = ledger.start(user_rows(spark, BOUNDARY), "d", "r", "raw_users", "raw_users", "2025-03-02")
    check = ledger.validate(log, "d", "r", "raw_users")
    st = ledger.state(log.unionByName(check)).collect()[0]
    assert (st.row_ingested, st.row_loaded, st.is_consistent) == (3, None, False)


def test_failure_marks_every_table_of_run(spark):
    src = user_rows(spark, BOUNDARY)
    events = [ledger.start(src, "d", "r", t, t, "2025-03-02", seq=1) for t in ("a", "b")]
    events.append(ledger.finish(src, "d", "r", "a", "2025-03-02", seq=2))
    events.append(ledger.fail(spark, "d", "r", "2025-03-02", seq=5))
    st = {r.source_table: r.run_status for r in ledger.state(ledger.union_all(events)).collect()}
    assert st == {"a": "FAILED", "b": "FAILED"}


def test_failure_without_entries(spark):
    st = ledger.state(ledger.fail(spark, "d", "r", "2025-03-02")).collect()
    assert len(st) == 1 and st[0].run_status == "FAILED" and st[0].is_consistent is False


def test_failed_ingest_writes_failure(spark):
    p = paths()
    bad = user_rows(spark, BOUNDARY).withColumn("name", F.lit(None).cast("string"))
    with pytest.raises(Exception):
        ingest_day(spark, "raw_users", bad, RAW_USERS, "2025-03-02", p, run_id="rf")
    st = _state(spark, p, "rf")["raw_users"]
    assert st.run_status == "FAILED"


def test_retried_run_reports_latest_attempt(spark):
    p = paths()
    bad = user_rows(spark, BOUNDARY).withColumn("name", F.lit(None).cast("string"))
    with pytest.raises(Exception):
        ingest_day(spark, "raw_users", bad, RAW_USERS, "2025-03-02", p, run_id="r")
    ingest_day(spark, "raw_users", user_rows(spark, BOUNDARY), RAW_USERS, "2025-03-02", p, run_id="r")
    st = _state(spark, p, "r")["raw_users"]
    assert (st.run_status, st.row_ingested, st.row_loaded, st.is_consistent) == ("SUCCESS", 2, 2, True)


def product_rows(spark, created, null_name=False):
    from ordersentry.schemas import RAW_PRODUCTS
    t = dt.datetime(2025, 3, 5)
    rows = [(i + 1, f"p{i}", None, None, None, "IDR", 100, 50, c, t, "batch") for i, c in enumerate(created)]
    df = spark.createDataFrame(rows, RAW_PRODUCTS)
    return df.withColumn("product_name", F.lit(None).cast("string")) if null_name else df


def test_run_over_tables_and_failure_marks_the_whole_run(spark):
    from ordersentry.plans.ingest import ingest_tables
    from ordersentry.schemas import RAW_PRODUCTS
    p = paths()
    good = {"raw_users": (user_rows(spark, BOUNDARY), RAW_USERS),
            "raw_products": (product_rows(spark, BOUNDARY), RAW_PRODUCTS)}
    st = {r.source_table: (r.run_status, r.is_consistent)
          for r in ingest_tables(spark, good, "2025-03-02", p, run_id="ok").collect()}
    assert st == {"raw_users": ("SUCCESS", True), "raw_products": ("SUCCESS", True)}
    bad = {"raw_products": (product_rows(spark, BOUNDARY, null_name=True), RAW_PRODUCTS),
           "raw_users": (user_rows(spark, BOUNDARY), RAW_USERS)}
    with pytest.raises(Exception):
        ingest_tables(spark, bad, "2025-03-02", p, run_id="bad")
    st = _state(spark, p, "bad")
    assert {t: r.run_status for t, r in st.items()} == {"raw_products": "FAILED", "raw_users": "FAILED"}


def test_first_load_of_an_empty_day_is_consistent(spark):
    p = paths()
    state = ingest_day(spark, "raw_users", user_rows(spark, []), RAW_USERS, "2025-03-02", p).first()
    assert (state.run_status, state.row_ingested, state.row_loaded, state.is_consistent) == ("SUCCESS", 0, 0, True)


def test_a_day_that_became_empty_is_replaced(spark):
    p = paths()
    ingest_day(spark, "raw_users", user_rows(spark, BOUNDARY), RAW_USERS, "2025-03-02", p)
    ingest_day(spark, "raw_users", user_rows(spark, BOUNDARY), RAW_USERS, "2025-03-03", p)
    state = ingest_day(spark, "raw_users", user_rows(spark, BOUNDARY[2:]), RAW_USERS, "2025-03-02", p).first()
    assert (state.row_ingested, state.row_loaded, state.is_consistent) == (0, 0, True)
    assert ndjson.read_days(spark, p.target("raw_users"), RAW_USERS).count() == 1          # the other day stays


def test_load_of_one_day_rejects_rows_of_another(spark, tmp_path):
    ndjson.write_ndjson(user_rows(spark, BOUNDARY), str(tmp_path / "x.json"))
    with pytest.raises(Exception, match="row outside"):
        ndjson.load_day(spark, str(tmp_path / "x.json"), RAW_USERS, str(tmp_path / "t"), only_day=dt.date(2025, 3, 1))


def test_the_export_counts_while_it_writes(spark):
    """The source is read once, for the export; its count is the export's own."""
    src, seen = user_rows(spark, BOUNDARY), spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    p = paths()
    st = ingest_day(spark, "raw_users", src.mapInArrow(watched, src.schema), RAW_USERS, "2025-03-02", p).first()
    assert (st.row_ingested, st.row_loaded, st.is_consistent, seen.value) == (2, 2, True, len(BOUNDARY))


def test_a_failed_export_leaves_no_count(spark):
    p = paths()
    bad = user_rows(spark, BOUNDARY).withColumn("email", F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(Exception, match="unreadable"):
        ingest_day(spark, "raw_users", bad, RAW_USERS, "2025-03-02", p, run_id="rx")
    st = _state(spark, p, "rx")["raw_users"]
    assert (st.run_status, st.row_ingested, st.row_loaded) == ("FAILED", None, None)


ORDER = ("order_id string, user_id string, product_id string, quantity long, amount string, amount_numeric long, country string, "
         "status string, created_date timestamp, event_ts timestamp, source string, ingestion_ts timestamp, n int")


def order_rows(spark, values):
    """One order per (number, quantity)."""
    t = dt.datetime(2025, 3, 1)
    return spark.createDataFrame([(f"O{i}", "U1", "P1", q, "Rp.1", 1, "ID", "Genuine", t, t, "stream", t, 0) for i, q in values], ORDER)


def test_changes_reach_the_warehouse_once_whatever_fails(spark, monkeypatch):
    from ordersentry.plans import ingest
    from ordersentry.schemas import RAW_ORDERS
    from ordersentry.sources import merge_table
    from ordersentry.sources.tables import read_table
    p = paths()
    source = f"{p.export_dir}/source"

    def move():
        return ingest.ingest_changes(spark, "raw_orders", source, RAW_ORDERS, p, "wh")

    def stored():
        return {r.order_id: r.quantity for r in read_table(spark, p.target("raw_orders")).collect()}

    assert move() is None                                          # nothing published yet
    merge_table.upsert(spark, source, order_rows(spark, [(1, 1), (2, 1)]), "order_id", "n", stamp_col=None)
    assert move() and stored() == {"O1": 1, "O2": 1}
    assert move() is None
    merge_table.upsert(spark, source, order_rows(spark, [(1, 1), (2, 5), (3, 3)]), "order_id", "n", stamp_col=None)
    with monkeypatch.context() as m:                               # stops after the load, before the bookmark
        def lost(*a, **k):
            raise RuntimeError("lost")
        m.setattr(merge_table, "advance", lost)
        with pytest.raises(RuntimeError, match="lost"):
            move()
    with monkeypatch.context() as m:                               # stops before the load
        m.setattr(merge_table, "upsert", lost)
        with pytest.raises(RuntimeError, match="lost"):
            move()
    export = move()
    assert sorted((r.order_id, r.change) for r in spark.read.json(export).collect()) == [("O2", "update"), ("O3", "insert")]
    assert stored() == {"O1": 1, "O2": 5, "O3": 3}
    st = _state_of(spark, p)
    assert (st["wh__-1_0"].row_ingested, st["wh__0_1"].row_ingested, st["wh__0_1"].row_loaded) == (2, 2, 2)
    assert st["wh__0_1"].is_consistent and st["wh__0_1"].run_status == "SUCCESS"


def _state_of(spark, p):
    return {r.run_id: r for r in ledger.state(read_ledger(spark, p)).collect()}
