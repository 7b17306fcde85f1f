import os
import random

import pytest
from pyspark.sql import functions as F

from ordersentry.sources import merge_table, tables

SCHEMA = "order_id string, v long, seq long"


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return {r.order_id: r.v for r in df.collect()}


def test_runs_merge_like_a_dictionary(spark, tmp_path, monkeypatch):
    """Random upserts with compaction between them against a plain dictionary."""
    monkeypatch.setattr(merge_table, "TIER_BASE", 4)
    path, rnd, want, seq, compacted = str(tmp_path / "t"), random.Random(3), {}, 0, 0
    for step in range(9):
        rows = []
        for _ in range(rnd.choice([1, 3, 6, 20])):
            k = rnd.choice([f"O{rnd.randrange(12)}", f"O{rnd.randrange(12)}000001", "odd id"])
            rows.append((k, rnd.randrange(10 ** 6), seq))
            want[k] = rows[-1][1]
            seq += 1
        rnd.shuffle(rows)
        merge_table.upsert(spark, path, batch(spark, rows), "order_id", "seq")
        if step % 2:
            compacted += len(merge_table.compact(spark, path, fan_in=2))
        if step in (0, 4, 8):
            read = tables.read_table(spark, path)
            assert content(read) == want and read.count() == len(want)
    assert compacted
    asked = [*rnd.sample(sorted(want), 5), "O77", "O5000000", None]
    found = merge_table.lookup(spark, path, spark.createDataFrame([(k,) for k in asked], "order_id string"))
    assert content(found) == {k: want[k] for k in asked if k in want}
    assert merge_table.lookup(spark, path, spark.createDataFrame([("O99999999",)], "order_id string")).count() == 0


def test_a_batch_costs_the_same_in_a_large_table(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    rows = [(f"O{i * 7}", i, i) for i in range(100)]
    merge_table.upsert(spark, small, batch(spark, rows), "order_id", "seq")
    many = spark.range(200_000).selectExpr("concat('O', id) AS order_id", "id AS v", "id AS seq")
    merge_table.upsert(spark, large, many, "order_id", "seq")
    written = []
    for path in (small, large):
        before = size(path)
        merge_table.upsert(spark, path, batch(spark, rows), "order_id", "seq")
        written.append(size(path) - before)
    assert written[1] < 1.5 * written[0]
    assert tables.read_table(spark, large).count() == 200_000


@pytest.mark.parametrize("crash", ["write", "publish", "compaction write", "compaction publish", "clean up"])
def test_crashes_leave_the_old_or_the_new_table(spark, tmp_path, monkeypatch, crash):
    path = str(tmp_path / "t")
    want = {}
    for b in range(3):
        rows = [(f"O{i}", 10 * b + i, i) for i in range(b, b + 3)]
        want |= {k: v for k, v, _ in rows}
        merge_table.upsert(spark, path, batch(spark, rows), "order_id", "seq")
    whole = {name: getattr(merge_table, name) for name in ("_write_run", "publish", "_remove_superseded")}
    at = "_write_run" if crash.endswith("write") else "publish" if crash.endswith("publish") else "_remove_superseded"

    def failing(*args):
        if at == "_write_run":
            whole[at](*args)                   # written, then lost
        raise OSError("lost")

    new = [("O1", 777, 1), ("O9", 999, 2)]

    def act():
        if crash.startswith("compaction"):
            merge_table.compact(spark, path, fan_in=3)
        else:
            merge_table.upsert(spark, path, batch(spark, new), "order_id", "seq")

    monkeypatch.setattr(merge_table, at, failing)
    with pytest.raises(OSError, match="lost"):
        act()
    after = want | {"O1": 777, "O9": 999}
    assert content(tables.read_table(spark, path)) == (after if crash == "clean up" else want)
    monkeypatch.undo()
    act()                                      # the replay
    assert content(tables.read_table(spark, path)) == (want if crash.startswith("compaction") else after)
    assert len(merge_table.runs(spark, path)) == (1 if crash.startswith("compaction") else 5 if crash == "clean up" else 4)


def test_an_open_reader_survives_the_next_version(spark, tmp_path):
    path = str(tmp_path / "t")
    for b in range(3):
        merge_table.upsert(spark, path, batch(spark, [(f"O{b}", b, b)]), "order_id", "seq")
    open_reader = tables.read_table(spark, path)
    assert merge_table.compact(spark, path, fan_in=3) == [0, 1, 2]
    assert content(open_reader) == {"O0": 0, "O1": 1, "O2": 2} == content(tables.read_table(spark, path))
    merge_table.upsert(spark, path, batch(spark, [("O0", 5, 9)]), "order_id", "seq")
    merge_table.upsert(spark, path, batch(spark, [("O0", 6, 9)]), "order_id", "seq")
    assert sorted(os.listdir(f"{path}/data")) == sorted(f"run={r['run']}" for r in merge_table.runs(spark, path))
    assert content(tables.read_table(spark, path)) == {"O0": 6, "O1": 1, "O2": 2}


def test_lookups_open_few_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    for b in range(4):
        rows = spark.range(3000).selectExpr(f"concat('O', id * 4 + {b} + 1000000 * (id % 3)) AS order_id", "id AS v", "id AS seq")
        merge_table.upsert(spark, path, rows, "order_id", "seq")
    keys = spark.createDataFrame([("O6",)], "order_id string")      # run 2, range 0
    assert merge_table.read(spark, path).filter("order_id = 'O6'").count() == 0
    keys = spark.read.parquet(f"{path}/data/run=2/key_range=1").select("order_id").limit(1)
    pairs = {(r["run"], r["key_range"]) for r in merge_table.candidates(spark, path, keys).collect()}
    assert (2, 1) in pairs and len(pairs) <= 2                       # 12 pairs exist
    assert merge_table.lookup(spark, path, keys).count() == 1
    # No stored key is ever refused.
    every = merge_table.read(spark, path)
    assert merge_table.lookup(spark, path, every.select("order_id")).count() == every.count() == 12000


def test_due_runs_are_neighbours_in_age():
    def run(i, rows):
        return {"run": i, "rows": rows}
    assert merge_table.due([run(i, 10) for i in range(7)]) == []
    assert len(merge_table.due([run(i, 10) for i in range(8)])) == 8
    mixed = [run(0, 10 ** 6), *(run(i, 10) for i in range(1, 9))]
    assert [r["run"] for r in merge_table.due(mixed)] == list(range(1, 9))
    assert merge_table.due([run(i, 10) for i in range(5)] + [run(5, 10 ** 6)] + [run(i, 10) for i in range(6, 10)]) == []
    tiered = [run(0, 10 ** 7), *(run(i, 5000) for i in range(1, 9)), run(9, 3)]
    assert [r["run"] for r in merge_table.due(tiered)] == list(range(1, 10))


def test_empty_batches_and_missing_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge_table.upsert(spark, path, batch(spark, []), "order_id", "seq") is None
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    merge_table.upsert(spark, path, batch(spark, [("O1", 1, 1)]), "order_id", "seq", now=F.lit("2024-01-01").cast("timestamp"))
    assert merge_table.upsert(spark, path, batch(spark, []), "order_id", "seq") is None
    assert len(merge_table.runs(spark, path)) == 1 and merge_table.compact(spark, path) == []


USERS = "email string, name string, ord long"


def test_inserts_ignore_stored_keys_and_go_on_numbering(spark, tmp_path):
    path, buckets = str(tmp_path / "t"), merge_table.hash_buckets(16)
    want, number = {}, 0
    for b in range(3):
        rows = [(f"e{i % 40}", f"n{b}-{i}", i) for i in range(20 * b, 20 * b + 50)]
        for e, n, _ in rows:
            if e not in want:
                number += 1
                want[e] = (number, n)
        sent = spark.createDataFrame(rows, USERS)
        added = merge_table.insert_ignore(spark, path, sent, "email", "ord", surrogate="user_id", defaults={"source": "batch"}, partition_of=buckets)
        before = len(merge_table.runs(spark, path))
        assert added == sum(n.startswith(f"n{b}-") for _, n in want.values())
        assert merge_table.insert_ignore(spark, path, sent, "email", "ord", surrogate="user_id", partition_of=buckets) == 0      # a replay
        assert len(merge_table.runs(spark, path)) == before
    assert {r.email: (r.user_id, r.name) for r in merge_table.read(spark, path, "email").collect()} == want
    with pytest.raises(Exception, match="NULL email"):
        merge_table.insert_ignore(spark, path, spark.createDataFrame([(None, "x", 1)], USERS), "email", "ord", partition_of=buckets)


def test_an_insert_opens_only_its_buckets(spark, tmp_path, monkeypatch):
    path, buckets = str(tmp_path / "t"), merge_table.hash_buckets(64)
    many = spark.range(4000).selectExpr("concat('e', id) AS email", "concat('n', id) AS name", "id AS ord")
    merge_table.insert_ignore(spark, path, many, "email", "ord", surrogate="user_id", partition_of=buckets)
    opened, rows = [], merge_table._rows

    def spy(spark, path, manifest, some, folders=None):
        opened.append(folders)
        out = rows(spark, path, manifest, some, folders)
        return out

    monkeypatch.setattr(merge_table, "_rows", spy)
    sent = spark.createDataFrame([("e5", "again", 1), ("e4001", "new", 2), ("e4002", "new", 3)], USERS)
    assert merge_table.insert_ignore(spark, path, sent, "email", "ord", surrogate="user_id", partition_of=buckets) == 2
    assert len(opened) == 1 and 1 <= len(opened[0]) <= 3                # of 64 buckets; two keys are new, so mostly one
    monkeypatch.undo()
    new = merge_table.read(spark, path, "email").filter("name = 'new'")
    assert sorted((r.email, r.user_id) for r in new.collect()) == [("e4001", 4001), ("e4002", 4002)]


def test_changes_are_the_difference_of_two_versions(spark, tmp_path, monkeypatch):
    """Random upserts and compactions; a bookmark's version outlives both."""
    monkeypatch.setattr(merge_table, "TIER_BASE", 4)
    path, rnd, state, held = str(tmp_path / "t"), random.Random(11), {}, {-1: {}}
    for step in range(6):
        rows = []
        for _ in range(rnd.choice([2, 5, 12])):
            k = rnd.choice([f"O{rnd.randrange(9)}", f"O{rnd.randrange(9)}000001"])
            state[k] = rnd.choice([state.get(k), rnd.randrange(3), None])
            rows.append((k, state[k], len(rows)))
        merge_table.upsert(spark, path, batch(spark, rows), "order_id", "seq")
        held[merge_table.version(spark, path)] = dict(state)
        if step == 1:
            merge_table.advance(spark, path, "wh", merge_table.version(spark, path))
        merge_table.compact(spark, path, fan_in=2)
        held[merge_table.version(spark, path)] = dict(state)
    mark, last = merge_table.bookmark(spark, path, "wh"), merge_table.version(spark, path)
    assert len(merge_table.runs(spark, path)) < 6 and 0 <= mark < last - 1
    for since, until in ((mark, last), (-1, last), (last, last), (-1, mark)):
        before, after = held[since], held[until]
        want = {(k, v, "update" if k in before else "insert") for k, v in after.items() if k not in before or before[k] != v}
        got = [(r.order_id, r.v, r.change) for r in merge_table.changes(spark, path, since, until).collect()]
        assert set(got) == want and len(got) == len(want)
    with pytest.raises(FileNotFoundError, match="is gone"):
        merge_table.changes(spark, path, mark + 1)
    merge_table.advance(spark, path, "wh", last)
    with pytest.raises(ValueError, match="past"):
        merge_table.advance(spark, path, "wh", mark)
    for k in range(2):
        merge_table.upsert(spark, path, batch(spark, [("O1", 100 + k, 0)]), "order_id", "seq")
    with pytest.raises(FileNotFoundError, match="is gone"):
        merge_table.changes(spark, path, mark)
    assert [(r.order_id, r.v) for r in merge_table.changes(spark, path, last).collect()] == [("O1", 101)]


def test_changes_see_columns_that_came_later(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_table.upsert(spark, path, batch(spark, [("O1", 1, 0), ("O2", 2, 0)]), "order_id", "seq")
    later = spark.createDataFrame([("O1", 1, None, 0), ("O2", 2, "x", 0)], "order_id string, v long, note string, seq long")
    merge_table.upsert(spark, path, later, "order_id", "seq")
    assert [(r.order_id, r.change) for r in merge_table.changes(spark, path, 0).collect()] == [("O2", "update")]


def test_a_key_range_is_written_by_several_tasks(spark, tmp_path):
    """A large batch's key range lies in several files, each a part of the keys in order;
    a small batch's in one, and buckets of other keys aren't cut."""
    path = str(tmp_path / "t")
    rows = spark.range(400_000).selectExpr("concat('O', 1000000 + id) AS order_id", "xxhash64(id) AS v", "id AS seq")
    merge_table.upsert(spark, path, rows, "order_id", "seq")
    merge_table.upsert(spark, path, rows.filter("id < 50"), "order_id", "seq")
    one = merge_table.hash_buckets(1)
    merge_table.upsert(spark, path, rows.withColumn("order_id", F.concat(F.lit("x"), "order_id")), "order_id", "seq", partition_of=one)
    files = [[n for n in os.listdir(f"{path}/data/run={run}/key_range={k}") if n.endswith(".parquet")] for run, k in ((0, 1), (1, 1), (2, 0))]
    assert len(files[0]) > 1 and len(files[1]) == len(files[2]) == 1
    for name in files[0]:
        keys = [r[0] for r in spark.read.parquet(f"{path}/data/run=0/key_range=1/{name}").select("order_id").collect()]
        assert keys == sorted(keys) and len(keys) < 400_000
    assert merge_table.read(spark, path).count() == 800_000
