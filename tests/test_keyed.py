import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from ordersentry.operators import fraud
from ordersentry.streaming.keyed import BUFFER, NO_TIME, ROCKSDB, bot_flags, by_stretch, start_keyed
from tests import brute
from tests.test_fraud import SCHEMA, random_stream

STREAM = T.StructType(SCHEMA.fields[2:] + [T.StructField("partition", T.IntegerType()), T.StructField("seq", T.LongType()),
                                           T.StructField("i", T.LongType())])


def stage(spark, rows, folder, name):
    spark.createDataFrame(rows, STREAM).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, root):
    orders = spark.readStream.schema(STREAM).parquet(f"{root}/in/*")
    start_keyed(orders, f"{root}/checkpoint", f"{root}/out", trigger={"availableNow": True}).awaitTermination(300)
    return spark.read.parquet(f"{root}/out")


def test_verdicts_equal_one_buffer_per_partition_across_restarts_and_new_partitions(spark, tmp_path):
    rnd = random.Random(17)
    orders = random_stream(17, 1500, 4, 2, 0.1)
    # The third stream partition appears with the second step.
    part = [rnd.randrange(2) if i < 500 else rnd.randrange(3) for i in range(len(orders))]
    want = {}
    for p in range(3):
        at = [i for i in range(len(orders)) if part[i] == p]
        want.update(zip(at, brute.screen([orders[i] for i in at])))
    rows = [tuple(o[f.name] for f in SCHEMA.fields[2:]) + (part[i], 3 * i + i % 2, i) for i, o in enumerate(orders)]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for step, (lo, hi) in enumerate([(0, 500), (500, 510), (510, 1500)]):
        shuffled = rows[lo:hi]
        rnd.shuffle(shuffled)                     # arrival is by offset, not by place in a file
        stage(spark, shuffled, f"{tmp_path}/in", f"step-{step}")
        out = run(spark, tmp_path)                # a restart but for the first
        assert out.count() == hi
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before != ROCKSDB
    got = {r.i: (r.status, r.first_rule) for r in out.collect()}
    assert got == want
    assert len({rule for _, rule in want.values()}) > 3
    # The orders come through as they were.
    fields = [f.name for f in STREAM.fields if f.name != "status"]
    assert sorted(map(tuple, out.select(*fields).collect())) == sorted(map(tuple, spark.createDataFrame(rows, STREAM).select(*fields).collect()))


def _frame(rows):
    return pd.DataFrame(rows, columns=[c.split()[0] for c in BUFFER.split(", ")])


def test_missing_times_and_ids():
    s = 1_000_000
    rows = [("x", "a", 1, True, 0), ("x", "a", 1, True, NO_TIME), ("x", "b", 0, False, s), ("x", "b", 2, True, 2 * s), ("y", "b", 2, True, 20 * s)]
    a, b, c = bot_flags(_frame(rows), 0, fraud.DEFAULT)
    assert a.tolist() == [False, False, False, True, False]
    assert c.tolist() == [False, False, True, True, False]
    assert b.tolist() == [False] * 5                # an id that is no number disables it


@pytest.mark.parametrize("size", [1, 2, 7])
def test_small_buffers_count_arrivals(size):
    params = fraud.FraudParams(buffer_size=size)
    rows = [("x", "a", 5 - i // 2, True, 0) for i in range(10)]
    a, b, c = bot_flags(_frame(rows), 4, params)
    assert len(a) == 6 and all(a == (size > 1)) and all(c == (size > 1))
    pairs_fall = [any(5 - j // 2 > 5 - (j + 1) // 2 for j in range(max(0, i - size + 1), i)) for i in range(4, 10)]
    assert b.tolist() == [size > 1 and not f for f in pairs_fall]


def test_a_task_holds_a_stretch_of_offsets_at_a_time(tmp_path):
    rnd = random.Random(5)
    seq = rnd.sample(range(0, 3000, 3), 1000)
    rows = pd.DataFrame({"seq": seq, "order": [f"order {i}" for i in seq], "f_country": [i % 2 == 0 for i in seq]})
    parts = [rows[lo:lo + 130] for lo in range(0, 1000, 130)]
    got = list(by_stretch(iter(parts), str(tmp_path), 300))
    assert [len(p) for p in got] == [100] * 10
    assert pd.concat(got, ignore_index=True).equals(rows.sort_values("seq", ignore_index=True))


def test_verdicts_across_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ordersentry.streaming.keyed.STRETCH", 64)
    orders = random_stream(23, 600, 4, 2, 0.1)
    stage(spark, [tuple(o[f.name] for f in SCHEMA.fields[2:]) + (0, 3 * i, i) for i, o in enumerate(orders)], f"{tmp_path}/in", "step-0")
    got = {r.i: (r.status, r.first_rule) for r in run(spark, tmp_path).collect()}
    assert got == dict(enumerate(brute.screen(orders)))
