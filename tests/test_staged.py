import json

import pytest

from ordersentry.streaming import staged

SCHEMA = "partition int, offset long, value string"


def put(spark, topic, step, rows):
    staged.stage(spark.createDataFrame([(p, o, f"{p}-{o}") for p, o in rows], SCHEMA).coalesce(1), topic, step)


class Query:
    """A consumer that appends what it reads; every run is a restart."""

    def __init__(self, spark, tmp_path, name, starting):
        self.spark, self.root, self.starting = spark, str(tmp_path / name), starting

    def run(self, topic):
        stream = staged.read_staged(self.spark, topic, self.starting, f"{self.root}/start.json")
        q = (stream.writeStream.format("parquet").option("path", f"{self.root}/out")
             .option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()

    def seen(self):
        rows = self.spark.read.schema(SCHEMA).parquet(f"{self.root}/out").collect()
        assert all(r.value == f"{r.partition}-{r.offset}" for r in rows)
        return sorted((r.partition, r.offset) for r in rows)


def test_start_and_resume(spark, tmp_path):
    topic = str(tmp_path / "topic")
    steps = [[(0, 0), (0, 3), (1, 10)], [(0, 4), (1, 11), (1, 15)], [(0, 9), (2, 0), (2, 1)]]
    early, late = Query(spark, tmp_path, "early", "earliest"), Query(spark, tmp_path, "late", "latest")
    named = Query(spark, tmp_path, "named", json.dumps({"0": 4, "1": -1}))
    put(spark, topic, 0, steps[0])
    for q in (early, late, named):
        q.run(topic)
    put(spark, topic, 1, steps[1])                # nobody runs
    put(spark, topic, 2, steps[2])                # partition 2 is new
    for q in (early, late, named):
        q.run(topic)
        q.run(topic)                              # nothing new
    assert early.seen() == sorted(sum(steps, []))
    assert late.seen() == sorted(steps[1] + steps[2])
    assert named.seen() == sorted(r for r in steps[1] + steps[2] if r != (0, 3))


def reader(topic, **options):
    return staged.StagedReader({"path": topic, "startingOffsets": "earliest", **options})


def read(r, start, end):
    return sorted((p, o) for t in r.partitions(start, end) for b in r.read(t) for p, o in zip(*(b.column(i).to_pylist() for i in (0, 1))))


def test_tasks_hold_the_planned_offsets_only(spark, tmp_path, monkeypatch):
    topic = str(tmp_path / "topic")
    rows = [(p, o) for p in (0, 1) for o in range(0, 3000, 3)]
    spark.createDataFrame([(p, o, f"{p}-{o}") for p, o in rows], SCHEMA).coalesce(1).write.option("parquet.block.size", 4096) \
        .option("parquet.page.size.row.check.min", 10).option("parquet.block.size.row.check.min", 10).option("parquet.page.size.row.check.max", 10) \
        .partitionBy("partition").parquet(f"{topic}/step=0")
    monkeypatch.setattr(staged, "TASK_BYTES", 4096)
    r = reader(topic)
    end = r.latestOffset()
    assert r.initialOffset() == {"0": 0, "1": 0} and end == {"0": 2998, "1": 2998}
    start, middle = {"0": 100, "1": 2000}, {"0": 200, "1": 2300}
    assert read(r, start, middle) == [(p, o) for p, o in rows if start[str(p)] <= o < middle[str(p)]]
    whole = r.partitions({"0": 0, "1": 0}, end)
    assert len(whole) > len(r.partitions(start, middle)) >= 2          # row groups by their statistics
    assert read(r, {"0": 0, "1": 0}, end) == sorted(rows)
    r.commit(middle)
    assert read(r, middle, end) == [(p, o) for p, o in rows if o >= middle[str(p)]]
    # A new reader plans the same batch from the offsets alone.
    assert read(reader(topic), start, middle) == [(p, o) for p, o in rows if start[str(p)] <= o < middle[str(p)]]


def test_the_first_start_is_remembered(spark, tmp_path):
    """A query lost inside its first batch asks for its start again."""
    topic, start = str(tmp_path / "topic"), str(tmp_path / "q" / "start.json")
    put(spark, topic, 0, [(0, 0), (0, 1)])
    assert reader(topic, startingOffsets="latest", startPath=start).initialOffset() == {"0": 2}
    put(spark, topic, 1, [(0, 2)])
    assert reader(topic, startingOffsets="latest", startPath=start).initialOffset() == {"0": 2}
    assert reader(topic, startingOffsets="latest").initialOffset() == {"0": 3}


def test_unfinished_and_disordered_steps(spark, tmp_path):
    topic = tmp_path / "topic"
    assert reader(str(topic)).latestOffset() == {}
    put(spark, str(topic), 0, [(0, 5)])
    put(spark, str(topic), 1, [(0, 7)])
    put(spark, str(topic), 2, [(0, 8)])
    marker = topic / "step=1" / "_SUCCESS"
    marker.rename(topic / "step=1" / "_later")
    r = reader(str(topic))
    assert r.latestOffset() == {"0": 6}                                 # step 2 waits for step 1
    (topic / "step=1" / "_later").rename(marker)
    assert r.latestOffset() == {"0": 9} and read(r, {"0": 6}, {"0": 9}) == [(0, 7), (0, 8)]
    put(spark, str(topic), 3, [(0, 8)])
    with pytest.raises(ValueError, match="stood at 9"):
        r.latestOffset()
