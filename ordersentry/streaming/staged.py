"""A message topic staged as Parquet files, as a stream with offsets.

Where messages reach the platform as files instead of through a broker, this
source gives them the topic's semantics: a query starts at ``earliest``, at
``latest`` or at named offsets, and resumes where its checkpoint stands.

    TOPIC/step=N/partition=P/*.parquet     columns offset long, value string
    TOPIC/step=N/_SUCCESS                  written when the step is complete

which is what ``messages.write.partitionBy("partition").parquet(f"{topic}/step=N")``
leaves.  A step is seen once its ``_SUCCESS`` is there, so never in part.

An offset of the stream is ``{partition: next message offset}``.  It comes from
the row groups' statistics of the steps not yet seen; no message is read for
it, and a known step isn't listed again.  A micro-batch has one task per stretch
of row groups of at most ``TASK_BYTES``, chosen by the same statistics, and a task
reads Arrow batches.  Offsets may have gaps, but a later step's have to follow: one
that starts below what a stream has seen is an error, not a silent loss.

Options: ``path``; ``startingOffsets``: ``latest`` (the default, as the screening's
consumer), ``earliest``, or JSON ``{"0": 120, "1": -2}`` (-1 latest, -2 earliest;
partitions not named, and those that appear later, from their first message);
``startPath``: a file in the shared folder that keeps the offsets of the first
start.  Spark asks for them again when a query was lost inside its first
micro-batch; at ``latest`` the answer would then lie past that batch's messages.

Files are opened by Arrow: local and mounted folders, ``file:``, and the stores
its file systems know (``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "staged_messages"
SCHEMA = "partition int, offset long, value string"
TASK_BYTES = 64 << 20
FOOTER_THREADS = 16
LATEST, EARLIEST = -1, -2
_ARROW = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``path`` and the path inside it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class Stretch(NamedTuple):
    """A row group of a file, by its statistics."""
    step: int
    partition: int
    file: str
    group: int
    first: int
    last: int
    bytes: int


class Task(InputPartition):
    """Row groups of one file, and the offsets wanted from it."""

    def __init__(self, file: str, groups: list[int], partition: int, start: int, end: int):
        self.file, self.groups, self.partition, self.start, self.end = file, groups, partition, start, end


def step_files(fs: pafs.FileSystem, step_path: str) -> list[tuple[int, str]]:
    """(stream partition, file) of a step."""
    out = []
    for info in fs.get_file_info(pafs.FileSelector(step_path, recursive=True)):
        found = re.search(r"/partition=(\d+)/[^/._][^/]*\.parquet$", info.path)
        if info.type == pafs.FileType.File and found:
            out.append((int(found[1]), info.path))
    return sorted(out)


def stretches(fs: pafs.FileSystem, step: int, partition: int, file: str) -> list[Stretch]:
    """The row groups of a file, from its footer."""
    with fs.open_input_file(file) as f:
        meta = pq.ParquetFile(f).metadata
        column = meta.schema.names.index("offset")
        out = []
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = group.column(column).statistics
            if not group.num_rows:
                continue
            if stats is None or not stats.has_min_max or stats.null_count:
                raise ValueError(f"{file}: offsets without statistics, or missing ones")
            out.append(Stretch(step, partition, file, g, stats.min, stats.max, group.total_byte_size))
    return out


class StagedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}      # as Spark hands them over
        self.path, self.starting = options["path"], options.get("startingoffsets", "latest")
        self.start_path = options.get("startpath")
        self.steps: set[int] = set()               # steps whose footers were read
        self.index: list[Stretch] = []             # row groups not yet committed
        self.first: dict[int, int] = {}
        self.next: dict[int, int] = {}

    # -------------------------------------------------------------- offsets
    def _refresh(self) -> None:
        fs, root = open_store(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        steps = sorted((int(m[1]), i.path) for i in found if (m := re.search(r"/step=(\d+)$", i.path)))
        for step, folder in steps:
            if step in self.steps:
                continue
            if fs.get_file_info(f"{folder}/_SUCCESS").type != pafs.FileType.File:
                break                              # later steps wait for this one
            with ThreadPoolExecutor(FOOTER_THREADS) as pool:
                footers = pool.map(lambda found: stretches(fs, step, *found), step_files(fs, folder))
                new = [s for groups in footers for s in groups]
            for s in new:
                if s.first < self.next.get(s.partition, s.first):
                    raise ValueError(f"{s.file} holds offset {s.first} of partition {s.partition}, which stood at {self.next[s.partition]}")
            for s in new:
                self.first[s.partition] = min(self.first.get(s.partition, s.first), s.first)
            for s in new:
                self.next[s.partition] = max(self.next.get(s.partition, 0), s.last + 1)
            self.index += new
            self.steps.add(step)

    def _resolved(self) -> dict[str, int]:
        """The starting offsets as numbers."""
        self._refresh()
        named = {}
        if self.starting not in ("latest", "earliest"):
            named = {int(p): int(o) for p, o in json.loads(self.starting).items()}
        other = LATEST if self.starting == "latest" else EARLIEST
        out = {}
        for p in sorted({*self.next, *named}):
            at = named.get(p, other)
            out[str(p)] = {LATEST: self.next.get(p, 0), EARLIEST: self.first.get(p, 0)}.get(at, at)
        return out

    def initialOffset(self) -> dict:
        if self.start_path is None:
            return self._resolved()
        fs, file = open_store(self.start_path)
        if fs.get_file_info(file).type == pafs.FileType.NotFound:
            offsets = self._resolved()
            fs.create_dir(file.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(f"{file}.tmp") as f:
                f.write(json.dumps(offsets).encode())
            fs.move(f"{file}.tmp", file)
        with fs.open_input_stream(file) as f:
            return json.loads(f.read())

    def latestOffset(self) -> dict:
        self._refresh()
        return {str(p): o for p, o in sorted(self.next.items())}

    # ---------------------------------------------------------------- tasks
    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if not {int(p) for p in end} <= set(self.next):
            self._refresh()                        # after a restart: the planned batch again
        by_file: dict[str, list[Stretch]] = {}
        for s in self.index:
            # A partition that appeared later starts with its first message.
            if s.last >= start.get(str(s.partition), s.first) and s.first < end.get(str(s.partition), 0):
                by_file.setdefault(s.file, []).append(s)
        tasks: list[InputPartition] = []
        for file, groups in by_file.items():
            p = groups[0].partition
            lo, hi = start.get(str(p), min(g.first for g in groups)), end[str(p)]
            part, size = [], 0
            for g in groups:
                if part and size + g.bytes > TASK_BYTES:
                    tasks.append(Task(file, part, p, lo, hi))
                    part, size = [], 0
                part.append(g.group)
                size += g.bytes
            tasks.append(Task(file, part, p, lo, hi))
        return tasks

    def read(self, partition: Task) -> Iterator[pa.RecordBatch]:
        fs, file = open_store(partition.file)
        with fs.open_input_file(file) as f:
            for batch in pq.ParquetFile(f).iter_batches(4096, row_groups=partition.groups, columns=["offset", "value"]):
                at = batch.column("offset")
                batch = batch.filter(pc.and_(pc.greater_equal(at, partition.start), pc.less(at, partition.end)))
                key = pa.array([partition.partition] * batch.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([key, batch.column("offset"), batch.column("value").cast(pa.string())], schema=_ARROW)

    def commit(self, end: dict) -> None:
        self.index = [s for s in self.index if s.last >= end.get(str(s.partition), 0)]


class StagedMessages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> StagedReader:
        return StagedReader(dict(self.options))


def read_staged(spark: SparkSession, path: str, starting: str = "latest", start_path: str | None = None) -> DataFrame:
    """A staged topic as a stream of ``partition, offset, value``, what
    :func:`.screening.decode_orders` takes."""
    spark.dataSource.register(StagedMessages)
    reader = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting)
    if start_path:
        reader = reader.option("startPath", start_path)
    return reader.load()


def stage(messages: DataFrame, path: str, step: int) -> None:
    """Append ``messages`` (partition, offset, value) to the topic as step ``step``."""
    (messages.select("partition", "offset", "value").sortWithinPartitions("partition", "offset")
     .write.mode("overwrite").partitionBy("partition").parquet(f"{path}/step={step}"))
