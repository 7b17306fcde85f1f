"""Helpers shared by the corpus operators.

Words are the maximal runs of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``); lower-casing touches A-Z only.  Both are done by
Arrow kernels on whole batches, never word by word in Python.

Large exchanges move *packed arrays*: a task writes one binary row per
(batch, destination) that holds numpy arrays, Spark shuffles those rows by
destination, and the receiving group unpacks them.  A destination's size
is set by the number of destinations, which follows the input.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 6 << 20          # text bytes handled at once inside a task


# ------------------------------------------------------------ Spark helpers
def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back:
    later reads survive lost executors and do not recompute it."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def remainder(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % modulus


def running_total(df: DataFrame, group: list[str], order: str, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` inside ``group`` along ``order``; for
    small tables of per-bucket sums (one row per thousands of input rows)."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def free_prefix(columns: Iterable[str]) -> str:
    """Underscores that no column's name begins with."""
    tag = "__"
    while any(c.startswith(tag) for c in columns):
        tag += "_"
    return tag


def repeat_rows(docs: DataFrame, copies: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, each row as often as ``copies`` says: rows
    (doc_id, tie, rows, copies) with ``tie`` the xxhash64 of the text, ``rows``
    how many input rows have this id and text, ``copies`` how many shall remain.
    Of several equal rows the i-th stays ``(copies + i) div rows`` times."""
    tag = free_prefix(docs.columns)
    said = copies.filter("copies > 0").select(*(F.col(c).alias(tag + c) for c in ("doc_id", "tie", "rows", "copies")))
    joined = docs.join(said, F.col(doc_id).cast("long").eqNullSafe(F.col(f"{tag}doc_id"))
                       & (F.xxhash64(F.col(text).cast("string")) == F.col(f"{tag}tie")))

    def out(rows, n):
        return rows.withColumn(f"{tag}copy", F.explode(F.sequence(F.lit(1).cast("long"), n.cast("long")))).select(*(F.col(f"`{c}`") for c in docs.columns))

    many = F.col(f"{tag}rows")
    single = out(joined.filter(many == 1), F.col(f"{tag}copies"))
    if said.filter(many > 1).isEmpty():
        return single
    number = F.row_number().over(Window.partitionBy(f"{tag}doc_id", f"{tag}tie").orderBy(f"{tag}tie")) - 1
    several = joined.filter(many > 1).withColumn(f"{tag}n", F.floor((F.col(f"{tag}copies") + number) / many)).filter(F.col(f"{tag}n") > 0)
    return single.unionByName(out(several, F.col(f"{tag}n")))


def one_thread() -> None:
    """Libraries inside a task keep to the task's core."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def kept_by_worker(key: tuple, make):
    """``make()``, once in each Python worker: Spark reuses workers, so later
    tasks of a worker find it.  Functions come by value and have no module to
    keep it in, hence the dictionary on an imported one."""
    import pyspark
    memo = pyspark.__dict__.setdefault("_kept_by_worker", {})
    if key not in memo:
        memo[key] = make()
    return memo[key]


def give_back() -> None:
    """Return freed memory to the system: Python workers live on, and an
    executor's tasks share its memory limit."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim:
        trim(0)


# ------------------------------------------------------------ packed arrays
def pack(*arrays: np.ndarray, compress: bool = False) -> bytes:
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts += [a.dtype.str.encode().ljust(8), np.array([a.size], np.int64).tobytes(), a.tobytes()]
    raw = b"".join(parts)
    return b"Z" + zstandard.ZstdCompressor(level=1).compress(raw) if compress else b"R" + raw


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(blob[1:]) if blob[:1] == b"Z" else blob[1:])
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for _ in range(n):
        dtype = np.dtype(bytes(raw[at:at + 8]).decode().strip())
        size = int(np.frombuffer(raw, np.int64, 1, at + 8)[0])
        out.append(np.frombuffer(raw, dtype, size, at + 16))
        at += 16 + size * dtype.itemsize
    return out


def split_by(dest: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(destination, row indices in their order) for every destination present."""
    order = np.argsort(dest, kind="stable")
    cuts = np.flatnonzero(np.diff(dest[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(dest[rows[0]]), rows


def binary_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i]+lens[i]-1 for all i, concatenated."""
    lens = np.asarray(lens, np.int64)
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lens), lens)


# -------------------------------------------------------------------- words
class Words(NamedTuple):
    offsets: np.ndarray      # n_texts + 1, into codes
    codes: np.ndarray        # word -> entry of vocabulary
    vocabulary: pa.Array     # distinct words of the batch

    def hashes(self) -> np.ndarray:
        """64-bit hash of every distinct word."""
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.vocabulary.to_pylist()),
                           np.uint64, len(self.vocabulary))


def split_words(texts: pa.Array, lower: bool = True) -> Words:
    """The words of every text (null: none)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.offset:                           # ascii_lower misreads an array that starts inside its buffers
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    encoded = lists.flatten().dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    codes, vocabulary = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    empty = pc.index(vocabulary, "").as_py()
    if empty is not None and empty >= 0:      # leading and trailing white space
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return Words(offsets, codes, vocabulary)


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one piece holds about ``limit`` bytes of text at
    most (one longer text makes a piece of its own; no text is cut)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(size + 64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield b.slice(lo, hi - lo)
    give_back()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


STEP = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive entries (order matters): a
    polynomial in ``STEP``, built by doubling the run's length."""
    if len(word_hashes) < k:
        return np.zeros(0, np.uint64)
    acc, have = word_hashes.astype(np.uint64, copy=False), 1
    for bit in f"{k:b}"[1:]:
        longer = acc[:len(acc) - have] * np.uint64(pow(int(STEP), have, 1 << 64))
        longer += acc[have:]
        acc, have = longer, 2 * have
        if bit == "1":
            acc = acc[:-1] * STEP
            acc += word_hashes[have:]
            have += 1
    return mix64(acc)


def shingles(offsets: np.ndarray, word_hashes: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of every text's k-word shingles in text order; a text
    of 1 .. k-1 words has one shingle, its whole sequence."""
    lens = np.diff(offsets)
    count = np.where(lens >= k, lens - k + 1, (lens > 0).astype(np.int64))
    out_off = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(int(out_off[-1]), np.uint64)
    every = window_hashes(word_hashes, k)
    long = np.flatnonzero(lens >= k)
    out[ragged(out_off[long], count[long])] = every[ragged(offsets[long], count[long])]
    for i in np.flatnonzero((lens > 0) & (lens < k)):
        run = word_hashes[offsets[i]:offsets[i + 1]]
        out[out_off[i]] = window_hashes(run, len(run))[0] ^ np.uint64(len(run))
    return out_off, out


# ------------------------------------------------------------------- blocks
BLOCK_SCHEMA = "block long, payload binary"
_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("payload", pa.binary())])


def n_blocks(rows: int, per_block: int = 4096) -> int:
    return max(1, math.ceil(rows / per_block))


def text_blocks(docs: DataFrame, blocks: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Texts packed by block (a hash of the id): rows (block, compressed Arrow
    stream of ``doc_id``, ``text``).  A block is a fixed set of documents,
    whatever the scan, so a second pass meets the same blocks."""
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                        F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(blocks)).alias("block"))

    def run(batches):
        for b in chunks(batches, "text", 4 * CHUNK_BYTES):
            table = pa.record_batch([b.column(0), b.column(1)], ["doc_id", "text"])
            rows = []
            for block, at in split_by(b.column("block").to_numpy(zero_copy_only=False)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as w:
                    w.write_batch(table.take(pa.array(at)))
                rows.append((block, zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())))
            yield binary_rows(rows, _BLOCK_ARROW)

    return keyed.mapInArrow(run, BLOCK_SCHEMA)


def block_docs(payloads: pa.ChunkedArray) -> pa.Table:
    """The documents of one block in a fixed order (id, then text)."""
    parts = [pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(p.as_py())).read_all() for p in payloads]
    table = pa.concat_tables(parts)
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
