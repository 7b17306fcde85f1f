"""Token-ID / binary output (operator 5).

``write_token_store`` encodes every document, appends the end id and writes
the ids in ascending ``doc_id`` order as *segments*.  A segment is one row of
a table in shared storage: the concatenated ids as 16- or 32-bit
little-endian integers, and two Elias-Fano sequences, the document
boundaries inside the segment and the document ids.  An Elias-Fano sequence
of n values below u takes about n * (2 + log2(u / n)) bits, and its sampled
select structure returns the i-th boundary without decoding the rest, so
there is no table of 64-bit offsets.

Segments hold whole documents and about ``segment_ids`` ids; a longer
document makes a longer segment.  Their global offsets are running sums
over one row per segment, kept apart from the ids.

Defined cases: a null text is the empty text (only the end id); a null
``doc_id`` sorts first and comes back as null; repeated ids keep all their
rows, ordered by a hash of the text; an empty table makes an empty store.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, kept_by_worker, one_thread, ragged, split_words, text_of


class EliasFano:
    """Non-decreasing integers: low bits packed, high bits in unary, every
    ``SAMPLE``-th one's position kept for select."""

    SAMPLE = 256
    HEAD = "<qqqBq"          # n, base, bytes of low bits, bits per low part, bytes of high bits

    def __init__(self, n, base, low_bits, low, high, samples):
        self.n, self.base, self.low_bits, self.low, self.high, self.samples = n, base, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        base = int(values[0])
        # Differences as unsigned: the span of signed 64-bit ids may exceed 2^63.
        v = values.astype(np.uint64) - np.uint64(base & 0xFFFFFFFFFFFFFFFF)
        span = int(v[-1]) + 1
        low_bits = max(0, (span // n).bit_length() - 1)
        low = v & np.uint64((1 << low_bits) - 1)
        bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(n, base, low_bits, np.packbits(bits.ravel(), bitorder="little"),
                   np.packbits(high, bitorder="little"), ones[::cls.SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = struct.pack(self.HEAD, self.n, self.base, len(self.low), self.low_bits, len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> "EliasFano":
        n, base, n_low, low_bits, n_high = struct.unpack_from(cls.HEAD, blob)
        at = struct.calcsize(cls.HEAD)
        return cls(n, base, low_bits, np.frombuffer(blob, np.uint8, n_low, at),
                   np.frombuffer(blob, np.uint8, n_high, at + n_low), np.frombuffer(blob, "<u4", -1, at + n_low + n_high))

    def _low(self, lo: int, hi: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(hi - lo, np.uint64)
        first, last = lo * self.low_bits, hi * self.low_bits
        bits = np.unpackbits(self.low[first // 8:(last + 7) // 8], bitorder="little")[first % 8:first % 8 + last - first]
        return (bits.reshape(-1, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def _signed(self, v: np.ndarray) -> np.ndarray:
        return (v + np.uint64(self.base & 0xFFFFFFFFFFFFFFFF)).astype(np.int64)

    def decode(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return self._signed((high << np.uint64(self.low_bits)) | self._low(0, self.n))

    def select(self, i: int) -> int:
        """The i-th value: jump to the sample before it, scan on by bytes."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // self.SAMPLE]), i % self.SAMPLE
        byte = at // 8
        part = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        part[:at % 8] = 0
        while (found := int(part.sum())) <= left:
            left -= found
            byte += 1
            part = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        one = byte * 8 + int(np.flatnonzero(part)[left])
        high = np.array([one - i], np.uint64)
        return int(self._signed((high << np.uint64(self.low_bits)) | self._low(i, i + 1))[0])


class WordEncoder:
    """Ids of texts by the tokenizers library, each distinct word encoded once.

    The tokenizer's pre-tokenizer drops white space and lets no piece cross
    it, so a text's ids are its words' ids in order.  A word that ends in a
    lower-case or caseless letter and a run of plain punctuation is two pieces of the
    pre-tokenizer, so both parts are looked up apart.  The memo is emptied
    when it is full, so its size does not grow with the corpus."""

    TAIL = ".,;:!?|#$%&*"

    def __init__(self, path: str, memo: int = 700_000):
        from tokenizers import Tokenizer
        one_thread()
        self.tokenizer, self.memo = Tokenizer.from_file(path), memo
        self._reset()

    def _reset(self):
        self.known: dict[str, int] = {"": 0}
        self.pool, self.bounds = array("I"), array("q", [0, 0])    # ids of piece i: pool[bounds[i]:bounds[i + 1]]

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, pool): where the ids of every piece stand."""
        if len(self.known) > self.memo:
            self._reset()
        missing = [p for p in pieces if p not in self.known]
        if missing:
            found = self.tokenizer.encode(missing, is_pretokenized=True, add_special_tokens=False)
            count = np.bincount(np.array(found.word_ids, np.int64), minlength=len(missing))
            first = len(self.known)
            self.known.update(zip(missing, range(first, first + len(missing))))
            self.bounds.frombytes((len(self.pool) + np.cumsum(count)).astype(np.int64).tobytes())
            self.pool.frombytes(np.array(found.ids, np.uint32).tobytes())
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        bounds = np.array(self.bounds)
        return bounds[at], bounds[at + 1] - bounds[at], np.array(self.pool)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of distinct words."""
        special = pc.match_substring(words, "<|")
        lower = pc.if_else(special, words, pc.ascii_lower(words))
        core = pc.utf8_rtrim(lower, characters=self.TAIL)
        cut = pc.and_(pc.match_substring_regex(core, r"[\p{Ll}\p{Lo}]$"), pc.invert(special))
        core = pc.if_else(cut, core, lower)
        tail = pc.if_else(cut, pc.replace_substring_regex(lower, r"^.*[\p{Ll}\p{Lo}]", ""), "")
        cores, tails = core.dictionary_encode(), tail.dictionary_encode()
        pieces = cores.dictionary.to_pylist()
        tail_pieces = tails.dictionary.to_pylist()
        # Both lists hold distinct strings; one may stand in both.
        both = dict.fromkeys(pieces + tail_pieces)
        starts, lens, pool = self._ids(list(both))
        place = dict(zip(both, range(len(both))))
        pick = np.empty(2 * len(words), np.int64)
        pick[0::2] = np.fromiter(map(place.__getitem__, pieces), np.int64, len(pieces))[cores.indices.to_numpy()]
        pick[1::2] = np.fromiter(map(place.__getitem__, tail_pieces), np.int64, len(tail_pieces))[tails.indices.to_numpy()]
        return lens[pick].reshape(-1, 2).sum(1), pool[ragged(starts[pick], lens[pick])]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids): every text's ids and the end id."""
        words = split_words(texts, lower=False)
        lens, flat = self._distinct(words.vocabulary)
        starts = np.cumsum(lens) - lens
        each = lens[words.codes]
        total = np.concatenate([[0], np.cumsum(each)])[words.offsets]
        n = np.diff(total) + 1
        out = np.full(int(n.sum()), end_id, np.uint32)
        ends = np.cumsum(n)
        out[ragged(ends - n, n - 1)] = flat[ragged(starts[words.codes], each)]
        return n, out


SEGMENT_SCHEMA = ("part int, segment int, n_docs long, n_ids long, null_ids long, width int, "
                  "ids binary, boundaries binary, doc_ids binary")
_SEGMENT_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                            ("null_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()),
                            ("boundaries", pa.binary()), ("doc_ids", pa.binary())])


def _segment(part, number, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    row = (part, number, len(counts), len(ids), doc_ids.null_count, width, ids.astype(f"<u{width}").tobytes(),
           EliasFano.encode(np.concatenate([[0], np.cumsum(counts)])).to_bytes(),
           EliasFano.encode(doc_ids.drop_null().to_numpy()).to_bytes())
    return pa.record_batch([pa.array([v], type=f.type) for v, f in zip(row, _SEGMENT_ARROW)], schema=_SEGMENT_ARROW)


def write_token_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1,
                      segment_ids: int = 1 << 20, doc_id: str = "doc_id", text: str = "text") -> str:
    """Encode ``docs`` and write the store to ``path`` (a folder every executor sees)."""
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))

    def run(batches):
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        encoder = kept_by_worker(("word-encoder", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        held: list[tuple] = []
        size = 0
        for b in chunks(batches, "text", 4 * CHUNK_BYTES // 3):
            counts, ids = encoder.encode(b.column("text"), end_id)
            held.append((b.column("doc_id"), counts, ids))
            size += len(ids)
            if size >= segment_ids:
                yield _segment(part, number, pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in (1, 2)))
                held, size, number = [], 0, number + 1
        if held:
            yield _segment(part, number, pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in (1, 2)))

    ordered.mapInArrow(run, SEGMENT_SCHEMA).write.option("compression", "zstd").parquet(path)
    return path


def segment_offsets(segments: DataFrame) -> DataFrame:
    """(part, segment, offset): ids before each segment, by running sums over
    the parts and then inside each part; reads three narrow columns."""
    sizes = segments.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_offset"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
            .select("part", "segment", (F.col("part_offset") + F.col("inside")).alias("offset")))


def read_token_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` of its ids as
    little-endian unsigned 32-bit integers, and with ``with_ids`` its ``ids``."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    schema = "part int, segment int, doc_id long, local long, n_tokens long, ids_crc32 long"
    fields = [("part", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()),
              ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        schema, fields = schema + ", ids array<int>", fields + [("ids", pa.list_(pa.int32()))]
    arrow = pa.schema(fields)

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                bounds = EliasFano.from_bytes(row["boundaries"]).decode()
                n = row["n_docs"]
                named = pa.array(EliasFano.from_bytes(row["doc_ids"]).decode(), pa.int64())
                doc_ids = pa.concat_arrays([pa.nulls(row["null_ids"], pa.int64()), named])
                crc = [zlib.crc32(ids[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]
                cols = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()), doc_ids,
                        pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.record_batch(cols, schema=arrow)

    columns = ["part", "segment", "n_docs", "null_ids", "width", "ids", "boundaries", "doc_ids"]
    rows = segments.select(*columns).mapInArrow(run, schema).join(segment_offsets(segments), ["part", "segment"])
    out = ["doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"]
    return rows.select(*out, *(["ids"] if with_ids else []))
