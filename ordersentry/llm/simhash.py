"""SimHash near-duplicates by pigeonhole blocks (operator 13).

A document's fingerprint has bit b set when more than half of its 3-word
shingles (repeats count) have bit b set in their XXH64 (seed 42).  Two
documents link when their fingerprints differ in at most ``RADIUS`` = 2 bits.

1. *Classes.*  Equal fingerprints are one class, whatever the number of its
   documents (combined before the shuffle), so copies are never paired.
2. *Blocks.*  The 64 bits are cut into ``n_blocks`` blocks.  Two changed bits
   spoil at most two of them, so a close pair agrees on ``n_blocks - 2``
   blocks; every choice of that many blocks makes one key.  The number of
   blocks follows the number of classes, so that a key of unrelated
   fingerprints has about one member at any size.
3. *Join.*  Classes that share a key are compared, and linked where the
   Hamming distance of the whole fingerprints is at most 2.
4. *Crowded keys.*  Where more than ``CROWD`` classes share a key (families of
   near copies), comparing all pairs would be quadratic.  There the members
   are joined by the fingerprints at distance 0 or 1 from them in the bits
   outside the key: two that differ in at most two bits have one in common,
   and any two that have one in common differ in at most two.  Each of these
   meeting points has at most 65 members, so the work grows with the members.
5. *Components* of the links (shared helper), then the smallest id of each.

Defined cases: a null or empty text, or one of white space, has fingerprint
zero and is linked like any other; one or two words make one shingle;
repeated rows are copies; a row with a null id has the component of its
fingerprint, null when no row of the component has an id; several texts under
one id are separate rows and don't link each other; an empty table gives no
rows; only the id and the text are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, saved
from .components import components

SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 2
CROWD = 16                    # classes of one key that are compared with each other
MEMBERS_PER_KEY = 1 << 2      # unrelated classes a key may have before it gets longer


# ------------------------------------------------------------- fingerprints
def normalized(texts: pa.Array) -> tuple[np.ndarray, bytes]:
    """(offsets, bytes) of the texts in lower case (A-Z), words joined by one space."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.offset:                           # ascii_lower misreads an array that starts inside its buffers
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    joined = pc.binary_join(pc.ascii_split_whitespace(texts), pa.scalar(" ", pa.large_string()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    _, offsets, data = joined.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(joined) + 1, 8 * joined.offset)
    whole = memoryview(data)[int(offsets[0]):int(offsets[-1])].tobytes() if data is not None else b""
    return offsets - offsets[0], whole


def shingle_hashes(offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of every text's shingles, repeats included."""
    lo, hi = offsets[:-1], offsets[1:]
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    some = lo < hi
    starts = np.sort(np.concatenate([lo[some], spaces + 1]))
    ends = np.sort(np.concatenate([hi[some], spaces]))
    first = np.searchsorted(starts, lo)        # first word of every text
    n = np.searchsorted(starts, hi) - first
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(count)])
    word = np.arange(out[-1]) + np.repeat(first - out[:-1], count)
    last = word + np.repeat(np.minimum(n, SHINGLE) - 1, count)
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(data[a:b], SEED) for a, b in zip(starts[word].tolist(), ends[last].tolist())), np.uint64, len(word))
    return out, hashes


_LANES = np.uint64(0x0101010101010101)


def majority(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per text: the bits set in over half of its hashes.

    Eight counters share one word: bit s of every byte is added up over runs of
    at most 255 hashes, then the runs' counters over the text."""
    n = np.diff(offsets)
    runs = -(-n // 255)
    run_off = np.concatenate([[0], np.cumsum(runs)])
    start = np.repeat(offsets[:-1], runs) + 255 * (np.arange(run_off[-1]) - np.repeat(run_off[:-1], runs))
    some = np.flatnonzero(n)
    out = np.zeros(len(n), np.uint64)
    if not len(some):
        return out
    for s in range(8):
        lanes = (hashes >> np.uint64(s)) & _LANES
        counters = np.add.reduceat(lanes, start).view(np.uint8).reshape(-1, 8)
        per_text = np.add.reduceat(counters, run_off[some], axis=0, dtype=np.int64)
        over = 2 * per_text > n[some][:, None]
        for byte in range(8):                  # little-endian: byte k holds bits 8k ..
            out[some] |= over[:, byte].astype(np.uint64) << np.uint64(8 * byte + s)
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp as a signed long."""
    def run(batches):
        for b in chunks(batches, "text"):
            fp = majority(*shingle_hashes(*normalized(b.column("text"))))
            yield pa.record_batch([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------- blocks
def n_blocks(classes: int) -> int:
    """The fewest blocks whose keys keep unrelated classes apart."""
    n = RADIUS + 1
    while n < 12 and classes > MEMBERS_PER_KEY << (BITS * (n - RADIUS) // n):
        n += 1
    return n


def key_masks(blocks: int) -> list[int]:
    """The bits of every key: each choice of ``blocks - RADIUS`` blocks."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(bits[i] for i in chosen) for chosen in combinations(range(blocks), blocks - RADIUS)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _meeting_points(masks: list[int]) -> Column:
    """The fingerprint itself and those one bit away outside the key."""
    flips = [F.array(*(F.lit(_signed(1 << b)) for b in range(BITS) if not mask >> b & 1)) for mask in masks]
    flip = F.coalesce(*(F.when(F.col("k") == k, f) for k, f in enumerate(flips)))
    return F.concat(F.array("fp"), F.transform(flip, lambda f: F.col("fp").bitwiseXOR(f)))


def links(classes: DataFrame, blocks: int) -> DataFrame:
    """(a, b): links that connect every two fingerprints ``fp`` of
    ``classes`` (each there once) within the radius."""
    masks = key_masks(blocks)
    key = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks))))
    keyed = classes.select("fp", key.alias("at")).select("fp", "at.k", "at.key")
    sizes = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = saved(keyed.join(sizes, ["k", "key"]), "simhash-shared")
    few = shared.filter(F.col("members") <= CROWD).groupBy("k", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    near = F.expr(f"""explode(flatten(transform(fps, (a, i) -> transform(
                          filter(fps, (b, j) -> j > i AND bit_count(a ^ b) <= {RADIUS}), b -> named_struct('a', a, 'b', b)))))""")
    pairs = few.select(near.alias("link")).select("link.a", "link.b")
    met = (shared.filter(F.col("members") > CROWD).select("fp", "k", "key", F.explode(_meeting_points(masks)).alias("point"))
           .groupBy("k", "key", "point").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1))
    stars = (met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
             .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)))
    return pairs.unionByName(stars)


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id, and
    ``copies``, the rows with the same fingerprint."""
    prints = saved(fingerprints(docs, doc_id, text), "simhash-prints")
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies")), "simhash-classes")
    linked = components(links(classes, n_blocks(classes.count())))
    placed = classes.join(linked, classes["fp"] == linked["node"], "left").select(
        "fp", "low", "copies", F.coalesce("component", "fp").alias("component"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    named = saved(placed.join(lowest, "component").select("fp", "copies", "component_id"), "simhash-components")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "copies")
