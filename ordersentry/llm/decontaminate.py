"""Benchmark decontamination by SimHash over item-sized windows (operator 8).

For a benchmark item of L words every window of L words of a document is a
possible copy.  The method:

1. *Windows.*  A window similar to an item shares a 5-word shingle with it.
   The item's shingles are looked up at every position of every document, and
   each hit at document word d and item word i gives the window that starts
   at d - i.  (Words shift by insertions and deletions, so hits of one copy
   give several starts; all are tried.)
2. *Fingerprints.*  Window and item get 64-bit SimHashes of their words,
   weighted by rarity in the benchmark.
3. *Multi-index.*  The 64 bits are cut into ``RADIUS + 1`` blocks; two
   fingerprints within ``RADIUS`` bits agree in one block at least, so a
   table per block finds every item fingerprint within the radius.
4. *Verification.*  Candidates are kept when the weighted shingle similarity
   (sum of minimum over sum of maximum of the shingles' weighted counts) of
   window and item is ``SIMILARITY`` or more.
5. *Completion.*  The radius is no proof, above all for short items.  What a
   window shares with an item weighs at least ``SIMILARITY`` of the item, so
   every document and item that share so much are compared at every start,
   best upper bound first, until no bound is above the best similarity found.
   So every item with a similar window of its own length is reported.

The benchmark is the small, given side: its items go to the tasks as one
table, whose size is checked (``MAX_BENCHMARK_BYTES``); a larger benchmark is
worked off in parts, each a scan of its own.  Documents are read once per
part, whole, without a shuffle.

Defined cases: words are lower-cased (A-Z), punctuation belongs to words; a
null or empty text has no window; a null, empty or wordless item matches
nothing; an item of 1 to 4 words is one shingle, its whole sequence; several
rows of an item id are items of their own; a document shorter than an item
is compared as far as it goes; repeated documents are all reported; empty
tables give no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, mix64, ragged, split_words, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 12
BLOCKS = RADIUS + 1
MAX_BENCHMARK_BYTES = 16 << 20


class Item(NamedTuple):
    item_id: int
    length: int               # words
    shingles: np.ndarray      # distinct hashes, ascending
    weights: np.ndarray       # weight times count of each
    fingerprint: int


def _grams(word_hashes: np.ndarray) -> np.ndarray:
    k = min(SHINGLE, len(word_hashes))
    return window_hashes(word_hashes, k) if k else np.zeros(0, np.uint64)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """+1 / -1 per bit of each (mixed) word hash."""
    raw = np.unpackbits(mix64(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return raw.astype(np.float32) * 2 - 1


def _block_edges() -> np.ndarray:
    return np.round(np.linspace(0, 64, BLOCKS + 1)).astype(int)


class Index:
    """The items of one part of the benchmark, ready for lookups."""

    def __init__(self, rows: list[tuple[int, str]]):
        words = split_words(pa.array([t or "" for _, t in rows], pa.large_string()))
        hashes = words.hashes()[words.codes]
        # Weight of a word: rarer in the benchmark, heavier, within 1 .. 2.
        self.known, times = np.unique(hashes, return_counts=True)
        self.word_weight = (1 + 1 / times).astype(np.float32)
        self.items: list[Item] = []
        at_gram, at_item, at_place = [], [], []
        spans = []
        for (item_id, _), lo, hi in zip(rows, words.offsets[:-1], words.offsets[1:]):
            if hi == lo:
                continue
            own = hashes[lo:hi]
            grams = _grams(own)
            at_gram.append(grams)
            at_item.append(np.full(len(grams), len(self.items)))
            at_place.append(np.arange(len(grams)))
            spans.append(own)
            self.items.append(Item(item_id, len(own), grams, grams, 0))
        self.gram = np.concatenate(at_gram) if at_gram else np.zeros(0, np.uint64)
        item, place = (np.concatenate(a) if a else np.zeros(0, np.int64) for a in (at_item, at_place))
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.gram_item, self.gram_place = self.gram[order], item[order], place[order]
        distinct, df = np.unique(self.gram, return_counts=True)
        self.distinct, self.gram_weight = distinct, 1 + 1 / df
        finger = [self.fingerprint(own) for own in spans]
        self.items = [Item(it.item_id, it.length, *self.weighted(it.shingles), f) for it, f in zip(self.items, finger)]
        self.lengths = np.array([it.length for it in self.items], np.int64)
        self.totals = np.array([it.weights.sum() for it in self.items])
        self.entry_weight = self.gram_weight[np.searchsorted(distinct, self.gram)]
        self.short = sorted({it.length for it in self.items if it.length < SHINGLE})
        self.fingers = np.array(finger, np.uint64)
        self.tables = [self._table(lo, hi) for lo, hi in zip(_block_edges()[:-1], _block_edges()[1:])]

    def _table(self, lo: int, hi: int):
        key = (self.fingers >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
        order = np.argsort(key, kind="stable")
        return lo, hi, key[order], order

    def fingerprint(self, word_hashes: np.ndarray) -> int:
        at = np.searchsorted(self.known, word_hashes).clip(max=len(self.known) - 1)
        weight = np.where(self.known[at] == word_hashes, self.word_weight[at], 2).astype(np.float32)
        total = weight @ _bits(word_hashes)
        return int(np.packbits(total > 0, bitorder="little").view(np.uint64)[0])

    def weighted(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles and weight times count; one unknown to the benchmark weighs most (2)."""
        found, count = np.unique(grams, return_counts=True)
        at = np.searchsorted(self.distinct, found).clip(max=len(self.distinct) - 1)
        return found, np.where(self.distinct[at] == found, self.gram_weight[at], 2.0) * count

    def within_radius(self, finger: int) -> np.ndarray:
        """Items whose fingerprint differs in at most ``RADIUS`` bits."""
        f, found = np.uint64(finger), []
        for lo, hi, keys, order in self.tables:
            key = (f >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            found.append(order[np.searchsorted(keys, key):np.searchsorted(keys, key, "right")])
        near = np.unique(np.concatenate(found))
        return near[np.bitwise_count(self.fingers[near] ^ f) <= RADIUS]

    def similarity(self, item: Item, grams: np.ndarray) -> float:
        found, weight = self.weighted(grams)
        common, a, b = np.intersect1d(item.shingles, found, assume_unique=True, return_indices=True)
        low = np.minimum(item.weights[a], weight[b]).sum()
        return float(low / (item.weights.sum() + weight.sum() - low))

    def hits(self, hashes: np.ndarray, offsets: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per shingle size: (size, document, word, place in ``gram``) of every item shingle in the documents."""
        found = []
        for k in sorted({SHINGLE, *self.short}):
            grams = window_hashes(hashes, k)
            # A hit is rare: one table lookup by low bits drops nearly all positions.
            at = np.flatnonzero(self._maybe()[(grams & np.uint64(0xFFFFF)).astype(np.int64)])
            lo, hi = np.searchsorted(self.gram, grams[at]), np.searchsorted(self.gram, grams[at], "right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            doc = np.searchsorted(offsets, at, "right") - 1
            inside = at + k <= offsets[doc + 1]
            at, lo, n, doc = at[inside], lo[inside], n[inside], doc[inside]
            entry = ragged(lo, n)
            fits = np.minimum(self.lengths[self.gram_item[entry]], SHINGLE) == k
            found.append((k, np.repeat(doc, n)[fits], np.repeat(at, n)[fits], entry[fits]))
        return found

    def windows(self, hits, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(document, start, length) of the item-sized windows worth a fingerprint."""
        found = []
        for _, doc, at, entry in hits:
            start = np.maximum(offsets[doc], at - self.gram_place[entry])
            found.append(np.stack([doc, start, self.lengths[self.gram_item[entry]]], 1))
        every = np.unique(np.concatenate(found), axis=0)
        return [tuple(map(int, w)) for w in every]

    def reaching(self, hits):
        """(shingle size, document, item, hit words ascending) where the shingles shared weigh enough for a similar window."""
        for k, doc, at, entry in hits:
            pair, entries = np.unique(doc * len(self.items) + self.gram_item[entry], return_inverse=True)
            # Every place of a shingle in the item counts once: weight times count.
            once = np.unique(entries * len(self.gram) + entry)
            shared = np.bincount(once // max(1, len(self.gram)), self.entry_weight[once % max(1, len(self.gram))], len(pair))
            enough = shared >= SIMILARITY * self.totals[pair % len(self.items)] - 1e-6
            at, entries = at[enough[entries]], entries[enough[entries]]
            order = np.lexsort((at, entries))
            at, entries = at[order], entries[order]
            new = np.flatnonzero(np.concatenate([[True], entries[1:] != entries[:-1], [True]])) if len(at) else np.zeros(1, np.int64)
            for lo, hi in zip(new, new[1:]):
                yield k, *(int(v) for v in divmod(pair[entries[lo]], len(self.items))), np.unique(at[lo:hi])

    def best_window(self, k: int, item: Item, hashes: np.ndarray, end: int, low: int, at: np.ndarray) -> tuple[int, int, float]:
        """(start, words, similarity) of the most similar window of the item's length in the
        document ``hashes[low:end]``; ``at`` are the words where a shingle of the item starts."""
        total, length = item.weights.sum(), item.length
        starts = np.arange(max(low, at[0] - (length - k)), at[-1] + 1)
        stops = np.minimum(starts + length, end)
        first, last = int(starts[0]), int(stops[-1])
        grams = window_hashes(hashes[first:last], k)[:last - first - k + 1]
        place = np.searchsorted(self.distinct, grams).clip(max=len(self.distinct) - 1)
        weight = np.where(self.distinct[place] == grams, self.gram_weight[place], 2.0)
        ours = np.zeros(len(grams))
        ours[at - first] = weight[at - first]
        weight, ours = (np.concatenate([[0.0], np.cumsum(w)]) for w in (weight, ours))
        lo, hi = starts - first, stops - first - k + 1
        common = np.minimum(ours[hi] - ours[lo], total)
        bound = common / (total + weight[hi] - weight[lo] - common)
        best = (0, 0, -1.0)
        for i in np.argsort(-bound, kind="stable"):
            if bound[i] < max(SIMILARITY, best[2]) - 1e-6:
                break
            s = self.similarity(item, _grams(hashes[starts[i]:stops[i]]))
            if s > best[2] or s == best[2] and starts[i] < best[0]:
                best = int(starts[i]), int(stops[i] - starts[i]), s
        return best

    def _maybe(self) -> np.ndarray:
        if not hasattr(self, "_flags"):
            self._flags = np.zeros(1 << 20, bool)
            self._flags[(self.gram & np.uint64(0xFFFFF)).astype(np.int64)] = True
        return self._flags

    def search(self, texts: pa.Array) -> list[tuple[int, int, int, int, float]]:
        """(document, item, start word, words, similarity): per document and item the best window."""
        if not self.items:
            return []
        words = split_words(texts)
        hashes = words.hashes()[words.codes]
        best: dict[tuple[int, int], tuple] = {}
        hits = self.hits(hashes, words.offsets)
        for doc, start, length in self.windows(hits, words.offsets):
            own = hashes[start:min(start + length, words.offsets[doc + 1])]
            near = self.within_radius(self.fingerprint(own))
            grams = _grams(own) if len(near) else None
            for i in near:
                item = self.items[i]
                if min(item.length, SHINGLE) != min(len(own), SHINGLE):
                    continue
                s = self.similarity(item, grams)
                if s >= SIMILARITY and s > best.get((doc, i), (0, 0, -1.0))[2]:
                    best[doc, i] = (start - int(words.offsets[doc]), len(own), s)
        for k, doc, i, at in self.reaching(hits):
            low, end = int(words.offsets[doc]), int(words.offsets[doc + 1])
            start, n, s = self.best_window(k, self.items[i], hashes, end, low, at)
            if s >= SIMILARITY and s > best.get((doc, i), (0, 0, -1.0))[2]:
                best[doc, i] = (start - low, n, s)
        return [(doc, int(i), *b) for (doc, i), b in sorted(best.items())]


def _parts(benchmark: DataFrame, item_id: str, text: str) -> list[list[tuple[int, str]]]:
    """The benchmark's rows in parts of at most ``MAX_BENCHMARK_BYTES``."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    parts, size = [[]], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():       # one partition at a time
        if parts[-1] and size + len(r["text"]) > MAX_BENCHMARK_BYTES:
            parts.append([])
            size = 0
        parts[-1].append((r["item_id"], r["text"]))
        size += len(r["text"])
    return parts


MATCHES = "doc_id long, item_id long, start_word long, n_words long, similarity double"


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item it holds: best window and similarity."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())])
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for rows in _parts(benchmark, "item_id", "text"):
        def run(batches, rows=rows):
            index = Index(rows)
            for b in chunks(batches, "text"):
                found = index.search(b.column("text"))
                if found:
                    at, item, start, n, s = zip(*found)
                    yield pa.record_batch([b.column("doc_id").take(pa.array(at)), pa.array([index.items[i].item_id for i in item], pa.int64()),
                                           pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(s)], schema=schema)
        part = narrow.mapInArrow(run, MATCHES)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, all columns, without the documents that hold an item; one
    narrow pass per part of the benchmark."""
    for rows in _parts(benchmark, "item_id", "text"):
        def run(batches, rows=rows):
            index = Index(rows)
            for b in chunks(batches, text):
                keep = np.ones(b.num_rows, bool)
                keep[[m[0] for m in index.search(b.column(text))]] = False
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return docs
