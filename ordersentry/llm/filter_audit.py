"""Filter interaction audit by decision diagrams (operator 12).

Five filters judge every document; what a filter removes depends on which
ran before it.  The audit reports every order of the filters, per part
(source), from one scan of the texts.

1. *Masks.*  One pass over the texts gives each document its failures of A to
   D and a SHA-256 of its text.  E (a smaller id has the same text) is an
   equality join on (text hash, smallest id), which no hot text skews.
2. *Cells.*  Spark counts documents, good and toxic ones per (part, failure
   mask): at most 32 rows a part, combined before the shuffle.
3. *Diagrams.*  A part's cells become a decision diagram: a node per level
   tests one filter, its branches are "passes" and "fails", a leaf holds the
   counts of a mask, every node the sum below it, equal nodes are one node and
   empty branches have none.
4. *Orders.*  Exchanging two adjacent levels rewrites only the nodes of the
   upper one.  One exchange leads from each order to the next, through all
   120.  In each, the walk down the all-pass path meets per step what the
   filter removes (the "fails" branch) and what stays (the "passes" branch).

The fails-first node of a filter has all its failures; the filter's last
place, after four passes, has its unique failures.

Defined cases: a null text is empty; a null source is the part ``''`` (as the
empty source); a null id is no copy and has no copies or labels; rows that
repeat an id are counted each, and are no copies of each other; labels that
repeat an id count once (good or toxic if any says so); a null label is
neither; an empty table gives no rows; only doc_id, text, source and the
labels' doc_id, quality and toxic are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, saved, split_words

FILTERS = "ABCDE"
PIECE_BYTES = 2 << 20              # text handled at once inside a task
# Fixed values of the filters.
MIN_WORDS = 200                    # A: fewer words
DISTINCT_SHARE = 50                # B: fewer distinct words, per hundred words
CAPITAL_SHARE = 2                  # C: more A-Z, per hundred code points
SYMBOLS = b"#$%&*|"                # D: any of them


# --------------------------------------------------------------------- masks
def text_failures(texts: pa.Array) -> np.ndarray:
    """Bits 0 to 3 (A to D) per text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if texts.offset:
        texts = texts.take(pa.array(np.arange(len(texts))))
    words = split_words(texts, lower=False)
    n = np.diff(words.offsets)
    size = max(1, len(words.vocabulary))
    met = np.unique(np.repeat(np.arange(len(n)), n) * size + words.codes)
    distinct = np.bincount(met // size, minlength=len(n))
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1)
    # Pieces of a batch share its buffer: look at their own part alone.
    chars = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]

    def count(table):
        total = np.concatenate([[0], np.cumsum(table[chars], dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    capital, symbol = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    capital[65:91] = 1
    symbol[list(SYMBOLS)] = 1
    points = pc.utf8_length(texts).to_numpy()
    return ((n < MIN_WORDS) | (100 * distinct < DISTINCT_SHARE * n) << 1
            | (100 * count(capital) > CAPITAL_SHARE * points) << 2 | (count(symbol) > 0) << 3).astype(np.int64)


def document_masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, part, mask of A to D, digest of the text) of every row."""
    def run(batches):
        for b in chunks(batches, "text", PIECE_BYTES):
            # One text at a time becomes a Python object.
            digest = [hashlib.sha256(t.as_buffer() if t.is_valid else b"").digest() for t in b.column("text")]
            yield pa.record_batch([b.column("doc_id"), b.column("part"), pa.array(text_failures(b.column("text")), pa.int32()),
                                   pa.array(digest, pa.binary())], ["doc_id", "part", "mask", "digest"])

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
                         F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def cells(docs: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    """(part, mask, n, good, toxic), at most 32 rows a part."""
    rows = saved(document_masks(docs, **names), "audit-masks")
    known = rows.filter("doc_id IS NOT NULL")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
             .filter("good = 1 OR toxic = 1"))
    copy = F.when(F.col("first").isNull(), 16).otherwise(0)
    marked = (known.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
              .select("part", F.col("mask").bitwiseOR(copy).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"),
                      F.coalesce("toxic", F.lit(0)).alias("toxic")))
    zero = F.lit(0).cast("long")
    unknown = rows.filter("doc_id IS NULL").select("part", "mask", zero.alias("good"), zero.alias("toxic"))
    return (marked.unionByName(unknown).groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")))


# ------------------------------------------------------------------ diagrams
class Node(NamedTuple):
    filter: int                   # -1: leaf
    passes: Node | None           # None: no documents
    fails: Node | None
    counts: tuple[int, ...]       # documents, good, toxic below


class Diagram:
    """Count-weighted decision diagram of failure masks, in any filter order."""

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int = len(FILTERS)):
        self.nothing = (0,) * len(next(iter(counts.values())))
        self.nodes: dict[tuple, Node] = {}
        self.order = list(range(filters))
        level = {mask: self._node(-1, None, None, c) for mask, c in counts.items()}
        for f in reversed(self.order):         # masks agree in the filters above f
            above = {mask & ~(1 << f) for mask in level}
            level = {m: self._node(f, level.get(m), level.get(m | 1 << f)) for m in above}
        self.root = level[0]

    def _node(self, f: int, passes: Node | None, fails: Node | None, counts: tuple[int, ...] | None = None) -> Node | None:
        if counts is None:
            if passes is None and fails is None:
                return None
            counts = tuple(a + b for a, b in zip(self.weight(passes), self.weight(fails)))
        # Equal nodes are one: its branches are unique already, so identity tells them apart.
        return self.nodes.setdefault((f, id(passes), id(fails), counts), Node(f, passes, fails, counts))

    def weight(self, node: Node | None) -> tuple[int, ...]:
        return node.counts if node else self.nothing

    def exchange(self, level: int) -> None:
        """Swap the filters of ``level`` and the one below it."""
        upper, lower = self.order[level], self.order[level + 1]
        done: dict[int, Node | None] = {}

        def swapped(node):
            p, f = node.passes, node.fails
            pp, pf = (p.passes, p.fails) if p else (None, None)
            fp, ff = (f.passes, f.fails) if f else (None, None)
            return self._node(lower, self._node(upper, pp, fp), self._node(upper, pf, ff))

        def rebuilt(node, depth):
            if node is None:
                return None
            if id(node) not in done:
                done[id(node)] = (swapped(node) if depth == level else
                                  self._node(node.filter, rebuilt(node.passes, depth + 1), rebuilt(node.fails, depth + 1)))
            return done[id(node)]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = lower, upper

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, counts kept, counts removed) along the all-pass path."""
        node = self.root
        for f in self.order:
            yield f, self.weight(node.passes if node else None), self.weight(node.fails if node else None)
            node = node.passes if node else None


def exchanges(n: int) -> list[int]:
    """Levels whose exchanges lead through all orders of n things, one each
    (the largest thing moves through a shorter sequence, to and fro)."""
    if n < 2:
        return []
    inner, out = exchanges(n - 1), []
    for i in range(len(inner) + 1):
        down = i % 2 == 0
        out += range(n - 2, -1, -1) if down else range(n - 1)
        if i < len(inner):
            out.append(inner[i] + (1 if down else 0))
    return out


_EXCHANGES = exchanges(len(FILTERS))
_ORDERS = ["".join(p) for p in permutations(FILTERS)]
_COLUMNS = ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counts: dict[int, tuple[int, int, int]]) -> list[tuple]:
    """All steps of all orders for one part; ``counts``: mask -> (documents, good, toxic)."""
    diagram, found, last = Diagram(counts), {}, len(FILTERS) - 1
    for level in (None, *_EXCHANGES):
        if level is not None:
            diagram.exchange(level)
        found["".join(FILTERS[f] for f in diagram.order)] = list(diagram.steps())
    shapley, fails, unique = [0] * len(FILTERS), [0] * len(FILTERS), [0] * len(FILTERS)
    for steps in found.values():
        for place, (f, _, removed) in enumerate(steps):
            shapley[f] += removed[0]
            if place == 0:
                fails[f] = removed[0]
            if place == last:
                unique[f] = removed[0]
    return [(order, place + 1, kept[0], removed[0], fails[f] - removed[0], unique[f], removed[1], removed[2], shapley[f])
            for order in _ORDERS for place, (f, kept, removed) in enumerate(found[order])]


_AUDIT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
                   + [(c, pa.int64()) for c in _COLUMNS[2:]])


def filter_audit(docs: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    """One row per part, order and step."""
    def run(batches):
        for b in batches:
            for part, found in zip(b.column("part").to_pylist(), b.column("cells").to_pylist()):
                rows = audit({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in found})
                columns = list(zip(*rows))
                yield pa.record_batch([pa.array([part] * len(rows)), *(pa.array(c, f.type) for c, f in zip(columns, list(_AUDIT)[1:]))], schema=_AUDIT)

    parts = cells(docs, labels, **names).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COLUMNS[2:])
    return parts.mapInArrow(run, schema)
