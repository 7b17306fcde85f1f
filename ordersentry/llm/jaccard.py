"""N-gram Jaccard join by prefix trees (operator 4).

A document's set holds its distinct 5-word shingles as 64-bit hashes; equal
sets form one class at once, whatever their number.  Classes are linked when
``|A & B| >= 0.8 |A | B|``; no pair of copies is ever listed.

1. *Signatures.*  A class publishes its ``K`` smallest hashes, K chosen so
   that two linked classes publish at least ``ell`` common ones
   (``K = n - ceil(0.8 n) + ell(n)``).  They travel as packed arrays to
   buckets of hashes, where those that no other class of a fitting size
   published are dropped.
2. *Prefixes.*  A class with fewer than ``ell`` kept hashes is linked with
   nothing.  The others keep a prefix in the order "rarest first", short
   enough that linked classes share a hash of it.
3. *Groups.*  Classes that share a prefix hash are connected (an edge to the
   smallest class of each hash); the connected components contain all links.
4. *Tries.*  The sets of a group, in the group's frequency order, are stored
   in a path-compressed trie.  Each set walks it level by level; all sets
   below a node share one partial overlap, and a subtree is pruned when its
   overlap plus the hashes still to come can't reach the bound, or when all
   its sets are connected with the walker already.
5. A group beyond ``GROUP_SETS`` sets or ``GROUP_HASHES`` hashes is cut into
   blocks.  First every block is joined together with the group's first set,
   then only the sets not connected with that one meet all blocks.

Links and prefixes are exact up to collisions of 64-bit hashes.

Defined cases: a null or empty text, or one of white space, has the empty set
and is linked with nothing; 1 to 4 words make one shingle; repeated rows are
copies; a row with a null id is linked with rows of an equal set only;
an empty table gives no rows; only the id and the text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_rows, chunks, pack, ragged, repeat_rows, saved, shingles, split_by, split_words, unpack
from .components import components

SHINGLE = 5
BUCKET_HASHES = 1 << 19       # published hashes of one bucket
GROUP_SETS, GROUP_HASHES = 4096, 1 << 21
BLOBS = "bucket long, payload binary"
_BLOBS = pa.schema([("bucket", pa.int64()), ("payload", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# ------------------------------------------------------------ sets, bounds
def sorted_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): every text's distinct shingle hashes, ascending."""
    words = split_words(texts)
    offsets, hashes = shingles(words.offsets, words.hashes()[words.codes], SHINGLE)
    found = [np.unique(hashes[lo:hi]) for lo, hi in zip(offsets[:-1], offsets[1:])]
    lens = np.fromiter(map(len, found), np.int64, len(found))
    return np.concatenate([[0], np.cumsum(lens)]), np.concatenate(found) if found else hashes


def set_key(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def least_overlap(n):
    """ceil(0.8 n): what a set of n shares with any set it is linked to."""
    return (4 * n + 4) // 5


def ell(n):
    return np.maximum(1, 3 * n // 10)


def published(n):
    return np.minimum(n, n - least_overlap(n) + ell(n))


def needed(n):
    """Common published hashes that any link of a set of n has at least."""
    return ell(least_overlap(n))


def document_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tie, n, key) per row; tie is a hash of the text, key null for the empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n", pa.int64()), ("key", pa.int64())])

    def run(batches):
        for b in chunks(batches, "text"):
            offsets, hashes = sorted_sets(b.column("text"))
            keys = [set_key(hashes[lo:hi]) if hi > lo else None for lo, hi in zip(offsets[:-1], offsets[1:])]
            yield pa.record_batch([b.column("doc_id"), b.column("tie"), pa.array(np.diff(offsets)), pa.array(keys, pa.int64())], schema=schema)

    return (_narrow(docs, doc_id, text).withColumn("tie", F.xxhash64("text"))
            .mapInArrow(run, "doc_id long, tie long, n long, key long"))


def _narrow(docs, doc_id="doc_id", text="text"):
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


# ------------------------------------------------------------- candidates
def _publish(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for b in chunks(batches, "text"):
            offsets, hashes = sorted_sets(b.column("text"))
            n = np.diff(offsets)
            own = {set_key(hashes[offsets[i]:offsets[i + 1]]): i for i in np.flatnonzero(n)}     # one of equal sets
            keys, at = np.array(list(own), np.int64), np.array(list(own.values()), np.int64)
            count = published(n[at])
            sent = hashes[ragged(offsets[at], count)]
            owner = np.repeat(np.arange(len(at)), count)
            rows = []
            for bucket, rows_at in split_by((sent % np.uint64(buckets)).astype(np.int64)):
                who, times = np.unique(owner[rows_at], return_counts=True)
                rows.append((bucket, pack(keys[who], n[at][who].astype(np.int32), times.astype(np.int32), sent[rows_at])))
            yield binary_rows(rows, _BLOBS)

    return docs.mapInArrow(run, BLOBS)


def _gather(payloads) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, key, n) rows without repeats, ordered by hash, then n; hashes that
    stand in one row only are left out."""
    parts = []
    for p in payloads:
        keys, n, times, hashes = unpack(p.as_py())
        parts.append((hashes, np.repeat(keys, times), np.repeat(n, times)))
    h, key, n = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(h, kind="stable")
    twice = np.zeros(len(h), bool)             # most hashes stand here once; drop them before the full sort
    again = h[order][1:] == h[order][:-1]
    twice[1:] |= again
    twice[:-1] |= again
    order = order[twice]
    h, key, n = h[order], key[order], n[order]
    order = np.lexsort((key, n, h))
    h, key, n = h[order], key[order], n[order].astype(np.int64)
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
    return h[new], key[new], n[new]


def _shared(buckets: int):
    """Published hashes that another class of a fitting size has too, with
    their frequency, sent to the classes."""
    def run(group: pa.Table) -> pa.Table:
        h, key, n = _gather(group.column("payload"))
        near = (h[1:] == h[:-1]) & (5 * n[:-1] >= 4 * n[1:])      # neighbours in size fit if any two do
        keep = np.zeros(len(h), bool)
        keep[1:] |= near
        keep[:-1] |= near
        h, key, n = h[keep], key[keep], n[keep]
        if not len(h):
            return pa.Table.from_batches([binary_rows([], _BLOBS)])
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        times = np.diff(np.append(start, len(h)))
        df = np.repeat(times, times).astype(np.int32)
        rows = [(b, pack(h[at], key[at], n[at].astype(np.int32), df[at])) for b, at in split_by(key % buckets)]
        return pa.Table.from_batches([binary_rows(rows, _BLOBS)])
    return run


def _prefixes(buckets: int):
    """Per class: enough kept hashes?  If so, its prefix, rarest first."""
    def run(group: pa.Table) -> pa.Table:
        h, key, n, df = (np.concatenate(c) for c in zip(*(unpack(p.as_py()) for p in group.column("payload"))))
        order = np.lexsort((h, df, key))
        h, key, n = h[order], key[order], n[order].astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        take = np.maximum(0, size - needed(n[start]) + 1)
        at = ragged(start, take)
        h, key, n = h[at], key[at], n[at]
        rows = [(b, pack(h[i], key[i])) for b, i in split_by((h % np.uint64(buckets)).astype(np.int64))] if len(h) else []
        return pa.Table.from_batches([binary_rows(rows, _BLOBS)])
    return run


def _stars(group: pa.Table) -> pa.Table:
    """An edge from every class of a prefix hash to the smallest one."""
    h, key = (np.concatenate(c) for c in zip(*(unpack(p.as_py()) for p in group.column("payload"))))
    order = np.lexsort((key, h))
    h, key = h[order], key[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    low = np.repeat(key[start], np.diff(np.append(start, len(h))))
    pairs = np.unique(np.stack([key, low], 1)[key != low], axis=0)
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_PAIRS)


def candidate_edges(docs: DataFrame, hashes: int) -> DataFrame:
    """Edges (a, b) between classes whose components contain every link."""
    buckets = max(1, math.ceil(hashes / 2 / BUCKET_HASHES))
    shared = _publish(docs, buckets).groupBy("bucket").applyInArrow(_shared(buckets), BLOBS)
    prefixes = shared.groupBy("bucket").applyInArrow(_prefixes(buckets), BLOBS)
    return prefixes.groupBy("bucket").applyInArrow(_stars, "a long, b long")


# ------------------------------------------------------------------- trie
class Trie:
    """Path-compressed trie of integer sequences given in lexicographic order.

    Node i covers the leaves ``lo[i] .. hi[i]-1``; its edge holds ``count[i]``
    entries of ``tokens`` from ``start[i]``; its children are ``child[i] ..
    child[i] + children[i] - 1``; its first ``ends[i]`` leaves end in it.
    ``deepest[i]`` is the longest way on below it, ``smallest[i]`` the least
    set size and ``last[i]`` the last entry above or in it."""

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray):
        m = len(sequences)
        lens = np.array([len(s) for s in sequences], np.int64)
        common = np.zeros(m, np.int64)
        for i in range(1, m):
            k = min(lens[i - 1], lens[i])
            differ = np.flatnonzero(sequences[i - 1][:k] != sequences[i][:k])
            common[i] = differ[0] if len(differ) else k
        self.sizes, nodes, edges, level = sizes, [], [], [(0, m, 0)]
        place = 0
        while level:
            below = []
            first_child = len(nodes) + len(level)
            for lo, hi, depth in level:
                end = int(common[lo + 1:hi].min()) if hi - lo > 1 else int(lens[lo])
                ends = int((lens[lo:hi] == end).sum())
                cuts = [lo + ends, *(lo + ends + 1 + np.flatnonzero(common[lo + ends + 1:hi] == end)), hi]
                children = [(a, b, end) for a, b in zip(cuts, cuts[1:]) if b > a]
                edges.append(sequences[lo][depth:end])
                nodes.append((lo, hi, place, end - depth, first_child + len(below), len(children), ends,
                              int(lens[lo:hi].max()) - end, int(sizes[lo:hi].min()), int(sequences[lo][end - 1]) if end else -1))
                place += end - depth
                below += children
            level = below
        (self.lo, self.hi, self.start, self.count, self.child, self.children, self.ends, self.deepest, self.smallest,
         self.last) = np.array(nodes, np.int64).T
        self.tokens = np.concatenate(edges) if edges else np.zeros(0, np.int64)

    def search(self, walker: np.ndarray, size: int, mark: np.ndarray, open_before: np.ndarray) -> np.ndarray:
        """Leaves linked with the set ``walker`` of ``size`` shingles.  ``mark``
        flags its entries; ``open_before[i]`` counts the leaves before i that matter."""
        found = []
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(nodes):
            wanted = open_before[self.hi[nodes]] > open_before[self.lo[nodes]]
            nodes, overlap = nodes[wanted], overlap[wanted]
            count = self.count[nodes]
            hits = np.concatenate([[0], np.cumsum(mark[self.tokens[ragged(self.start[nodes], count)]])])
            ends = np.cumsum(count)
            overlap = overlap + hits[ends] - hits[ends - count]
            left = np.minimum(len(walker) - np.searchsorted(walker, self.last[nodes], "right"), self.deepest[nodes])
            alive = 9 * (overlap + left) >= 4 * (size + self.smallest[nodes])
            nodes, overlap = nodes[alive], overlap[alive]
            ending = self.ends[nodes]
            leaves = ragged(self.lo[nodes], ending)
            found.append(leaves[9 * np.repeat(overlap, ending) >= 4 * (size + self.sizes[leaves])])
            overlap = np.repeat(overlap, self.children[nodes])
            nodes = ragged(self.child[nodes], self.children[nodes])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def join_group(keys: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], labels: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links inside one group; sets whose ``labels``
    agree are connected already."""
    lens = np.array([len(s) for s in sets], np.int64)
    _, inverse, frequency = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(frequency), np.int64)
    rank[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
    rank = np.where(frequency > 1, rank, -1)[inverse]         # what one set alone has can't overlap
    ends = np.cumsum(lens)
    sequences = [np.sort(r[r >= 0]) for r in (rank[e - n:e] for e, n in zip(ends, lens))]
    order = sorted(range(len(sets)), key=lambda i: sequences[i].astype(">u4").tobytes())
    sequences, keys, sizes, labels = [sequences[i] for i in order], keys[order], sizes[order], labels[order].copy()
    trie = Trie(sequences, sizes)
    mark = np.zeros(len(frequency), np.int64)
    edges = []
    for i in range(len(sequences)):
        matters = labels != labels[i]
        matters[:i + 1] = False
        if not matters.any():
            continue
        mark[sequences[i]] = 1
        for j in trie.search(sequences[i], int(sizes[i]), mark, np.concatenate([[0], np.cumsum(matters)])):
            if labels[j] != labels[i] and j > i:
                edges.append((int(keys[i]), int(keys[j])))
                labels[labels == labels[j]] = labels[i]
        mark[sequences[i]] = 0
    return edges


def _join_cell(group: pa.Table) -> pa.Table:
    groups = group.column("grp").to_numpy()
    keys, sizes, labels = (group.column(c).to_numpy() for c in ("key", "n", "label"))
    blobs = group.column("hashes")
    edges = []
    for _, at in split_by(groups):
        _, first = np.unique(keys[at], return_index=True)
        at = at[first]
        if len(at) > 1:
            edges += join_group(keys[at], sizes[at], [np.frombuffer(blobs[int(i)].as_py(), np.uint64) for i in at], labels[at])
    cols = zip(*edges) if edges else ([], [])
    return pa.table([pa.array(c, pa.int64()) for c in cols], schema=_PAIRS)


def _with_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (doc_id, key and others) with the documents' sets."""
    joined = docs.join(members, "doc_id")
    others = [f for f in joined.schema.fields if f.name not in ("doc_id", "text")]

    def run(batches):
        for b in chunks(batches, "text"):
            offsets, hashes = sorted_sets(b.column("text"))
            sets = [hashes[lo:hi] for lo, hi in zip(offsets[:-1], offsets[1:])]
            # An id may stand on rows with other texts.
            own = [i for i, (s, k) in enumerate(zip(sets, b.column("key").to_pylist())) if len(s) and set_key(s) == k]
            out = b.take(pa.array(own, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(out.column(f.name) for f in others), pa.array([sets[i].tobytes() for i in own], pa.binary())],
                                             names=[*(f.name for f in others), "hashes"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["hashes binary"])
    return joined.select("text", *(f.name for f in others)).mapInArrow(run, schema)


def links(docs: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Spanning edges (a, b) of the links inside every group.  ``classes``:
    (key, doc_id, n), one document per class; ``groups``: (node, component)."""
    members = groups.select(F.col("node").alias("key"), F.col("component").alias("grp")).join(classes, "key")
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("m") / GROUP_SETS), F.ceil(F.col("total") / GROUP_HASHES))
    sizes = sizes.select("grp", blocks.alias("blocks"))
    members = saved(members.join(sizes, "grp").withColumn("label", F.col("key"))
                    .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks"))), "jaccard-members")
    small = members.filter("blocks = 1")
    bins = max(1, math.ceil((small.agg(F.sum("n")).first()[0] or 0) / GROUP_HASHES * 2))
    cells = small.select("doc_id", "key", "grp", "n", "label", F.pmod(F.xxhash64("grp"), F.lit(bins)).alias("cell"), F.lit(-1).cast("long").alias("block"))
    large = members.filter("blocks > 1")
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    cells = cells.unionByName(large.select("doc_id", "key", "grp", "n", "label", F.col("grp").alias("cell"),
                                           F.explode(F.when(F.col("key") == F.col("grp"), everywhere).otherwise(F.array("block"))).alias("block")))
    out = _with_sets(docs, cells).groupBy("cell", "block").applyInArrow(_join_cell, "a long, b long")
    if large.isEmpty():
        return out
    # Sets of a large group that its blocks didn't connect with its first set meet every block.
    out = saved(out, "jaccard-links")
    label = components(out).withColumnRenamed("component", "found")
    large = large.join(label, large["key"] == label["node"], "left").withColumn("label", F.coalesce("found", "key")).drop("node", "found")
    firsts = large.filter("key = grp").select("grp", F.col("label").alias("first_label"))
    large = saved(large.join(firsts, "grp").withColumn("rest", F.col("label") != F.col("first_label")), "jaccard-rest")
    rests = (large.filter("rest").groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
             .select("grp", F.greatest(F.ceil(F.col("m") / GROUP_SETS), F.ceil(F.col("total") / GROUP_HASHES)).alias("rest_blocks")))
    large = large.join(rests, "grp")
    columns = ["doc_id", "key", "grp", "n", "label", F.col("grp").alias("cell")]
    rest_block = F.pmod(F.xxhash64(F.lit(1), F.col("key")), F.col("rest_blocks"))
    pairs = (large.filter("rest").select(*columns, rest_block.alias("rest_block"), F.explode(everywhere).alias("block"))
             .unionByName(large.select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)).alias("rest_block"), "block")))
    more = _with_sets(docs, pairs).groupBy("cell", "block", "rest_block").applyInArrow(_join_cell, "a long, b long")
    return out.unionByName(more)


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id
    reachable over links, itself included), ``class_key`` (equal for equal sets)
    and ``tie`` (a hash of the text)."""
    narrow = _narrow(docs, doc_id, text)
    sets = saved(document_sets(docs, doc_id, text), "jaccard-sets")
    hashes = sets.agg(F.sum("n")).first()[0] or 0
    # Classes of null ids only have no links; one could be the first of a group that it is no member of.
    candidates = components(candidate_edges(narrow.filter("doc_id IS NOT NULL"), hashes))
    classes = sets.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"))
    linked = components(links(narrow, classes, saved(candidates, "jaccard-groups")))
    placed = (sets.join(linked, sets["key"] == linked["node"], "left")
              .select("doc_id", "tie", "n", "key", F.coalesce("component", "key").alias("component")))
    lowest = saved(placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id")), "jaccard-lowest")
    return (placed.join(lowest, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.col("key").alias("class_key"), "component", "tie"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of every component (smallest id,
    null last, then smallest text hash) and every row of an empty set."""
    placed = saved(jaccard_components(docs, doc_id, text), "jaccard-placed")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie"))
    lowest = placed.filter("component IS NOT NULL").groupBy("component").agg(first.alias("first")).select("first.doc_id", "first.tie")
    rows = placed.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("component").isNull()).alias("empty"))
    kept = (rows.alias("r").join(lowest.withColumn("first", F.lit(True)).alias("l"),
                                 F.expr("r.doc_id <=> l.doc_id AND r.tie = l.tie"), "left")
            .select("r.doc_id", "r.tie", "r.rows", F.when(F.col("r.empty"), F.col("r.rows")).when(F.col("l.first"), 1).otherwise(0).alias("copies")))
    return repeat_rows(docs, kept, doc_id, text)
