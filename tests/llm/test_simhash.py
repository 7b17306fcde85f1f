import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ordersentry.llm import simhash

from .text import edited, prose, words


def fingerprint(text):
    w = words(text)
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(prints):
    """Component number per fingerprint, by all pairs."""
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    some = sorted(parent)
    for i, a in enumerate(some):
        for b in some[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {p: find(p) for p in some}


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    roots = brute(prints)
    low = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            low[roots[p]] = min(low.get(roots[p], i), i)
    return sorted(((i, f"{p:016x}", low.get(roots[p])) for (i, _), p in zip(rows, prints)), key=str)


def got(out):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out.collect()), key=str)


def corpus():
    rng = random.Random(13)
    rows, i = [], 0
    for _ in range(30):
        base = prose(rng, rng.choice([1, 2, 3, 4, 40, 300, 1500]))
        for _ in range(rng.randrange(1, 7)):
            rows.append((i * 7 % 1009, " ".join(edited(rng, base, rng.randrange(0, 3)))))
            i += 1
    rows += [(2000, None), (2001, ""), (2002, "\n "), (2003, "A b"), (2004, "a  B"), (2005, "b a"), (2006, "x " * 3000), (2007, "x " * 2000),
             (2008, "É été x  Y z É"), (None, "a b"), (None, "no id at all here"), (3, "another text of one id")]
    return rows + [rows[3], rows[3]]


def test_against_all_pairs(docs):
    rows = corpus()
    assert got(simhash.simhash_components(docs(rows))) == expected(rows)


def test_crowded_keys(docs, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 2)
    rng = random.Random(14)
    base = prose(rng, 900)
    rows = [(i, " ".join(edited(rng, base, rng.randrange(12)))) for i in range(300)]
    assert got(simhash.simhash_components(docs(rows))) == expected(rows)


def family(rng, n):
    """Fingerprints around a few centres, so that keys are crowded, and unrelated ones."""
    out = set()
    for centre in [0, 2 ** 64 - 1, *(rng.getrandbits(64) for _ in range(3))]:
        for _ in range(n):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))))
    return sorted(out | {rng.getrandbits(64) for _ in range(n)})


def test_links_connect_every_close_pair(spark):
    rng = random.Random(15)
    for blocks in (3, 4, 5, 7):
        prints = family(rng, 60)
        signed = [p - 2 ** 64 if p >> 63 else p for p in prints]
        classes = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(5)
        found = {(r["a"] % 2 ** 64, r["b"] % 2 ** 64) for r in simhash.links(classes, blocks).collect()}
        assert all((a ^ b).bit_count() <= 2 and a != b for a, b in found)
        parent = {p: p for p in prints}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in found:
            parent[find(a)] = find(b)
        roots = brute(prints)
        groups = lambda of: sorted(sorted(p for p in prints if of(p) == r) for r in {of(p) for p in prints})
        assert groups(find) == groups(roots.__getitem__)


def test_without_shared_blocks_nothing_links(docs, monkeypatch):
    """The blocks carry the result: keys that never agree lose every link."""
    rows = corpus()
    monkeypatch.setattr(simhash, "links", lambda classes, blocks: classes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0))
    assert got(simhash.simhash_components(docs(rows))) != expected(rows)


def test_masks_cover_every_pair_of_changed_bits():
    for blocks in range(3, 9):
        masks = simhash.key_masks(blocks)
        assert all(any(not m >> a & 1 and not m >> b & 1 for m in masks) for a in range(64) for b in range(64))
    assert [simhash.n_blocks(n) for n in (0, 10 ** 6, 10 ** 8, 10 ** 11)] == [3, 3, 4, 5]


def test_majority_counts_long_texts():
    rng = np.random.default_rng(16)
    n = [0, 1, 2, 255, 256, 700, 0, 10000]
    h = rng.integers(0, 2 ** 64, sum(n), dtype=np.uint64)
    off = np.concatenate([[0], np.cumsum(n)])
    want = [sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h[lo:hi]) > hi - lo) for lo, hi in zip(off, off[1:])]
    assert simhash.majority(off, h).tolist() == want


def test_normalized_on_slices():
    texts = pa.array(["zz", " A  b\tC ", None, "", "é X"]).slice(1)
    offsets, data = simhash.normalized(texts)
    assert [data[a:b].decode() for a, b in zip(offsets, offsets[1:])] == ["a b c", "", "", "é x"]


def test_empty_table(docs):
    assert simhash.simhash_components(docs([])).count() == 0
