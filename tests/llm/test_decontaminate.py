import random

import pyarrow as pa

from ordersentry.llm import decontaminate
from ordersentry.llm.decontaminate import Index

from .text import edited, prose, shingles, words

BENCH = "item_id long, text string, score string"


def plain_similarity(index, item_words, window):
    """The weighted similarity, from scratch."""
    from collections import Counter
    every = Counter(g for w in index for g in grams(w))
    a, b = Counter(grams(item_words)), Counter(grams(window))
    weight = {g: 1 + 1 / every[g] if g in every else 2.0 for g in set(a) | set(b)}
    return sum(weight[g] * min(a[g], b[g]) for g in weight) / sum(weight[g] * max(a[g], b[g]) for g in weight)


def grams(w):
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)]


def fixture():
    rng = random.Random(12)
    items = [(i, prose(rng, n)) for i, n in enumerate([20, 33, 60, 14, 120, 3, 5, 200])]
    docs = []
    for i in range(120):
        w = prose(rng, rng.randrange(0, 150))
        if i % 3 == 0:
            _, item = items[rng.randrange(len(items))]
            part = edited(rng, item, rng.randrange(0, max(1, len(item) // 20)))
            if rng.random() < 0.3:
                part = part[:rng.randrange(1, len(part) + 1)]
            at = rng.randrange(len(w) + 1)
            w = w[:at] + part + w[at:]
        docs.append((i, " ".join(w)))
    return items, docs


def test_against_every_window(spark, docs):
    items, rows = fixture()
    table = spark.createDataFrame([(i, " ".join(w).upper(), "x") for i, w in items] + [(50, None, "x"), (51, " ", "x")], BENCH)
    extra = [(900, None), (901, ""), (None, rows[0][1]), (rows[3][0], rows[3][1])]
    got = {}
    for r in decontaminate.matches(docs(rows + extra), table).collect():
        got[r["doc_id"], r["item_id"]] = r["similarity"]
    bench = [w for _, w in items]
    expected = {}
    for i, t in rows:
        w = words(t)
        for k, item in items:
            n = len(item)
            best = max((plain_similarity(bench, item, w[s:s + n]) for s in range(len(w)) if len(w[s:s + n]) >= min(5, n)), default=0)
            if best >= 0.8:
                expected[i, k] = best
    assert {k for k in got if k[0] is not None} == set(expected)
    assert all(0.8 <= got[k] <= expected[k] + 1e-9 for k in expected)          # the best of the windows that a hit starts


def test_edge_edits_of_short_items(spark, docs):
    rng = random.Random(14)
    common = prose(rng, 12, 40)
    items = [(i, prose(rng, rng.randrange(10, 31), 40) if i % 2 else rng.sample(common, 9) + prose(rng, rng.randrange(4, 16), 40)) for i in range(150)]
    rows = []
    for i, item in items:
        for edits in (0, 1, 2):
            w = list(item)
            for e in range(edits):
                w[-1 if e == 0 else rng.choice([0, -2])] = f"u{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(prose(rng, rng.randrange(9)) + w + prose(rng, rng.randrange(9)))))
    table = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items], BENCH)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.matches(docs(rows), table).collect()}
    bench = Index([(i, " ".join(w)) for i, w in items])
    expected = {}
    for d, t in rows:                                           # three documents for every item
        item, split = bench.items[d // 3], decontaminate.split_words(pa.array([t], pa.large_string()))
        h = split.hashes()[split.codes]
        s = max(bench.similarity(item, decontaminate._grams(h[x:x + item.length])) for x in range(len(h) - 4))
        if s >= 0.8:
            expected[d, d // 3] = s
    assert len(expected) > 200
    assert {k for k in expected if k not in got} == set()
    assert all(got[k] >= expected[k] - 1e-9 for k in expected)


def test_radius_lookup_is_complete():
    rng = random.Random(13)
    index = Index([(i, " ".join(prose(rng, 30))) for i in range(300)])
    for _ in range(300):
        f = int(index.fingers[rng.randrange(300)])
        for _ in range(rng.randrange(16)):
            f ^= 1 << rng.randrange(64)
        near = {i for i, g in enumerate(index.fingers.tolist()) if bin(f ^ g).count("1") <= decontaminate.RADIUS}
        assert set(index.within_radius(f).tolist()) == near


def test_clean_keeps_the_rest_and_all_columns(spark, docs, monkeypatch):
    items, rows = fixture()
    d = docs(rows + [(900, None)])
    table = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items], BENCH)
    hit = {r["doc_id"] for r in decontaminate.matches(d, table).collect()}
    for limit in (decontaminate.MAX_BENCHMARK_BYTES, 500):     # one part, several parts
        monkeypatch.setattr(decontaminate, "MAX_BENCHMARK_BYTES", limit)
        out = decontaminate.clean(d, table)
        assert out.columns == d.columns
        assert sorted(r["doc_id"] for r in out.collect()) == sorted({i for i, _ in rows} - hit | {900})


def test_empty_tables(spark, docs):
    empty = spark.createDataFrame([], BENCH)
    assert decontaminate.matches(docs([(1, "a b c d e f")]), empty).collect() == []
    assert decontaminate.clean(docs([(1, "a")]), empty).count() == 1
    assert decontaminate.matches(docs([]), spark.createDataFrame([(1, "a b c d e f", "x")], BENCH)).collect() == []
