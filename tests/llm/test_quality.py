import random
import zlib

import numpy as np
import pyarrow as pa

from ordersentry.llm import quality

from .text import prose

LABELS = "doc_id long, quality int, toxic int, score string"


def corpus(n=700):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        good = i % 5 > 0
        w = prose(rng, rng.randrange(5, 250))
        if not good:
            bad = rng.randrange(3)
            w = [x.upper() + "!!" for x in w] if bad == 0 else [w[0]] * len(w) if bad == 1 else [x + "***" for x in w]
            if len(w) > 100 and rng.random() < 0.5:
                w[:40] = prose(rng, 40)          # only part of the passages is bad
        rows.append((i, " ".join(w)))
        labels.append((i, int(good), 0, "x"))
    return rows, labels


def test_learns_labels_and_scores_everything(spark, docs):
    rows, labels = corpus()
    extra = [(5000, None), (5001, ""), (5002, " \n"), (None, "some text"), (5003, "w " * 30_000), (3, rows[3][1])]
    d = docs(rows + extra)
    model = quality.train(d, spark.createDataFrame(labels + [(None, 1, 0, "x"), (4, None, 0, "x"), (5, 1, 0, "x")], LABELS))
    out = quality.score(d, model)
    assert out.columns == [c for c in d.columns if c != "score"] + ["score"]
    got = out.collect()
    assert len(got) == len(rows + extra) and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["score"] >= 0.7, r["doc_id"] % 5 > 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 700 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.95
    again = quality.train(d, spark.createDataFrame(labels + [(5, 1, 0, "x")], LABELS))
    assert all(np.array_equal(a, b) for a, b in zip(model.weights.values(), again.weights.values()))


def test_labels_of_the_held_out_fold_are_not_used(spark, docs):
    rows, labels = corpus(300)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t, s) for i, q, t, s in labels]
    a, b = (quality.train(docs(rows), spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert all(np.array_equal(p, q) for p, q in zip(a.weights.values(), b.weights.values()))


def test_without_labels_of_both_kinds(spark, docs):
    d = docs([(1, "a"), (2, None)])
    assert quality.train(d, spark.createDataFrame([], LABELS)).constant == 0.5
    assert quality.train(d, spark.createDataFrame([(1, 1, 0, "x"), (2, 1, 0, "x")], LABELS)).constant == 1.0
    assert [r["score"] for r in quality.score(d, quality.Model(0.5)).collect()] == [0.5, 0.5]
    assert quality.score(docs([]), quality.Model(0.5)).collect() == []


def test_gradient():
    rng = np.random.default_rng(0)
    offsets = np.array([0, 2, 3, 7])
    x, y = rng.normal(size=(7, 4)), np.array([0.0, 1, 1])
    model = quality.fit(offsets, x, y, np.ones(3))
    p = model.score(offsets, x)
    assert np.abs(p - y).max() < 0.2           # three bags are easily separated


def test_passages_cover_whole_texts():
    offsets, x = quality.passages(pa.array(["a " * 130, None, "B!! c", ""]))
    assert np.diff(offsets).tolist() == [3, 1, 1, 1]
    assert x.shape == (6, quality.N_FEATURES) and not x[3].any() and not x[5].any()
