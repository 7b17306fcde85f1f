import random

import numpy as np
import pyarrow as pa

from ordersentry.llm import common

from .text import words


def test_split_words_matches_the_pattern_also_on_slices():
    rng = random.Random(1)
    alphabet = list("abAB é  \x1c\x85\t\n\x0b\x0c\r  ") + ["İ", "日"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(500)] + [None, "", "   "]
    for array in (pa.array(texts), pa.array(["x"] * 7 + texts).slice(7)):
        for lower in (True, False):
            w = common.split_words(array, lower)
            vocabulary = w.vocabulary.to_pylist()
            got = [[vocabulary[c] for c in w.codes[lo:hi]] for lo, hi in zip(w.offsets, w.offsets[1:])]
            assert got == [words(t, lower) for t in texts]


def test_shingles_short_and_long():
    w = common.split_words(pa.array(["a b c d e f", "a b", "", None, "b a", "A  B"]))
    offsets, h = common.shingles(w.offsets, w.hashes()[w.codes])
    assert np.diff(offsets).tolist() == [2, 1, 0, 0, 1, 1]
    assert h[2] != h[3] and h[2] == h[4]                        # order matters, case and spacing don't


def test_pack_round_trip_and_ragged():
    arrays = [np.arange(5, dtype=np.uint16), np.zeros(0), np.array([2 ** 63], np.uint64)]
    for compress in (False, True):
        assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(arrays, common.unpack(common.pack(*arrays, compress=compress))))
    assert common.ragged(np.array([5, 0, 9]), np.array([2, 0, 1])).tolist() == [5, 6, 9]


def test_chunks_cover_all_rows():
    b = pa.record_batch([pa.array(["x" * 100] * 50 + [None, "y" * 5000])], ["text"])
    assert sum(c.num_rows for c in common.chunks([b], "text", 1000)) == 52


def test_repeat_rows(docs, spark):
    from pyspark.sql import functions as F
    d = docs([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (None, None)])
    said = d.groupBy("doc_id", F.xxhash64("text").alias("tie")).agg(F.count("*").alias("rows")).withColumn(
        "copies", F.expr("CASE doc_id WHEN 1 THEN 4 WHEN 2 THEN 0 ELSE 1 END"))
    out = common.repeat_rows(d, said)
    assert out.columns == d.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted([(1, "a")] * 4 + [(None, None)], key=str)


def test_window_hashes_are_polynomials_of_every_run():
    h = np.random.default_rng(5).integers(0, 2 ** 63, 60).astype(np.uint64)
    for k in (1, 2, 5, 8, 35, 60, 61):
        want = []
        for i in range(len(h) - k + 1):
            value = 0
            for x in h[i:i + k].tolist():
                value = (value * int(common.STEP) + x) % 2 ** 64
            want.append(value)
        assert np.array_equal(common.window_hashes(h, k), common.mix64(np.array(want, np.uint64)))


def test_repeat_rows_with_clashing_columns(spark):
    from pyspark.sql import functions as F
    names = ["doc_id", "text", "__doc_id", "__copy", "__copies", "___n", "__tie", "rows"]
    d = spark.createDataFrame([(i, t, "a", "b", "c", "d", "e", "f") for i, t in [(1, "a"), (1, "a"), (2, "b"), (None, None)]],
                              ", ".join(f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    said = d.groupBy("doc_id", F.xxhash64("text").alias("tie")).agg(F.count("*").alias("rows")).withColumn("copies", F.expr("CASE doc_id WHEN 1 THEN 3 ELSE 1 END"))
    out = common.repeat_rows(d, said)
    assert out.columns == names
    assert sorted(((r["doc_id"], r["__copy"]) for r in out.collect()), key=str) == sorted([(1, "b")] * 3 + [(2, "b"), (None, "b")], key=str)


def test_free_prefix():
    assert common.free_prefix(["a", "_b"]) == "__" and common.free_prefix(["__a", "___"]) == "____"
