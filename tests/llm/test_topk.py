import math
import random

from pyspark.sql import functions as F

from ordersentry.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, x string"


def brute(rows, k):
    v = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = {}
    for q, e in v:
        if q % 5 == 0:
            ranked = sorted(((-sum(a * b for a, b in zip(e, f)), i) for i, f in v if i != q))[:k]
            out[q] = [(i, -s) for s, i in ranked]
    return out


def run(spark, rows, **kw):
    import numpy as np
    rows = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]
    df = spark.createDataFrame([(i, e, "s", "x") for i, e in rows], SCHEMA)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 5 == 0, **kw).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got, brute(rows, kw["k"])


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(24)]) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(2000, None), (2005, [float("nan")] * 24), (2010, [float("inf")] * 24), (2015, [None] * 24), (None, rows[0][1])]
    got, expected = run(spark, rows, k=5, shard_rows=100, block_rows=40)
    assert got == expected


def test_few_and_odd_vectors(spark):
    got, expected = run(spark, [(0, [0.5, -0.5]), (1, [1.0, 1.0]), (5, []), (6, [0.0, 0.0])], k=5)
    assert got == expected
    assert run(spark, [(0, [1.0])], k=5)[0] == {}
    assert run(spark, [], k=5)[0] == {}


def test_large_components_against_python_integers(spark):
    """Sums that overflow 64 bits on the way, and vectors beyond 2^31 / 256."""
    rng = random.Random(4)
    for width, size, asked in ((384, 1.05e6, 1.05e6), (64, 2.1e6, 2.1e6), (64, 2 ** 26, 1e3), (3, 2 ** 22, 2 ** 22)):
        rows = [(i, [rng.choice([-1, 1]) * rng.uniform(0.5, 1) * (size if i % 5 else asked) for _ in range(width)]) for i in range(60)]
        rows += [(101, [0.0] * width), (105, [1e-3] * width)]
        got, expected = run(spark, rows, k=5, shard_rows=20)
        assert got == expected


def test_a_score_beyond_a_long_is_an_error(spark):
    import pytest
    with pytest.raises(Exception, match="does not fit a long"):
        run(spark, [(0, [2.0 ** 40]), (1, [2.0 ** 40])], k=5)
