import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from ordersentry.llm import whitening as w

TABLE = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                      T.StructField("component", T.StringType()), T.StructField("code", T.StringType())])


def table(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if c is None else float(c) for c in v], "x", "y") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, TABLE)


def brute(vectors, k=16):
    """(kept rows, exact deviations, eigenvalues, eigenvectors, centred rows, trace) by whole numbers and a dense solver."""
    kept = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    longest = max((len(vectors[i]) for i in kept), default=0)
    kept = [i for i in kept if len(vectors[i]) == longest]
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in vectors[i]] for i in kept]
    fit = sorted(set(map(tuple, x)))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    centre = lambda rows: np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in rows])
    v = centre(fit).T @ centre(fit) / n
    values, vectors = np.linalg.eigh(v)
    return kept, deviation, values[::-1][:k], vectors[:, ::-1][:, :k], centre(x), np.trace(v), n


def compare(spark, vectors, ids=None):
    out = w.whiten(table(spark, vectors, ids)).toPandas()
    kept, deviation, values, basis, centred, trace, n = brute(vectors)
    k = int((values > 1e-12 * max(values[0], 1e-300)).sum())
    assert len(out) == k * len(kept)
    assert out.empty or (set(out["n"]) == {n} and out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9)
    want = centred @ basis[:, :k] / np.sqrt(values[:k])
    for at, row in enumerate(kept):
        mine = out[out["vec_id"] == (row if ids is None else ids[row])].sort_values("component")
        assert mine["component"].tolist() == list(range(1, k + 1))
        assert set(mine["deviation_text"]) == {str(deviation[at])}
        assert mine["deviation"].tolist() == [deviation[at]] * k
    got = np.vstack([out[out["vec_id"] == (r if ids is None else ids[r])].sort_values("component")["whitened"] for r in kept]) if len(out) else want
    assert np.abs(np.abs(got) - np.abs(want)).max(initial=0) < 1e-7
    for c in range(k if len(out) else 0):                        # one sign for all rows
        assert np.abs(got[:, c] - want[:, c]).max() < 1e-7 or np.abs(got[:, c] + want[:, c]).max() < 1e-7
    if len(out):
        explained = out.groupby("component")["explained"].first().to_numpy()
        assert np.abs(explained / (values[:k] / trace) - 1).max() < 1e-9


def test_against_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    flat = rng.standard_normal((400, 48)) * 0.3                  # hardly any gaps: the filter has work to do
    steep = rng.standard_normal((300, 40)) * (0.75 ** np.arange(40)) @ np.linalg.qr(rng.standard_normal((40, 40)))[0] + 3
    for vectors in (flat, steep):
        rows = [list(v) for v in vectors]
        rows += [rows[0]] * 150 + [None, [None] + rows[1][1:], [float("nan")] + rows[1][1:], [float("-inf")] + rows[2][1:], rows[3][:-1], []]
        compare(spark, rows)


def test_few_dimensions_few_vectors_and_no_variance(spark):
    rng = np.random.default_rng(4)
    compare(spark, [list(v) for v in rng.standard_normal((30, 5))])
    compare(spark, [list(v) for v in rng.standard_normal((9, 40))])       # rank 8
    for rows in ([], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[0.001, 0.5], [0.002, 0.5]]):
        assert w.whiten(table(spark, rows)).count() == 0


def test_null_and_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [list(v) for v in rng.standard_normal((6, 3))]
    out = w.whiten(table(spark, rows, [None, 1, 1, 2, 3, None]))
    assert sorted(((r["vec_id"], r["count"]) for r in out.groupBy("vec_id").count().collect()), key=str) == sorted([(None, 6), (1, 6), (2, 3), (3, 3)], key=str)


def test_the_filter_does_the_work():
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    for spectrum in (np.linspace(2, 1, 200), 0.9 ** np.arange(200), np.r_[1e6, np.linspace(2, 1, 199)], np.r_[np.ones(40), np.zeros(160)]):
        v = (q * spectrum) @ q.T
        products = []

        def product(block):
            products.append(block.shape[1])
            return v @ block

        values, basis, passes, residual = w.leading_pairs(product, 200, 16)
        assert np.allclose(values, np.sort(spectrum)[::-1][:16], rtol=1e-10) and residual < 1e-11
        assert passes == len(products) < 200 and max(products) <= 41           # narrow blocks only
        assert np.abs(basis.T @ basis - np.eye(16)).max() < 1e-12


def test_deviations_are_exact_at_any_size():
    rng = np.random.default_rng(7)
    for n, spread in ((7, 50), (3 * 10 ** 9, 2 ** 28), (10 ** 6, 2 ** 42), (10 ** 9, 2 ** 50)):
        x = rng.integers(-spread, spread, (5, 11))
        base, rest = rng.integers(-spread, spread, 11), rng.integers(0, n, 11)
        want = [sum((n * (a - b) - r) ** 2 for a, b, r in zip(row, base.tolist(), rest.tolist())) for row in x.tolist()]
        assert w.deviations(x, w.Fit(n, base, rest)) == want


def test_large_entries(spark):
    assert w.whole_numbers(pa.array([[2.0 ** 50, -2.0 ** 56]]))[2].tolist() == [2 ** 56, -2 ** 62]
    with pytest.raises(ValueError, match="does not fit a long"):
        w.whole_numbers(pa.array([[1e30]]))
    big = [[2.0 ** 40, 1.0], [-2.0 ** 41, 0.5], [3.0, 2.0 ** 39]]
    out = w.whiten(table(spark, big)).collect()
    kept, deviation, *_ = brute(big)
    assert {(r["vec_id"], r["deviation"], r["deviation_text"]) for r in out} == {(i, None, str(deviation[i])) for i in kept}
