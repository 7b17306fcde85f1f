"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 11).

Every entry c becomes the whole number ``x = floor(64 c) + 1000000``.  The
covariance V is that of the *fit list*, each distinct x vector once; its
leading eigenvectors whiten all rows.

1. *Fit list.*  Vectors travel as bytes of the narrowest integer type that
   holds them (equal vectors have equal bytes), are made distinct by an
   ordinary Spark aggregation (copies combine before the shuffle) and are
   written to the shared folder as integer blocks.
2. *Sums.*  Count and sums per dimension are exact whole numbers, so centring
   subtracts a whole number and a fraction below one: no digits are lost to
   the large offset.
3. *Passes.*  One pass multiplies the centred X'X by a narrow block of
   columns: every task multiplies its blocks, Spark adds the tasks' rows per
   dimension.  Only matrices of (dimensions x block) reach the driver; V is
   never formed.
4. *Filter.*  A Chebyshev recurrence over such passes damps the part of the
   spectrum below the block's smallest Ritz value.  Its lower edge comes from
   a Lanczos vector that rides along with the first passes.  QR and
   Rayleigh-Ritz follow, until every wanted residual is at rounding level
   (``CERTIFIED``); without that the run fails rather than return less.

Defined cases: rows whose vector is null, or holds null or non-finite
entries, drop out; so does a vector shorter than the longest one (it lacks
entries).  A null vec_id stays null, repeated rows are all returned.  A
direction without variance has no component, so constant or single vectors,
like an empty table, give no rows; with fewer than 16 dimensions there are as
many components as directions.  Equal eigenvalues leave the choice of the
basis free.  An entry whose x doesn't fit a long is an error.  A deviation
that doesn't fit a long is null; ``deviation_text`` always holds all its digits.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_rows, saved

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
EXTRA = 24                    # block columns beyond the wanted components
DEGREE = 10                   # of one filter, at most
GROWTH = 1e6                  # of the leading column against the damped part, in one filter
CERTIFIED = 1e-13             # residual of every wanted pair, over the largest eigenvalue
MAX_PASSES = 2000
BLOCK_VALUES = 1 << 19        # entries of one stored block
SEED = 11

_FIT = pa.schema([("dims", pa.int32()), ("n", pa.int64()), ("code", pa.binary())])
_SUMS = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])


class Fit(NamedTuple):
    """The fit list's exact sums: entry j of x has the mean ``base[j] + rest[j] / n``."""
    n: int
    base: np.ndarray          # int64
    rest: np.ndarray          # int64, 0 <= rest < n

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n


class Whitening(NamedTuple):
    fit: Fit
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # dimensions x components
    trace: float
    passes: int
    residual: float           # largest of the wanted pairs, over the largest eigenvalue


# ------------------------------------------------------------------- vectors
def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that take part, their lengths, their x - OFFSET end to end)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(vectors)), lengths)
    flat = pc.list_flatten(vectors)
    values = pc.cast(flat, pa.float64()).to_numpy(zero_copy_only=False)        # null: nan
    bad = np.zeros(len(vectors), bool)
    bad[owner[~np.isfinite(values)]] = True
    bad |= vectors.is_null().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(~bad)
    values = np.floor(values[~bad[owner]] * SCALE)
    if len(values) and np.abs(values).max() >= 2.0 ** 63 - 2 * OFFSET:
        raise ValueError("an embedding entry times 64 does not fit a long")
    return rows, lengths[rows], values.astype(np.int64)


def codes(lengths: np.ndarray, values: np.ndarray) -> list[bytes]:
    """Per vector: a byte for the width of its integers, then the integers."""
    ends = np.cumsum(lengths)
    out = []
    for lo, hi in zip(ends - lengths, ends):
        v = values[lo:hi]
        width = 2 if not len(v) or (-2 ** 15 <= v.min() and v.max() < 2 ** 15) else 4 if -2 ** 31 <= v.min() and v.max() < 2 ** 31 else 8
        out.append(bytes([width]) + v.astype(f"<i{width}").tobytes())
    return out


def matrix(code: list[bytes], dims: int) -> np.ndarray:
    """x - OFFSET of vectors of ``dims`` entries, as int64 rows."""
    out = np.empty((len(code), dims), np.int64)
    widths = np.fromiter((c[0] for c in code), np.int64, len(code))
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        out[at] = np.frombuffer(b"".join(code[i][1:] for i in at), f"<i{width}").reshape(len(at), dims)
    return out


def encoded(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, dims, code) of every row that takes part."""
    def run(batches):
        for b in batches:
            rows, lengths, values = whole_numbers(b.column("embedding"))
            yield pa.record_batch([b.column("vec_id").take(pa.array(rows)), pa.array(lengths, pa.int32()),
                                   pa.array(codes(lengths, values), pa.binary())], ["vec_id", "dims", "code"])

    narrow = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    return narrow.mapInArrow(run, "vec_id long, dims int, code binary")


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct vector once, as saved blocks (dims, n, code: a width byte and the integers)."""
    def run(batches):
        for b in batches:
            dims = b.column("dims").to_numpy()
            code = b.column("code").to_pylist()
            rows = []
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                step = max(1, BLOCK_VALUES // max(1, d))
                for lo in range(0, len(at), step):
                    x = matrix([code[i] for i in at[lo:lo + step]], d)
                    rows.append((d, len(x), codes(np.array([x.size]), x.ravel())[0]))
            yield binary_rows(rows, _FIT)

    return saved(vectors.select("dims", "code").distinct().mapInArrow(run, "dims int, n long, code binary"), "whitening-fit")


# -------------------------------------------------------------------- passes
def exact_sums(fit: DataFrame, dims: int) -> Fit | None:
    """Count and sums of x over the fit list; None when it is empty."""
    def run(batches):
        n, total = 0, [0] * dims
        for b in batches:
            for rows, code in zip(b.column("n").to_pylist(), b.column("code").to_pylist()):
                x = np.frombuffer(code, f"<i{code[0]}", offset=1).reshape(rows, dims)
                n += rows
                high = x.astype(np.int64) >> 32         # two parts, so that no sum of a block overflows
                low = x.astype(np.int64) & 0xFFFFFFFF
                total = [t + (h << 32) + lo for t, h, lo in zip(total, high.sum(0).tolist(), low.sum(0).tolist())]
        if n:
            from decimal import Decimal
            yield binary_rows([(j, n, Decimal(t)) for j, t in enumerate(total)], _SUMS)

    rows = fit.mapInArrow(run, "i int, n long, total decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    if not rows:
        return None
    n = int(rows[0]["n"])
    total = {r["i"]: int(r["total"]) for r in rows}
    base = [total[j] // n for j in range(dims)]
    return Fit(n, np.array(base, np.int64), np.array([total[j] - b * n for j, b in enumerate(base)], np.int64))


def _summed(fit: DataFrame, sums: Fit, rows: int, columns: int, block_sum) -> np.ndarray:
    """Sum over all blocks of ``block_sum(centred block)`` (rows x columns):
    tasks add their own, Spark adds the tasks' rows."""
    def run(batches):
        total = None
        for b in batches:
            for n, code in zip(b.column("n").to_pylist(), b.column("code").to_pylist()):
                x = np.frombuffer(code, f"<i{code[0]}", offset=1).reshape(n, len(sums.base))
                part = block_sum(sums.centred(x))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(rows), pa.int32()), *(pa.array(c) for c in np.ascontiguousarray(total.T))],
                                  ["i", *(f"v{j}" for j in range(columns))])

    schema = ", ".join(["i int", *(f"v{j} double" for j in range(columns))])
    out = np.zeros((rows, columns))
    for r in fit.select("n", "code").mapInArrow(run, schema).groupBy("i").agg(*(F.sum(f"v{j}").alias(f"v{j}") for j in range(columns))).collect():
        out[r["i"]] = r[1:]
    return out


def multiply(fit: DataFrame, sums: Fit, block: np.ndarray) -> np.ndarray:
    """V times ``block`` (dimensions x columns)."""
    def one(x):
        return x.T @ (x @ block)
    return _summed(fit, sums, *block.shape, one) / sums.n


def total_variance(fit: DataFrame, sums: Fit) -> float:
    def one(x):
        return np.array([[np.einsum("ij,ij->", x, x)]])
    return float(_summed(fit, sums, 1, 1, one)[0, 0] / sums.n)


# ------------------------------------------------------------ eigenvectors
class _LowerEdge:
    """A Lanczos vector whose products ride along with other passes; gives an
    estimate of the spectrum's lower end, from below."""

    def __init__(self, dims: int, rng: np.random.Generator):
        v = rng.standard_normal(dims)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    def column(self) -> np.ndarray:
        return self.basis[-1][:, None]

    def take(self, product: np.ndarray) -> None:
        v = self.basis[-1]
        self.alpha.append(float(v @ product))
        w = product.copy()
        for _ in range(2):
            for u in self.basis:
                w -= (u @ w) * u
        self.beta.append(float(np.linalg.norm(w)))
        self.basis.append(w / self.beta[-1] if self.beta[-1] > 1e-12 * abs(self.alpha[0]) else np.zeros_like(w))

    def edge(self) -> float:
        if not self.alpha:
            return 0.0
        t = np.diag(self.alpha) + np.diag(self.beta[:-1], 1) + np.diag(self.beta[:-1], -1)
        values, vectors = np.linalg.eigh(t)
        low = values[0] - self.beta[-1] * abs(vectors[-1, 0])
        return max(0.0, float(low - 0.05 * (values[-1] - values[0])))


def _filter_degree(low: float, high: float, top: float) -> int:
    """As many steps as keep the leading column's growth over the damped part at GROWTH."""
    at = 1 + 2 * (top - high) / max(high - low, 1e-300)
    steps = math.acosh(GROWTH) / math.acosh(max(at, 1 + 1e-9))
    return int(min(DEGREE, max(2, steps)))


def leading_pairs(product, dims: int, wanted: int, seed: int = SEED, extra: int = EXTRA) -> tuple[np.ndarray, np.ndarray, int, float]:
    """(values, vectors, passes, residual) of the ``wanted`` largest eigenpairs
    of a symmetric positive semidefinite matrix known by ``product(block)``."""
    rng = np.random.default_rng(seed)
    width = min(dims, wanted + extra)
    wanted = min(wanted, width)
    q = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    probe, passes, fresh = _LowerEdge(dims, rng), 0, 0

    def times(block):
        nonlocal passes
        passes += 1
        if len(probe.alpha) >= min(DEGREE, dims - 1):
            return product(block)
        both = product(np.hstack([block, probe.column()]))
        probe.take(both[:, -1])
        return both[:, :-1]

    while True:
        aq = times(q)
        values, turn = np.linalg.eigh(q.T @ aq)
        order = np.argsort(-values)
        values, q, aq = values[order], q @ turn[:, order], aq @ turn[:, order]
        top = values[0]
        if top <= 0:
            return values[:0], q[:, :0], passes, 0.0
        residual = float(np.linalg.norm(aq - q * values, axis=0)[:wanted].max() / top)
        if residual <= CERTIFIED * math.sqrt(dims) or width == dims:
            return values[:wanted], q[:, :wanted], passes, residual
        if passes >= MAX_PASSES:
            raise RuntimeError(f"eigenvectors not certified after {passes} passes: residual {residual:.1e}")
        # Chebyshev polynomial that is small on [low, high], scaled to 1 at the top.
        high, low = float(values[-1 - fresh]), probe.edge()
        edge = float(values[wanted - 1])
        if edge - high <= 10 * residual * top:  # no telling them apart (yet, or a tie): damp what lies clearly lower
            high = edge - 0.05 * max(edge - low, 0.0)
        low = min(low, 0.95 * high)
        if high <= 1e-14 * top:                 # what is left has no variance
            high = 1e-14 * top
        half, middle = (high - low) / 2, (high + low) / 2
        first = sigma = half / (top - middle)
        before, y = q, (aq - middle * q) * (sigma / half)
        for _ in range(_filter_degree(low, high, top) - 1):
            after = 1 / (2 / first - sigma)
            before, y = y, (times(y) - middle * y) * (2 * after / half) - before * (sigma * after)
            sigma = after
        y /= np.maximum(np.linalg.norm(y, axis=0), 1e-300)
        # Fresh columns: what the block's start lacked comes in.
        fresh = min(2, max(0, width - wanted - 1))
        y[:, width - fresh:] = rng.standard_normal((dims, fresh)) / math.sqrt(dims)
        q = np.linalg.qr(np.linalg.qr(y)[0])[0]


def train(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame, int]:
    """(model or None without variance, saved fit list, dimensions)."""
    fit = fit_list(vectors)
    dims = fit.agg(F.max("dims")).first()[0] or 0
    fit = fit.filter(F.col("dims") == dims)
    sums = exact_sums(fit, dims) if dims else None
    if sums is None:
        return None, fit, dims
    trace = total_variance(fit, sums)
    if trace <= 0:
        return None, fit, dims
    values, basis, passes, residual = leading_pairs(lambda block: multiply(fit, sums, block), dims, components)
    some = values > 64 * np.finfo(float).eps * dims * values[0]
    return Whitening(sums, values[some], basis[:, some], trace, passes, residual), fit, dims


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    scaled = model.vectors / np.sqrt(model.values)
    k = len(model.values)

    def one(x):
        w = np.hstack([x @ scaled, np.ones((len(x), 1))])
        return w.T @ w

    s = _summed(fit, model.fit, k + 1, k + 1, one) / model.fit.n
    return float(np.abs(s[:k, :k] - np.outer(s[:k, k], s[k, :k]) - np.eye(k)).max())


# -------------------------------------------------------------------- output
def deviations(x: np.ndarray, fit: Fit) -> list[int]:
    """Sum over dimensions of ``(n x - S)^2`` per row, exact."""
    if not len(x):
        return []
    far = max(abs(int((x - fit.base).max())), abs(int((x - fit.base).min()))) + 1
    if far * fit.n >= 1 << 62:
        whole = [[fit.n * (a - b) - r for a, b, r in zip(row, fit.base.tolist(), fit.rest.tolist())] for row in x.tolist()]
        return [sum(d * d for d in row) for row in whole]
    d = np.abs(fit.n * (x - fit.base) - fit.rest)
    if (far * fit.n) ** 2 * x.shape[1] < 1 << 63:
        return (d * d).sum(1).tolist()
    # Halves of 31 bits, whose products fit; products are added by halves of 32 bits.
    high, low = d >> 31, d & 0x7FFFFFFF
    out = [0] * len(x)
    for product, shift in ((high * high, 62), (high * low, 32), (low * low, 0)):
        upper, lower = (product >> 32).sum(1).tolist(), (product & 0xFFFFFFFF).sum(1).tolist()
        out = [o + (((u << 32) + v) << shift) for o, u, v in zip(out, upper, lower)]
    return out


def whitened(vectors: DataFrame, model: Whitening, dims: int, error: float) -> DataFrame:
    """Every row's components in long form."""
    fit, k = model.fit, len(model.values)
    scaled = model.vectors / np.sqrt(model.values)
    explained = model.values / model.trace

    def run(batches):
        for b in batches:
            step = max(1, BLOCK_VALUES // dims)
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                # The model's sums are those of x - OFFSET; the shift cancels in every difference.
                x = matrix(part.column("code").to_pylist(), dims)
                exact = deviations(x, fit)
                rows = np.repeat(np.arange(len(x)), k)
                fits = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
                yield pa.record_batch([
                    part.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(rows), fit.n), pa.int64()), fits.take(pa.array(rows)),
                    pa.array((fit.centred(x) @ scaled).ravel()), pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error)), pa.array([str(e) for e in exact]).take(pa.array(rows))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"])

    return vectors.filter(F.col("dims") == dims).mapInArrow(run, OUTPUT)


OUTPUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_text string")


def whiten(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error, deviation_text)."""
    vectors = encoded(table, vec_id, embedding)
    model, fit, dims = train(vectors, components)
    if model is None:
        return table.sparkSession.createDataFrame([], OUTPUT)
    return whitened(vectors, model, dims, identity_error(fit, model))
