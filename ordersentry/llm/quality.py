"""Quality classifier by attention-based multiple-instance learning (operator 1).

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is
described by word-shape and repetition statistics and encoded by a learned
layer, ``h = tanh(W x + b)``; gated attention
``a = softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs the passages, and the
score is a logistic function of the weighted representation ``sum a h``.
Encoder, attention and output are learned together from document labels, by
Adam over whole bags.

Training uses a bounded sample: at most ``TRAIN_DOCS`` labelled documents,
half of them of either label where there are enough (smallest id hashes
first; re-weighted to the labels' true shares), none of more than
``TRAIN_CHARS`` characters.  Scoring reads every whole text, passage by
passage, in one narrow pass without a shuffle.

Defined cases: a null or empty text, or one of white space only, is a bag of
one empty passage and gets a score too; label rows with null id or quality
are left out, and of several labels of an id the smallest counts; documents
sharing an id share its label; without labels of both kinds the score is the
share of label 1 (0.5 without labels); an output column replaces an input
column of the same name.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, remainder, split_words

PASSAGE_WORDS = 64
TRAIN_DOCS = 6000
TRAIN_CHARS = 1 << 20
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.7
HIDDEN, ATTENTION, EPOCHS, RATE, DECAY = 16, 8, 300, 0.02, 1e-4


# ----------------------------------------------------------------- passages
def _word_shapes(words: pa.Array) -> np.ndarray:
    def per_char(pattern):
        return pc.count_substring_regex(words, pattern).to_numpy(zero_copy_only=False).astype(np.float32)

    def has(pattern):
        return pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False).astype(np.float32)

    chars = np.maximum(pc.utf8_length(words).to_numpy(zero_copy_only=False), 1).astype(np.float32)
    upper, lower, other = per_char(r"\p{Lu}"), per_char(r"\p{Ll}"), per_char(r"[^\p{L}\p{N}]")
    return np.stack([np.log1p(chars), (chars > 20).astype(np.float32), upper / chars, ((upper > 1) & (lower == 0)).astype(np.float32),
                     per_char("[0-9]") / chars, other / chars, has(r"[^\p{L}\p{N}]{2,}$"), has(r"^[^\p{L}\p{N}]+$"),
                     per_char(r"[^\x00-\x7F]") / chars, has(r"[.!?]$")], 1)


N_FEATURES = 10 + 5


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(passage offsets per text, features of every passage)."""
    words = split_words(texts, lower=False)
    lens = np.diff(words.offsets)
    count = np.maximum(1, -(-lens // PASSAGE_WORDS))
    offsets = np.concatenate([[0], np.cumsum(count)])
    x = np.zeros((int(offsets[-1]), N_FEATURES), np.float32)
    n = len(words.codes)
    if not n:
        return offsets, x
    doc = np.repeat(np.arange(len(lens)), lens)
    passage = offsets[doc] + (np.arange(n) - words.offsets[doc]) // PASSAGE_WORDS
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    at, size = passage[starts], np.diff(np.append(starts, n)).astype(np.float32)
    shapes = _word_shapes(words.vocabulary)
    for f in range(shapes.shape[1]):           # one column at a time keeps the gather small
        x[at, f] = np.add.reduceat(shapes[words.codes, f], starts) / size
    for i, back in enumerate((1, 2, 3)):
        same = np.zeros(n, np.float32)
        same[back:] = (words.codes[back:] == words.codes[:-back]) & (doc[back:] == doc[:-back])
        x[at, 10 + i] = np.add.reduceat(same, starts) / size
    distinct = np.unique(passage * len(words.vocabulary) + words.codes) // len(words.vocabulary)
    x[:, 13] = np.bincount(distinct, minlength=len(x))
    x[at, 13] /= size
    x[at, 14] = np.log1p(size) / np.log(PASSAGE_WORDS + 1)
    return offsets, x


# -------------------------------------------------------------------- model
def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model(NamedTuple):
    """``weights`` is None for a constant score."""
    constant: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict | None = None

    def _forward(self, offsets, x):
        p, starts = self.weights, offsets[:-1]
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(starts)), np.diff(offsets))
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, g, a, z, bag, _sigmoid(z @ p["c"] + p["d"])

    def score(self, offsets: np.ndarray, x: np.ndarray) -> np.ndarray:
        if self.weights is None or len(offsets) < 2:
            return np.full(len(offsets) - 1, self.constant)
        return self._forward(offsets, (x - self.mean) / self.scale)[-1].astype(np.float64)


def fit(offsets: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Weighted logistic loss over bags, minimised by Adam; deterministic."""
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(0)
    shape = {"W": (x.shape[1], HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s) for k, s in shape.items()}
    model = Model(float(y.mean()), mean, scale, p)
    m, v = ({k: np.zeros_like(q) for k, q in p.items()} for _ in range(2))
    starts = offsets[:-1]
    for step in range(1, EPOCHS + 1):
        h, t, g, a, z, bag, s = model._forward(offsets, x)
        dlogit = weight * (s - y) / weight.sum()
        dz = dlogit[:, None] * p["c"]
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, starts)[bag])
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - h * h)
        grad = {"W": x.T @ dpre, "b": dpre.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ dlogit, "d": dlogit.sum(keepdims=True)}
        rate = RATE * (1 - 0.9 * step / EPOCHS)
        for k, q in p.items():
            d = grad[k] + DECAY * q
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.999 * v[k] + 0.001 * d * d
            q -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


# -------------------------------------------------------------------- Spark
_BAG = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("features", pa.binary())])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """A model from the labelled documents outside the held-out fold.  The
    driver gets the passage features of at most ``train_docs`` documents."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(remainder("doc_id", FOLDS) != HELD_OUT_FOLD)
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    shares = dict(known.groupBy("quality").count().collect())
    total = sum(shares.values())
    if len(shares) < 2:
        return Model(shares.get(1, 0) / total if total else 0.5)
    half = train_docs // 2
    counts = {q: min(n, max(half, train_docs - min(half, shares[1 - q]))) for q, n in shares.items()}
    sample = None
    for q, n in sorted(counts.items()):
        part = known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        sample = part if sample is None else sample.unionByName(part)

    def bags(batches):
        for b in chunks(batches, "text"):
            offsets, x = passages(b.column("text"))
            yield pa.record_batch([b.column("doc_id"), pa.array(np.diff(offsets), pa.int32()),
                                   pa.array([x[lo:hi].tobytes() for lo, hi in zip(offsets[:-1], offsets[1:])], pa.binary())], schema=_BAG)

    # The sample has at most train_docs rows, so its broadcast is bounded.
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
             .filter(F.coalesce(F.length("text"), F.lit(0)) <= TRAIN_CHARS))
    rows = texts.mapInArrow(bags, "doc_id long, n int, features binary").toArrow().sort_by([("doc_id", "ascending"), ("n", "ascending")])
    quality = dict(map(tuple, sample.collect()))
    found, first = np.unique(rows.column("doc_id").to_numpy(), return_index=True)    # one text of an id
    y = np.array([quality[i] for i in found], np.float64)
    if len(set(y)) < 2:
        return Model(shares.get(1, 0) / total)
    x = [np.frombuffer(rows.column("features")[int(i)].as_py(), np.float32).reshape(-1, N_FEATURES) for i in first]
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in x])])
    weight = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    return fit(offsets, np.concatenate(x).astype(np.float64), y, weight)


def score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs``, all columns, with the score of every whole text."""
    kept = docs.select(*[c for c in docs.columns if c.lower() != out.lower()])
    schema = T.StructType(kept.schema.fields + [T.StructField(out, T.DoubleType())])

    def run(batches):
        for b in chunks(batches, text):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(*passages(b.column(text))), pa.float64())],
                                             names=[*b.schema.names, out])

    return kept.mapInArrow(run, schema)
