"""Exact top-k inner-product search (operator 2, MaxScore).

Components become integers, ``floor(256 * x)``.  A vector dimension is a
query term; its postings in a shard are the components of the shard's
vectors, and its score bound is ``|q_d|`` times the largest component of the
query's sign.  Per query and shard MaxScore

1. orders the terms by bound and takes a first threshold from the exact
   scores of a few promising vectors,
2. calls the longest tail of terms whose bounds sum to less than the
   threshold non-essential: no vector gets into the top k by them alone,
3. traverses the essential postings, then probes the non-essential ones
   for those vectors only whose partial score plus the bounds still to come
   reaches the threshold, which rises as scores become exact.

A vector is dropped only when its bound is strictly below the threshold, so
equal scores survive and ties go to the smaller id.

Queries are cut into blocks and candidates into shards by hash; a cell
(shard, query block) is one co-group, whose size does not grow with the
table, and a query's shard results are merged by a rank of at most k rows
per shard.

Sums are 64-bit integers where no score or bound of the cell can overflow them,
else Python's unbounded ones; a score that doesn't fit a long is an error.

Defined cases: vectors that are null or hold null or non-finite components
take no part; shorter vectors count as padded
with zeros; an empty vector scores 0; candidates with the query's id are its
own rows; of repeated query rows one (the smallest vector) is asked, while
every repeated candidate row counts; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x) with x the integer components of the usable vectors, as
    doubles (which hold the floor of any double exactly)."""
    x = F.col("e")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = 2.0 ** 53                          # from here on doubles are whole numbers

    def integer(v):
        y = v * SCALE
        return F.when(F.abs(y) < whole, F.floor(y).cast("double")).otherwise(y)

    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
            .filter(F.col("vec_id").isNotNull() & x.isNotNull() & usable)
            .select("vec_id", F.transform(x, integer).alias("x")))


def _matrix(col: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = col.combine_chunks()
    lens = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lens), width))
    at = np.arange(width)[None, :] < lens[:, None]
    out[at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _integers(whole: np.ndarray, exact: bool) -> np.ndarray:
    """Doubles that are whole numbers as int64 or, where sums could overflow, Python integers."""
    if not exact:
        return whole.astype(np.int64)
    return np.array([int(v) for v in whole.ravel().tolist()], object).reshape(whole.shape)


def _kth(scores: np.ndarray, k: int):
    """The k-th largest."""
    return (np.sort(scores) if scores.dtype == object else np.partition(scores, len(scores) - k))[len(scores) - k]


class Shard:
    """Postings of one shard: row d of ``postings`` holds dimension d of every
    vector, vectors in ascending id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.postings = ids[order], np.ascontiguousarray(vectors[order].T)
        self.most = np.maximum(self.postings.max(1, initial=0), 0)
        self.least = np.minimum(self.postings.min(1, initial=0), 0)

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of a superset-free top k: score down, id up."""
        others = np.flatnonzero(self.ids != own)
        bound = np.where(q > 0, q * self.most, q * self.least)
        terms = np.argsort(-bound, kind="stable")
        rest = np.concatenate([np.cumsum(bound[terms][::-1])[::-1], [0]])    # rest[i]: bounds of terms i, i+1, ...
        threshold = None
        if len(others) > k:
            lead = sum(q[d] * self.postings[d, others] for d in terms[:8])
            first = np.argsort(-lead) if lead.dtype == object else np.argpartition(-lead, min(4 * k, len(others) - 1))
            threshold = np.sort(q @ self.postings[:, others[first[:4 * k]]])[-k]
        essential = len(terms) if threshold is None else int(np.argmax(rest < threshold)) if (rest < threshold).any() else len(terms)
        partial = np.zeros(len(self.ids), self.postings.dtype)
        for d in terms[:essential]:
            partial += q[d] * self.postings[d]
        alive, score = others, partial[others]
        for i in range(essential, len(terms)):
            keep = score + rest[i] >= threshold
            if not keep.all():
                alive, score = alive[keep], score[keep]
            score = score + q[terms[i]] * self.postings[terms[i], alive]
            if len(score) > k and i % 8 == 0:      # partial plus the most negative rest is a lower bound
                low = np.where(q > 0, q * self.least, q * self.most)[terms[i + 1:]].sum()
                threshold = max(threshold, _kth(score, k) + low)
        if len(score) > k:
            keep = score >= _kth(score, k)
            alive, score = alive[keep], score[keep]
        ids = self.ids[alive]                # ascending, so a stable order by score breaks ties by id
        best = np.argsort(-score, kind="stable")[:k]
        if any(abs(int(s)) >= 1 << 63 for s in score[best]):
            raise ValueError(f"an inner product of vector {own} does not fit a long")
        return ids[best], score[best].astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = 8192, block_rows: int = 1024,
          vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows where ``is_query`` (over
    ``vec_id``) holds, against all rows."""
    rows = integer_vectors(vectors, vec_id, embedding)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = max(1, math.ceil(total["n"] / shard_rows)), max(1, math.ceil(total["q"] / block_rows))

    def cut(col, n, seed):
        return F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = (rows.filter(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
               .select("vec_id", "x", cut("vec_id", blocks, 1).alias("block"), every(shards).alias("shard")))
    candidates = rows.select("vec_id", "x", cut("vec_id", shards, 2).alias("shard"), every(blocks).alias("block"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def cell(asked: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and found.num_rows:
            width = max((len(v) for c in (asked, found) for v in c.column("x").to_pylist()), default=0)
            ids, candidates = found.column("vec_id").to_numpy(), _matrix(found.column("x"), width)
            largest, shards = np.abs(candidates).max(initial=0), {}
            for qid, q in zip(asked.column("vec_id").to_numpy(), _matrix(asked.column("x"), width)):
                # Every score, bound and partial sum is at most width * |q| * |c|, with room for a difference.
                exact = bool(max(largest, 1.0) * max(np.abs(q).max(initial=0), 1.0) * max(width, 1) >= 2.0 ** 61)
                if exact not in shards:
                    shards[exact] = Shard(ids, _integers(candidates, exact))
                near, scores = shards[exact].search(_integers(q, exact), qid, k)
                out.append((np.full(len(near), qid), near, scores))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], schema=schema)

    per_shard = (queries.groupBy("shard", "block").cogroup(candidates.groupBy("shard", "block"))
                 .applyInArrow(cell, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (per_shard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
