"""LM scoring by a hierarchical Pitman-Yor model (operator 6).

The model has a restaurant for every context and one root restaurant, their
common parent, above a uniform base over the training words and one unseen
word.  A token's context is the whole word before it, by 16 bits of its hash
(``CONTEXTS``), with a context of its own for the start of a text: up to some
ten thousand words each has a restaurant to itself, beyond that several share
one.  Customers are the tokens of the training texts; every table of a context
restaurant sends one customer to the root.

Training, over all training texts:

1. Texts are packed into blocks (a hash of the id).  Each block sends its
   distinct words and (word, context) pairs with training counts, as packed
   arrays, to buckets of words.
2. A bucket adds the counts up: all customers of its words, whatever the
   context, and the words' root restaurants entries are in one bucket.
3. Blocked Gibbs sweeps: the customers of a dish leave a restaurant together,
   their tables leave the restaurant's total and the root, and they are seated
   again one after the other, each opening a table with probability
   proportional to ``(theta + d T) p_parent``, T with the tables opened so far.
   Two approximations: all dishes are seated side by side, from what the others
   had after the sweep before, and beyond the first 16 the customers of a dish
   come in batches of a sixteenth of those seated (binomial).  Sweeps exchange
   table totals per context, a vector of fixed size.  Seating is a
   function of (seed, bucket, sweep), so a bucket replays earlier sweeps
   instead of storing them, and a lost task gives the same seats again.
4. A bucket answers every block with the counts of its words and the
   predictive probability of its pairs, averaged over the sweeps after the
   first, as single-precision log10; a text's score sums them in double.

Scoring meets answers and texts block by block.  Each document is read
whole.  No vocabulary is broadcast or sent to the driver; what travels is
each block's distinct words and pairs.

Words are compared by 64-bit hashes.  Defined cases: a null or empty text is
the end token alone; a null id counts as the empty text when folds are dealt;
repeated rows are scored, and counted in training, each time; without
training tokens the base and the model are uniform over the unseen word;
only the id and the text are read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_docs, give_back, n_blocks, pack, saved, split_words, text_blocks, unpack

FOLDS, HELD_OUT_FOLD = 5, 1
CONTEXTS = 1 << 16
SWEEPS = 4
THETA_CONTEXT, THETA_ROOT = 5.0, 50.0
BLOCK_DOCS, BUCKET_DOCS = 4096, 2048
END = np.uint64(xxhash.xxh3_64_intdigest(" end"))      # no word holds a blank


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT_FOLD


class Block(NamedTuple):
    """A block's tokens; ``words`` (hashes) ascending by (bucket, hash) and
    ``pairs`` (word rank * CONTEXTS + context) ascending."""
    docs: pa.Table
    offsets: np.ndarray      # tokens of document i: offsets[i] .. offsets[i + 1]
    words: np.ndarray
    pairs: np.ndarray
    token_pair: np.ndarray   # token -> pair
    buckets: np.ndarray      # bucket of every word


def read_block(payloads, buckets: int) -> Block:
    give_back()
    docs = block_docs(payloads)
    split = split_words(docs.column("text"))
    hashes = np.append(split.hashes(), END)
    context = ((hashes >> np.uint64(40)) % np.uint64(CONTEXTS - 1)).astype(np.int64) + 1
    context[-1] = 0
    n, n_docs = len(split.codes), docs.num_rows
    offsets = split.offsets + np.arange(n_docs + 1)              # every text has an end token
    tokens = np.full(n + n_docs, len(hashes) - 1, np.int64)
    tokens[np.arange(n) + np.repeat(np.arange(n_docs), np.diff(split.offsets))] = split.codes
    before = np.zeros(len(tokens), np.int64)
    before[1:] = context[tokens[:-1]]                            # behind an end token: 0, the start of a text
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pairs, token_pair = np.unique(rank[tokens] * CONTEXTS + before, return_inverse=True)
    return Block(docs, offsets, hashes[order], pairs, token_pair, bucket[order])


REQUESTS = "bucket long, block long, payload binary"
_REQUESTS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())])


def _by_bucket(block: Block):
    """(bucket, slice of words, slice of pairs)."""
    starts = np.flatnonzero(np.concatenate([[True], block.buckets[1:] != block.buckets[:-1]]))
    ends = np.append(starts[1:], len(block.buckets))
    cut = np.searchsorted(block.pairs, np.append(starts, len(block.words)) * CONTEXTS)
    for i, (lo, hi) in enumerate(zip(starts, ends)):
        yield int(block.buckets[lo]), slice(lo, hi), slice(cut[i], cut[i + 1])


def _request(buckets: int):
    def run(group: pa.Table) -> pa.Table:
        block = read_block(group.column("payload"), buckets)
        train = np.array([not held_out(i) for i in block.docs.column("doc_id").to_pylist()], np.float64)
        count = np.bincount(block.token_pair, weights=np.repeat(train, np.diff(block.offsets)), minlength=len(block.pairs)).astype(np.uint32)
        number, rows = group.column("block")[0].as_py(), []
        for bucket, w, p in _by_bucket(block):
            per_word = np.bincount(block.pairs[p] // CONTEXTS - w.start, minlength=w.stop - w.start).astype(np.uint32)
            rows.append((bucket, number, pack(block.words[w], per_word, (block.pairs[p] % CONTEXTS).astype(np.uint16), count[p], compress=True)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _REQUESTS)], schema=_REQUESTS)
    return run


# ------------------------------------------------------------------ buckets
class Counts(NamedTuple):
    words: np.ndarray        # hashes with training tokens, ascending
    pairs: np.ndarray        # word index * CONTEXTS + context, ascending
    count: np.ndarray        # training tokens of every pair


def add_up(requests) -> Counts:
    """Training counts of one bucket from its blocks' requests."""
    hashes, contexts, counts = [], [], []
    for words, per_word, context, count in requests:
        own = np.repeat(words, per_word)
        seen = count > 0
        hashes.append(own[seen])
        contexts.append(context[seen].astype(np.int64))
        counts.append(count[seen].astype(np.int64))
    words, index = np.unique(np.concatenate(hashes), return_inverse=True)
    pairs, where = np.unique(index * CONTEXTS + np.concatenate(contexts), return_inverse=True)
    return Counts(words, pairs, np.bincount(where, weights=np.concatenate(counts), minlength=len(pairs)).astype(np.int64))


class Totals(NamedTuple):
    """What the buckets share; table totals as of some sweep."""
    tokens: np.ndarray        # training tokens per context
    tables: np.ndarray        # tables per context
    root_tables: int


class Settings(NamedTuple):
    vocabulary: int
    discount: float           # of the context restaurants
    root_discount: float
    seed: int


def seat(customers: np.ndarray, rest: np.ndarray, parent: np.ndarray, theta: float, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after all customers of every dish sat down in turn; ``rest``: the
    restaurant's tables of other dishes, ``parent``: the dish's probability above."""
    tables = np.minimum(customers, 1)
    seated = tables.copy()
    active = np.flatnonzero(customers > 1)
    while len(active):
        n, t = seated[active], tables[active]
        new = (theta + discount * (rest[active] + t)) * parent[active]
        come = np.minimum(np.maximum(1, n // 16), customers[active] - n)
        tables[active] = t + rng.binomial(come, new / (n - discount * t + new))
        seated[active] = n + come
        active = active[seated[active] < customers[active]]
    return tables


def root_probability(customers, tables, totals: Totals, s: Settings, gone=0):
    """Predictive probability of dishes in the root restaurant, after ``gone``
    customers of the dish left it (and the tables that nobody is left for)."""
    total = int(totals.tables.sum()) - gone
    base = 1 / (s.vocabulary + 1)
    left = customers - gone
    closed = np.maximum(tables - left, 0)
    return (left - s.root_discount * (tables - closed)
            + (THETA_ROOT + s.root_discount * (totals.root_tables - closed)) * base) / (THETA_ROOT + total)


def sweeps(counts: Counts, bucket: int, history: list[Totals], s: Settings):
    """Yields (tables per pair, root customers and root tables per word) of
    sweep 1, 2, ...; sweep i + 1 uses ``history[i]``, the totals after sweep i."""
    word, context = counts.pairs // CONTEXTS, counts.pairs % CONTEXTS
    tables = np.ones(len(counts.pairs), np.int64)
    root_customers = np.bincount(word, minlength=len(counts.words))
    root_tables = np.ones(len(counts.words), np.int64)
    base = np.full(len(counts.words), 1 / (s.vocabulary + 1))
    for number, totals in enumerate(history):
        rng = np.random.default_rng([s.seed, bucket, number])
        parent = root_probability(root_customers[word], root_tables[word], totals, s, tables)
        tables = seat(counts.count, totals.tables[context] - tables, parent, THETA_CONTEXT, s.discount, rng)
        root_customers = np.bincount(word, weights=tables, minlength=len(counts.words)).astype(np.int64)
        root_tables = seat(root_customers, totals.root_tables - root_tables, base, THETA_ROOT, s.root_discount, rng)
        yield tables, root_customers, root_tables


COUNTS = "bucket long, words long, ones long, twos long, pair_ones long, pair_twos long, payload binary"


def _count(group: pa.Table) -> pa.Table:
    c = add_up(unpack(p.as_py()) for p in group.column("payload"))
    per_word = np.bincount(c.pairs // CONTEXTS, weights=c.count, minlength=len(c.words))
    row = (group.column("bucket")[0].as_py(), len(c.words), int((per_word == 1).sum()), int((per_word == 2).sum()),
           int((c.count == 1).sum()), int((c.count == 2).sum()), pack(c.words, c.pairs, c.count.astype(np.uint32), compress=True))
    names = [x.split()[0] for x in COUNTS.split(", ")]
    return pa.table([pa.array([v], pa.binary() if n == "payload" else pa.int64()) for v, n in zip(row, names)], names=names)


def _read_counts(blob: bytes) -> Counts:
    words, pairs, count = unpack(blob)
    return Counts(words, pairs, count.astype(np.int64))


def _totals(counts: DataFrame, history: list[Totals], settings: Settings | None) -> Totals:
    """Token and table totals over all buckets after the sweeps in ``history``
    (none: one table per pair); one row per context reaches the driver."""
    schema = pa.schema([("context", pa.int64()), ("tokens", pa.int64()), ("tables", pa.int64())])

    def run(batches):
        tokens, tables, root = np.zeros(CONTEXTS, np.int64), np.zeros(CONTEXTS, np.int64), 0
        for b in batches:
            for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("payload")):
                c = _read_counts(blob.as_py())
                seats, root_seats = np.ones(len(c.pairs), np.int64), np.ones(len(c.words), np.int64)
                for seats, _, root_seats in sweeps(c, bucket, history, settings) if history else ():
                    pass
                context = c.pairs % CONTEXTS
                tokens += np.bincount(context, weights=c.count, minlength=CONTEXTS).astype(np.int64)
                tables += np.bincount(context, weights=seats, minlength=CONTEXTS).astype(np.int64)
                root += int(root_seats.sum())
        at = np.flatnonzero(tokens)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(tokens[at], 0)), pa.array(np.append(tables[at], root))], schema=schema)

    rows = (counts.select("bucket", "payload").mapInArrow(run, "context long, tokens long, tables long")
            .groupBy("context").agg(F.sum("tokens").alias("tokens"), F.sum("tables").alias("tables")).collect())
    tokens, tables, root = np.zeros(CONTEXTS, np.int64), np.zeros(CONTEXTS, np.int64), 0
    for r in rows:
        if r["context"] < 0:
            root = r["tables"]
        else:
            tokens[r["context"]], tables[r["context"]] = r["tokens"], r["tables"]
    return Totals(tokens, tables, root)


def _answer(history: list[Totals], settings: Settings):
    """Counts and averaged predictive probabilities for every request of a bucket."""
    def run(group: pa.Table) -> pa.Table:
        requests = [unpack(p.as_py()) for p in group.column("payload")]
        bucket = group.column("bucket")[0].as_py()
        c = add_up(requests)
        per_word = np.bincount(c.pairs // CONTEXTS, weights=c.count, minlength=len(c.words)).astype(np.uint32)
        samples = []
        for number, (tables, root_customers, root_tables) in enumerate(sweeps(c, bucket, history[:-1], settings)):
            if number:
                after = history[number + 1]
                samples.append((after, tables, root_probability(root_customers, root_tables, after, settings), root_probability(0, 0, after, settings)))
        rows = []
        for block, (words, per, context, _) in zip(group.column("block").to_pylist(), requests):
            at = np.searchsorted(c.words, words)
            known = at < len(c.words)
            known[known] = c.words[at[known]] == words[known]
            count = np.zeros(len(words), np.uint32)
            count[known] = per_word[at[known]]
            word, context = np.repeat(at, per), context.astype(np.int64)
            word_known = np.repeat(known, per)
            code = word * CONTEXTS + context
            pair = np.searchsorted(c.pairs, code)
            pair_known = word_known & (pair < len(c.pairs))
            pair_known[pair_known] = c.pairs[pair[pair_known]] == code[pair_known]
            p = np.zeros(len(code))
            for totals, tables, root, unseen in samples:
                parent = np.full(len(code), unseen)
                parent[word_known] = root[word[word_known]]
                own = np.zeros(len(code))
                own[pair_known] = c.count[pair[pair_known]] - settings.discount * tables[pair[pair_known]]
                p += (own + (THETA_CONTEXT + settings.discount * totals.tables[context]) * parent) / (THETA_CONTEXT + totals.tokens[context])
            rows.append((bucket, block, pack(count, np.log10(p / len(samples)).astype(np.float32), compress=True)))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), _REQUESTS)], schema=_REQUESTS)
    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(buckets: int, n: int, v: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block = read_block(texts.column("payload"), buckets)
        answer = dict(zip(answers.column("bucket").to_pylist(), answers.column("payload")))
        count, log_p = np.zeros(len(block.words)), np.zeros(len(block.pairs))
        for bucket, w, p in _by_bucket(block):
            count[w], log_p[p] = unpack(answer[bucket].as_py())
        base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
        word = (block.pairs // CONTEXTS)[block.token_pair]
        starts = block.offsets[:-1]
        ids = block.docs.column("doc_id").to_pylist()
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([held_out(i) for i in ids], pa.bool_()),
            "n_tokens": pa.array(np.diff(block.offsets)), "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64)[word], starts)),
            "base_score": pa.array(np.add.reduceat(base[word], starts)),
            "score": pa.array(np.add.reduceat(log_p[block.token_pair], starts))})
    return run


def _discount(ones: int, twos: int) -> float:
    """The usual estimate from counts of counts, kept inside (0, 1)."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5


def score(docs: DataFrame, seed: int = 6, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probability of the text)."""
    rows = docs.count()
    blocks, buckets = n_blocks(rows, BLOCK_DOCS), n_blocks(rows, BUCKET_DOCS)
    texts = text_blocks(docs, blocks, text, doc_id)
    requests = saved(texts.groupBy("block").applyInArrow(_request(buckets), REQUESTS), "lm-requests")
    counts = saved(requests.groupBy("bucket").applyInArrow(_count, COUNTS), "lm-counts")
    total = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "ones", "twos", "pair_ones", "pair_twos"))).first()
    settings = Settings(total["words"], _discount(total["pair_ones"], total["pair_twos"]), _discount(total["ones"], total["twos"]), seed)
    history = [_totals(counts, [], None)]
    for _ in range(SWEEPS):
        history.append(_totals(counts, list(history), settings))
    n = int(history[0].tokens.sum())
    answers = requests.groupBy("bucket").applyInArrow(_answer(history, settings), REQUESTS)
    scored = (texts.groupBy("block").cogroup(answers.groupBy("block"))
              .applyInArrow(_score(buckets, n, settings.vocabulary), SCORES))
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))
