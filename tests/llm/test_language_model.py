import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ordersentry.llm import language_model as lm

from .text import prose, words


def corpus():
    rng = random.Random(14)
    rows = []
    for i in range(260):
        w = prose(rng, rng.randrange(0, 80), 120)
        if i % 2:
            w = [x for y in w for x in ("of", y)]        # order that a context can learn
        rows.append((i, " ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    return rows + [(900, None), (901, " \n"), (None, "w1 w2"), (2, "w5 w5"), (2, "w5 w5"), (902, "q " * 5000)]


def brute_base(rows):
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [words(t) + [None] for _, t in rows]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
            for (i, _), h, t in zip(rows, held, tokens)]


def key(r):
    return str(r[:5]), r[5]


def test_counts_and_base_match_brute_force_and_the_model_beats_it(docs, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_DOCS", 50)
    monkeypatch.setattr(lm, "BUCKET_DOCS", 60)
    rows = corpus()
    out = lm.score(docs(rows)).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out), key=key)
    expected = sorted(brute_base(rows), key=key)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert all(abs(g[5] - e[5]) < 1e-9 for g, e in zip(got, expected))
    for held in (False, True):
        part = [r for r in out if r["held_out"] == held]
        assert sum(r["score"] for r in part) > sum(r["base_score"] for r in part)
    again = lm.score(docs(rows[::-1])).collect()
    assert sorted(r["score"] for r in again) == sorted(r["score"] for r in out)


def test_scores_are_not_rounded(docs):
    """An unseen word after an unseen one has the root's share of the base, to single precision."""
    held = [i for i in range(400) if lm.held_out(i)][:2]
    free = [i for i in range(400) if not lm.held_out(i)][:40]
    rows = [(i, f"a{i} b") for i in free] + [(held[0], "zz"), (held[1], "zz zz zz zz")]
    score = {r["doc_id"]: r["score"] for r in lm.score(docs(rows)).collect()}
    short, long = score[held[0]], score[held[1]]
    # The longer text holds three more unseen words, each in a context without customers.
    share = (long - short) / 3
    assert share < 0 and abs(share * 2048 - round(share * 2048)) > 1e-4
    again = {r["doc_id"]: r["score"] for r in lm.score(docs(rows)).collect()}
    assert again == score


def test_empty_and_all_held_out(docs):
    assert lm.score(docs([])).collect() == []
    held = next(i for i in range(100) if lm.held_out(i))
    r = lm.score(docs([(held, "a b")])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    words_ = np.arange(1, 40, dtype=np.uint64)
    pairs = np.unique(rng.integers(0, 39, 300) * lm.CONTEXTS + rng.integers(0, 5, 300))
    counts = lm.Counts(words_, pairs, rng.integers(1, 50, len(pairs)))
    # every word needs a customer
    assert set((pairs // lm.CONTEXTS).tolist()) == set(range(39))
    s = lm.Settings(39, 0.6, 0.4, 3)

    def totals(tables, root):
        c = np.bincount(pairs % lm.CONTEXTS, weights=counts.count, minlength=lm.CONTEXTS).astype(np.int64)
        return lm.Totals(c, np.bincount(pairs % lm.CONTEXTS, weights=tables, minlength=lm.CONTEXTS).astype(np.int64), root)

    history = [totals(np.ones(len(pairs)), 39)]
    for _ in range(3):
        *_, (tables, customers, root_tables) = lm.sweeps(counts, 0, history, s)
        assert ((1 <= tables) & (tables <= counts.count)).all() and ((1 <= root_tables) & (root_tables <= customers)).all()
        history.append(totals(tables, int(root_tables.sum())))
    after = history[-1]
    root = lm.root_probability(customers, root_tables, after, s)
    unseen = lm.root_probability(0, 0, after, s)
    assert root.sum() + unseen == pytest.approx(1)
    for u in range(5):
        own = np.zeros(39)
        at = pairs % lm.CONTEXTS == u
        own[pairs[at] // lm.CONTEXTS] = counts.count[at] - s.discount * tables[at]
        back = lm.THETA_CONTEXT + s.discount * after.tables[u]
        p = (own + back * root) / (lm.THETA_CONTEXT + after.tokens[u])
        assert p.sum() + back * unseen / (lm.THETA_CONTEXT + after.tokens[u]) == pytest.approx(1)


def test_seating_follows_the_restaurant_process():
    rng = np.random.default_rng(2)
    d, theta, rest, parent = 0.5, 5.0, 30, 0.02
    tables = lm.seat(np.full(4000, 40), np.full(4000, rest), np.full(4000, parent), theta, d, rng)
    turns = random.Random(3)
    seen = []
    for _ in range(4000):                         # customer by customer
        t = 1
        for n in range(1, 40):
            new = (theta + d * (rest + t)) * parent
            t += turns.random() < new / (n - d * t + new)
        seen.append(t)
    assert abs(tables.mean() - np.mean(seen)) < 0.15
    few = lm.seat(np.array([0, 1, 100_000]), np.zeros(3), np.array([1.0, 1.0, 1e-12]), theta, d, rng)
    assert few.tolist() == [0, 1, 1]


class Restaurant:
    """Customers seated one at a time; its parent has a customer for every table."""

    def __init__(self, theta, d, parent):
        self.theta, self.d, self.parent, self.tables = theta, d, parent, {}

    def p(self, dish):
        own = self.tables.get(dish, [])
        n, t = sum(map(sum, self.tables.values())), sum(map(len, self.tables.values()))
        above = self.parent.p(dish) if self.parent else BASE
        return (sum(own) - self.d * len(own) + (self.theta + self.d * t) * above) / (self.theta + n)

    def sit(self, dish, rng):
        own = self.tables.setdefault(dish, [])
        above = self.parent.p(dish) if self.parent else BASE
        new = (self.theta + self.d * sum(map(len, self.tables.values()))) * above
        i = rng.choices(range(len(own) + 1), [c - self.d for c in own] + [new])[0]
        if i < len(own):
            own[i] += 1
        else:
            own.append(1)
            if self.parent:
                self.parent.sit(dish, rng)

    def leave(self, dish, rng):
        own = self.tables[dish]
        i = rng.choices(range(len(own)), own)[0]
        own[i] -= 1
        if not own[i]:
            del own[i]
            if self.parent:
                self.parent.leave(dish, rng)


def test_scores_agree_with_a_sampler_that_seats_one_customer_at_a_time(docs, monkeypatch):
    monkeypatch.setattr(lm, "SWEEPS", 12)
    rng = random.Random(5)
    rows, after = [], {}
    for i in range(60):
        w = [f"w{rng.randrange(6)}"]
        while len(w) < 9:                          # some words follow others
            w.append(after.setdefault(w[-1], f"w{rng.randrange(6)}") if rng.random() < 0.6 else f"w{rng.randrange(12)}")
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["score"] for r in lm.score(docs(rows)).collect()}
    tokens = {i: list(zip([None, *t.split()], [*t.split(), "."])) for i, t in rows}
    customers = [x for i, t in tokens.items() if not lm.held_out(i) for x in t]
    global BASE
    BASE = 1 / (len({w for _, w in customers}) + 1)

    def discount(counts):
        n = Counter(counts.values())
        return lm._discount(n[1], n[2])

    root = Restaurant(lm.THETA_ROOT, discount(Counter(w for _, w in customers)), None)
    d = discount(Counter(customers))
    contexts = {c: Restaurant(lm.THETA_CONTEXT, d, root) for c in [None, *{w for t in tokens.values() for _, w in t}]}
    for c, w in customers:
        contexts[c].sit(w, rng)
    p, samples = Counter(), 0
    for sweep in range(60):
        for c, w in customers:
            contexts[c].leave(w, rng)
            contexts[c].sit(w, rng)
        if sweep >= 10:
            samples += 1
            for x in {x for t in tokens.values() for x in t}:
                p[x] += contexts[x[0]].p(x[1])
    for i, t in tokens.items():
        expected = sum(math.log10(p[x] / samples) for x in t)
        assert abs(got[i] - expected) < 0.03 * len(t), (i, got[i], expected)


def test_training_texts_that_occur_twice_score_apart(docs):
    rng = random.Random(8)
    rows = [(i, " ".join(prose(rng, 60, 400))) for i in range(400)]
    free = [i for i, _ in rows if not lm.held_out(i)]
    twice = dict(zip(free[:40:2], free[1:40:2]))
    texts = dict(rows)
    texts.update({b: texts[a] for a, b in twice.items()})
    out = {r["doc_id"]: (r["score"] - r["base_score"]) / r["n_tokens"] for r in lm.score(docs(list(texts.items()))).collect()}
    pairs = {*twice, *twice.values()}
    once = sorted(v for i, v in out.items() if i not in pairs)
    assert min(out[i] for i in pairs) > once[int(0.95 * len(once))]
