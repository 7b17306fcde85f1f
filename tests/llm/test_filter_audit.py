import random
from itertools import permutations

import pytest

from ordersentry.llm import filter_audit as fa
from ordersentry.llm.oracle import oracle_sql

from .text import prose, words

LABELS = "doc_id long, quality int, toxic int, part string"


def mask(text, copy):
    text = text or ""
    w = words(text, lower=False)
    return ((len(w) < 200) | (100 * len(set(w)) < 50 * len(w)) << 1 | (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)) << 2
            | any(c in "#$%&*|" for c in text) << 3 | copy << 4)


def brute(rows, labels):
    """Every order applied step by step to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    judged = []
    for i, text, part in rows:
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows)
        judged.append((part or "", i, mask(text, copy)))
    out = {}
    for part in {p for p, *_ in judged}:
        mine = [(i, m) for p, i, m in judged if p == part]
        shapley = dict.fromkeys(range(5), 0)
        for order in permutations(range(5)):
            left = mine
            for step, f in enumerate(order):
                gone = [(i, m) for i, m in left if m >> f & 1]
                left = [(i, m) for i, m in left if not m >> f & 1]
                shapley[f] += len(gone)
                fails = sum(m >> f & 1 for _, m in mine)
                out[part, "".join("ABCDE"[g] for g in order), step + 1] = [len(left), len(gone), fails - len(gone), sum(m == 1 << f for _, m in mine),
                                                                          sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for order in permutations(range(5)):
            for step, f in enumerate(order):
                out[part, "".join("ABCDE"[g] for g in order), step + 1].append(shapley[f])
    return out


def corpus():
    rng = random.Random(12)
    rows = []
    for i in range(160):
        w = prose(rng, rng.choice([0, 1, 199, 200, 201, 300]), rng.choice([50, 3000]))
        if rng.random() < 0.3:
            w = [x.upper() for x in w]
        if rng.random() < 0.3:
            w.append(rng.choice(["#", "a$b", "100%", "&", "**", "|", "é"]))
        rows.append((i * 37 % 1009, " ".join(w), rng.choice(["s", "t", None, "", "u"])))
    rows += [(2000 + k, rows[k][1], "s") for k in range(0, 60, 3)] + [rows[5], rows[5]]
    rows += [(3000, None, "t"), (3001, "", "t"), (None, rows[7][1], "s"), (None, None, None), (-5, rows[9][1], "u"),
             (3002, "A" + " é" * 49, "v"), (3003, "A" + " é" * 50, "v"), (3004, " ".join(["x"] * 100 + [f"y{k}" for k in range(99)]), "v")]
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for r in rows if rng.random() < 0.6]
    return rows, labels + labels[:9] + [(None, 1, 1, "x"), (99999, 1, 1, "x")]


def got(out):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
            for r in out.collect()}


def test_against_applying_the_filters(docs, spark):
    rows, labels = corpus()
    table = docs([(i, t, s) for i, t, s in rows])
    out = fa.filter_audit(table, spark.createDataFrame(labels, LABELS))
    assert got(out) == brute(rows, [r[:3] for r in labels])
    assert out.count() == 600 * 5


def test_sql_says_the_same(docs, spark):
    import duckdb
    rows, labels = corpus()
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    db.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    db.executemany("INSERT INTO labels VALUES (?, ?, ?)", [r[:3] for r in labels])
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = db.execute(f"SELECT {', '.join(names)} FROM ({oracle_sql()['op12_filter_audit']})").fetchall()
    assert {tuple(r[:3]): list(r[3:]) for r in found} == brute(rows, [r[:3] for r in labels])


def test_diagrams_in_every_order():
    rng = random.Random(1)
    for masks in (range(32), rng.sample(range(32), 7), [0], [31], [5, 10]):
        counts = {m: (rng.randrange(1, 4), rng.randrange(3), 0) for m in masks}
        diagram = fa.Diagram(counts)
        for level in (None, *fa.exchanges(5)):
            if level is not None:
                diagram.exchange(level)
            passed = 0
            for f, kept, removed in diagram.steps():
                at = [(m, c) for m, c in counts.items() if not m & passed]
                passed |= 1 << f
                assert removed == tuple(sum(c[k] for m, c in at if m >> f & 1) for k in range(3))
                assert kept == tuple(sum(c[k] for m, c in at if not m >> f & 1) for k in range(3))


@pytest.mark.parametrize("n", range(1, 7))
def test_exchanges_reach_all_orders(n):
    order, seen = list(range(n)), set()
    for level in (None, *fa.exchanges(n)):
        if level is not None:
            order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == len(fa.exchanges(n)) + 1 == len(list(permutations(range(n))))


def test_equal_nodes_are_one():
    diagram = fa.Diagram({m: (1, 0, 0) for m in range(32)})
    seen, todo = set(), [diagram.root]
    while todo:
        node = todo.pop()
        if node is not None and id(node) not in seen:
            seen.add(id(node))
            todo += [node.passes, node.fails]
    assert len(seen) == 6                     # one node a level and the leaf


def test_empty_tables(docs, spark):
    assert fa.filter_audit(docs([]), spark.createDataFrame([], LABELS)).count() == 0
    out = fa.filter_audit(docs([(1, "a")]), spark.createDataFrame([], LABELS)).filter("filter_order = 'ABCDE' AND step = 1").first()
    assert (out["kept"], out["removed"], out["good_lost"]) == (0, 1, 0)
