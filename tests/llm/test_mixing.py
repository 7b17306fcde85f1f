from collections import defaultdict

from pyspark.sql import functions as F

from ordersentry.llm import mixing

from .text import words


def water_fill(sizes, budget=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), set(names)
    left = budget * sum(sizes.values())
    while left > 1e-9 and open_:                        # hand out by weight, stop at the cap, reshare
        total = sum(weight[s] for s in open_)
        give = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, g in give.items():
            target[s] += g
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def test_mix_meets_targets(docs):
    rows = [(i, " ".join(["w"] * (i % 37 + 3)), ["a", "b", "é", None, "Z"][min(4, i % 9)]) for i in range(1500)]
    rows += [(7, "w w w", "a"), (7, "w w w", "a"), (8000, None, "b"), (8001, " \t", "b"), (None, "q q", "b"), (9000, "w " * 5000, "tiny")]
    d = docs(rows)
    documents, schedule = mixing.mix(d, block_words=16)
    got = documents.collect()
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t, _ in rows)
    size, taken = defaultdict(int), defaultdict(int)
    for r in got:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    target = water_fill(size)
    for r in got:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == size[r["source"]]
    for s in size:
        assert abs(taken[s] - target[s]) <= 8 * 16
    assert sorted(map(str, documents.collect())) == sorted(map(str, mixing.mix(d, block_words=16)[0].collect()))
    # any stretch of the schedule holds each source in its share
    slots = sorted(schedule.collect(), key=lambda r: r["slot"])
    names = sorted((s for s in size if s is not None), key=str.encode) + [None]
    for lo in range(0, len(slots) - 400, 400):
        part = [r["src"] for r in slots[lo:lo + 400]]
        for i, s in enumerate(names):
            assert abs(part.count(i) / 400 - target[s] / sum(target.values())) < 0.05


def test_tiny_sources_beside_a_hot_one_take_their_targets(docs):
    rows = [(i, "w " * 100, "hot") for i in range(1000)]
    for k in range(60):                                 # 20 to 1000 words each; "a.." and "t.." stand on both sides of the hot one
        n = (20, 60, 65, 200, 1000)[k % 5]
        rows += [(10_000 + 100 * k + j, "w " * (n // 5), f"{'at'[k % 2]}{k:03}") for j in range(5)]
    d = docs(rows)
    documents, schedule = mixing.mix(d, budget=1.2)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in documents.collect():
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in size)
    assert any(target[s] == 2 * size[s] for s in size if s != "hot")
    slots, blocks = schedule.collect(), defaultdict(int)
    names = sorted(size, key=str.encode)
    for r in slots:
        assert 0 < r["words"] <= 64 and 0 <= r["first"] and r["first"] + r["words"] <= size[names[r["src"]]]
        blocks[names[r["src"]]] += r["words"]
    assert blocks == taken and len({r["slot"] for r in slots}) == len(slots)
    assert len({(r["src"], r["pass"], r["block"]) for r in slots}) == len(slots)
    kept = defaultdict(int)
    for r in mixing.take_documents(d, budget=1.2).collect():
        kept[r["source"]] += len(words(r["text"]))
    assert all(kept[s] == target[s] for s in size if target[s] == 2 * size[s])


def test_a_document_stands_at_the_first_slot_that_takes_its_words(docs):
    rows = [(i, " ".join(["w"] * (i % 23)), "abc"[i % 3] if i % 5 else "c") for i in range(400)]
    d = docs(rows)
    documents, schedule = mixing.mix(d, budget=0.7, block_words=16, seed=3)
    key = {r["doc_id"]: r["key"] for r in d.select("doc_id", F.xxhash64(F.lit(3), F.col("doc_id").cast("long")).alias("key")).collect()}
    taking = defaultdict(list)
    for r in schedule.collect():
        taking["abc"[r["src"]]].append((r["slot"], r["first"], r["first"] + r["words"]))
    want, at = {}, defaultdict(int)
    for i, text, s in sorted(rows, key=lambda r: key[r[0]]):
        lo, hi = at[s], at[s] + len(words(text))
        want[i] = min((slot for slot, first, end in taking[s] if first < hi and lo < end and lo < hi), default=None)
        at[s] = hi
    got = documents.collect()
    assert {r["doc_id"]: r["first_slot"] for r in got} == want
    assert all((r["first_slot"] is None) == (r["taken"] == 0) for r in got) and None in want.values()


def test_mix_without_words(docs):
    for rows in ([], [(1, None, "a"), (2, "", None)]):
        got = mixing.mix(docs(rows))[0].collect()
        assert [(r["taken"], r["target"]) for r in got] == [(0, 0.0)] * len(rows)


def test_take_documents_keeps_columns(docs):
    d = docs([(i, "w " * 10, "a" if i % 4 else "b") for i in range(200)])
    out = mixing.take_documents(d, block_words=5)
    assert out.columns == d.columns
    assert abs(out.count() - 300) <= 5
