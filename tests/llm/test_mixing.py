import random

import pytest
from samples import awkward, sentence, table, vocabulary, words

from tidemark.llm.mixing import cyclic_weights, mix_sources, take_mix


def brute_targets(sizes, weights, epochs):
    total, held = sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in held}
        rest = total - sum(held.values())
        level = rest / sum(free.values()) if free else 0
        over = [s for s, w in free.items() if w * level > epochs * sizes[s]]
        if not over:
            return {**held, **{s: w * level for s, w in free.items()}}
        held.update({s: epochs * sizes[s] for s in over})


def test_targets_and_taken(spark):
    r = random.Random(1)
    vocab = vocabulary(50)
    names = ["b", "a", "ä", "Z", None, "c"]
    rows = [(i, sentence(r, vocab, r.randint(0, 40) if i % 50 else 900), names[min(r.randint(0, 9), 5)]) for i in range(600)]
    rows += [(x[0], x[1], "c") for x in awkward()]
    docs = table(spark, rows)
    got = mix_sources(docs, cyclic_weights((5, 2, 1))).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    target = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3.0)
    source_of = {i: s for i, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for g in got:
        s = source_of[g["doc_id"]]
        assert g["source_size"] == sizes[s] and g["target"] == pytest.approx(target[s])
        assert 0 <= g["taken"] <= 3 * g["size"] and g["taken"] == g["size"] * g["repeats"]
        taken[s] += g["taken"]
    largest = {}
    for _, text, source in rows:
        largest[source] = max(largest.get(source, 0), len(words(text)))
    assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], largest[s] / 2) for s in sizes)
    again = mix_sources(docs.repartition(7), cyclic_weights((5, 2, 1))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_rows_of_the_mix(spark):
    rows = [(i, "a b c", "x") for i in range(20)] + [(100 + i, "d e f g", "y") for i in range(40)]
    docs = table(spark, rows)
    mixed = take_mix(docs, cyclic_weights((1, 1)))
    assert mixed.columns == docs.columns
    n = {}
    for m in mixed.collect():
        n[m["source"]] = n.get(m["source"], 0) + len(words(m["text"]))
    assert n == {"x": 111, "y": 108} or abs(n["x"] - 110) <= 3 and abs(n["y"] - 110) <= 4


def test_capped_and_empty(spark):
    docs = table(spark, [(1, "a b", "x"), (2, "c " * 98, "y")])
    got = {g["doc_id"]: g for g in mix_sources(docs, cyclic_weights((1, 1))).collect()}
    assert got[1]["target"] == 6 and got[1]["taken"] == 6 and got[2]["target"] == 94
    assert mix_sources(docs.where("false"), cyclic_weights((5, 2, 1))).collect() == []
    blank = mix_sources(table(spark, [(1, "", None), (2, None, "x")]), cyclic_weights((5, 2, 1))).collect()
    assert [b["taken"] for b in blank] == [0, 0]


def test_equal_rows_are_taken_in_part(spark):
    rows = [(i, f"a{i} b c d e", "x") for i in range(500)] + [(7000, "v w x y z", "x")] * 500 + [(8000 + i, "k " * 10, "y") for i in range(500)] + [(9000, "m n", None)] * 300
    docs = table(spark, rows).repartition(5)
    got = mix_sources(docs, cyclic_weights((5, 2, 1))).collect()
    for size, largest in ((5_000, 5), (5_000, 10), (600, 2)):
        mine = [g for g in got if g["source_size"] == size and g["size"] == largest]
        assert abs(sum(g["taken"] for g in mine) - mine[0]["target"]) <= largest / 2
    repeats = {g["repeats"] for g in got if g["doc_id"] == 7000}
    assert len(repeats) <= 2 and max(repeats) - min(repeats) <= 1
    again = mix_sources(docs.repartition(3), cyclic_weights((5, 2, 1))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = take_mix(docs, cyclic_weights((5, 2, 1))).groupBy("source").count().collect()
    assert {m["source"]: m["count"] for m in mixed} == {s: sum(g["repeats"] for g in got if g["doc_id"] in ids) for s, ids in (("x", {*range(500), 7000}), ("y", {*range(8000, 8500)}), (None, {9000}))}


def test_many_sources_fill_in_one_pass(spark):
    r = random.Random(2)
    sizes = {f"s{i:04}": r.choice([1, 2, 3, 50]) for i in range(900)}
    docs = table(spark, [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())])
    got = mix_sources(docs, cyclic_weights((5, 2, 1))).collect()
    target = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}, 3.0)
    assert all(g["target"] == pytest.approx(target[f"s{g['doc_id']:04}"]) for g in got)
    assert sum(g["target"] for g in got) == pytest.approx(sum(sizes.values()))
