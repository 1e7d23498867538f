import pathlib
import random

import numpy as np
import pytest
from samples import awkward, sentence, table, vocabulary, words

from tidemark.llm import blocks, near_dedup
from tidemark.llm.components import components
from tidemark.llm.near_dedup import drop_near_copies, near_classes
from tidemark.llm.sketches import may_repeat, sketch_members
from tidemark.session import shared_dir


def shingles(text, n):
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, similarity):
    """doc_id -> (size of the set, component), for distinct ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(n_groups=12, hot=150):
    r = random.Random(10)
    vocab = vocabulary(3_000)
    common = sentence(r, vocab, 40)
    rows, n = [], 0

    def edited(text, most):
        w = text.split()
        for _ in range(r.randint(0, most)):
            w[r.randrange(len(w))] = r.choice(vocab)
        return " ".join(w)

    for g in range(n_groups):
        base = sentence(r, vocab, r.choice([6, 20, 80, 300]))
        for _ in range(r.randint(1, 6)):
            rows.append((n, edited(base, max(1, len(base.split()) // 30))))
            n += 1
    hub = sentence(r, vocab, 140)
    for _ in range(hot):  # a large group, near to and far from its hub
        rows.append((n, edited(hub, r.choice([0, 2, 6, 12, 40]))))
        n += 1
    for _ in range(60):  # a common passage
        rows.append((n, common + " " + sentence(r, vocab, r.choice([1, 3, 10, 60]))))
        n += 1
    rows += [(n + i, rows[3][1].upper()) for i in range(20)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shingle", "similarity", "k", "block"), [(3, 85, 128, 256), (5, 80, 128, 40)])
def test_against_brute_force(spark, monkeypatch, shingle, similarity, k, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = corpus() + [x for x in awkward() if x[0] not in (906, None)]
    got = near_classes(table(spark, rows), shingle=shingle, similarity=similarity, k=k).collect()
    wanted = brute(rows, shingle, similarity)
    assert {g["doc_id"]: (g["n_shingles"], g["component_id"]) for g in got} == wanted
    assert all(g["kept"] == (g["doc_id"] == g["component_id"]) for g in got) and len(got) == len(rows)


def test_repeated_rows_null_ids_and_none(spark):
    docs = table(spark, awkward())
    got = near_classes(docs)
    found = [(g["doc_id"], g["component_id"], g["kept"]) for g in got.collect()]
    assert len(found) == len(awkward()) and (906, 905, False) in found and found.count((906, 905, False)) == 2 and (None, None, True) in found
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(awkward()) - 2
    assert near_classes(docs.where("false")).collect() == []


def test_components_of_long_paths(spark):
    r = random.Random(2)
    path = list(range(300))
    r.shuffle(path)
    links = [(path[i], path[i + 1]) for i in range(199)] + [(path[200], path[i]) for i in range(201, 300)]
    got = {g["node"]: g["component"] for g in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[p] for p in path[:200]} == {min(path[:200])} and {got[p] for p in path[200:]} == {min(path[200:])}


def test_rows_without_ids_and_repeated_ids_are_documents_of_their_own(spark):
    r = random.Random(14)
    vocab = vocabulary(3_000)
    texts = [sentence(r, vocab, 120) for _ in range(8)]
    near = texts[0] + " and a little more"
    rows = [(3, texts[0]), (None, near), (None, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[2] + " end"), (None, ""), (None, None)]
    rows += [(7, texts[3]), (7, texts[4]), (7, texts[4]), (8, texts[4] + " end"), (9, texts[5]), (9, texts[5] + " end"), (9, texts[0] + " z")]
    docs = table(spark, rows)
    found = [tuple(g) for g in near_classes(docs).select("doc_id", "component_id", "kept").collect()]
    assert len(found) == len(rows) and found.count((None, 3, False)) == 1
    assert sum(f == (None, None, True) for f in found) == 4 and sum(f == (None, None, False) for f in found) == 2
    assert found.count((3, 3, True)) == 1 and found.count((7, 7, True)) == 2 and found.count((7, 7, False)) == 1 and found.count((8, 7, False)) == 1
    assert found.count((9, 9, True)) == 1 and found.count((9, 9, False)) == 1 and found.count((9, 3, False)) == 1
    left = [(x["doc_id"], x["text"]) for x in drop_near_copies(docs).collect()]
    assert len(left) == 8 and {(3, texts[0]), (None, texts[1]), (None, ""), (None, None), (7, texts[3]), (7, texts[4])} <= set(left)
    assert sum((t or "").startswith(texts[2]) for _, t in left) == 1 and sum((t or "").startswith(texts[5]) for _, t in left) == 1


def test_words_of_one_pattern_are_told_apart(spark):
    one = "a"
    while len(one) < 4_096:
        one += one.translate(str.maketrans("ab", "ba"))
    got = near_classes(table(spark, [(1, one), (2, one.translate(str.maketrans("ab", "ba"))), (3, one.upper())]), shingle=3, similarity=85).collect()
    assert {g["doc_id"]: g["component_id"] for g in got} == {1: 1, 2: 2, 3: 1}


def test_stars_meet_again_without_their_anchor(spark, monkeypatch):
    """Stars (1, 2) and (3; 4, 5, 6): only 4, 5 and 6 have pairs that their anchors' links leave open."""
    near = {5: range(100), 6: range(2, 100)}
    full = {i: np.sort(np.array([x * 2**40 + 7 for x in near.get(i, range(100 * i, 100 * i + 100))], np.uint64)) for i in range(1, 7)}
    stars = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (3, 3, 1), (3, 4, 1), (3, 5, 1), (3, 6, 1)], "anchor long, id long, blocks int")
    sets = spark.createDataFrame([(i, near_dedup.pack_set(x)) for i, x in full.items()], "id long, full binary")
    labels = spark.createDataFrame([], "node long, component long")
    counts, write = {}, near_dedup.stage

    def counted(df, name):
        out = write(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "stage", counted)
    found = near_dedup.across_components(stars, labels, sets, 128, 85).collect()
    assert [tuple(r) for r in found] == [(5, 6)]
    assert counts == {"near-members": 4, "near-mixed": 1}


def packed(spark, sets):
    full = {i: np.sort(np.array([x * 2**40 + 7 for x in found], np.uint64)) for i, found in sets.items()}
    return spark.createDataFrame([(i, near_dedup.pack_set(x)) for i, x in full.items()], "id long, full binary")


def test_only_members_with_a_close_partner_meet_by_full_sets(spark, monkeypatch):
    """Of 60 members in three blocks, 10 and 11 are alike beyond what a sketch holds, 12 and 13 as wholes; all others are alone."""
    near = {10: range(9000, 9500), 11: range(9020, 9500), 12: range(90), 13: range(5, 90), 14: range(90, 120)}
    sets = packed(spark, {i: near.get(i, range(1000 * i, 1000 * i + 150 + i)) for i in range(1, 62)})
    stars = spark.createDataFrame([(1, i, 3) for i in range(1, 62)], "anchor long, id long, blocks int")
    counts, write = {}, blocks.stage

    def counted(df, name):
        out = write(df, name)
        counts[name] = out.select("id").distinct().count()
        return out

    monkeypatch.setattr(blocks, "stage", counted)
    found = near_dedup.across_components(stars, spark.createDataFrame([], "node long, component long"), sets, 128, 85).collect()
    assert sorted(tuple(r) for r in found) == [(10, 11), (12, 13)]
    assert counts == {"near-close": 4}


def test_sketches_values_and_sets_go_when_they_are_done_with(spark):
    folder = pathlib.Path(shared_dir(spark).removeprefix("file:"), "stage")
    before = set(folder.glob("*"))
    found = near_classes(table(spark, corpus(4, 30)))
    left = {p.name.rpartition("-")[0] for p in set(folder.glob("*")) - before}
    assert left >= {"near-rows", "near-found"}
    assert not left & {"sketch", "near-sketches", "near-values", "near-often", "near-sets"}
    assert found.count() == len(corpus(4, 30))


def test_merged_sketches_take_few_jobs_whatever_the_partitions(spark):
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    ids = spark.range(0, 3_000, 3, 4)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.sparkContext.setJobGroup("sketch", "sketch")
        known = sketch_members(ids, 20, 1_000)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("sketch")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for c, value in before.items():
            spark.conf.set(c, value)
    assert len(jobs) < 12
    assert may_repeat(np.arange(0, 3_000, 3, dtype=np.uint64), known.value, 20).all()
    assert may_repeat(np.arange(1, 3_000, 3, dtype=np.uint64), known.value, 20).sum() < 5
