import math
import random
import re

import numpy as np
from samples import awkward, sentence, table, vocabulary

from tidemark.llm import decontaminate
from tidemark.llm.decontaminate import WALKS, contamination, drop_contaminated, edit_distance, edits_allowed, embed, find_passages, repetitions, sample_keys


def tokens(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, items):
    out = []
    for i, text in rows:
        w, found = tokens(text), []
        for item, passage in items:
            p = tokens(passage)
            most = int(edits_allowed(len(p)))
            if len(p) >= 5 and any(edit_distance(w[s : s + len(p)], p, most) <= most for s in range(len(w) - len(p) + 1)):
                found.append(item)
        out.append((i, len(set(found)), ",".join(map(str, sorted(set(found)))), bool(found)))
    return out


def corpus():
    r = random.Random(12)
    vocab = vocabulary(150)
    items = [(i, sentence(r, vocab, r.randint(5, 40))) for i in range(12)]
    rows = []
    for i in range(160):
        w = sentence(r, vocab, r.randint(0, 40)).split()
        if i % 3 == 0:
            p = r.choice(items)[1].split()
            for _ in range(r.randint(0, len(p) // 4 + 1)):  # up to and beyond what is allowed
                at = r.randrange(len(p))
                r.choice([lambda: p.__setitem__(at, r.choice(vocab)), lambda: p.insert(at, r.choice(vocab)), lambda: p.pop(at) if len(p) > 1 else None])()
            at = r.randint(0, len(w))
            w[at:at] = p
        rows.append((i, r.choice([" ", "\n"]).join(x.upper() if r.random() < 0.2 else x + r.choice(["", ",", "."]) for x in w)))
    return rows + awkward(), items


def test_against_brute_force(spark):
    rows, items = corpus()
    extra = [(50, "too short here"), (51, None), (None, "an item without any id at all"), (3, items[3][1])]
    benchmark = spark.createDataFrame([(i, t, "z") for i, t in items + extra], "item_id long, text string, n string")
    docs = table(spark, rows)
    got = sorted(map(tuple, contamination(docs, benchmark).collect()), key=str)
    wanted = sorted(brute(rows, items), key=str)
    assert got == wanted and sum(g[3] for g in got) > 20
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not g[3] for g in got)
    blocks = find_passages(docs.select("doc_id", "text"), benchmark, block_bytes=300).select("found").collect()
    assert sum(len(b["found"]) > 0 for b in blocks) == sum(g[3] for g in got)


def test_recall_of_samples():
    """Windows with the most edits allowed are named by some sample, about as often as asked for."""

    import pyarrow as pa

    r = random.Random(3)
    vocab = vocabulary(5_000)
    items = [(i, sentence(r, vocab, r.randint(15, 60))) for i in range(60)]
    index = decontaminate.index_items(items)
    named = 0
    for n, (_, text) in enumerate(items):
        p = text.split()
        for at in r.sample(range(len(p)), int(edits_allowed(len(p)))):
            p[at] = r.choice(vocab)
        data, offsets = decontaminate.text_bytes(pa.array([" ".join(p)]))
        hashes, *_, first = decontaminate.words(data, offsets, lower=True, gaps=decontaminate.MARKS)
        named += any(m[1] == n for m in decontaminate.matches(hashes, np.asarray(first), index))
    assert named >= 58


def test_empty(spark):
    docs, none = table(spark, [(1, "a b c d e f")]), spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).collect()[0]["contaminated"] is False
    assert contamination(docs.where("false"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []


def least_edits(w, p):
    """Fewest edits between ``p`` and any run of ``w``."""
    row = [0] * (len(w) + 1)
    for i, x in enumerate(p, 1):
        previous, row = row, [i] + [0] * len(w)
        for j, y in enumerate(w, 1):
            row[j] = min(previous[j - 1] + (x != y), previous[j] + 1, row[j - 1] + 1)
    return min(row)


def test_free_ends_against_all_lengths(spark):
    rows, items = corpus()
    rows = [x for x in rows if x[0] != 907]  # 20,000 words
    r = random.Random(8)
    for n, (_, text) in enumerate(items):  # documents that are an item without some words, at its ends or scattered, alone and inside a text
        p = text.split()
        most = int(edits_allowed(len(p)))
        gone = set(r.sample(range(len(p)), most))
        scattered = [x for at, x in enumerate(p) if at not in gone]
        for m, cut in enumerate((p[most:], p[: len(p) - most], scattered, [f"q{n}", *scattered, f"r{n}", "s", "t", "u"])):
            rows.append((2_000 + 10 * n + m, " ".join(cut)))
    got = {g["doc_id"]: g for g in contamination(table(spark, rows), spark.createDataFrame(items, "item_id long, text string"), free_ends=True).collect()}
    wanted = {i: [k for k, p in items if len(tokens(p)) >= 5 and least_edits(tokens(t), tokens(p)) <= int(edits_allowed(len(tokens(p))))] for i, t in rows}
    assert {i: g["items"] for i, g in got.items()} == {i: ",".join(map(str, sorted(w))) for i, w in wanted.items()}
    assert all(got[2_000 + 10 * n + m]["contaminated"] for n, (_, t) in enumerate(items) for m in range(4) if len(t.split()) >= 5)


def test_free_match():
    r = random.Random(2)
    for _ in range(300):
        p, w = [r.randrange(4) for _ in range(r.randint(5, 9))], [r.randrange(4) for _ in range(r.randint(1, 25))]
        best = least_edits(w, p)
        found = decontaminate.free_match(p, w, len(p) - 1)
        if found is None:
            assert best == len(p)
            continue
        edits, start, n = found
        assert edits == best and n > 0 and edit_distance(w[start : start + n], p, len(p)) == best
        assert all(edit_distance(w[s : s + m], p, len(p)) > best for s in range(start) for m in range(1, len(w) - s + 1))


def _pairs(r, n, count=200):
    """Items, windows of their size with as many random edits as a match may have, by turns of all kinds."""
    items, windows = [], []
    for _ in range(count):
        item = [r.getrandbits(60) + 1 for _ in range(n)]
        window = list(item)
        for _ in range(int(edits_allowed(n))):
            kind, at = r.choice("sdi"), r.randrange(len(window))
            if kind == "d":
                del window[at]
            else:
                window[at : at + (kind == "s")] = [r.getrandbits(60) + 1]
        items.append(item)
        windows.append((window + [r.getrandbits(60) + 1 for _ in range(n)])[:n])
    return np.array(items, np.uint64), np.array(windows, np.uint64)


def test_samples_meet_for_matches_and_hardly_ever_otherwise():
    r = random.Random(21)
    number = math.ceil(repetitions() / WALKS)
    for n in (5, 8, 15, 38, 59, 200):
        items, windows = _pairs(r, n)
        lengths = np.full(len(items), n)
        met, strangers = np.zeros(len(items), bool), np.zeros(len(items), bool)
        for walk in range(WALKS):
            a, alive = sample_keys(embed(items, lengths, walk), lengths, walk, number)
            b, living = sample_keys(embed(windows, lengths, walk), lengths, walk, number)
            assert alive.mean() > 0.8
            met |= ((a == b) & alive & living).any(axis=1)
            strangers |= ((a == b[::-1]) & alive & living[::-1]).any(axis=1)
        assert met.mean() >= 0.9 and strangers.mean() < 0.05
