import math
import random
import re
from collections import Counter

import numpy as np
from samples import awkward, sentence, table, vocabulary

from tidemark.llm import ranked_search
from tidemark.llm.ranked_search import Best, Items, masks, search, search_block

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, rank string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, n_docs = sum(n for _, _, n in counted), len(counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if i is not None and t is not None}:
        asked, scores = Counter(terms(text)), []
        for i, c, n in counted:
            m = 100 - 25 + 25 * n * n_docs // total
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in asked.items() if t in c)
            if score > 0:
                scores.append((-score, math.inf if i is None else i, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2])[:top])]
    return sorted(out, key=str)


def sample():
    r, vocab = random.Random(11), vocabulary(60) + ["é中", "Straße", "x1", "ÄÖ", "K"]
    docs = [(i, sentence(r, vocab, r.randint(1, 40)).title() + r.choice(["", ".", " a-b_c", "\x7f\x00d"])) for i in range(400)] + awkward()
    docs += [(500 + i, docs[7][1]) for i in range(30)] + [docs[3]] * 3  # ties beyond the top
    items = [(i, sentence(r, vocab, r.randint(1, 12))) for i in range(30)] + [(50, sentence(r, vocabulary(300), 200)), (51, docs[7][1]), (51, "two items of one id a b"), (51, "two items of one id a b")]
    return docs, items + [(52, None), (53, ""), (54, "... \n"), (55, "unheard-of"), (None, "abc"), (56, awkward()[8][1])]


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    docs, items = sample()
    frame, asked = table(spark, docs), spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    wanted = brute(docs, items)
    assert rows(search(frame.repartition(3), asked)) == wanted
    # items in many groups
    monkeypatch.setattr(ranked_search, "GROUP_TERMS", 400)
    assert rows(search(frame, asked)) == wanted


def test_masks_group_documents():
    r = np.random.default_rng(2)
    for n_terms, n_docs in ((1, 9), (70, 100), (8, 64)):
        held = r.random((n_terms, n_docs)) < 0.3
        bits, order, starts = masks(np.packbits(held, axis=1), n_docs)
        assert sorted(order) == [d for d in range(n_docs) if held[:, d].any()]
        assert len({tuple(b) for b in bits}) == len(bits)
        for g, mask in enumerate(bits):
            assert all((held[:, d] == mask).all() for d in order[starts[g] : starts[g + 1]])


def test_bounds_leave_documents_unscored():
    r = random.Random(5)
    vocab = vocabulary(80)
    items = Items([(1, " ".join(vocab[:12]).encode())])
    weights = np.arange(100, 112)
    texts = [[r.choice(vocab) for _ in range(30)] for _ in range(4_000)]
    rows = []
    for i, t in enumerate(texts):
        held = sorted((items.numbers[w.encode()], c) for w, c in Counter(t).items() if w.encode() in items.numbers)
        rows.append((i, i, len(t), np.array([h for h, _ in held], "<u4").tobytes(), np.array([c for _, c in held], "<u4").tobytes()))
    best = [Best(20)]
    scored, met = search_block(tuple(zip(*rows, strict=True)), items, weights, 4_000, 120_000, best)
    assert 0 < scored < met / 2
    every = sorted((-sum(int(weights[t]) * (10**9 * int(c) // (1000 * int(c) + 12 * 100)) for t, c in zip(np.frombuffer(h, "<u4"), np.frombuffer(f, "<u4"), strict=True)), i) for i, _, _, h, f in rows)
    assert [(int(a), int(b)) for a, b, _ in best[0].rows] == every[:20]


def test_empty(spark):
    docs, items = sample()
    frame, asked = table(spark, docs), spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    assert search(frame.where("false"), asked).collect() == []
    assert search(frame, asked.where("false")).collect() == []
    assert search(frame, asked.where("item_id >= 52 AND item_id <= 55")).collect() == []
