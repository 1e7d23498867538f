import random
import zlib

import numpy as np
from samples import awkward, sentence, table, vocabulary

from tidemark.llm.toxicity import drop_toxic, toxicity, train

BAD = ["vile", "rotten", "foul"]


def corpus(n=900, seed=2):
    r = random.Random(seed)
    vocab = vocabulary(400)
    rows, toxic = [], {}
    for i in range(n):
        text = sentence(r, vocab, r.randint(10, 120)).split()
        toxic[i] = int(r.random() < 0.15)
        for _ in range(3 if toxic[i] else 0):
            text.insert(r.randrange(len(text)), r.choice(BAD) + r.choice(["", ",", "."]))
        rows.append((i, " ".join(text)))
    return rows, toxic


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy_and_blindness(spark):
    rows, toxic = corpus()
    docs = table(spark, rows + awkward())
    pairs = [(i, t) for i, t in toxic.items() if i % 2 or t] + [(None, 1), (3, None)]
    labels = spark.createDataFrame(pairs, "doc_id long, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(awkward())
    assert all(g["held_out"] == (g["doc_id"] is not None and held(g["doc_id"])) and 0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.5) for g in got)
    right = [g["predicted"] == toxic[g["doc_id"]] for g in got if g["held_out"] and g["doc_id"] in toxic]
    assert np.mean(right) > 0.97
    # Labels of the held-out fold say nothing, and a score is the text's alone.
    turned = spark.createDataFrame([(i, 1 - t if i is not None and t is not None and held(i) else t) for i, t in pairs], "doc_id long, toxic int")
    assert sorted(map(str, toxicity(docs, turned).collect())) == sorted(map(str, got))
    by_text = {}
    texts = {**dict(rows), **dict(awkward())}
    for g in got:
        assert by_text.setdefault(texts[g["doc_id"]] or "", g["score"]) == g["score"]
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 - g["predicted"] for g in got)


def test_without_labels_or_rows(spark):
    docs = table(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert [g["score"] for g in toxicity(docs, none).collect()] == [0.0, 0.0]
    assert toxicity(docs.where("false"), spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")).collect() == []


def test_risk_is_not_negative():
    r = np.random.default_rng(0)
    toxic = [np.array([1, *r.integers(10, 60, 5)]) for _ in range(60)]
    free = [np.array([*([1] if i % 10 == 0 else []), *r.integers(10, 60, 5)]) for i in range(600)]
    w, b = train([np.unique(x) for x in toxic], [np.unique(x) for x in free], 0.1)
    scores = [w[np.unique(x)].sum() + b > 0 for x in free]
    assert np.mean([s == (i % 10 == 0) for i, s in enumerate(scores)]) > 0.97
