import random

import numpy as np
import pytest
from samples import awkward, sentence, table, vocabulary, words

from tidemark.llm import sketches, substring_dedup
from tidemark.llm.substring_dedup import remove_repeats


def brute(rows, length):
    rank = lambda r: (r[0] is None, r[0] or 0)
    first, out = {}, []
    ordered = sorted({(i, t or "") for i, t in rows}, key=rank)
    lists = {(i, t): words(t) for i, t in ordered}
    for key, w in lists.items():
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), (key, s))
    for i, t in rows:
        key, w = (i, t or ""), words(t)
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] != (key, s):
                gone[s : s + length] = [True] * length
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.fixture
def rows():
    r = random.Random(4)
    vocab = vocabulary(300)
    shared = [sentence(r, vocab, n) for n in (5, 12, 30, 60)]
    out = []
    for i in range(200):
        parts = [sentence(r, vocab, r.randint(0, 50))] + [r.choice(shared) for _ in range(r.randint(0, 3))] + [sentence(r, vocab, r.randint(0, 9))]
        out.append((1000 - i, r.choice([" ", "\n", "  "]).join(parts)))
    out += [(2000 + i, out[7][1]) for i in range(40)]  # many copies
    return out + [(3000, "a b " * 400)] + awkward()


def test_against_brute_force(spark, rows, monkeypatch):
    for length in (5, 20):
        got = remove_repeats(table(spark, rows).repartition(5), length).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute(rows, length), key=str)


def test_small_buckets_and_flushes(spark, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BUCKET_WINDOWS", 500)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 4_000)
    got = remove_repeats(table(spark, rows).repartition(9), 5).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows, 5), key=str)


def test_empty(spark):
    assert remove_repeats(table(spark, [(1, "a")]).where("false")).collect() == []


def test_sketch_never_too_low(spark, monkeypatch):
    r = np.random.default_rng(1)
    values = r.integers(0, 4_000, 6_000).astype(np.int64)
    rows = spark.createDataFrame([(int(v),) for v in values], "v long").repartition(6)
    monkeypatch.setattr(sketches, "FAN_IN", 2)
    merged = sketches.sketch_repeats(rows, lambda b: iter([b.column("v").to_numpy().view(np.uint64)]), 20, 6_000).value
    found = sketches.may_repeat(np.arange(4_000, dtype=np.uint64), merged, 20)
    counts = np.bincount(values, minlength=4_000)
    assert found[counts > 1].all() and found[counts == 1].mean() < 0.05 and found[counts == 0].mean() < 0.05


def thue_morse(n):
    """A word and its complement for which sums of byte values times powers of a base agree modulo 2**64."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_one_pattern_are_told_apart(spark):
    one, other = thue_morse(4_096)
    rest = " ".join(f"w{i}" for i in range(19))
    got = {g["doc_id"]: g["n_removed"] for g in remove_repeats(table(spark, [(1, f"{rest} {one}"), (2, f"{rest} {other}"), (3, f"{rest} {one}")])).collect()}
    assert got == {1: 0, 2: 0, 3: 20}
