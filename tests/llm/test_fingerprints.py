import hashlib
import random
import struct

import xxhash
from pyspark.sql import functions as F
from samples import awkward, sentence, table, vocabulary

from tidemark.llm.fingerprints import anchors, fingerprint, fingerprint_edits, word_hashes


def brute(rows):
    """doc_id -> (n_chars, edited) for rows of distinct ids."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = {}
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        out[doc] = (len(text), text[: len(text) - half] + after[:half])
    return out


def test_edits_and_likeness(spark):
    r = random.Random(9)
    vocab = vocabulary(2_000)
    rows = [(3 * i, sentence(r, vocab, r.randint(0, 200))) for i in range(240)]
    rows = [x for x in rows + awkward() if x[0] != 906] + [(5000, rows[4][1]), (5001, rows[4][1])]
    r.shuffle(rows)
    docs = table(spark, rows)
    got = fingerprint_edits(docs, chunk_rows=17).collect()
    wanted = brute(rows)
    assert len(got) == len(rows)
    for g in got:
        n, edited = wanted[g["doc_id"]]
        assert g["n_chars"] == n and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
    by_id = {g["doc_id"]: g for g in got}
    assert by_id[5000]["near_next"] == 1.0 and by_id[5000]["fingerprint"] == by_id[5001]["fingerprint"] == by_id[12]["fingerprint"]
    alone = {f["doc_id"]: f["fingerprint"] for f in fingerprint(docs).collect()}
    assert alone == {g["doc_id"]: g["fingerprint"] for g in got}
    edited = spark.createDataFrame([(i, e) for i, (_, e) in wanted.items()], "doc_id long, text string")
    assert {f["doc_id"]: f["fingerprint"] for f in fingerprint(edited).collect()} == {g["doc_id"]: g["edited_fingerprint"] for g in got}
    long = [g for g in got if g["n_chars"] > 200 and g["doc_id"] != 5000]
    assert sum(g["near_edited"] > g["near_next"] + 0.15 for g in long) >= 0.98 * len(long)


def test_anchors_do_not_depend_on_their_context(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    df = spark.createDataFrame([(passage,), ("a b c " + passage + " d e",)], "text string").withColumn("h", word_hashes(F.col("text")))
    one, two = ([(a["position"], a["value"]) for a in r["a"]] for r in df.select(anchors(F.col("h")).alias("a")).collect())
    assert set(one) <= {(p - 3, v) for p, v in two} and 10 <= len(one) <= 30


def test_one_row_ties_and_none(spark):
    one = fingerprint_edits(table(spark, [(1, "abcd efgh")])).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abcd abcd").hexdigest()
    assert fingerprint_edits(table(spark, [(1, "a")]).where("false")).collect() == []
    assert len(fingerprint_edits(table(spark, [(1, "a b"), (1, "c d"), (1, "a b"), (None, "x"), (None, None)])).collect()) == 5


def unpacked(fingerprint):
    """(position, value) of every anchor of a fingerprint."""
    at, out = 0, []
    for a in filter(None, fingerprint.split(",")):
        at += int(a[:-8], 16)
        out.append((at, a[-8:]))
    return out


def test_long_texts_keep_all_anchors(spark):
    r = random.Random(4)
    shared = [f"p{i}" for i in range(50)]
    texts = [" ".join([f"{c}{r.random()}" for _ in range(3_000)] + shared + [f"{c}{r.random()}" for _ in range(100 * n)]) for n, c in enumerate("xy")]
    got = {g["doc_id"]: g for g in fingerprint_edits(table(spark, list(enumerate(texts)))).collect()}
    found = [unpacked(got[i]["fingerprint"]) for i in (0, 1)]
    sets = [{v for _, v in f} for f in found]
    assert all(len(f) > 1_200 and [p for p, _ in f] == sorted({p for p, _ in f}) for f in found)
    assert len(sets[0] & sets[1]) >= 10
    for g in got.values():
        edited = {v for _, v in unpacked(g["edited_fingerprint"])}
        assert abs(g["near_next"] - 2 * len(sets[0] & sets[1]) / (len(sets[0]) + len(sets[1]))) < 1e-9
        assert abs(g["near_edited"] - 2 * len(sets[g["doc_id"]] & edited) / (len(sets[g["doc_id"]]) + len(edited))) < 1e-9


def test_one_rule_for_all_lengths(spark):
    """Half of an edited text stays, and so do about half of its anchors, at every length and in text without white space."""
    r = random.Random(6)
    vocab = vocabulary(2_000)
    han = ["".join(chr(r.randint(0x4E00, 0x9F00)) for _ in range(n)) for n in (40, 600, 3_000)]
    code = ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n)) for n in (60, 600, 5_000)]
    plain = [sentence(r, vocab, n) for n in (8, 20, 31, 31, 40, 31, 300, 31, 31, 20, 100, 8, 2_000)]
    rows = list(enumerate([*han, *code, *plain, sentence(r, vocab, 40)]))
    got = {g["doc_id"]: g for g in fingerprint_edits(table(spark, rows)).collect()}
    short = {i for i, t in rows if len(rows[(i + 1) % len(rows)][1]) < len(t) // 2}
    # texts of under 100 characters have few anchors
    assert all(g["near_edited"] > (0.1 if g["n_chars"] < 100 else 0.35) for g in got.values()), "\n".join(str((g["doc_id"], g["n_chars"], g["near_edited"])) for g in got.values())
    assert all(g["near_edited"] < 0.75 for i, g in got.items() if i not in short and g["n_chars"] > 100)


def test_pieces_do_not_depend_on_the_text_around(spark):
    r = random.Random(7)
    blob = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1_000))
    one, two = (g["fingerprint"] for g in fingerprint(table(spark, [(1, blob), (2, "xZ!q" + blob + "end")])).orderBy("doc_id").collect())
    a, b = ({v for _, v in unpacked(f)} for f in (one, two))
    assert len(a & b) >= len(a) - 3 and len(a) > 100


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def plain_pieces(text):
    """Pieces by the rule itself, a character at a time."""
    out, now = [], ""
    for c in text:
        if c in " \t\n\v\f\r":
            out, now = [*out, now], ""
            continue
        now += c
        if len(now) == 3 or ord(c) > 127 or c in "AEIOUYaeiouy0123456789":
            out, now = [*out, now], ""
    return [p for p in [*out, now] if p]


def plain_fingerprint(text, k=4):
    hashes = [signed(xxhash.xxh64(p.encode(), seed=42).intdigest()) for p in plain_pieces(text)]
    found = []
    for i in range(len(hashes) - k + 1):
        run = hashes[i : i + k]
        if min(run) in (run[0], run[-1]):
            value = 42
            for h in run:
                value = xxhash.xxh64(struct.pack("<q", h), seed=value).intdigest()
            found.append((i, f"{value >> 32:08x}"))
    return found, len(hashes)


def test_anchors_against_plain_python(spark):
    r = random.Random(12)
    signs = "bcdXYZaeiou09 \t\n,.-_/\x00\x7fé中ß\xa0 \U0001f600"
    rows = [(i, "".join(r.choice(signs) for _ in range(r.randint(0, 120)))) for i in range(300)] + [(400, " ".join(vocabulary(400)))]
    for f in fingerprint(table(spark, rows)).collect():
        wanted, n = plain_fingerprint(dict(rows)[f["doc_id"]])
        if n >= 4:
            assert unpacked(f["fingerprint"]) == wanted
