import random
import zlib

from samples import awkward, sentence, table, vocabulary

from tidemark.llm.sharding import granted, shard_documents


def corpus():
    r = random.Random(8)
    vocab = vocabulary(80)
    rows = [(i, sentence(r, vocab, r.randint(1, 40))) for i in range(800)]
    rows += [(1000 + i, rows[r.randrange(60)][1]) for i in range(200)]  # small groups
    rows += [(5000 + i, "the very same words in a third of all") for i in range(500)]  # a hot one
    return rows


def test_law_slots_and_groups(spark):
    rows = corpus()
    got = shard_documents(table(spark, rows)).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    total = sum(g["size"] for g in got)
    loads, slots, where = {}, {}, {}
    for g in got:
        raw = text[g["doc_id"]].encode()
        assert g["size"] == len(raw) + 1 and g["text_crc32"] == zlib.crc32(raw) and g["law"] == "bytes" and g["grown_shard"] is None
        loads[g["shard"]] = loads.get(g["shard"], 0) + g["size"]
        slots.setdefault(g["shard"], []).append(g["slot"])
        where.setdefault(text[g["doc_id"]], set()).add(g["shard"])
    assert set(loads) == set(range(16)) and max(abs(b - total / 16) for b in loads.values()) <= 250
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    cut = [t for t, s in where.items() if len(s) > 1]
    hot = "the very same words in a third of all"
    hot_bytes = sum(g["size"] for g in got if text[g["doc_id"]] == hot)
    assert len(cut) <= 17 and len(where[hot]) <= hot_bytes / (total / 16) + 3
    assert sum(len(s) > 1 for t, s in where.items() if t != hot) <= 16
    again = shard_documents(table(spark, rows).repartition(5)).collect()
    assert sorted((g["doc_id"], g["shard"]) for g in got) == sorted((g["doc_id"], g["shard"]) for g in again)


def test_links_are_followed(spark):
    rows = [(i, "x" * 30) if i % 2 else (i, f"text {i}" + "y" * 25) for i in range(400)]
    links = spark.createDataFrame([(i, f"g{i // 8}") for i in range(400)], "doc_id long, hub string")
    got = {g["doc_id"]: g["shard"] for g in shard_documents(table(spark, rows), links, shards=4).collect()}
    cut = sum(len({got[j] for j in range(8 * i, 8 * i + 8)}) > 1 for i in range(50))
    assert cut <= 6


def test_awkward_and_empty(spark):
    got = shard_documents(table(spark, awkward()), shards=3).collect()
    assert len(got) == len(awkward())
    for s in range(3):
        mine = sorted(g["slot"] for g in got if g["shard"] == s)
        assert mine == list(range(len(mine)))
    assert shard_documents(table(spark, [(1, "a")]).where("false")).collect() == []
    assert shard_documents(table(spark, [(1, "a")]), shards=1).collect()[0]["shard"] == 0


def test_quotas():
    share = granted({0: 90, 1: 100, 2: 10}, {(0, 1): 40, (1, 2): 30, (2, 1): 5}, 100)
    assert share[2] == 1.0 and 0 < share[1] <= 30 / 45 + 1e-9


def test_equal_rows_keep_the_law(spark):
    rows = [(i, f"{i} " + "t" * (20 + i % 30)) for i in range(1_000)] + [(None, "the same row again and again")] * 600 + [(7, "twice")] * 2
    got = shard_documents(table(spark, rows).repartition(6)).collect()
    loads = {}
    for g in got:
        loads[g["shard"]] = loads.get(g["shard"], 0) + g["size"]
    assert len(got) == len(rows) and max(abs(b - sum(loads.values()) / 16) for b in loads.values()) <= 52
    hot = {g["shard"] for g in got if g["doc_id"] is None}
    assert len(hot) <= 10  # about five shards of bytes
