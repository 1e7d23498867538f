import random

from samples import awkward, sentence, table, vocabulary

from tidemark.llm.token_counts import at_limits, context_report, encoded_lengths, encoder, length_histogram, length_quantiles, read_vocabulary


def test_report_of_all_limits(spark):
    r = random.Random(6)
    vocab = vocabulary(90)
    rows = [(i, sentence(r, vocab, r.randint(0, 60))) for i in range(150)] + awkward()
    docs = table(spark, rows)
    encode = encoder(read_vocabulary()).encode_ordinary
    lengths = [len(encode(t)) if t else 0 for _, t in rows]
    assert sorted((g["doc_id"] or -1, g["n_tokens"]) for g in encoded_lengths(docs).collect()) == sorted((i or -1, n) for (i, _), n in zip(rows, lengths, strict=True))
    report = context_report(length_histogram(docs)).cache()
    got = {g["n_tokens"]: g for g in report.collect()}
    assert set(got) == set(lengths)
    for limit, g in got.items():
        assert g["docs"] == lengths.count(limit) and g["docs_within"] == sum(x <= limit for x in lengths) and g["docs_beyond"] == sum(x > limit for x in lengths)
        assert g["truncated_total"] == sum(min(x, limit) for x in lengths) and g["cut_tokens"] == sum(max(0, x - limit) for x in lengths)
        assert g["tokens_within"] == sum(x for x in lengths if x <= limit)
    limits = [0, 1, 7, 50, 10_000, 10**7]
    assert {g["limit"]: g["truncated_total"] for g in at_limits(report, limits).collect()} == {m: sum(min(x, m) for x in lengths) for m in limits}
    for g in length_quantiles(report).collect():
        assert g["n_tokens"] == min(x for x in lengths if sum(y <= x for y in lengths) >= g["share"] * len(lengths))


def test_empty(spark):
    assert context_report(length_histogram(table(spark, [(1, "a")]).where("false"))).collect() == []
