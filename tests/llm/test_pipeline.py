import collections

import corpus_pipeline
import duckdb
from test_decontaminate import brute as passages
from test_near_dedup import brute as classes

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {"": {r["doc_id"]: r["text"] for r in docs.collect()}}
    counts = {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF)
        if name != "sharding":
            assert out.columns == columns
        path = corpus_pipeline.stage(out, f"test-{name}")
        rows[name] = {r["doc_id"]: r["text"] for r in path.collect()} if name != "sharding" else None
        counts[name] = collections.Counter(r["doc_id"] for r in path.select("doc_id").collect())
        docs = path
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    found = classes(list(rows["toxicity"].items()), 5, 80)
    assert set(rows["near_dedup"]) == {i for i, (_, c) in found.items() if c == i}
    clean = {i for i, _, _, bad in passages(list(rows["near_dedup"].items()), items) if not bad}
    assert set(rows["decontamination"]) == clean
    assert set(rows["mixing"]) <= clean and all(1 <= n <= 3 for n in counts["mixing"].values())
    assert counts["sharding"] == counts["mixing"]
    labels = duckdb.sql(f"select doc_id from '{SF}/labels.parquet' where toxic = 1").fetchall()
    gone = set(rows[""]) - set(rows["toxicity"])
    assert len(gone) <= 0.3 * len(rows[""]) and sum(i in gone for (i,) in labels) >= 0.5 * len(labels)
