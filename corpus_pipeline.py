"""A corpus prepared for training: toxic texts out, one of each near-duplicate class, no benchmark passages, mixed, sharded.

``STAGES`` are functions ``(spark, docs, sf_dir) -> DataFrame``. Each works on all rows of the one before; all but the last
return the columns of ``documents``. ``run`` writes each result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.mixing import cyclic_weights, take_mix
from tidemark.llm.near_dedup import drop_near_copies
from tidemark.llm.sharding import shard_documents
from tidemark.llm.toxicity import drop_toxic
from tidemark.session import stage

WEIGHTS = (5, 2, 1)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by classifiers learned from ``labels``."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each class of near duplicates: shingles of five words, similarity 0.8."""
    return drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), free_ends=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1, repeating, at most three epochs; a row appears as often as the mix takes it."""
    return take_mix(docs, cyclic_weights(WEIGHTS))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and shard of every row of the mix; repeats of a document stay together as far as sizes allow."""
    return shard_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Learned scores, sketches and propagation have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
