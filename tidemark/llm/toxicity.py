"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled texts, a bounded sample of each, train a few numpy classifiers inside Spark tasks. Their risk
counts unlabelled texts as clean after taking out the share that the class prior says is toxic, and never lets that
part become negative. Every text is then scored whole by the mean of the classifiers, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import query, shield, table
from tidemark.llm.words import MARKS, pieces, text_bytes, words

FEATURE_BITS = 18  # words are hashed to so many bits
MODELS = 3
MOST_POSITIVE = 4_000  # confirmed toxic texts a classifier learns from, about
MOST_UNLABELLED = 12_000  # unlabelled texts a classifier learns from, about
TELLING = 4.0  # standard deviations by which the rates of a word must differ for it to count
STEPS, RATE, SHRINK = 220, 0.1, 1e-4
SEED = 11
FOLDS = 5


def features(piece: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words of every text: the feature numbers, text after text, and where each text's begin."""
    data, offsets = text_bytes(piece.column(column))
    hashes, _, _, first = words(data, offsets, lower=True, gaps=MARKS)
    text = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    found = np.unique((text << np.uint64(FEATURE_BITS)) | (hashes >> np.uint64(64 - FEATURE_BITS)))
    begins = np.searchsorted(found, np.arange(len(first), dtype=np.uint64) << np.uint64(FEATURE_BITS))
    return (found & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64), begins


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts; empty parts sum to 0."""
    upto = np.concatenate([[0.0], np.cumsum(values)])
    return upto[begins[1:]] - upto[begins[:-1]]


def train(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, float]:
    """Weights per feature and bias of a linear classifier with the least non-negative risk.

    The risk is ``prior * toxic as toxic + max(0, unlabelled as clean - prior * toxic as clean)`` with logistic losses;
    while the second part is negative, steps go to raise it. Words count whose rates in the two samples differ by
    ``TELLING`` standard deviations.
    """
    n = len(toxic)
    every = toxic + unlabelled
    begins = np.concatenate([[0], np.cumsum([len(x) for x in every])])
    flat = np.concatenate(every) if every else np.empty(0, np.int64)
    m = len(unlabelled)
    seen = [np.bincount(part, minlength=1 << FEATURE_BITS) for part in (flat[: begins[n]], flat[begins[n] :])]
    pooled = (seen[0] + seen[1]) / (n + m)
    spread = np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    used = np.flatnonzero(np.abs(seen[0] / n - seen[1] / m) > TELLING * spread)
    number = np.full(1 << FEATURE_BITS, -1)
    number[used] = np.arange(len(used))
    kept = number[flat] >= 0
    begins = np.concatenate([[0], np.cumsum(kept)])[begins]
    flat = number[flat[kept]]
    row = np.repeat(np.arange(len(every)), np.diff(begins))
    w, bias = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    moments = [np.zeros(len(used) + 1), np.zeros(len(used) + 1)]
    for step in range(1, STEPS + 1):
        z = np.clip(_sums(w[flat], begins) + bias, -30, 30)
        chance = 1 / (1 + np.exp(-z))
        as_clean = np.logaddexp(0, z)
        if as_clean[n:].mean() >= prior * as_clean[:n].mean():
            slope = np.concatenate([-prior * np.ones(n) / n, chance[n:] / m])  # both losses of a toxic text together
        else:
            slope = np.concatenate([prior * chance[:n] / n, -chance[n:] / m])
        grad = np.append(np.bincount(flat, slope[row], minlength=len(used)) + SHRINK * w, slope.sum())
        moments = [0.9 * moments[0] + 0.1 * grad, 0.999 * moments[1] + 0.001 * grad**2]
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - float(move[-1])
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    weights[used] = w
    return weights, bias


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _within(seed: int, part: float) -> Column:
    """Whether a row belongs to a sample of this share, by its id."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 40)) < int(min(1.0, part) * (1 << 40))


def fit(docs: DataFrame, labels: DataFrame, *, models: int = MODELS, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED, seed: int = SEED):
    """``(weights, biases)`` of the classifiers, or None without a confirmed toxic text among the rows to learn from.

    ``labels`` is (doc_id, toxic); only rows outside the held-out fold are used, of labels as of unlabelled texts. The samples
    are drawn by hashes of ids; their sizes are set by the parameters and do not grow with the tables.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not seen["toxic"]:
        return None
    prior = min(0.5, max(0.001, seen["toxic"] / seen["n"]))
    learn = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~_held_out(F.col("doc_id")))
    total = max(1, learn.select("doc_id").count())
    in_models = [_within(seed + m, most_positive / seen["toxic"]) for m in range(models)]
    chosen = known.where("toxic = 1").select("doc_id", F.array(*(F.when(c, F.lit(m)) for m, c in enumerate(in_models))).alias("toxic_in"))
    chosen = chosen.where(F.size(F.array_compact("toxic_in")) > 0)  # at most about models * most_positive ids
    free = F.array(*(F.when(_within(seed + models + m, most_unlabelled / total), F.lit(m)) for m in range(models)))
    rows = learn.withColumn("free_in", free).join(F.broadcast(chosen), "doc_id", "left")
    uses = F.concat(
        F.transform(F.array_compact(F.coalesce("toxic_in", F.array().cast("array<int>"))), lambda m: F.struct(m.alias("model"), F.lit(1).alias("toxic"))),
        F.transform(F.array_compact("free_in"), lambda m: F.struct(m.alias("model"), F.lit(0).alias("toxic"))),
    )
    rows = rows.select("text", uses.alias("uses")).where(F.size("uses") > 0)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found, begins = features(piece)
                packed = pa.array([found[a:b].astype("<u4").tobytes() for a, b in pairwise(begins)], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column("uses"), packed], ["uses", "features"])

    encoded = rows.mapInArrow(encode, "uses array<struct<model:int,toxic:int>>, features binary").select(F.explode("uses").alias("use"), "features").select("use.*", "features")

    def learn_one(group: pa.Table) -> pa.Table:
        toxic = np.array(group.column("toxic").to_pylist()) == 1
        texts = [np.frombuffer(x, "<u4").astype(np.int64) for x in group.column("features").to_pylist()]
        order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), texts[i].tobytes()))  # sums must not depend on the order of rows
        p, u = ([texts[i] for i in order if toxic[i] == side] for side in (True, False))
        weights, bias = train(p, u, prior) if p and u else (np.zeros(1 << FEATURE_BITS, np.float32), float(np.log(prior / (1 - prior))))
        return pa.table([pa.array([group.column("model")[0].as_py()], pa.int32()), pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], names=["model", "weights", "bias"])

    fitted = encoded.groupBy("model").applyInArrow(learn_one, "model int, weights binary, bias double").orderBy("model").collect()  # a row per classifier
    if not fitted:
        return None
    return np.stack([np.frombuffer(r["weights"], np.float32) for r in fitted]), np.array([r["bias"] for r in fitted])


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``toxicity``, 0 to 1: the mean of the classifiers' chances for the whole text; 0 without a model."""
    if model is None:
        return docs.withColumn("toxicity", F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())])

    def chances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, biases = sent.value
        for batch in batches:
            for piece in pieces(batch):
                found, begins = features(piece)
                z = np.stack([_sums(w[found].astype(np.float64), begins) + b for w, b in zip(weights, biases, strict=True)])
                chance = (1 / (1 + np.exp(-np.clip(z, -30, 30)))).mean(axis=0)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(chance, pa.float64())], [*columns, "toxicity"])

    return docs.mapInArrow(chances, schema)


def toxicity(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    ``docs`` needs ``doc_id, text`` and ``labels`` needs ``doc_id, toxic`` (0, 1 or null); other columns are ignored. A score depends on the
    text alone. Null and empty texts have no words and get the classifiers' base rate. Ids with several labels count as toxic if
    any is; rows without an id are not learned from and not held out. Without a toxic label to learn from all
    scores are 0. Without rows the result is empty.
    """
    rows = docs.select("doc_id", "text")
    scored = score(rows, fit(rows, labels, **settings))
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with their columns, that are not predicted toxic."""
    rows, restore = shield(docs, ("doc_id", "text"))
    return restore(score(rows, fit(rows.select("doc_id", "text"), labels, **settings)).where("toxicity < 0.5"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
