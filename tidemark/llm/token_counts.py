"""Token counts for every context limit from one exact histogram of encoded lengths."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.session import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANGE_BITS = 12
QUANTILES = (0.5, 0.9, 0.99)
MOST_VOCABULARY = 64 << 20  # bytes of a vocabulary file that is sent to the executors


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The rank file, read once on the driver; its size is checked, as executors get a copy."""
    if os.path.getsize(path) > MOST_VOCABULARY:
        raise ValueError(f"a vocabulary of more than {MOST_VOCABULARY} bytes is not sent to executors")
    with open(path, "rb") as f:
        return f.read()


def encoder(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens`` of every whole text; null and empty texts have 0 tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if (t := value.as_py()) else 0 for value in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(lengths, f"doc_id {kind}, n_tokens bigint")


def length_histogram(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``n_tokens, docs``: how many rows encode to each length; written once, so that no report encodes texts again."""
    return stage(encoded_lengths(docs, path).groupBy("n_tokens").agg(F.count("*").alias("docs")), "length-histogram")


def context_report(histogram: DataFrame) -> DataFrame:
    """For each occurring length as context limit: what fits, what is cut and what remains.

    Columns: ``n_tokens`` (the limit), ``docs`` of this length, ``docs_within`` and ``docs_beyond`` the limit, ``tokens_within`` of documents that fit,
    ``truncated_total`` (tokens left if longer documents are cut), ``cut_tokens``, and ``quantile``, the share of documents
    of at most this length. Lengths are summed by ranges of 4,096, so that no task sees more than the lengths of
    one range or the totals of all ranges. Without rows the result is empty.
    """
    rows = histogram.withColumn("_range", F.shiftright("n_tokens", RANGE_BITS))
    totals = rows.groupBy("_range").agg(F.sum("docs").alias("_docs"), F.sum(F.col("docs") * F.col("n_tokens")).alias("_tokens"))
    after, everything = Window.orderBy("_range").rowsBetween(1, Window.unboundedFollowing), Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = totals.select(
        "_range", *(F.coalesce(F.sum(f"_{c}").over(after), F.lit(0)).alias(f"_{c}_after") for c in ("docs", "tokens")), *(F.sum(f"_{c}").over(everything).alias(f"_{c}_all") for c in ("docs", "tokens"))
    )
    inside = Window.partitionBy("_range").orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumns({
        "_d": F.coalesce(F.sum("docs").over(inside), F.lit(0)),
        "_t": F.coalesce(F.sum(F.col("docs") * F.col("n_tokens")).over(inside), F.lit(0)),
    }).join(later, "_range")
    beyond, longer = F.col("_d") + F.col("_docs_after"), F.col("_t") + F.col("_tokens_after")
    return rows.select(
        "n_tokens", "docs", (F.col("_docs_all") - beyond).alias("docs_within"), beyond.alias("docs_beyond"), (F.col("_tokens_all") - longer).alias("tokens_within"),
        (F.col("_tokens_all") - longer + F.col("n_tokens") * beyond).alias("truncated_total"), (longer - F.col("n_tokens") * beyond).alias("cut_tokens"),
        ((F.col("_docs_all") - beyond) / F.col("_docs_all")).alias("quantile"),
    )


def at_limits(report: DataFrame, limits) -> DataFrame:
    """``limit, truncated_total`` for any limits (a few numbers), from the row of the longest length up to each."""
    asked = report.sparkSession.createDataFrame([(int(x),) for x in limits], "limit long")
    upto = report.join(F.broadcast(asked), F.col("n_tokens") <= F.col("limit")).groupBy("limit").agg(F.max(F.struct("n_tokens", "tokens_within", "docs_beyond")).alias("r"))
    total = report.agg(F.sum(F.col("docs") * F.col("n_tokens")).alias("_t"), F.sum("docs").alias("_n"))
    joined = asked.join(upto, "limit", "left").join(F.broadcast(total))
    within, beyond = F.coalesce("r.tokens_within", F.lit(0)), F.coalesce("r.docs_beyond", F.col("_n"))
    return joined.select("limit", F.coalesce(within + F.col("limit") * beyond, F.lit(0)).alias("truncated_total"))


def length_quantiles(report: DataFrame, quantiles=QUANTILES) -> DataFrame:
    """``share, n_tokens``: the least length that at least this share of documents does not exceed."""
    asked = report.sparkSession.createDataFrame([(float(q),) for q in quantiles], "share double")
    return report.join(F.broadcast(asked), F.col("quantile") >= F.col("share")).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


@query("op7_length_histogram")
def op7(spark, sf_dir):
    return context_report(length_histogram(table(spark, sf_dir, "documents")))
