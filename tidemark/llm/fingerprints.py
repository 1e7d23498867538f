"""Document fingerprints by closed syncmers.

A run of ``K`` pieces is an anchor if the least hash among its pieces stands at either edge. Whether a run is an anchor
depends on the run alone, so a passage keeps its anchors wherever it is moved. The pieces are short groups of characters that
end where their own last character says so, by the same rule in texts of every length: at the end of a word, at an ASCII vowel or
digit, at any character beyond ASCII, and after ``PIECE`` characters. Text without white space is cut as finely as other
text. Every step is a DataFrame expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, table

K = 4  # pieces of an anchor
PIECE = 3  # characters of a piece at most
ENDING = "AEIOUYaeiouy0123456789"  # ASCII characters that end their piece; all others beyond ASCII do too
WHITE = "\t\n\v\f\r "  # ASCII white space
# Classes that list their characters one by one, and repetitions that never go back, match many times faster than ranges.
WITHIN = "[" + "".join(rf"\x{c:02X}" for c in range(128) if chr(c) not in ENDING + WHITE) + "]"
PIECES = rf"{WITHIN}{{0,{PIECE - 1}}}+[^\x20\x09-\x0D]|{WITHIN}{{1,{PIECE - 1}}}+"
CHUNK_ROWS = 500
MOST_CHUNKS = 2**16  # borders of chunks are held by the plan
STEP = 256


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order; empty for null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def anchor_values(hashes: Column, k: int = K) -> Column:
    """Per position the value (32 bits) of the anchor that starts there, else null.

    ``hashes`` must be a column of its own, since each position looks at its neighbours. Sequences of fewer than
    ``k`` have one anchor, the whole, at position 0.
    """

    def at(x, i):
        inner = [F.get(hashes, i + j) for j in range(1, k)]
        edge, middle = F.least(x, inner[-1]), inner[:-1]
        closed = edge <= (F.least(*middle) if len(middle) > 1 else middle[0]) if middle else F.lit(True)
        return F.when(inner[-1].isNotNull() & closed, F.shiftrightunsigned(F.xxhash64(x, *inner), 32))

    whole = F.array(F.shiftrightunsigned(F.xxhash64(hashes), 32))
    return F.when(F.size(hashes) >= k, F.transform(hashes, at)).when(F.size(hashes) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def anchors(hashes: Column, k: int = K) -> Column:
    """Anchors with their place, array of (position, value), for matching passages by position."""
    placed = F.transform(anchor_values(hashes, k), lambda v, i: F.struct(i.alias("position"), v.alias("value")))
    return F.filter(placed, lambda a: a["value"].isNotNull())


def piece_hashes(text: Column) -> Column:
    """Hashes of the pieces of a text, in order; empty for null."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECES), F.lit(0)), lambda x: F.xxhash64(x))


def values(anchored: Column) -> Column:
    """Distinct values of anchors."""
    return F.array_distinct(F.transform(anchored, lambda a: a["value"]))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common values of two sets over the values of both, 0 to 1; 1 if both are empty. ``a`` and ``b`` are distinct values."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(2 * F.size(F.array_intersect(a, b)) / both)


def as_text(anchored: Column) -> Column:
    """All anchors in order, joined by commas: hexadecimal steps from one position to the next, then 8 digits of value.

    ``anchored`` must be a column of its own, since each anchor looks at the one before.
    """

    def packed(a, i):
        step = a["position"] - F.coalesce(F.get(anchored, i - 1)["position"], F.lit(0))
        return F.lower(F.concat(F.hex(step), F.lpad(F.hex(a["value"]), 8, "0")))

    return F.array_join(F.transform(anchored, packed), ",")


def with_anchors(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``df`` with all anchors of a text and their positions among its pieces."""
    return df.withColumn("_w", piece_hashes(F.col(text))).withColumn(name, anchors(F.col("_w"), k)).drop("_w")


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, fingerprint`` of every row; a null or empty text has the empty fingerprint."""
    return with_anchors(docs.select("doc_id", "text"), "text", "_f", k).select("doc_id", as_text(F.col("_f")).alias("fingerprint"))


def _chunk(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds up to ``doc_id``, found by every 256th bound first; rows without an id come last."""
    if not bounds:
        return F.lit(0)
    every = F.array(*(F.lit(b) for b in bounds[::STEP]))
    fine = F.array(*(F.lit(b) for b in bounds))
    coarse = F.greatest(F.size(F.filter(every, lambda b: b <= doc_id)) - 1, F.lit(0)) * STEP
    inside = F.size(F.filter(F.slice(fine, coarse + 1, STEP), lambda b: b <= doc_id))
    return F.when(doc_id.isNull(), F.lit(len(bounds))).otherwise(coarse + inside)


def with_next(docs: DataFrame, columns: list[str], chunk_rows: int = CHUNK_ROWS, add: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``docs`` with ``next_<c>`` for each of ``columns``: the value of the next row by ascending ``doc_id``, of the first after the last.

    Rows are dealt once, by ranges of ids of about ``chunk_rows`` rows; the first row of a range goes to the range before it
    too. Ids are numbers; null ids come last, and ties follow the hash of the columns of ``docs`` among ``columns``. ``add`` may
    make others of ``columns`` once rows are dealt, so that they are not shuffled; they are kept.
    """
    own = [c for c in columns if c in docs.columns]
    ids = docs.select("doc_id")
    n = ids.count()
    chunks = min(MOST_CHUNKS, max(1, math.ceil(n / chunk_rows)))
    bounds: list[int] = []
    if chunks > 1:
        parts = [i / chunks for i in range(1, chunks)]
        found = ids.agg(F.percentile_approx("doc_id", parts, max(10_000, 4 * chunks)).alias("b")).first()["b"]
        bounds = sorted({int(b) for b in found or []})
    chunk = _chunk(F.col("doc_id"), bounds)
    firsts = {r["c"]: r["f"] for r in ids.groupBy(chunk.alias("c")).agg(F.min("doc_id").alias("f")).collect()}  # a row per chunk
    if not firsts:
        added = add(docs)
        return added.select("*", *(F.lit(None).cast(added.schema[c].dataType).alias(f"next_{c}") for c in columns))
    order = sorted(firsts)
    before = dict(zip(order, [order[-1], *order[:-1]], strict=True))
    slots = range(len(bounds) + 1)
    first = F.get(F.array(*(F.lit(firsts.get(c)).cast("bigint") for c in slots)), F.col("_chunk"))
    previous = F.get(F.array(*(F.lit(before.get(c, 0)) for c in slots)), F.col("_chunk"))
    here = F.struct(F.col("_chunk").alias("chunk"), F.lit(0).alias("wrap"), F.lit(False).alias("guest"))
    guest = F.struct(previous.alias("chunk"), F.when(F.col("_chunk") == order[0], 1).otherwise(0).alias("wrap"), F.lit(True).alias("guest"))
    at = F.explode(F.when(F.col("doc_id").eqNullSafe(first), F.array(here, guest)).otherwise(F.array(here)))
    dealt = docs.withColumn("_chunk", chunk).withColumn("_at", at)
    dealt = dealt.select(*docs.columns, F.col("_at.chunk").alias("_chunk"), F.col("_at.wrap").alias("_wrap"), F.col("_at.guest").alias("_guest"), F.xxhash64(*own).alias("_tie"))
    dealt = add(dealt.repartition("_chunk"))
    ordered = Window.partitionBy("_chunk").orderBy("_wrap", F.col("doc_id").asc_nulls_last(), "_guest", "_tie")
    dealt = dealt.withColumn("_next", F.lead(F.struct(*columns)).over(ordered)).where(~F.col("_guest"))
    kept = [c for c in dealt.columns if c not in ("_chunk", "_wrap", "_guest", "_tie", "_next")]
    return dealt.select(*kept, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in columns))


def fingerprint_edits(docs: DataFrame, *, k: int = K, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and to the next document's.

    Per row of ``docs`` (``doc_id, text``; other columns are ignored): ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``. The edited text has the last half of its code points replaced by the first as many of
    the next document by id. A null text is empty; empty texts have the empty fingerprint, and two of them
    are alike by 1. Fingerprints hold every anchor with its position and likeness compares all of them, whatever the length of the
    texts. Rows of equal id are neighbours in the order of their texts' hashes. A table of one row follows
    itself; without rows the result is empty. Ids are numbers.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = with_next(rows, ["text", "v"], chunk_rows, lambda df: with_anchors(df, "text", "f", k).withColumn("v", values(F.col("f"))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 2)"), F.expr("left(next_text, int(length(text) div 2))"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "f", "v", "next_v", F.when(half > 0, edited).otherwise(F.col("text")).alias("edited"))
    rows = with_anchors(rows, "edited", "e", k)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("f")).alias("fingerprint"), as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("v"), values(F.col("e"))).alias("near_edited"), likeness(F.col("v"), F.col("next_v")).alias("near_next"),
    )


@query("op9_closed_syncmers")
def op9(spark, sf_dir):
    return fingerprint_edits(table(spark, sf_dir, "documents"))
