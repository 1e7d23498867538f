"""Ranked lexical search by presence masks.

Pass one finds, per document, the terms that any item asks for; these hits are written once, packed, and counted. Pass two reads blocks of
hits. In a block every term is a bitmap over documents; the bitmaps of an item's terms, read across, give each document the
mask of terms it holds, and documents of one mask form a group. The bound of a mask is the sum of the largest impacts its terms
have in the block. Masks are evaluated by descending bound until the next bound lies below the item's worst kept score,
so no document that could rank is left out. Tasks send their best documents of each item; a last step ranks those.

Terms are compared as bytes, never by hashes. Items are taken in groups of a bounded number of terms, each a broadcast of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, ranked, table
from tidemark.session import stage

TOP = 20
BLOCK = 4_096  # documents of a block, at most
BLOCK_HITS = 1 << 20  # hits of a block, but for one document
GROUP_TERMS = 1_000_000  # terms of items, repeats included, that are broadcast at a time; a larger item goes alone
GROUP_BYTES = 64 << 20  # texts of items that the driver reads at a time, likewise
CHUNK = 256  # documents scored between two looks at the bounds
SALTS = 32
LAST = 2**63 - 1
# Bytes of terms: ASCII letters and digits, and all bytes of other characters. A-Z are lower-cased, the rest separates.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_HITS = pa.schema([("place", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tf", pa.binary())])


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TERMS).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """Terms of a group of items: their numbers, and per item the numbers it asks for with their repeats."""

    def __init__(self, texts: list[tuple[int, bytes]]):
        self.numbers: dict[bytes, int] = {}
        self.asked: list[tuple[int, np.ndarray, np.ndarray]] = []
        for item, text in texts:
            counts = Counter(terms(text))
            own = np.array([self.numbers.setdefault(t, len(self.numbers)) for t in counts], np.int64)
            if len(own):
                self.asked.append((item, own, np.array(list(counts.values()), np.int64)))


def _find(batches: Iterator[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Per document that has terms: its number of terms, and of those asked for the numbers and occurrences."""
    for batch in batches:
        out = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
            found = terms(text.as_py())
            if found:
                held = {numbers[t]: c for t, c in Counter(found).items() if t in numbers}
                ids = np.fromiter(held, "<u4", len(held))
                order = np.argsort(ids)
                tf = np.fromiter(held.values(), "<u4", len(held))[order]
                out.append((LAST if doc is None else doc, doc, len(found), ids[order].tobytes(), tf.tobytes()))
        columns = zip(*out, strict=True) if out else [[]] * len(_HITS)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _HITS.types, strict=True)], schema=_HITS)


def _count(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """Of a task: per term the documents that hold it; under the number -1 all documents and all their terms."""
    df, docs, total = np.zeros(n_terms, np.int64), 0, 0
    for batch in batches:
        docs += batch.num_rows
        total += sum(batch.column("n").to_pylist())
        held = b"".join(batch.column("terms").to_pylist())
        df += np.bincount(np.frombuffer(held, "<u4"), minlength=n_terms)
    term = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(term, -1)), pa.array(np.append(df[term], docs)), pa.array(np.append(np.zeros(len(term), np.int64), total))], ["term", "df", "total"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list, list]]:
    rows, hits = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and (len(rows) >= BLOCK or hits + len(row[3]) // 4 > BLOCK_HITS):
                yield tuple(zip(*rows, strict=True))
                rows, hits = [], 0
            rows.append(row)
            hits += len(row[3]) // 4
    if rows:
        yield tuple(zip(*rows, strict=True))


class Best:
    """The best documents of one item so far: highest score, then least place, as rows of (-score, place, whether an id)."""

    def __init__(self, top: int):
        self.top, self.rows = top, np.empty((0, 3), np.int64)

    def least(self) -> int:
        """A score below this cannot enter; one equal to it can."""
        return int(-self.rows[-1, 0]) if len(self.rows) == self.top else 1

    def add(self, score: np.ndarray, place: np.ndarray, named: np.ndarray) -> None:
        new = np.column_stack([-score, place, named])[score >= self.least()]
        if len(new):
            rows = np.concatenate([self.rows, new])
            self.rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))[: self.top]]


def masks(bitmaps: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From bitmaps over documents, one row per term: the distinct masks of terms, bits in rows, and documents in groups.

    The result is ``masks, order, starts``: group ``g`` has the documents ``order[starts[g]:starts[g + 1]]``. Documents
    without any term are in no group.
    """
    across = np.packbits(np.unpackbits(bitmaps, axis=1, count=n_docs), axis=0).T  # per document the bits of its terms
    wide = np.zeros((n_docs, -(-across.shape[1] // 8) * 8), np.uint8)
    wide[:, : across.shape[1]] = across
    words = wide.view(np.uint64)
    some = np.flatnonzero(words.any(axis=1))
    words = words[some]
    order = np.lexsort(words.T)
    sorted_words = words[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_words[1:] != sorted_words[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    bits = np.unpackbits(sorted_words[starts].view(np.uint8), axis=1, count=len(bitmaps)).astype(bool)
    return bits, some[order], np.append(starts, len(order))


def search_block(block, items: Items, weights: np.ndarray, n_docs: int, total: int, best: list[Best]) -> tuple[int, int]:
    """Rank the documents of a block into ``best``; returns how many (item, document) groups members were scored and met."""
    places, ids, n, held, tf = block
    place = np.array(places, np.int64)
    named = np.array([i is not None for i in ids], np.int64)
    sizes = np.array([len(h) // 4 for h in held])
    first = np.concatenate([[0], np.cumsum(sizes)])
    term, tf = np.frombuffer(b"".join(held), "<u4").astype(np.int64), np.frombuffer(b"".join(tf), "<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(place)), sizes)
    m = np.array([100 - 25 + 25 * x * n_docs // total for x in n], np.int64)
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    by_term = np.argsort(term, kind="stable")
    present, at = np.unique(term[by_term], return_index=True)
    highest = np.zeros(len(weights), np.int64)
    if len(present):
        highest[present] = np.maximum.reduceat(impact[by_term], at)
    row_of = np.full(len(weights), -1)
    row_of[present] = np.arange(len(present))
    bitmaps = np.zeros((len(present), -(-len(place) // 8)), np.uint8)
    np.bitwise_or.at(bitmaps, (row_of[term], doc >> 3), (128 >> (doc & 7)).astype(np.uint8))
    repeats = np.zeros(len(weights), np.int64)
    scored = met = 0
    for (_, asked, times), found in zip(items.asked, best, strict=True):
        mine = asked[row_of[asked] >= 0]
        worth = (highest[asked] * times)[row_of[asked] >= 0]
        if not len(mine) or worth.sum() < found.least():
            continue
        bits, order, starts = masks(bitmaps[row_of[mine]], len(place))
        bound = bits @ worth
        met += len(order)
        repeats[asked] = times
        by_bound = np.argsort(-bound, kind="stable")
        turn = 0
        while turn < len(by_bound) and bound[by_bound[turn]] >= found.least():
            chosen, members = [], 0
            while turn < len(by_bound) and members < CHUNK and bound[by_bound[turn]] >= found.least():
                group = by_bound[turn]
                chosen.append(order[starts[group] : starts[group + 1]])
                members += len(chosen[-1])
                turn += 1
            docs = np.concatenate(chosen)
            scored += len(docs)
            spans = sizes[docs]
            ends = np.cumsum(spans)
            hits = np.arange(ends[-1]) + np.repeat(first[docs] - ends + spans, spans)
            sums = np.concatenate([[0], np.cumsum(impact[hits] * repeats[term[hits]])])
            found.add(sums[ends] - sums[ends - spans], place[docs], named[docs])
        repeats[asked] = 0
    return scored, met


def _search(batches: Iterator[pa.RecordBatch], items: Items, weights: np.ndarray, n_docs: int, total: int, top: int) -> Iterator[pa.RecordBatch]:
    best = [Best(top) for _ in items.asked]
    for block in _blocks(batches):
        search_block(block, items, weights, n_docs, total, best)
    out = [(item, row, place if named else None, place, -score) for row, ((item, _, _), b) in enumerate(zip(items.asked, best, strict=True)) for score, place, named in b.rows.tolist()]
    kinds = [pa.int64()] * 5
    columns = zip(*out, strict=True) if out else [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item_id", "item", "doc_id", "place", "score"])


def _groups(items: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """Items in groups that are small enough for the driver and a broadcast, read one group at a time."""
    least = F.greatest(F.octet_length("text") / GROUP_BYTES, (F.octet_length("text") + 1) / 2 / GROUP_TERMS)
    numbered = stage(ranked(items.withColumn("_load", least), "_n", F.col("item_id"), F.col("text")), "search-items")
    # ranges of 1,024 items get running sums of their sizes, so that the groups need no task that sees all items
    runs = numbered.groupBy(F.floor(F.col("_n") / 1024).alias("_run")).agg(F.sum("_load").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    inside = F.coalesce(F.sum("_load").over(Window.partitionBy("_run").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    dealt = numbered.withColumn("_run", F.floor(F.col("_n") / 1024)).join(runs.select("_run", before.alias("_before")), "_run")
    dealt = stage(dealt.select("item_id", "text", F.floor(F.col("_before") + inside).cast("long").alias("_group")), "search-groups")
    n = (dealt.agg(F.max("_group")).first()[0] or 0) + 1
    for group in range(n):
        rows = dealt.where(F.col("_group") == group).select("item_id", F.col("text").cast("binary").alias("text")).collect()  # bounded
        if rows:
            yield sorted((r["item_id"], bytes(r["text"])) for r in rows)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    ``docs`` (``doc_id, text``) and ``items`` (``item_id, text``) have integer ids; other columns are ignored. Terms are runs of ASCII letters,
    digits and all other characters beyond ASCII, A-Z lower-cased. Scores are integers: see ``weight`` and ``search_block``. Equal
    scores follow ascending ids, null ids last. Every row is a document, so repeated rows are ranked each. Items equal in id and text are one;
    items without an id, without text or without terms have no rows; two items of one id have ranks each. Without rows the result is empty.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    results = None
    for group in _groups(asked):
        known = Items(group)
        sent = spark.sparkContext.broadcast(known)
        hits = stage(docs.mapInArrow(lambda b, sent=sent: _find(b, sent.value.numbers), "place bigint, doc_id bigint, n bigint, terms binary, tf binary"), "search-hits")
        size = max(1, len(known.numbers))
        counts = hits.select("n", "terms").mapInArrow(lambda b, size=size: _count(b, size), "term bigint, df bigint, total bigint").groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        df = {r["term"]: (r["df"], r["total"]) for r in counts.collect()}  # a row per term asked for
        n_docs, total = df.pop(-1, (0, 0))
        weights = np.zeros(size, np.int64)
        for t, (found, _) in df.items():
            weights[t] = weight(n_docs, found)
        settings = spark.sparkContext.broadcast((weights, n_docs, total))
        part = hits.mapInArrow(lambda b, sent=sent, settings=settings: _search(b, sent.value, *settings.value, top), "item_id bigint, item bigint, doc_id bigint, place bigint, score bigint")
        for salt in (F.pmod(F.hash("place", "score"), F.lit(SALTS)), F.lit(0)):
            by = Window.partitionBy("item_id", "item", salt).orderBy(F.col("score").desc(), "place")
            part = part.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
        part = stage(part.select("item_id", "rank", "doc_id", "score"), "search-best")
        results = part if results is None else results.unionByName(part)
    return results if results is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
hits AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM hits, corpus GROUP BY term, docs),
impacts AS (
  SELECT hits.doc_id, hits.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total))) AS impact
  FROM hits JOIN sizes ON hits.doc_id = sizes.doc_id JOIN weights ON hits.term = weights.term, corpus),
scores AS (SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM impacts JOIN asked ON impacts.term = asked.term GROUP BY item_id, doc_id),
best AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM best WHERE rank <= {TOP}
"""


@query("op11_ranked_search", SQL)
def op11(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
