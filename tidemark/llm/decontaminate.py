"""Benchmark passages in documents, found by embedding edit distance into Hamming distance.

Passages and document windows of an item's size are sequences of words. Random walks copy each into a longer sequence so that few
edits make few differences; equal samples of the copies' symbols, repeated to a target recall, name the items that a
window may hold; the word edit distance decides, over passages of any size around the window where ends are free. Windows are embedded where they can match at all: an item cut into
one piece more than the edits allowed leaves a piece whole in every match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import query, shield, table
from tidemark.llm.words import GOLDEN, LOWER, MARKS, mix, pieces, runs, text_bytes, words

MOST_EDITS = 0.2  # of an item's words: a similarity of 0.8
LEAST_WORDS = 5  # shorter items name no passage
BLOCK_BYTES = 16 << 20  # text of the items that executors hold at a time
WALKS = 8  # independent embeddings
SAMPLED = 2  # symbols of an embedding that must agree
AGREEING = 0.3  # share of sampled symbols that agree in a match with the most edits; measured: 0.42 to 0.77, less in longer items
RECALL = 0.999
STRETCH = 3  # symbols of an embedding per word
LIVE = 1.6  # of them, those per word at which nearly all walks are still inside their row: only these are sampled
PAD, BEYOND = np.uint64(0), np.uint64(0x6A09E667F3BCC909)  # symbols after a row's end, and of a window outside its text


def repetitions(recall: float = RECALL, agreeing: float = AGREEING, sampled: int = SAMPLED) -> int:
    """Samples needed for one of them to agree with this probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agreeing**sampled)))


def embed(symbols: np.ndarray, lengths: np.ndarray, walk: int) -> np.ndarray:
    """Random walks along rows of word hashes (padded to one width), one for all rows: ``STRETCH`` symbols per word of the widest.

    At each step the symbol under the walk is copied, and a random bit of step and symbol says whether the walk goes on.
    Past a row's end it copies padding.
    """
    n, width = symbols.shape
    steps = STRETCH * width
    out = np.full((n, steps), PAD, np.uint64)
    at, rows = np.zeros(n, np.int64), np.arange(n)
    with np.errstate(over="ignore"):
        salts = mix(np.arange(1, steps + 1, dtype=np.uint64) * np.uint64(GOLDEN) + np.uint64(walk * 0x10001))
        for step in range(steps):
            live = at < lengths
            here = symbols[rows, np.minimum(at, width - 1)]
            out[live, step] = here[live]
            at += live & (mix(here ^ salts[step]) & np.uint64(1)).astype(bool)
    return out


def sample_keys(embedded: np.ndarray, lengths: np.ndarray, walk: int, number: int, sampled: int = SAMPLED) -> tuple[np.ndarray, np.ndarray]:
    """``number`` keys per row, each of the length and ``sampled`` symbols at random live places of the row's own walk; and which count.

    A key that has sampled padding says nothing about the words and does not count.
    """
    places = np.random.default_rng(1_000 + walk).random((number, sampled))
    at = (places[None] * (LIVE * lengths)[:, None, None]).astype(np.int64)
    picked = embedded[np.arange(len(embedded))[:, None, None], at]
    with np.errstate(over="ignore"):
        key = mix(lengths.astype(np.uint64))[:, None] + np.arange(number, dtype=np.uint64)[None]
        for j in range(sampled):
            key = mix(key * np.uint64(GOLDEN) + picked[:, :, j])
    return key, (picked != PAD).all(axis=2)


def edit_distance(a, b, most: int) -> int:
    """Edits of symbols between two sequences; ``most + 1`` if there are more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        previous, row = row, [most + 1] * (len(b) + 1)
        row[0] = i
        for j in range(low, high + 1):
            row[j] = min(previous[j - 1] + (x != b[j - 1]), previous[j] + 1, row[j - 1] + 1)
        if min(row[low - 1 : high + 1]) > most:
            return most + 1
    return min(row[len(b)], most + 1)


def end_distances(pattern: list[int], text: list[int], anchored: bool = False) -> list[int]:
    """Per position of ``text`` the fewest edits between ``pattern`` and a sequence that ends there.

    The sequence may begin anywhere, or, if ``anchored``, where the text does. A column of distances is two integers with a
    bit per symbol of the pattern.
    """
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    where: dict[int, int] = {}
    for i, x in enumerate(pattern):
        where[x] = where.get(x, 0) | 1 << i
    more, less, distance, out = full, 0, len(pattern), []
    for x in text:
        same = where.get(x, 0)
        vertical = same | less
        flat = (((same & more) + more) ^ more) | same
        up, down = less | ~(flat | more) & full, more & flat
        distance += 1 if up & top else -1 if down & top else 0
        up, down = (up << 1 | anchored) & full, down << 1 & full
        more, less = down | ~(vertical | up) & full, up & vertical
        out.append(distance)
    return out


def free_match(item: list[int], text: list[int], most: int) -> tuple[int, int, int] | None:
    """(edits, start, words) of the best passage of any length: least edits, leftmost, nearest to the item's size."""
    from_start = end_distances(item[::-1], text[::-1])[::-1]
    edits = min(from_start, default=most + 1)
    if edits > most:
        return None
    start = from_start.index(edits)
    lengths = end_distances(item, text[start : start + len(item) + edits], anchored=True)
    return edits, start, min((n for n, d in enumerate(lengths, 1) if d == edits), key=lambda n: abs(n - len(item)))


@dataclass
class Items:
    """A block of benchmark items, as executors hold it."""

    ids: np.ndarray
    symbols: np.ndarray  # word hashes, padded
    lengths: np.ndarray
    whole: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by piece length: hashes (ascending), item, offset
    keys: list[tuple[np.ndarray, np.ndarray]]  # by walk: sample keys (ascending), item


def edits_allowed(length, most: float = MOST_EDITS):
    return np.floor(np.asarray(length) * most + 1e-9).astype(np.int64)


def index_items(rows: list, most: float = MOST_EDITS) -> Items | None:
    """Index (id, text) rows; items of fewer than ``LEAST_WORDS`` words are left out."""
    data, offsets = text_bytes(pa.array([r[1] for r in rows], pa.string()))
    hashes, _, _, first = words(data, offsets, lower=True, gaps=MARKS)
    chosen = [i for i in range(len(rows)) if first[i + 1] - first[i] >= LEAST_WORDS]
    if not chosen:
        return None
    lengths = np.array([first[i + 1] - first[i] for i in chosen])
    symbols = np.full((len(chosen), int(lengths.max())), PAD, np.uint64)
    whole: dict[int, list] = {}
    for n, i in enumerate(chosen):
        own = hashes[first[i] : first[i + 1]]
        symbols[n, : len(own)] = own
        parts = int(edits_allowed(len(own), most)) + 1
        width = len(own) // parts
        found = runs(own, width)
        whole.setdefault(width, []).extend((found[p * width], n, p * width) for p in range(parts))
    pieces_by_width = {}
    for width, found in whole.items():
        h = np.array([x[0] for x in found], np.uint64)
        order = np.argsort(h, kind="stable")
        pieces_by_width[width] = (h[order], *(np.array([x[c] for x in found])[order] for c in (1, 2)))
    keys, number = [], math.ceil(repetitions() / WALKS)
    for walk in range(WALKS):
        k, counts = sample_keys(embed(symbols, lengths, walk), lengths, walk, number)
        item = np.nonzero(counts)[0]
        order = np.argsort(k[counts], kind="stable")
        keys.append((k[counts][order], item[order]))
    return Items(np.array([rows[i][0] for i in chosen]), symbols, lengths, pieces_by_width, keys)


def _spans(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (index into ``values``, index into the ascending ``keys``) of equal entries."""
    low, high = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
    counts = high - low
    index = np.repeat(np.arange(len(values)), counts)
    inner = np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)
    return index, low[index] + inner


def _windows(hashes: np.ndarray, first: np.ndarray, items: Items, most: float, free_ends: bool) -> np.ndarray:
    """Distinct (text, start, words) of windows of an item's size around whole pieces of it.

    With ``free_ends`` windows may reach beyond a text, so that one that lacks the ends of an item still lies as the item does.
    """
    out = []
    for width, (known, item, offset) in items.whole.items():
        found = runs(hashes, width)
        hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found)
        if not len(hit):
            continue
        text = np.searchsorted(first, hit, side="right") - 1
        inside = hit + width <= first[text + 1]
        hit, text = hit[inside], text[inside]
        index, entry = _spans(found[hit], known)
        length, begin = items.lengths[item[entry]], hit[index] - offset[entry]
        low, high = first[text[index]], first[text[index] + 1]
        reach = int(edits_allowed(items.lengths.max(), most))
        for shift in range(-reach, reach + 1):
            start = begin + shift
            fits = abs(shift) <= edits_allowed(length, most)
            if not free_ends:
                fits &= (start >= low) & (start + length <= high)
            out.append(np.stack([text[index][fits], start[fits], length[fits]], axis=1))
    return np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 3), np.int64)


def matches(hashes: np.ndarray, first: np.ndarray, items: Items, most: float = MOST_EDITS, free_ends: bool = False) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, words, edits) of the best passage of each item found in each text: least edits, then leftmost.

    Passages are windows of an item's size, or, with ``free_ends``, of any size around such windows.
    """
    windows = _windows(hashes, first, items, most, free_ends)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    around: dict[tuple[int, int], list[int]] = {}
    for low in range(0, len(windows), 4_096):
        texts, start, length = windows[low : low + 4_096].T
        at = start[:, None] + np.arange(int(length.max()))
        inside = (at >= first[texts][:, None]) & (at < first[texts + 1][:, None])
        symbols = np.where(inside, hashes[np.clip(at, 0, len(hashes) - 1)], BEYOND)
        pairs = set()
        for walk, (known, item) in enumerate(items.keys):
            keys, counts = sample_keys(embed(symbols, length, walk), length, walk, math.ceil(repetitions() / WALKS))
            window = np.nonzero(counts)[0]
            index, entry = _spans(keys[counts], known)
            pairs.update(zip(window[index].tolist(), item[entry].tolist(), strict=True))
        for w, i in sorted(pairs):
            n, text = int(items.lengths[i]), int(texts[w])
            if n != length[w]:
                continue
            allowed = int(edits_allowed(n, most))
            if free_ends:
                around.setdefault((text, i), []).append(int(start[w]))
                continue
            edits = edit_distance(hashes[start[w] : start[w] + n].tolist(), items.symbols[i, :n].tolist(), allowed)
            if edits <= allowed:
                entry = (edits, int(start[w] - first[text]), n)
                best[text, i] = min(best.get((text, i), entry), entry)
    for (text, i), starts in around.items():
        n = int(items.lengths[i])
        allowed = int(edits_allowed(n, most))
        passage, end = items.symbols[i, :n].tolist(), -1
        spans: list[list[int]] = []
        for start in starts:  # ascending; windows widened by the edits allowed, joined where they touch
            low, high = max(start - allowed, int(first[text])), min(start + n + allowed, int(first[text + 1]))
            if low <= end:
                spans[-1][1] = end = max(end, high)
            else:
                spans.append([low, high])
                end = high
        for low, high in spans:
            if found := free_match(passage, hashes[low:high].tolist(), allowed):
                entry = (found[0], low - int(first[text]) + found[1], found[2])
                best[text, i] = min(best.get((text, i), entry), entry)
    return [(text, i, start, n, edits) for (text, i), (edits, start, n) in sorted(best.items())]


_NAMES = ("item_id", "start", "words", "edits")
_FOUND = T.StructField("found", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in _NAMES])))
_ENTRY = pa.list_(pa.struct([(c, pa.int64()) for c in _NAMES]))


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The benchmark in blocks of bounded size, read part by part; null ids and texts are left out, equal rows count once."""
    rows, size = [], 0
    for row in benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item_id", "text").toLocalIterator():
        rows.append((row[0], row[1]))
        size += len(row[1])
        if size >= block_bytes:
            yield from filter(None, [index_items(rows)])
            rows, size = [], 0
    yield from filter(None, [index_items(rows)] if rows else [])


def find_passages(docs: DataFrame, benchmark: DataFrame, *, block_bytes: int = BLOCK_BYTES, free_ends: bool = False) -> DataFrame:
    """``docs`` with ``found``: the items in the text as (item_id, start, words, edits), start in words.

    An item is found where consecutive words differ from it by at most 20 % edits of words: with ``free_ends`` any number of words, else
    as many as the item has, so that words deleted or inserted count twice and a text of fewer words holds nothing. Words are
    lower-cased runs of ASCII letters, digits and all other characters beyond ASCII. ``benchmark`` (item_id, text) is the stated query set;
    it is held in blocks of ``block_bytes`` of text, one pass over the batches for all of them. Null and empty texts
    hold nothing; items of fewer than five words, null items and null ids are ignored. ``docs`` needs ``text`` and must
    not have a column ``found``.
    """
    spark = docs.sparkSession
    held = [spark.sparkContext.broadcast(block) for block in item_blocks(benchmark, block_bytes)]
    columns = docs.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                data, offsets = text_bytes(piece.column("text"))
                hashes, _, _, first = words(data, offsets, lower=True, gaps=MARKS)
                found = [[] for _ in range(piece.num_rows)]
                for block in held:
                    items = block.value
                    for text, i, start, n, edits in matches(hashes, first, items, free_ends=free_ends):
                        found[text].append({"item_id": int(items.ids[i]), "start": start, "words": n, "edits": edits})
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(found, _ENTRY)], [*columns, "found"])

    return docs.mapInArrow(search, T.StructType([*docs.schema.fields, _FOUND]))


def contamination(docs: DataFrame, benchmark: DataFrame, *, free_ends: bool = False) -> DataFrame:
    """``doc_id, n_items, items, contaminated`` of every row of ``docs``; ``items`` is the ids found, ascending, joined by commas.

    ``docs`` needs ``doc_id, text``; other columns are ignored. See ``find_passages`` for what is found. Repeated rows are
    searched each; without rows the result is empty.
    """
    found = find_passages(docs.select("doc_id", "text"), benchmark, free_ends=free_ends)
    ids = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item_id"])))
    return found.select("doc_id", F.size(ids).cast("long").alias("n_items"), F.array_join(ids, ",").alias("items"), (F.size(ids) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, free_ends: bool = False) -> DataFrame:
    """The rows of ``docs``, with their columns, that hold no benchmark passage."""
    rows, restore = shield(docs, ("text",))
    return restore(find_passages(rows, benchmark, free_ends=free_ends).where(F.size("found") == 0))


@query("op4_benchmark_passages")
def op4(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), free_ends=True)
