"""Near-duplicate classes by bottom-k MinHash sketches of one hash function.

A document's set is its distinct shingles of words; its sketch the ``K`` least of their hashes. Inverted lists of retained values
bring similar documents together, sketches of unions estimate the similarity, exact sets decide.

Lists stay short because only the rarest retained values are listed: documents that share most of their sketches share one of
those. The members of a list are compared with its anchor first, the member with the most frequent values, which is
the hub of a group of copies; classes grow from these links. Then documents that met an anchor but ended in different
classes are compared with each other, in blocks, so that no link between classes is lost, whatever the size of a
group, and links inside a class need no search. Equal sets are one document from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import among, close_meetings, meetings
from tidemark.llm.common import query, shield, table
from tidemark.llm.components import components
from tidemark.llm.sketches import cell_bits, may_repeat, pack, sketch_members, sketch_repeats, unpack
from tidemark.llm.words import mix, pieces, run_starts, runs, text_bytes, words
from tidemark.session import discard, stage

K = 128  # values of a sketch
SHINGLE, SIMILARITY = 5, 80  # words; per cent
DEVIATIONS = 6  # how far chance may take a sketch from its set, in standard deviations
BLOCK = 256  # documents compared with each other at a time


def shingle_sets(piece: pa.RecordBatch, shingle: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingle hashes of every text; a shorter text has one, its whole sequence."""
    data, offsets = text_bytes(piece.column("text"))
    hashes, _, _, first = words(data, offsets, lower=True)
    at, text = run_starts(first, shingle)
    found = runs(hashes, shingle)[at]
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[new], text[new]
    begins = np.searchsorted(text, np.arange(piece.num_rows + 1))
    for i, (a, b) in enumerate(pairwise(begins)):
        n = int(first[i + 1] - first[i])
        if 0 < n < shingle:
            yield mix(runs(hashes[first[i] : first[i + 1]], n) + np.uint64(n))
        else:
            yield found[a:b]


def bound(n: int | np.ndarray, k: int, similarity: int):
    """Least number of retained values that linked sets share, the one with ``n`` values among them.

    The ``k`` least values of the union are a sample of it, at least ``similarity`` of which lies in both sets, but for
    chance. Sets of up to ``k`` values are known whole; a linked set may be larger than ``k`` all the same.
    """
    s = similarity / 100
    sampled = math.floor(k * s - DEVIATIONS * math.sqrt(k * s * (1 - s)))
    n = np.asarray(n)
    small = np.ceil(n - n * (1 - s) / s - 1e-9).astype(np.int64)
    return np.maximum(1, np.where(n >= k, sampled, np.where(n <= math.floor(k * s), np.ceil(n * s - 1e-9).astype(np.int64), np.maximum(small, 1))))


def _bound(n: Column, k: int, similarity: int) -> Column:
    """``bound`` as a column."""
    s = similarity / 100
    sampled = math.floor(k * s - DEVIATIONS * math.sqrt(k * s * (1 - s)))
    whole, small = F.ceil(n * s - 1e-9), F.ceil(n - n * ((1 - s) / s) - 1e-9)
    return F.greatest(F.lit(1), F.when(n >= k, sampled).when(n <= math.floor(k * s), whole).otherwise(small)).cast("int")


def sketches(docs: DataFrame, shingle: int, k: int) -> DataFrame:
    """All columns but ``text``, and ``n, s1, s2, sketch`` of every row: size and 128-bit hash of the set, its ``k`` least values."""
    own = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in own)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                n, s1, s2, least = [], [], [], []
                with np.errstate(over="ignore"):
                    for found in shingle_sets(piece, shingle):
                        n.append(len(found))
                        s1.append(int(mix(found + np.uint64(1)).sum().view(np.int64)) if len(found) else 0)
                        s2.append(int(mix(found + np.uint64(2)).sum().view(np.int64)) if len(found) else 0)
                        least.append(found[:k].astype("<u8").tobytes())
                columns = [pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(least, pa.binary())]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in own), *columns], [*own, "n", "s1", "s2", "sketch"])

    return docs.select(*own, "text").mapInArrow(encode, f"{kinds}, n bigint, s1 bigint, s2 bigint, sketch binary")


def repeated_values(base: DataFrame, firsts: DataFrame, k: int) -> DataFrame:
    """``value, id, bound`` for the retained values of classes that may occur in several sketches.

    ``bound`` is the class's share of retained values that a linked class must have. Rows of ``base`` stand for their class if their
    id may be among ``firsts``; the few others that seem so are copies, and their links join what is joined anyhow.
    """
    counted = base.agg(F.coalesce(F.sum(F.least("n", F.lit(k))), F.lit(0)).alias("values"), F.count("*").alias("rows")).first()
    id_bits, bits = cell_bits(counted["rows"]), cell_bits(counted["values"])
    known = sketch_members(firsts.select("id"), id_bits, counted["rows"])

    def classes(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("id").to_numpy(zero_copy_only=False).view(np.uint64)
        return batch.filter(pa.array(may_repeat(ids, known.value, id_bits)))

    def values_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.frombuffer(b"".join(classes(batch).column("sketch").to_pylist()), "<u8")

    rows = base.select("id", "bound", "sketch")
    merged = sketch_repeats(rows, values_of, bits, counted["values"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(classes, batches):
            lengths = np.array([len(s) // 8 for s in batch.column("sketch").to_pylist()], np.int64)
            values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u8")
            found = may_repeat(values, merged.value, bits)
            row = pa.array(np.repeat(np.arange(batch.num_rows), lengths)[found])
            yield pa.RecordBatch.from_arrays([pa.array(values[found].view(np.int64)), batch.column("id").take(row), batch.column("bound").take(row)], ["value", "id", "bound"])

    return rows.mapInArrow(listed, "value bigint, id bigint, bound int")


def listed_values(base: DataFrame, firsts: DataFrame, k: int) -> DataFrame:
    """``value, id, heat``: the rarest retained values of each class, as many as linked classes cannot all avoid.

    ``heat`` is the sum of how often the class's values are retained; the most of a list marks its anchor.
    """
    values = stage(repeated_values(base, firsts, k), "near-values")
    often = stage(values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1"), "near-often")
    own = Window.partitionBy("id")
    rare = own.orderBy("often", "value")
    listed = values.join(often, "value").withColumns({"repeated": F.count("*").over(own), "heat": F.sum("often").over(own), "place": F.row_number().over(rare)})
    # Values of this class alone come first in the order by frequency and cannot be shared; so many places are taken.
    listed = stage(listed.where(F.col("place") <= F.col("repeated") + 1 - F.col("bound")).select("value", "id", "heat"), "near-lists")
    discard(values, often)
    return listed


def _estimate(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """Common values among the least of the union, and how many of the union they are."""
    union = np.union1d(a, b)[:k]
    common = np.intersect1d(a, b, assume_unique=True)
    return int(np.searchsorted(common, union[-1], side="right")) if len(union) else 0, len(union)


def _may_link(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, k: int, similarity: int) -> bool:
    """Whether sets of these sketches can be linked, but for chance of ``DEVIATIONS``; exact for sets known whole."""
    if 100 * min(n_a, n_b) < similarity * max(n_a, n_b):
        return False
    common, size = _estimate(a, b, k)
    s = similarity / 100
    if n_a <= k and n_b <= k and n_a + n_b - len(np.intersect1d(a, b, assume_unique=True)) <= k:
        return common >= s * size - 1e-9
    return common >= s * size - DEVIATIONS * math.sqrt(size * s * (1 - s))


def pack_set(values: np.ndarray) -> bytes:
    """Ascending values as steps, whose upper bytes are small in large sets."""
    return pack(np.diff(values, prepend=np.uint64(0)).astype("<u8"))


def unpack_set(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, "<u8"), dtype=np.uint64)


def full_sets(texts: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``id, full``: the sets of all texts whose id may be among ``ids``, a written table; ``texts`` (id, text) stay where they are."""
    wanted = among(ids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(wanted(batch)):
                packed = pa.array([pack_set(s) for s in shingle_sets(piece, shingle)], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column("id"), packed], ["id", "full"])

    return texts.mapInArrow(encode, "id bigint, full binary")


def _linked(a: np.ndarray, b: np.ndarray, k: int, similarity: int) -> bool:
    """Whether full sets are linked; their least values, the sketches, rule out most that are not."""
    if not _may_link(a[:k], b[:k], len(a), len(b), k, similarity):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= similarity * (len(a) + len(b) - common)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pairs(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table([pa.array([int(min(p)) for p in found], pa.int64()), pa.array([int(max(p)) for p in found], pa.int64())], schema=_PAIR)


def _from_anchor(group: pa.Table, k: int, similarity: int) -> pa.Table:
    """Links between the anchor of a list and a block of its members."""
    ids, sets = group.column("id").to_pylist(), [unpack_set(x) for x in group.column("full").to_pylist()]
    anchor = group.column("anchor")[0].as_py()
    if anchor not in ids:
        return _pairs([])
    center = sets[ids.index(anchor)]
    return _pairs([(anchor, i) for i, s in zip(ids, sets, strict=True) if i != anchor and _linked(center, s, k, similarity)])


def star_links(stars: DataFrame, sets: DataFrame, k: int, similarity: int) -> DataFrame:
    """Links (a, b) between anchors and members; ``stars`` is (anchor, id, blocks). Every block gets a copy of the anchor."""
    members = stars.where("anchor != id").select("anchor", "id", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    anchors = members.select("anchor", F.col("anchor").alias("id"), "block").distinct()
    met = members.unionByName(anchors).join(sets, "id")
    return met.groupBy("anchor", "block").applyInArrow(lambda t: _from_anchor(t, k, similarity), "a bigint, b bigint")


def lean_sets(sets: DataFrame, k: int) -> DataFrame:
    """``id, n, sketch`` of full sets."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = [unpack_set(x) for x in batch.column("full").to_pylist()]
            columns = [pa.array([len(s) for s in full], pa.int64()), pa.array([s[:k].astype("<u8").tobytes() for s in full], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n", "sketch"])

    return sets.select("id", "full").mapInArrow(encode, "id bigint, n bigint, sketch binary")


def _may_meet(group: pa.Table, least: list[np.ndarray], sizes: np.ndarray, k: int, similarity: int) -> tuple[np.ndarray, ...]:
    """Documents of a block, or of two: ``rows, others``, their numbers of common least values, and which pairs may be links across components."""
    comps, side, same = group.column("component").to_numpy(), group.column("side").to_numpy(), group.column("same")[0].as_py()
    known, column = np.unique(np.concatenate(least), return_inverse=True)
    has = np.zeros((len(least), len(known)), np.float32)
    has[np.repeat(np.arange(len(least)), [len(s) for s in least]), column] = 1
    rows, others = (np.arange(len(least)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    common = has[rows] @ has[others].T
    n, m = sizes[rows][:, None], sizes[others][None]
    may = (comps[rows][:, None] != comps[others][None]) & (100 * np.minimum(n, m) >= similarity * np.maximum(n, m))
    may &= common >= np.maximum(bound(n, k, similarity), bound(m, k, similarity))
    if same:
        may &= rows[:, None] < others[None]
    # sketches that are the sets decide at once
    may &= (n > k) | (m > k) | (100 * common >= similarity * (n + m - common))
    return rows, others, may


def _close(group: pa.Table, k: int, similarity: int) -> np.ndarray:
    """Which documents of a block, or of two, have a partner that their sketches allow."""
    least = [np.frombuffer(x, "<u8") for x in group.column("sketch").to_pylist()]
    rows, others, may = _may_meet(group, least, group.column("n").to_numpy(), k, similarity)
    found = np.zeros(group.num_rows, bool)
    found[rows[may.any(axis=1)]] = True
    found[others[may.any(axis=0)]] = True
    return found


def _across(group: pa.Table, k: int, similarity: int) -> pa.Table:
    """Links between documents of different components of a block, or of two blocks."""
    ids, sets = group.column("id").to_numpy(), [unpack_set(x) for x in group.column("full").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    rows, others, may = _may_meet(group, [s[:k] for s in sets], sizes, k, similarity)
    whole = (sizes[rows][:, None] <= k) & (sizes[others][None] <= k)
    found = [(ids[rows[i]], ids[others[j]]) for i, j in zip(*np.nonzero(may & whole), strict=True)]
    found += [(ids[rows[i]], ids[others[j]]) for i, j in zip(*np.nonzero(may & ~whole), strict=True) if _linked(sets[rows[i]], sets[others[j]], k, similarity)]
    return _pairs(found)


def across_components(stars: DataFrame, labels: DataFrame, sets: DataFrame, k: int, similarity: int) -> DataFrame:
    """Links (a, b) between members of one star that are of different components.

    ``stars`` is (anchor, id, blocks). A star of many members is cut into blocks by hash and every two blocks meet. The anchor has met
    all members before (``star_links``), so it is left out, and with it all stars whose other members are of one component.
    Blocks meet by sketches first; members with a partner whom these allow meet again by full sets.
    """
    members = stars.where("anchor != id").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    members = stage(members, "near-members")
    mixed = members.groupBy("anchor").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("anchor")
    members = members.join(stage(mixed, "near-mixed"), "anchor")
    close = close_meetings(meetings(members), lean_sets(sets, k), lambda t: _close(t, k, similarity))
    wanted = among(close.select("id"))
    sets = sets.select("id", "full").mapInArrow(lambda batches: map(wanted, batches), "id bigint, full binary")
    met = close.join(sets, "id")
    return met.groupBy("anchor", "low", "high").applyInArrow(lambda t: _across(t, k, similarity), "a bigint, b bigint").distinct()


MISSING = 2**63 - 1  # place of rows without an id


def _keys() -> tuple[Column, Column]:
    """What a row is known by: ``place``, its id, and ``id``, a hash of id and text. Rows equal in both are told apart by a number."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(MISSING)).alias("place"), F.xxhash64("doc_id", "text").alias("id")


def _near_rows(docs: DataFrame, shingle: int, similarity: int, k: int) -> tuple[DataFrame, DataFrame]:
    """``place, id, n, component, kept`` of every row of ``docs`` (``component``: the least place), and the table of sketches."""
    rows = docs.select(*_keys(), "text")
    drawn = sketches(rows, shingle, k).withColumn("bound", _bound(F.col("n"), k, similarity))
    drawn = stage(drawn.withColumn("row", F.monotonically_increasing_id()), "near-sketches")
    base = stage(drawn.drop("sketch", "bound"), "near-rows")
    filled = base.where("n > 0")
    # A class of equal sets stands for its rows; its first row is the one it keeps.
    head = F.struct("place", "id", "row")
    firsts = stage(filled.groupBy("s1", "s2", "n").agg(F.min(head).alias("head")).select("s1", "s2", "n", "head.*"), "near-classes")

    lists = listed_values(drawn.where("n > 0"), firsts, k)
    discard(drawn)
    place = F.shiftleft(F.least("heat", F.lit(2**38)), 24) + F.shiftrightunsigned(F.xxhash64("id"), 40)
    anchors = lists.groupBy("value").agg(F.count("*").alias("size"), F.max_by("id", place).alias("anchor")).where("size > 1").select("value", "anchor")
    stars = stage(lists.select("value", "id").join(stage(anchors, "near-anchors"), "value").select("anchor", "id").distinct(), "near-pairs")
    blocks = stars.groupBy("anchor").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    stars = stage(stars.join(stage(blocks, "near-blocks"), "anchor"), "near-stars")
    sets = stage(full_sets(rows.select("id", "text"), stars.select("id"), shingle), "near-sets")
    if sets.count() > sets.select("id").distinct().count():  # equal rows
        sets = stage(sets.dropDuplicates(["id"]), "near-sets")
    links = stage(star_links(stars, sets, k, similarity), "near-links")
    labels = components(links)
    more = stage(across_components(stars, labels, sets, k, similarity), "near-links")
    discard(sets)
    labels = components(links.unionByName(more)).select(F.col("node").alias("id"), F.col("component").alias("label"))

    # Every row by its set: the class, then the first row of the component of the class.
    heads = labels.join(firsts, "id").groupBy("label").agg(F.min(head).alias("head"))
    heads = labels.join(stage(heads, "near-heads"), "label").select("id", "head")
    found = firsts.join(heads, "id", "left").select("s1", "s2", "n", F.coalesce("head.place", "place").alias("component"), F.coalesce("head.row", "row").alias("first"))
    joined = base.select("place", "id", "row", "n", "s1", "s2").join(stage(found, "near-found"), ["s1", "s2", "n"], "left")
    kept = F.col("row") == F.coalesce("first", "row")
    return joined.select("place", "id", "n", F.coalesce("component", "place").alias("component"), kept.alias("kept")), base


def near_classes(docs: DataFrame, *, shingle: int = SHINGLE, similarity: int = SIMILARITY, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    ``docs`` needs ``doc_id`` (an integer) and ``text``; other columns are ignored. A-Z are lower-cased; words are runs of
    anything but ASCII white space. Documents are linked if their sets' intersection is at least ``similarity`` per cent of
    their union; ``component_id`` is the least id reachable. Rows without words, and null texts, have no set, are linked
    with nothing and keep themselves. Every row is a document of its own, whatever its id; ``component_id`` is null
    where no row with an id is reached. One row of each component is ``kept``, one of the least id. Without rows the result is empty.
    """
    found, _ = _near_rows(docs, shingle, similarity, k)
    return found.select(
        F.nullif("place", F.lit(MISSING)).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif("component", F.lit(MISSING)).alias("component_id"), "kept"
    )


def drop_near_copies(docs: DataFrame, *, shingle: int = SHINGLE, similarity: int = SIMILARITY, k: int = K) -> DataFrame:
    """The rows of ``docs``, with their columns, that stand for their component: one row of its least id each."""
    rows, restore = shield(docs, ("doc_id", "text"))
    found, base = _near_rows(rows.select("doc_id", "text"), shingle, similarity, k)
    kept = found.where("kept").select("place", "id").distinct()
    rows = rows.select("*", *_keys())
    equal = stage(base.where("n > 0").groupBy("place", "id").agg(F.count("*").alias("rows")).where("rows > 1").select("place", "id"), "near-equal")
    if not equal.limit(1).count():
        return restore(rows.join(kept, ["place", "id"], "left_semi"))
    # Of rows equal in id and text one stays, chosen by the hash of the other columns.
    kept = stage(kept, "near-kept")
    alone = rows.join(kept.join(equal, ["place", "id"], "left_anti"), ["place", "id"], "left_semi")
    several = rows.join(kept.join(equal, ["place", "id"], "left_semi"), ["place", "id"], "left_semi")
    order = F.xxhash64(*(F.col(f.name) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()))
    one = several.groupBy("place", "id").agg(F.min_by(F.struct(*rows.columns), order).alias("one")).select("one.*")
    return restore(alone.select(*rows.columns).unionByName(one))


@query("op5_near_classes")
def op5(spark, sf_dir):
    return near_classes(table(spark, sf_dir, "documents"), shingle=3, similarity=85)
