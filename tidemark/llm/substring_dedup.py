"""Removing repeated passages: windows of words, a count-min prefilter, an exact second pass.

Pass one sketches how often windows occur. Pass two sends the windows that may be repeated, and only those, to be grouped by their
96-bit hashes; each group answers with its first occurrence. A last pass deals texts and answers by document and
removes every word that lies in a repeated window which is not the first of its group. Windows estimated to be single are
single, so none is lost; windows wrongly estimated to be repeated are firsts of their own group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.llm.sketches import cell_bits, may_repeat, pack, sketch_repeats, unpack
from tidemark.llm.words import pieces, run_starts, runs, text_bytes, words

WINDOW = 20
BYTES_A_WORD = 6  # to size the sketch and the buckets; nothing depends on it but sizes
BUCKET_WINDOWS = 1 << 20
BUCKET_BYTES = 4 << 20
FLUSH = 1_000_000  # candidate windows a task gathers before it sends them
_FIRST = np.dtype([("doc", "<i8"), ("tie", "<i8"), ("start", "<u4")])


def _windows(batch: pa.RecordBatch, length: int):
    """Per piece of a batch: the piece, its words and windows (``first, index, text, k1``)."""
    for piece in pieces(batch):
        data, offsets = text_bytes(piece.column("text"))
        hashes, _, _, first = words(data, offsets)
        at, text = run_starts(first, length)
        yield piece, data, offsets, hashes, first, at, text, runs(hashes, length)[at]


def _numbers(doc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The place of each (doc, tie) among the distinct ones, in ascending order."""
    order = np.lexsort((tie, doc))
    d, t = doc[order], tie[order]
    new = np.zeros(len(order), np.uint64)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(new)
    return out


def _place(number: np.ndarray, start: np.ndarray) -> np.ndarray:
    return (number << np.uint64(32)) | start.astype(np.uint64)


def _first_of_each(k1: np.ndarray, k2: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Indexes of the least place of each key, by ascending key."""
    order = np.lexsort((place, k2, k1))
    a, b = k1[order], k2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order[new]


_CANDIDATES = "bucket int, steps binary, k2 binary, docs binary, at binary"
_DOC = np.dtype([("doc", "<i8"), ("tie", "<i8")])


def _send_candidates(docs: list[tuple[np.ndarray, ...]], gathered: list[tuple[np.ndarray, ...]], bucket_bits: int) -> pa.RecordBatch:
    """First occurrence in this task of each window, packed by bucket of the hash."""
    doc, tie = (np.concatenate(c) for c in zip(*docs, strict=True))
    k1, k2, row, start = (np.concatenate(c) for c in zip(*gathered, strict=True))
    chosen = _first_of_each(k1, k2, _place(_numbers(doc, tie)[row], start))
    k1, k2, row, start = k1[chosen], k2[chosen], row[chosen], start[chosen]
    bucket = (k1 >> np.uint64(64 - bucket_bits)) if bucket_bits else np.zeros(len(k1), np.uint64)
    borders = np.searchsorted(bucket, np.arange((1 << bucket_bits) + 1, dtype=np.uint64))
    out = []
    for b, (a, z) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
        if a < z:
            used, idx = np.unique(row[a:z], return_inverse=True)
            names = np.empty(len(used), _DOC)
            names["doc"], names["tie"] = doc[used], tie[used]
            at = np.concatenate([idx.astype("<u4"), start[a:z].astype("<u4")])
            steps = np.diff(k1[a:z], prepend=np.uint64(0)).astype("<u8")
            out.append((b, pack(steps), k2[a:z].astype("<u4").tobytes(), pack(names), pack(at)))
    kinds = [pa.int32(), *[pa.binary()] * 4]
    columns = zip(*out, strict=True) if out else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bucket", "steps", "k2", "docs", "at"])


def _firsts(rows: pa.Table, doc_buckets: int) -> pa.Table:
    """The first occurrence of each window of a bucket, packed by bucket of the document."""
    k1s, k2s, docs, row, starts, base = [], [], [], [], [], 0
    for steps, k2, names, at in zip(*(rows.column(c).to_pylist() for c in ("steps", "k2", "docs", "at")), strict=True):
        places, names = unpack(at, "<u4"), unpack(names, _DOC)
        k1s.append(np.cumsum(unpack(steps, "<u8"), dtype=np.uint64))
        k2s.append(np.frombuffer(k2, "<u4"))
        n = len(k2s[-1])
        docs.append(names)
        row.append(places[:n].astype(np.int64) + base)
        starts.append(places[n:])
        base += len(names)
    docs, row, start = np.concatenate(docs), np.concatenate(row), np.concatenate(starts)
    chosen = _first_of_each(np.concatenate(k1s), np.concatenate(k2s), _place(_numbers(docs["doc"], docs["tie"])[row], start))
    found = np.empty(len(chosen), _FIRST)
    found["doc"], found["tie"], found["start"] = docs["doc"][row[chosen]], docs["tie"][row[chosen]], start[chosen]
    bucket = np.mod(found["tie"], doc_buckets)
    order = np.lexsort((found["start"], found["tie"], bucket))
    found, bucket = found[order], bucket[order]
    borders = np.searchsorted(bucket, np.arange(doc_buckets + 1))
    out = [(b, pack(found[a:z])) for b, (a, z) in enumerate(zip(borders[:-1], borders[1:], strict=True)) if a < z]
    return pa.table([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], names=["bucket", "firsts"])


def _keep(left: pa.Table, right: pa.Table, length: int, merged: np.ndarray, bits: int) -> pa.Table:
    """Texts of a bucket without the words that its firsts do not protect."""
    firsts = [unpack(p, _FIRST) for p in right.column("firsts").to_pylist()]
    firsts = np.concatenate(firsts) if firsts else np.empty(0, _FIRST)
    mine = [left.column(c).to_numpy() for c in ("place", "tie")]
    number = _numbers(np.concatenate([mine[0], firsts["doc"]]), np.concatenate([mine[1], firsts["tie"]]))
    number, protected = number[: left.num_rows], np.sort(_place(number[left.num_rows :], firsts["start"]))
    ids, counts, removed, kept, done = [], [], [], [], 0
    for batch in left.to_batches():
        for piece, data, offsets, _, first, at, text, k1 in _windows(batch, length):
            candidate = may_repeat(k1, merged, bits)
            at, text = at[candidate], text[candidate]
            window = _place(number[done + text], at - first[:-1][text])
            if len(protected):
                at = at[protected[np.minimum(np.searchsorted(protected, window), len(protected) - 1)] != window]
            change = np.zeros(int(first[-1]) + 1, np.int32)
            change[at] += 1  # starts are distinct
            change[at + length] -= 1
            keep = np.cumsum(change[:-1]) == 0
            dropped = np.concatenate([[0], np.cumsum(~keep)])
            for i in range(piece.num_rows):
                a, z = first[i], first[i + 1]
                here = data[offsets[i] : offsets[i + 1]].tobytes().split()
                kept.append(b" ".join(compress(here, keep[a:z].tolist()) if dropped[z] > dropped[a] else here).decode())
            ids += piece.column("doc_id").to_pylist()
            counts.append(np.diff(first))
            removed.append(dropped[first[1:]] - dropped[first[:-1]])
            done += piece.num_rows
    sums = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (counts, removed)]
    return pa.table([pa.array(ids, left.schema.field("doc_id").type), *(pa.array(x, pa.int64()) for x in sums), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every text without passages of ``window`` words that started earlier.

    ``docs`` needs ``doc_id`` (an integer) and ``text``; other columns are ignored. Words are runs of anything but ASCII white
    space, unchanged; kept words are joined by a space. Earlier is a smaller id, or the same text further left; null ids come
    last. Rows of equal id follow a hash of their text; rows equal in id and text are one document and lose the same
    words. Null and empty texts have no words and an empty result. Without rows the result is empty.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"place": place, "tie": F.xxhash64(place, F.col("text"))})
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    windows = size // BYTES_A_WORD + 1
    bits = cell_bits(windows // 2)
    merged = sketch_repeats(rows.select("text"), lambda batch: (w[-1] for w in _windows(batch, window)), bits, windows)
    bucket_bits = max(0, math.ceil(math.log2(max(1, windows / 2 / BUCKET_WINDOWS))))
    doc_buckets = max(1, size // BUCKET_BYTES)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, gathered, n, base = [], [], 0, 0
        for batch in batches:
            for piece, _, _, hashes, first, at, text, k1 in _windows(batch, window):
                chosen = may_repeat(k1, merged.value, bits)
                at, text = at[chosen], text[chosen]
                if len(at):
                    docs.append(tuple(piece.column(c).to_numpy() for c in ("place", "tie")))
                    gathered.append((k1[chosen], (runs(hashes, window, 1)[at] >> np.uint64(32)).astype(np.uint32), text + base, at - first[:-1][text]))
                    base += piece.num_rows
                    n += len(at)
                if n >= FLUSH:
                    yield _send_candidates(docs, gathered, bucket_bits)
                    docs, gathered, n, base = [], [], 0, 0
        if n:
            yield _send_candidates(docs, gathered, bucket_bits)

    sent = rows.select("place", "tie", "text").mapInArrow(candidates, _CANDIDATES)
    firsts = sent.groupBy("bucket").applyInArrow(lambda t: _firsts(t, doc_buckets), "bucket int, firsts binary")
    dealt = rows.withColumn("bucket", F.pmod("tie", F.lit(doc_buckets)).cast("int"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = dealt.groupBy("bucket").cogroup(firsts.groupBy("bucket"))
    return joined.applyInArrow(lambda left, right: _keep(left, right, window, merged.value, bits), f"doc_id {kind}, n_words bigint, n_removed bigint, kept string")


@query("op3_remove_repeats")
def op3(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
