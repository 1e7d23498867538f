"""Hard negatives by zone maps over blocks of vectors in Hilbert order.

Vectors are sorted by label and place on a Hilbert curve through their most spread dimensions and written as Parquet, a block of
neighbours per row, with the least and largest value of every dimension, the range of labels and the least id: its zone map.
A vector's product with anything in a box lies between two sums of products with the box's sides, so the zone maps alone tell which
blocks can hold what an anchor looks for, and only those are read.

Each search reads twice. First every anchor reads the few blocks with the best bounds, which gives it a score to beat. Then it reads
all blocks whose bounds reach that score, inside its window. Nothing is approximate. Anchors and blocks meet in
bounded groups of both: a task holds one group of anchors and one chunk of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.session import stage

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score: the window of a hard negative's
SCALE = 256  # components become whole numbers of this fraction
LARGEST = 2**31  # of such a number's size; rows beyond it take no part
CURVE_DIMENSIONS, CURVE_BITS = 12, 5  # of the Hilbert curve
BLOCK = 256  # vectors of a block
SEEDS = 4  # blocks that an anchor reads first
GROUP = 8_192  # anchors that meet a chunk of blocks at a time
MOST_CHUNK, TASKS = 256, 64  # blocks of a chunk at most; chunks to aim for while they can be smaller
ZONES = 8_192  # zone maps that meet a group of anchors at a time
SALTS = 32
LAST = 2**63 - 1
_POINTS = "rid bigint, vec_id bigint, label bigint, vector binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of whole coordinates below ``2 ** bits``; rows times bits must fit 62 bits.

    From the highest bit down, coordinates are reflected and exchanged as the curve turns in each octant (Gray code order).
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            turned = (x[i] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        carry ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= carry
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two whole-number matrices, exact: by floats where their sums are, else by 64-bit integers."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if largest < 2**63:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    raise ValueError("scores do not fit 64 bits")


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest product of each anchor with anything in each box (interval arithmetic)."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _points(rows: DataFrame) -> DataFrame:
    """Rows that take part: ``rid, vec_id, label, vector``, components as 32-bit whole numbers; shorter vectors end in zeros."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < float(LARGEST)))  # false for NaN and infinity too
    sound = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    sound = sound.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), v.alias("v"))
    width = sound.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.zeros((batch.num_rows, width), "<i4")
            ends = np.cumsum(sizes)
            flat[np.repeat(np.arange(len(sizes)), sizes), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "vec_id", "label")), pa.array([r.tobytes() for r in flat], pa.binary())], ["rid", "vec_id", "label", "vector"])

    return stage(sound.mapInArrow(pack, _POINTS), "negatives-points")


def _matrix(column) -> np.ndarray:
    values = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return np.frombuffer(b"".join(values), "<i4").reshape(len(values), -1) if values else np.empty((0, 0), np.int32)


def _spreads(points: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every dimension, from one row of sums per task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, 0.0, 0.0
        for batch in batches:
            m = _matrix(batch.column(0)).astype(np.float64)
            n, s, q = n + len(m), s + m.sum(axis=0), q + (m * m).sum(axis=0)
        if n:
            d = np.arange(len(s), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(np.full(len(d), float(n))), pa.array(s), pa.array(q)], ["d", "n", "s", "q"])

    rows = points.select("vector").mapInArrow(sums, "d bigint, n double, s double, q double").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("d").collect()
    n, s, q = (np.array([r[c] for r in rows]) for c in "nsq")
    return s / n, np.sqrt(np.maximum(q / n - (s / n) ** 2, 0))


_BLOCKS = "block bigint, low binary, high binary, label_low bigint, label_high bigint, id_low bigint, rids binary, ids binary, named binary, labels binary, vectors binary"


def lay_out(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """The vectors as Parquet, a row per block of neighbours: numbers, ids, labels and vectors packed, and the zone map."""
    mean, deviation = _spreads(points)
    used = np.sort(np.argsort(-deviation, kind="stable")[:CURVE_DIMENSIONS])
    cells = 1 << CURVE_BITS

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("vector"))
            key = np.zeros(len(m), np.int64)
            if len(m) and len(used):
                at = (m[:, used] - mean[used]) / np.maximum(deviation[used], 1e-9) * (cells / 6) + cells / 2  # three deviations to either side
                key = hilbert_keys(np.clip(at, 0, cells - 1).astype(np.int64), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], ["rid", "vec_id", "label", "vector", "key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        rest: list[pa.RecordBatch] = []
        held = 0

        def row(t: pa.Table, number: int):
            m, labels = _matrix(t.column("vector")), t.column("label").to_numpy()
            ids = pc.fill_null(t.column("vec_id"), LAST).to_numpy()
            named = t.column("vec_id").is_valid().to_numpy()
            values = [
                (part << 32) + number, m.min(axis=0).tobytes(), m.max(axis=0).tobytes(), int(labels.min()), int(labels.max()), int(ids.min()), t.column("rid").to_numpy().tobytes(),
                ids.tobytes(), named.tobytes(), labels.tobytes(), m.tobytes(),
            ]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            rest.append(batch)
            held += batch.num_rows
            if held >= block:
                whole = pa.Table.from_batches(rest)
                for start in range(0, held - block + 1, block):
                    yield row(whole.slice(start, block), number)
                    number += 1
                rest = whole.slice(held - held % block).to_batches()
                held %= block
        if held:
            yield row(pa.Table.from_batches(rest), number)

    keyed = points.mapInArrow(keys, _POINTS + ", key bigint")
    order = ["label", "key", F.xxhash64("vector"), F.xxhash64("vec_id", "rid")]  # equal vectors lie together, and are still spread over ranges
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("rid", "vec_id", "label", "vector")
    return stage(dealt.mapInArrow(pack, _BLOCKS), "negatives-blocks")


_ANCHORS = "rid bigint, vec_id bigint, named boolean, label bigint, vector binary, home bigint"


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """A row per vector whose id is divisible by ``every``; ``home`` is its run of 16 blocks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, rids, ids, named, labels, vectors in zip(*(batch.column(c).to_pylist() for c in ("block", "rids", "ids", "named", "labels", "vectors")), strict=True):
                ids, named = np.frombuffer(ids, np.int64), np.frombuffer(named, bool)
                chosen = np.flatnonzero(named & (ids % every == 0))
                m = np.frombuffer(vectors, "<i4").reshape(len(ids), -1)
                columns = [pa.array(np.frombuffer(rids, np.int64)[chosen]), pa.array(ids[chosen]), pa.array(named[chosen]), pa.array(np.frombuffer(labels, np.int64)[chosen])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([m[i].tobytes() for i in chosen], pa.binary()), pa.array(np.full(len(chosen), b >> 4))], [c.split()[0] for c in _ANCHORS.split(", ")])

    return stage(blocks.mapInArrow(unpack, _ANCHORS), "negatives-anchors")


# What an anchor looks for, in lists of equal length: ``kind`` numbers its windows, ``floor`` and ``ceiling`` are scores, ``last`` is the
# largest id that still helps at the score ``floor``. ``same`` asks for its own label.
_WANTS = "kinds array<int>, floors array<bigint>, ceilings array<bigint>, lasts array<bigint>"


def _choose(same: bool, seeds: int):
    """For anchors of a group and zone maps of a segment: the blocks to read (with ``seeds`` those with the best bounds)."""

    def chosen(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"group": [], "block": [], "rid": [], "gap": []})
        least, most = bounds(_matrix(left["vector"]), _matrix(right["low"]), _matrix(right["high"]))
        label, low, high = left["label"].to_numpy()[:, None], right["label_low"].to_numpy(), right["label_high"].to_numpy()
        fits = (low <= label) & (label <= high) if same else (low != label) | (high != label)
        need, gap = np.zeros(least.shape, bool), np.full(least.shape, np.inf)
        first = right["id_low"].to_numpy()
        for i, (floors, ceilings, lasts) in enumerate(zip(left["floors"], left["ceilings"], left["lasts"], strict=True)):
            for floor, ceiling, last in zip(floors, ceilings, lasts, strict=True):
                here = fits[i] & (least[i] <= ceiling) & ((most[i] > floor) | ((most[i] == floor) & (first <= last)))
                need[i] |= here
                if seeds:  # best is a box whose middle is near the ceiling; without a ceiling, one that reaches highest
                    middle = (least[i] + most[i]) / 2.0
                    gap[i] = np.where(here, np.minimum(gap[i], np.abs(ceiling - middle) if ceiling < LAST else LAST / 2 - most[i]), gap[i])
        if seeds:
            rank = np.argsort(np.argsort(gap, axis=1, kind="stable"), axis=1)
            need &= rank < seeds
            row, block = np.nonzero(need)
            return pd.DataFrame({"group": left["group"].to_numpy()[row], "block": right["block"].to_numpy()[block], "rid": left["rid"].to_numpy()[row], "gap": gap[row, block]})
        block = np.flatnonzero(need.any(axis=0))
        return pd.DataFrame({"group": left["group"].iloc[0], "block": right["block"].to_numpy()[block], "rid": 0, "gap": 0.0})

    return chosen


def _score(same: bool, keep: int):
    """For anchors of a group and a chunk of blocks: the best ``keep`` rows inside each of an anchor's windows.

    A block with ``askers`` is scored for those anchors alone, and gives its own best; the others are scored together for all anchors.
    """

    def best(out, blocks: pd.DataFrame, anchors: pd.DataFrame) -> None:
        ids, rids, labels = (np.frombuffer(b"".join(blocks[c]), np.int64) for c in ("ids", "rids", "labels"))
        named = np.frombuffer(b"".join(blocks["named"]), bool)
        m = np.frombuffer(b"".join(blocks["vectors"]), "<i4").reshape(len(ids), -1)
        v = _matrix(anchors["vector"])
        wants = list(zip(anchors["rid"], anchors["label"], anchors["kinds"], anchors["floors"], anchors["ceilings"], anchors["lasts"], strict=True))
        for start in range(0, len(wants), 256):
            score = products(v[start : start + 256], m)
            for values, (rid, label, kinds, floors, ceilings, lasts) in zip(score, wants[start : start + 256], strict=True):
                open_ = ((labels == label) & (rids != rid)) if same else labels != label
                for kind, floor, ceiling, last in zip(kinds, floors, ceilings, lasts, strict=True):
                    at = np.flatnonzero(open_ & (values <= ceiling) & ((values > floor) | ((values == floor) & (ids <= last))))
                    if len(at) > 4 * keep:  # all that reach the score of the last one kept
                        at = at[values[at] >= np.partition(values[at], len(at) - keep)[len(at) - keep]]
                    at = at[np.lexsort((rids[at], ids[at], -values[at]))[:keep]]
                    if len(at):
                        out.append((np.full(len(at), rid), np.full(len(at), kind), values[at], ids[at], named[at], rids[at]))

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(left) and len(right):
            some = right["askers"].notna()
            for i in np.flatnonzero(some):
                best(out, right.iloc[i : i + 1], left[left["rid"].isin(right["askers"].iloc[i])])
            if not some.all():
                best(out, right[~some], left)
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[]] * 6
        return pd.DataFrame(dict(zip(("rid", "kind", "score", "id", "named", "other"), columns, strict=True)))

    return scored


def _cogroup(left: DataFrame, right: DataFrame, keys: list[str], function, schema: str) -> DataFrame:
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(function, schema)


def _first(rows: DataFrame, keep: int, *keys: str) -> DataFrame:
    """The first ``keep`` of each of ``keys`` by descending score, ascending id; in two steps, so that no group is read by one task."""
    for salt in (F.pmod(F.xxhash64("other"), F.lit(SALTS)), F.lit(0)):
        by = Window.partitionBy(*keys, salt).orderBy(F.col("score").desc(), "id", "other")
        rows = rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= keep)
    return rows


class Search:
    """Blocks, their zone maps and the sizes of groups for one table."""

    def __init__(self, blocks: DataFrame, anchors: DataFrame, seeds: int = SEEDS, group: int = GROUP):
        n, asked = blocks.count(), anchors.count()
        self.blocks, self.seeds = blocks, seeds
        self.chunks = max(1, math.ceil(n / min(MOST_CHUNK, max(1, n // TASKS))))
        self.segments, self.groups = max(1, math.ceil(n / ZONES)), max(1, math.ceil(asked / group))
        self.zones = blocks.select("block", "low", "high", "label_low", "label_high", "id_low", F.pmod(F.xxhash64("block"), F.lit(self.segments)).alias("segment"))

    def _copies(self, df: DataFrame, name: str, n: int) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))

    def _read(self, wanted: DataFrame, pairs: DataFrame, same: bool, keep: int) -> DataFrame:
        """The best rows of each window in the blocks of ``pairs`` (group, block, askers)."""
        held = self.blocks.join(pairs, "block").withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(self.chunks))).select("group", "chunk", "rids", "ids", "named", "labels", "vectors", "askers")
        found = _cogroup(self._copies(wanted, "chunk", self.chunks), held, ["group", "chunk"], _score(same, keep), "rid bigint, kind int, score bigint, id bigint, named boolean, other bigint")
        return _first(found, keep, "rid", "kind")

    def run(self, wanted: DataFrame, same: bool, keep: int) -> DataFrame:
        """``rid, kind, rank, score, id, named, other``: the first ``keep`` rows in each window of ``wanted`` (anchors with ``_WANTS``)."""
        wanted = wanted.withColumn("group", F.pmod(F.xxhash64("home"), F.lit(self.groups)))
        pairs = "group bigint, block bigint, rid bigint, gap double"
        zones = self._copies(self.zones, "group", self.groups)
        dealt = self._copies(wanted.drop("kinds"), "segment", self.segments)
        near = _cogroup(dealt, zones, ["group", "segment"], _choose(same, self.seeds), pairs)
        if self.segments > 1:
            near = near.withColumn("rank", F.row_number().over(Window.partitionBy("rid").orderBy("gap", "block"))).where(F.col("rank") <= self.seeds)
        near = near.groupBy("group", "block").agg(F.collect_set("rid").alias("askers"))  # at most a group of anchors
        seeded = stage(self._read(wanted, near, same, keep), "negatives-seeds")
        # With ``keep`` rows found the last of them is the score to beat, and at that score its id.
        last = seeded.where(F.col("rank") == keep).groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("kind", F.struct("score", "id")))).alias("last"))
        wanted = wanted.join(last, "rid", "left")
        wanted = wanted.withColumns({
            "lasts": F.zip_with("kinds", "lasts", lambda k, x: F.coalesce(F.col("last")[k]["id"], x)),
            "floors": F.zip_with("kinds", "floors", lambda k, x: F.coalesce(F.col("last")[k]["score"], x)),
        }).drop("last")
        wanted = stage(wanted, "negatives-wanted")
        dealt = self._copies(wanted.drop("kinds"), "segment", self.segments)
        reach = _cogroup(dealt, zones, ["group", "segment"], _choose(same, 0), pairs).select("group", "block", F.lit(None).cast("array<bigint>").alias("askers")).distinct()
        return stage(self._read(wanted, reach, same, keep), "negatives-found")


def _window(*parts: tuple[Column, Column, Column]) -> dict[str, Column]:
    kinds, floors, ceilings, lasts = zip(*((F.lit(i), floor, ceiling, last) for i, (floor, ceiling, last) in enumerate(parts)), strict=True)
    return {"kinds": F.array(*kinds), "floors": F.array(*floors), "ceilings": F.array(*ceilings), "lasts": F.array(*lasts)}


def mine_hard_negatives(
    rows: DataFrame, *, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK, seeds: int = SEEDS, group: int = GROUP,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for anchors among ``rows``.

    ``rows`` needs ``vec_id`` (an integer), ``embedding`` and ``label``; other columns are ignored. Rows with a null label or vector, or with a null,
    non-finite or huge component (``LARGEST``), take no part; shorter vectors end in zeros. Labels of ids divisible by 7 move on by
    one. Anchors are rows whose id is divisible by ``every``; rows without an id are none, but may be found, after all others
    of their score. Repeated rows are rows of their own: anchors each, and each other's candidates. Equal scores follow ascending ids. An anchor's positives
    are the first ``positives`` other rows of its label, a positive's negatives the first ``negatives`` rows of other labels
    with ``low * positive_score <= 100 * negative_score <= high * positive_score``. Anchors without any are left out; without rows
    the result is empty. Scores must fit 64 bits.
    """
    points = _points(rows)
    blocks = lay_out(points, block) if points.limit(1).count() else None
    if blocks is None:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    anchors = anchors_of(blocks, every)
    found = Search(blocks, anchors, seeds, group)
    everything = (F.lit(-LAST - 1), F.lit(LAST), F.lit(LAST))
    near = found.run(anchors.withColumns(_window(everything)), True, positives)
    near = near.select("rid", F.col("rank").alias("place"), F.col("score").alias("positive_score"), F.when(F.col("named"), F.col("id")).alias("positive_id"))
    near = stage(near, "negatives-positives")
    # The window of a positive in whole scores: 100 * score from low to high per cent of its own.
    low_score = F.expr(f"CAST(({low} * positive_score + pmod(-{low} * positive_score, 100)) DIV 100 AS BIGINT)")
    high_score = F.expr(f"CAST(({high} * positive_score - pmod({high} * positive_score, 100)) DIV 100 AS BIGINT)")
    windows = near.select("rid", "place", low_score.alias("floor"), high_score.alias("ceiling")).where("floor <= ceiling")
    windows = windows.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("place", "floor", "ceiling"))).alias("w"))
    wanted = anchors.join(windows, "rid").select(
        *anchors.columns, F.col("w.place").alias("kinds"), F.col("w.floor").alias("floors"), F.col("w.ceiling").alias("ceilings"), F.transform("w", lambda _: F.lit(LAST)).alias("lasts"),
    )
    hard = found.run(wanted, False, negatives)
    joined = hard.join(near, (hard["rid"] == near["rid"]) & (hard["kind"] == near["place"])).drop(near["rid"]).join(anchors.select(F.col("rid"), F.col("vec_id").alias("anchor_id")), "rid")
    return joined.select(
        "anchor_id", "positive_id", "rank", F.when(F.col("named"), F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


SQL = f"""
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, unnest(range(len(embedding))) AS d, floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS x FROM rows_),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS other_id, b.label, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM parts AS a JOIN parts AS b ON a.d = b.d WHERE a.vec_id % 100 = 0 AND a.vec_id != b.vec_id GROUP BY ALL),
positives AS (
  SELECT anchor_id, own, other_id AS positive_id, score AS positive_score FROM scores WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
  FROM positives AS p JOIN scores AS s ON p.anchor_id = s.anchor_id
  WHERE s.label != p.own AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT * FROM ranked WHERE rank <= {NEGATIVES}
"""


@query("op13_hard_negatives", SQL)
def op13(spark, sf_dir):
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"))
