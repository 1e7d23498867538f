"""Ordered work inside long series without giving one series to one task.

A station may hold a large share of all rows, so nothing here sorts a whole series in a single
window partition. A series is cut into *blocks* of consecutive positions and each (series, block)
pair is a window partition of its own. Two things cross block borders:

* bounded look-back or look-ahead: neighbouring rows are copied into the block (``with_halo``);
* unbounded carries such as "last known value": each block is reduced to one summary row, each run of
  ``RUN_BLOCKS`` blocks to one row of those, the rows of runs are scanned in order, and the result is handed back to
  the blocks (``block_carry``). A scan of blocks never leaves its run, and a series of 10^12 rows has 60,000 runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16_384
BLOCK = "_block"
CORE = "_core"
RUN_BLOCKS = 1_024
RUN = "_run"


def block_of(position: Column, block_rows: int = BLOCK_ROWS) -> Column:
    return F.floor(position / F.lit(block_rows)).cast("long")


def with_block(df: DataFrame, position: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return df.withColumn(BLOCK, block_of(F.col(position), block_rows))


def with_halo(
    df: DataFrame, position: str, block_rows: int = BLOCK_ROWS, back: int = 0, ahead: int = 0
) -> DataFrame:
    """Copy each row into every block that needs it as context.

    A block sees ``back`` positions before its first row and ``ahead`` after its last. ``_core``
    marks the one copy that belongs to the block; keep only those after the window expressions.
    """
    p = F.col(position)
    home = block_of(p, block_rows)
    if not back and not ahead:
        return df.withColumn(BLOCK, home).withColumn(CORE, F.lit(True))
    first = block_of(F.greatest(p - F.lit(ahead), F.lit(0)), block_rows)
    last = block_of(p + F.lit(back), block_rows)
    return df.withColumn(BLOCK, F.explode(F.sequence(first, last))).withColumn(CORE, F.col(BLOCK) == home)


def core_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORE)).drop(CORE)


def in_block(keys: Sequence[str], *order: str | Column, block: str = BLOCK):
    return Window.partitionBy(*keys, block).orderBy(*order)


def block_carry(
    df: DataFrame,
    keys: Sequence[str],
    earlier: dict[str, Column] | None = None,
    later: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    block: str = BLOCK,
    run_blocks: int | None = None,
) -> DataFrame:
    """Per (keys, block): values carried in from the blocks before and after.

    Each argument maps an output name to an aggregate over a block's rows. ``earlier`` gives the
    nearest non-null result among preceding blocks, ``later`` among following blocks and ``total``
    the maximum over all blocks of the series. The scan has two levels: ``run_blocks`` consecutive blocks are
    summed up in one row, those rows are scanned, and each run of blocks is scanned on its own from what it is handed.
    """
    earlier, later, total = earlier or {}, later or {}, total or {}
    summary = df.groupBy(*keys, block).agg(
        *[expression.alias(name) for name, expression in {**earlier, **later, **total}.items()]
    )
    # Both levels read all columns of the same exchange, and no filter for nulls tells them apart, so it is made once.
    run = F.coalesce(F.floor(F.col(block) / F.lit(run_blocks or RUN_BLOCKS)), F.lit(0).cast("long"))
    summary = summary.withColumn(RUN, run).repartition(*[F.col(k) for k in keys], F.col(RUN))

    def known(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.col(block))

    runs = summary.groupBy(*keys, RUN).agg(
        *[F.max_by(name, known(name)).alias(name) for name in earlier],
        *[F.min_by(name, known(name)).alias(name) for name in later],
        *[F.max(name).alias(name) for name in total],
    )
    handed = _scan(runs, list(keys), RUN, earlier, later, total, "_run_")
    inside = _scan(summary, [*keys, RUN], block, earlier, later, total, "_in_")
    return inside.join(handed, [*keys, RUN]).select(
        *keys,
        block,
        *[F.coalesce(f"_in_{name}", f"_run_{name}").alias(name) for name in (*earlier, *later)],
        *[F.greatest(f"_in_{name}", f"_run_{name}").alias(name) for name in total],
    )


def _scan(rows: DataFrame, series: list[str], order: str, earlier, later, total, prefix: str) -> DataFrame:
    """Per row of a series the nearest known value before it, after it, and the largest of all."""
    # A frame that ends at "unbounded following" is re-read for every row; walking in descending order keeps the
    # look-ahead linear.
    before = Window.partitionBy(*series).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*series).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        *series,
        *([order] if order not in series else []),
        *[F.last(name, ignorenulls=True).over(before).alias(f"{prefix}{name}") for name in earlier],
        *[F.last(name, ignorenulls=True).over(after).alias(f"{prefix}{name}") for name in later],
        *[F.max(name).over(Window.partitionBy(*series)).alias(f"{prefix}{name}") for name in total],
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: dict[str, Column],
    name: str = "pos",
) -> DataFrame:
    """0-based position of each row in its series, without sorting a series in one task.

    ``buckets`` are expressions that never decrease along ``order_by`` (for example the day of a
    timestamp). Rows are numbered inside their bucket; the bucket sizes give the offsets.
    ``order_by`` must be a total order for the numbering to be repeatable.
    """
    tagged = df.withColumns({f"_b{i}_{n}": e for i, (n, e) in enumerate(buckets.items())})
    parts = [f"_b{i}_{n}" for i, n in enumerate(buckets)]
    before = Window.partitionBy(*keys).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*keys, *parts)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, *parts, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = tagged.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys, *parts).orderBy(*order_by))
    )
    return (
        numbered.join(offsets, [*keys, *parts])
        .withColumn(name, (F.col("_offset") + F.col("_rank") - 1).cast("long"))
        .drop("_rank", "_offset", *parts)
        .select(*df.columns, name)
    )


def previous_values(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    columns: Sequence[str],
    block_rows: int = BLOCK_ROWS,
    keep_block: bool = False,
) -> DataFrame:
    """Adds ``prev_<c>``: the value one position earlier in the series.

    ``keep_block`` leaves the block column in place, so that further work per block needs no shuffle.
    """
    frame = with_halo(df, position, block_rows, back=1)
    w = in_block(keys, position)
    found = core_rows(frame.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns}))
    return found if keep_block else found.drop(BLOCK)


SALTS = 16


def spread_join(rows: DataFrame, small: DataFrame, keys: Sequence[str], by: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Inner join of many ``rows`` to one ``small`` row per key, with a frequent key spread out.

    Rows of one key are dealt over ``salts`` sub-keys by a hash of the ``by`` columns and the small
    side is repeated once per sub-key, so a key with a large share of the rows is not one partition.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*keys, "_salt"]).drop("_salt")
