"""Shared pieces: the register, staged tables, numbering and cut points of ordered sums."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

RADIX_BITS = 12  # an ordered sum is cut by 4,096 ranges of its key at a time
CUT_ROWS = 2_000  # rows of a range that one task orders
LAST = 2**63 - 1


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame``, with its DuckDB SQL where there is one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with column ``name``: its position from 0 in ``order``, without one task that sees all rows.

    Rows are dealt by range and numbered within their part; a part starts at the sum of the parts before it,
    a table with one row per part.
    """
    parts = stage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return parts.withColumn(name, local).join(starts, "_part").withColumn(name, F.col(name) + F.col("_start")).drop("_part", "_start")


def equal_numbers(rows: DataFrame, key: str) -> DataFrame:
    """``rid, number``: from 0, the place of each row among those of equal ``key``, for keys that occur more than once.

    ``rows`` is a written table with ``rid`` (``monotonically_increasing_id``), whose upper bits name a part of it. Rows are numbered by
    key and part, and a part starts at the sum of those before it, so a frequent key is in no task whole.
    """
    dealt = rows.select(key, "rid", F.shiftright("rid", 33).alias("_part"))
    by_key = Window.partitionBy(key)
    parts = dealt.groupBy(key, "_part").agg(F.count("*").alias("_n")).withColumns({
        "_all": F.sum("_n").over(by_key), "_start": F.coalesce(F.sum("_n").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    repeated = dealt.join(parts.where("_all > 1").select(key, "_part", "_start"), [key, "_part"])
    local = F.row_number().over(Window.partitionBy(key, "_part").orderBy("rid")) - 1
    return repeated.select("rid", (F.col("_start") + local).alias("number"))


def cut_points(atoms: DataFrame, budgets: DataFrame, rows: int) -> DataFrame:
    """Where ordered sums reach their budgets.

    ``atoms`` has group ``g``, key ``u`` (long, spread over its whole range) and ``size``; ``budgets`` has ``g``, a number
    ``t`` and ``budget``. For each budget the result has ``cut``, the largest key so that the sizes of keys up to it
    sum to at most the budget, and ``below``, that sum. Without such a key ``cut`` is null and ``below`` 0.
    ``rows``, the number of atoms, sets how often the range that holds the cut is narrowed; no task orders more than
    the 4,096 ranges of a group or the keys of one narrowed range.
    """
    levels = max(1, math.ceil(math.log(max(rows / CUT_ROWS, 2)) / math.log(2**RADIX_BITS)))
    # _parent: the range found so far, by its number among ranges of its width; _base: the sum before it
    found = budgets.select("g", "t", F.col("budget").cast("double").alias("budget"), F.lit(0).cast("long").alias("_parent"), F.lit(0.0).alias("_base"))
    for level in range(1, min(levels, 5) + 1):
        shift = 64 - RADIX_BITS * level
        inside = _inside(atoms, found, shift + RADIX_BITS) if level > 1 else atoms.withColumn("_parent", F.lit(0).cast("long"))
        ranges = inside.groupBy("g", "_parent", F.shiftright("u", shift).alias("_range")).agg(F.sum("size").alias("_size"))
        up_to = Window.partitionBy("g", "_parent").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranges = ranges.withColumn("_sum", F.sum("_size").over(up_to).cast("double"))
        here = found.join(ranges, ["g", "_parent"]).where(F.col("_base") + F.col("_sum") > F.col("budget"))
        # the first range that goes beyond the budget; budgets that none exceeds take all keys
        first = here.groupBy("g", "t").agg(F.min("_range").alias("_range"), F.min("_sum").alias("_sum"))
        first = first.join(ranges.select("g", "_range", F.col("_size").cast("double").alias("_size")), ["g", "_range"])
        first = first.select("g", "t", F.col("_range").alias("_next"), (F.col("_sum") - F.col("_size")).alias("_add"))
        found = stage(
            found.join(first, ["g", "t"], "left").select(
                "g", "t", "budget", F.col("_next").alias("_parent"), (F.col("_base") + F.coalesce("_add", F.lit(0.0))).alias("_base"), F.col("_next").isNull().alias("_all")
            ),
            "cuts",
        )
        whole = found.where("_all").drop("_all") if level == 1 else whole
        found = found.where("NOT _all").drop("_all")
    inside = _inside(atoms, found, shift).groupBy("g", "_parent", "u").agg(F.sum("size").alias("size"))
    up_to = Window.partitionBy("g", "_parent").orderBy("u").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_sum", F.sum("size").over(up_to).cast("double"))
    within = found.join(inside, ["g", "_parent"]).where(F.col("_base") + F.col("_sum") <= F.col("budget"))
    last = within.groupBy("g", "t").agg(F.max("u").alias("cut"), F.max("_sum").alias("_sum"))
    # no key of the range fits: the cut lies just before the range
    start = F.shiftleft("_parent", shift) - 1
    narrow = found.join(last, ["g", "t"], "left").select(
        "g", "t", F.when(F.col("_base") + F.coalesce("_sum", F.lit(0.0)) > 0, F.coalesce("cut", start)).alias("cut"),
        (F.col("_base") + F.coalesce("_sum", F.lit(0.0))).alias("below"),
    )
    sums = atoms.groupBy("g").agg(F.sum("size").cast("double").alias("below"))
    return narrow.unionByName(whole.select("g", "t", F.lit(LAST).alias("cut")).join(sums, "g").select("g", "t", "cut", "below"))


def _inside(atoms: DataFrame, found: DataFrame, shift: int) -> DataFrame:
    """Atoms in the ranges that ``found`` has reached."""
    return atoms.withColumn("_parent", F.shiftright("u", shift)).join(found.select("g", "_parent").distinct(), ["g", "_parent"])


def shield(docs: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``needed`` renamed, and a function that gives the own columns back.

    What an operator adds in between cannot clash with columns of the caller.
    """
    names = {c: c if c in needed else f"own{i}__" for i, c in enumerate(docs.columns)}

    def restore(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(name).alias(c) for c, name in names.items()))

    return docs.select(*(F.col(f"`{c}`").alias(name) for c, name in names.items())), restore
