"""Exact linear-interpolation quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one task, so it serves only while the largest
group is known to be small. Beyond that a mergeable sketch first brackets each requested rank; a
second pass counts what lies below the bracket and orders only the values inside it, which is a
fraction of about 4 / accuracy of the group.

Both ways read the input twice; give them a table that is stored, not one that is costly to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import quoted
from tidemark.operators.series import spread_join

ACCURACY = 50_000
IN_MEMORY_ROWS = 100_000
DRIFT = 1e-9


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    probabilities: Sequence[float],
    accuracy: int = ACCURACY,
    few_keys: bool = False,
    in_memory_rows: int = IN_MEMORY_ROWS,
) -> DataFrame:
    """One row per ``keys``: ``n`` (non-null count) and ``q``, an array aligned with ``probabilities``.

    Equal to numpy / pandas quantiles with linear interpolation; null and NaN are skipped. Keys with
    no value are absent. ``few_keys`` says that the keys are a fixed small set (column names), so the
    bracket table may be broadcast.
    """
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, value.cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= in_memory_rows:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        found = rows.groupBy(*keys).agg(F.count("_v").alias("n"), F.percentile("_v", wanted).alias("q"))
        return found.where("n > 0")
    slack = 2.0 / accuracy
    low = [max(p - slack, 0.0) for p in probabilities]
    high = [min(p + slack, 1.0) for p in probabilities]
    sketch = rows.groupBy(*keys).agg(
        F.count("_v").alias("n"),
        F.percentile_approx("_v", [*low, *high], accuracy).alias("_s"),
    )
    m = len(probabilities)
    if keys:
        if few_keys:
            bracketed = rows.join(F.broadcast(sketch), list(keys))
        else:
            bracketed = spread_join(rows, sketch, keys, ["_v"])
    else:
        bracket = scalar_struct(sketch)
        bracketed = rows.withColumns({"n": bracket["n"], "_s": bracket["_s"]})
    # Floating sums may differ in the last bits when upstream work is repeated; a bracket a hair wider
    # than the sketch still holds the same values.
    lows = [f"(_s[{j}] - {DRIFT}D * abs(_s[{j}]))" for j in range(m)]
    highs = [f"(_s[{m + j}] + {DRIFT}D * abs(_s[{m + j}]))" for j in range(m)]
    inside = " OR ".join(f"(_v >= {lo} AND _v <= {hi})" for lo, hi in zip(lows, highs))
    # Values inside some bracket keep a row of their own; all others fall together.
    tails = [
        item
        for j in range(m)
        for item in (
            f"count_if(_v < {lows[j]}) AS _below{j}",
            f"max(CASE WHEN _v < {lows[j]} THEN _v END) AS _most{j}",
            f"count_if(_v > {highs[j]}) AS _above{j}",
            f"min(CASE WHEN _v > {highs[j]} THEN _v END) AS _least{j}",
        )
    ]
    grouped = bracketed.selectExpr(*map(quoted, keys), "n", "_s", "_v", f"CASE WHEN {inside} THEN _v END AS _x").groupBy(
        *keys, "_x"
    ).agg(F.count(F.lit(1)).alias("_all"), F.first("n").alias("n"), *[F.expr(t) for t in tails])
    sides = ", ".join(
        f"named_struct('j', {j}, 'side', 0, 'x', CAST(NULL AS DOUBLE), 'c', _below{j}, 'most', _most{j}, 'least', CAST(NULL AS DOUBLE)), "
        f"named_struct('j', {j}, 'side', 1, 'x', _x, 'c', _all - _below{j} - _above{j}, 'most', CAST(NULL AS DOUBLE), 'least', CAST(NULL AS DOUBLE)), "
        f"named_struct('j', {j}, 'side', 2, 'x', CAST(NULL AS DOUBLE), 'c', _above{j}, 'most', CAST(NULL AS DOUBLE), 'least', _least{j})"
        for j in range(m)
    )
    counted = (
        grouped.selectExpr(*map(quoted, keys), "n", f"inline(array({sides}))")
        .where("c > 0")
        .groupBy(*keys, "n", "j", "side", "x")
        .agg(F.sum("c").alias("_c"), F.min("least").alias("_least"), F.max("most").alias("_most"))
    )
    running = Window.partitionBy(*keys, "j").orderBy("side", "x").rowsBetween(Window.unboundedPreceding, 0)
    target = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("j") + 1) * (F.col("n") - 1)
    ranked = counted.withColumn("_upto", F.sum("_c").over(running)).withColumn("_t", target)
    below, above = F.floor("_t"), F.ceil("_t")

    def holds(rank: Column) -> Column:
        return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank)

    # The sketch rounds ranks up, so the wanted one may be the last below the bracket (or the first above).
    low_end, high_end = F.col("_upto") - F.col("_c"), F.col("_upto") - 1

    def at(rank: Column) -> Column:
        return (
            F.when(holds(rank) & (F.col("side") == 1), F.col("x"))
            .when((rank == high_end) & (F.col("side") == 0), F.col("_most"))
            .when((rank == low_end) & (F.col("side") == 2), F.col("_least"))
        )

    picked = ranked.groupBy(*keys, "n", "j").agg(
        F.max(at(below)).alias("_lo"),
        F.max(at(above)).alias("_hi"),
        F.first(F.col("_t") - below).alias("_w"),
    )
    exact = picked.withColumn(
        "_q",
        F.when(
            F.col("_lo").isNull() | F.col("_hi").isNull(),
            F.raise_error(F.lit("quantile rank fell outside its bracket; raise the accuracy")).cast("double"),
        ).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")),
    )
    return exact.groupBy(*keys, "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", "_q"))), lambda s: s["_q"]).alias("q")
    )


def scalar_struct(one_row: DataFrame) -> Column:
    """The single row of ``one_row`` as a struct-valued scalar subquery."""
    return one_row.select(F.struct(*one_row.columns).alias("_row")).scalar()


