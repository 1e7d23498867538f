"""Bounded gap filling on a regular grid, identified by ``keys`` and a contiguous ``position``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import angle_of, present, quoted
from tidemark.operators.series import BLOCK, BLOCK_ROWS, CORE, block_carry, core_rows, in_block, with_halo


def ffill_limited(
    df: DataFrame, keys: Sequence[str], position: str, columns: Sequence[str], limit: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Carry the last known value forward over at most ``limit`` rows."""
    frame = with_halo(df, position, block_rows, back=limit)
    w = in_block(keys, position).rowsBetween(-limit, 0)
    return core_rows(frame.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})).drop(BLOCK)


def bfill_limited(
    df: DataFrame, keys: Sequence[str], position: str, columns: Sequence[str], limit: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Carry the next known value backward over at most ``limit`` rows."""
    frame = with_halo(df, position, block_rows, ahead=limit)
    w = in_block(keys, position).rowsBetween(0, limit)
    return core_rows(frame.withColumns({c: F.first(c, ignorenulls=True).over(w) for c in columns})).drop(BLOCK)


def interpolate_linear_limited(
    df: DataFrame, keys: Sequence[str], position: str, columns: Sequence[str], limit: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Linear by position, at most ``limit`` rows after a known value; a trailing gap stays flat."""
    return _fill(df, keys, position, columns, 0, limit, block_rows)


def gap_fill(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    numeric: Sequence[str],
    directional: Sequence[str] = (),
    small: int = 2,
    medium: int = 6,
    drop_large_gap_rows: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Forward fill, then backward fill, each over ``small`` rows, then interpolate ``medium`` rows.

    Directions are filled as (sin, cos) pairs and turned back into angles.
    """
    directional = present(df, directional)
    numeric = [c for c in present(df, numeric) if c not in set(directional)]
    circle = {}
    for c in directional:
        circle[f"{c}__sin"] = F.sin(F.radians(c))
        circle[f"{c}__cos"] = F.cos(F.radians(c))
    filled = _fill(
        df.withColumns(circle) if circle else df, keys, position, [*numeric, *circle], small, medium, block_rows
    )
    if circle:
        angles = {c: angle_of(F.col(f"{c}__sin"), F.col(f"{c}__cos")) for c in directional}
        filled = filled.withColumns(angles).select(*df.columns)
    if drop_large_gap_rows:
        filled = filled.na.drop("any", subset=[*numeric, *directional])
    return filled


def circular_gap_fill(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    directional: Sequence[str],
    small: int = 2,
    medium: int = 6,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    return gap_fill(df, keys, position, (), directional, small, medium, block_rows=block_rows)


def _fill(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    names: Sequence[str],
    small: int,
    medium: int,
    block_rows: int,
) -> DataFrame:
    """Closed form of the three fills.

    Only known values within ``small + medium`` rows before a gap matter, a bounded look-back. The
    end of a gap may be any distance ahead, so the next known value is carried across blocks.
    """
    if not names:
        return df
    reach = small + medium
    i = quoted(position)
    columns = {n: quoted(n) for n in names}

    def part(name: str, role: str) -> str:
        return quoted(f"{name}__{role}")

    known = [
        f"CASE WHEN {c} IS NOT NULL THEN named_struct('p', {i}, 'v', CAST({c} AS DOUBLE)) END AS {part(n, 'k')}"
        for n, c in columns.items()
    ]
    frame = with_halo(df.selectExpr("*", *known), position, block_rows, back=reach)
    # Plain numbers, unlike structs, keep this a hash aggregate.
    later = {}
    for n, c in columns.items():
        at = f"CASE WHEN {c} IS NOT NULL THEN {i} END"
        later[f"{n}__later_p"] = F.expr(f"min({at})")
        later[f"{n}__later_v"] = F.expr(f"min_by(CAST({c} AS DOUBLE), {at})")
    carry = block_carry(frame.where(F.col(CORE)), keys, later=later)
    series = ", ".join([*map(quoted, keys), quoted(BLOCK)])
    back = f"(PARTITION BY {series} ORDER BY {i} ROWS BETWEEN {reach} PRECEDING AND CURRENT ROW)"
    ahead = f"(PARTITION BY {series} ORDER BY {i} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    seen = core_rows(
        frame.selectExpr(
            "*",
            *[f"last({part(n, 'k')}, true) OVER {back} AS {part(n, 'p')}" for n in names],
            *[f"last({part(n, 'k')}, true) OVER {ahead} AS {part(n, 'n')}" for n in names],
        )
    ).join(carry, [*keys, BLOCK], "left")

    def filled(name: str) -> str:
        x, before = columns[name], part(name, "p")
        after_p = f"coalesce({part(name, 'n')}.p, {part(name, 'later_p')})"
        after_v = f"coalesce({part(name, 'n')}.v, {part(name, 'later_v')})"
        start, stop = f"({before}.p + {small})", f"({after_p} - {small})"
        return f"""CASE WHEN {x} IS NOT NULL THEN CAST({x} AS DOUBLE)
            WHEN {i} - {before}.p <= {small} THEN {before}.v
            WHEN {after_p} - {i} <= {small} THEN {after_v}
            WHEN {before} IS NULL THEN CAST(NULL AS DOUBLE)
            WHEN {after_p} IS NULL THEN {before}.v
            ELSE {before}.v + ({after_v} - {before}.v) / ({stop} - {start}) * ({i} - {start}) END AS {x}"""

    return seen.selectExpr(*[filled(c) if c in columns else quoted(c) for c in df.columns])
