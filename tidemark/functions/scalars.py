"""Row-level expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.params import SENTINELS

# Severity and risk scores at or above these are Medium / High.
MEDIUM_SCORE = 0.33
HIGH_SCORE = 0.66


def quoted(name: str) -> str:
    """A column name for use inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def sentinel_to_null(df: DataFrame, columns: Iterable[str], sentinels: Sequence[float] = SENTINELS) -> DataFrame:
    """Exact matches of a sentinel become null, in those of ``columns`` that exist."""
    cleaned = {
        c: F.when(~F.col(c).isin(*sentinels), F.col(c)) for c in present(df, columns)
    }
    return df.withColumns(cleaned) if cleaned and sentinels else df


def encode_direction(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Angles in degrees gain ``<c>_SIN`` and ``<c>_COS`` companions."""
    encoded = {}
    for c in present(df, columns):
        encoded[f"{c}_SIN"] = F.sin(F.radians(c))
        encoded[f"{c}_COS"] = F.cos(F.radians(c))
    return df.withColumns(encoded) if encoded else df


def angle_of(sin: Column, cos: Column) -> Column:
    """Direction in [0, 360) of a (sin, cos) pair."""
    return F.pmod(F.degrees(F.atan2(sin, cos)) + F.lit(360.0), F.lit(360.0))


def severity_level(score: Column) -> Column:
    return (
        F.when(score >= HIGH_SCORE, "High").when(score >= MEDIUM_SCORE, "Medium").otherwise("Low")
    )


def two_decimals(column: Column) -> Column:
    """Text with two decimals, exact halves to the even digit as C and Python print them."""
    return F.call_function("format_number", column.cast("double"), F.lit("0.00"))


def explain_parts(*parts: Column) -> Column:
    return F.concat_ws(" | ", *parts)


def columns_like(names: Iterable[str], prefix: str, suffix: str = "_mean") -> list[str]:
    return sorted(n for n in names if n.startswith(f"{prefix}_") and n.endswith(suffix))


def first_mean_column(names: Iterable[str], prefix: str) -> str | None:
    """Lexicographically first ``<prefix>_..._mean`` name, so ``_s24_`` comes before ``_s6_``."""
    found = columns_like(names, prefix)
    return found[0] if found else None


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def lookup_default(key: Column, mapping: dict[int, int]) -> Column:
    """``mapping[key]``, or the key itself where the mapping has no entry."""
    if not mapping:
        return key
    pairs = [F.lit(int(v)) for item in sorted(mapping.items()) for v in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), key.cast("int")), key.cast("int"))
