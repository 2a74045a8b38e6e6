"""Data-quality checks and profile counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.operators.joins import missing_keys


class QualityError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def top_duplicates(df: DataFrame, keys: Sequence[str], n: int = 100, out: str = "row_count") -> DataFrame:
    """The ``n`` most repeated keys, largest first."""
    return duplicate_keys(df, keys, out).orderBy(F.desc(out), *keys).limit(n)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail when a key repeats; otherwise return the input."""
    if not duplicate_keys(df, keys).limit(1).isEmpty():
        raise QualityError(f"duplicate rows for key {list(keys)}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """Fail on an empty input; otherwise return it."""
    if df.isEmpty():
        raise QualityError("the input has no rows")
    return df


def coverage_gap(df: DataFrame, other: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows with known keys that the other side does not represent."""
    for c in on:
        df = df.where(F.col(c).isNotNull())
    return missing_keys(df, other, on)


def count_histogram(
    df: DataFrame, key: str, bounds: tuple[int, int] = (5, 100), out: str = "row_count"
) -> DataFrame:
    """Keys with more than one row, counted by how many rows they have: few, some, many."""
    low, high = bounds
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    segment = (
        F.when(F.col("n") <= low, F.lit(f"<={low}"))
        .when(F.col("n") <= high, F.lit(f"{low + 1}-{high}"))
        .otherwise(F.lit(f">{high}"))
    )
    return per_key.groupBy(segment.alias("segment")).agg(F.count(F.lit(1)).alias(out))


def category_counts(df: DataFrame, col: str, out: str = "row_count") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
