"""Scaling numeric columns. Statistics are a few numbers per column, computed in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.operators.quantiles import exact_quantiles

Stats = Mapping[str, tuple[float | None, float | None]]


def _stats(df: DataFrame, cols: Sequence[str], first, second) -> dict[str, tuple]:
    row = df.agg(
        *[first(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
        *[second(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(cols)}


def _shift_and_divide(df: DataFrame, stats: Stats) -> DataFrame:
    """``(x - centre) / spread``; a spread of 0 divides by 1, a column without values stays."""
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(centre)) / F.lit(spread or 1.0)
            for c, (centre, spread) in stats.items()
            if centre is not None
        }
    )


def standard_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean 0 and population standard deviation 1; null stays null."""
    return _shift_and_divide(df, _stats(df, cols, F.avg, F.stddev_pop))


def robust_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Median 0 and interquartile range 1, by exact quantiles."""
    edges = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    stats = {c: (q2, None if q1 is None else q3 - q1) for c, (q1, q2, q3) in edges.items()}
    return _shift_and_divide(df, stats)


def minmax_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    return _stats(df, cols, F.min, F.max)


def minmax_scale(df: DataFrame, cols: Sequence[str], stats: Stats | None = None) -> DataFrame:
    """From min..max to 0..1; a constant column becomes 0."""
    stats = stats or minmax_stats(df, cols)
    spans = {c: (low, None if low is None else high - low) for c, (low, high) in stats.items()}
    return _shift_and_divide(df, spans)


def minmax_inverse(df: DataFrame, stats: Stats) -> DataFrame:
    """Undo ``minmax_scale`` with the statistics it used."""
    return df.withColumns(
        {
            c: F.col(c) * F.lit((high - low) or 1.0) + F.lit(low)
            for c, (low, high) in stats.items()
            if low is not None
        }
    )
