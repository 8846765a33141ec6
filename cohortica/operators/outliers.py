"""Quantile fences: find, count, drop or clip values outside them."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.operators.quantiles import exact_quantiles

Fence = tuple[float, float]


def outlier_thresholds(
    df: DataFrame,
    cols: Sequence[str],
    q1: float = 0.25,
    q3: float = 0.75,
    rounding: str | None = None,
) -> dict[str, Fence]:
    """``low, up`` per column: 1.5 interquantile ranges beyond the two quantiles.

    ``rounding``: None, "round" (half to even) or "outward" (floor the low, ceil the up end).
    A column without values gets no fence.
    """
    fences = {}
    for c, (a, b) in exact_quantiles(df, cols, [q1, q3]).items():
        if a is None:
            continue
        low, up = a - 1.5 * (b - a), b + 1.5 * (b - a)
        if rounding == "round":
            low, up = float(round(low)), float(round(up))
        elif rounding == "outward":
            low, up = float(math.floor(low)), float(math.ceil(up))
        elif rounding is not None:
            raise ValueError(rounding)
        fences[c] = (low, up)
    return fences


def thresholds_table(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    rows = [(c, low, up) for c, (low, up) in fences.items()]
    return df.sparkSession.createDataFrame(rows, "variable string, low double, up double")


def is_outlier(col: str, fence: Fence) -> Column:
    """Strictly outside the fence; false for null."""
    low, up = fence
    outside = (F.col(col) < F.lit(low)) | (F.col(col) > F.lit(up))
    return F.coalesce(outside, F.lit(False))


def outlier_summary(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    """Number of outliers per column and their share of all rows, in one pass."""
    return _per_column(
        df,
        fences,
        lambda c: [
            F.count_if(is_outlier(c, fences[c])).alias("outliers"),
            F.try_divide(F.count_if(is_outlier(c, fences[c])), F.count(F.lit(1))).alias("ratio"),
        ],
    )


def check_outliers(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    """Whether each column has outliers, in one pass."""
    return _per_column(
        df,
        fences,
        lambda c: [
            F.coalesce(F.bool_or(is_outlier(c, fences[c])), F.lit(False)).alias("has_outliers")
        ],
    )


def _per_column(df: DataFrame, fences: Mapping[str, Fence], measures) -> DataFrame:
    parts = [
        F.struct(F.lit(c).alias("variable"), *measures(c)).alias(f"c{i}")
        for i, c in enumerate(fences)
    ]
    return df.agg(*parts).select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(parts))])))


def grab_outliers(
    df: DataFrame, col: str, fence: Fence, keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows outside the fence, or only their keys. The fence is a literal the scan can use."""
    low, up = fence
    rows = df.where((F.col(col) < F.lit(low)) | (F.col(col) > F.lit(up)))
    return rows.select(*keys) if keys else rows


def remove_outliers(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    """Drop rows outside any of the fences; nulls stay."""
    for c, fence in fences.items():
        df = df.where(~is_outlier(c, fence))
    return df


def clip_outliers(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    """Pull values outside a fence to its nearer end; nulls stay."""
    return df.withColumns(
        {
            c: F.when(F.col(c) < F.lit(low), F.lit(low))
            .when(F.col(c) > F.lit(up), F.lit(up))
            .otherwise(F.col(c))
            for c, (low, up) in fences.items()
        }
    )
