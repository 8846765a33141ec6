"""Looking at a table: shape, summary statistics, counts of values, column types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from cohortica.functions.columns import approx_distinct
from cohortica.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)
TWELVE_QUANTILES = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99)


@dataclass(frozen=True)
class TableProfile:
    rows: int
    columns: list[str]
    types: dict[str, str]
    first: DataFrame
    last: DataFrame


def table_profile(df: DataFrame, key: Sequence[str], n: int = 5) -> TableProfile:
    """Row count, names and types, and the first and last ``n`` rows by ``key``."""
    return TableProfile(
        df.count(), df.columns, dict(df.dtypes), head(df, key, n), tail(df, key, n)
    )


def head(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*key).limit(n)


def tail(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.desc(k) for k in key]).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def melt(
    df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), kind: str = "string"
) -> DataFrame:
    """One row per (row, column): ``variable``, ``value`` and the columns in ``keep``."""
    types = dict(df.dtypes)

    def cell(c: str) -> Column:
        # Adding 0.0 turns -0.0 into 0.0, which are two texts but one number.
        x = F.col(f"`{c}`") + F.lit(0.0) if types[c] == "double" else F.col(f"`{c}`")
        return F.struct(F.lit(c).alias("variable"), x.cast(kind).alias("value"))

    cells = F.array(*[cell(c) for c in cols])
    return df.select(*keep, F.explode(cells).alias("_cell")).select(
        *keep, "_cell.variable", "_cell.value"
    )


def quantile_name(q: float) -> str:
    return f"p{round(q * 100):02d}"


def describe(
    df: DataFrame, cols: Sequence[str] | None = None, qs: Sequence[float] = QUARTILES
) -> DataFrame:
    """Count, mean, sample standard deviation, min, exact quantiles and max per numeric column.

    The median is always among the quantiles.
    """
    cols = numeric_columns(df) if cols is None else list(cols)
    qs = sorted({*qs, 0.5})
    edges = exact_quantiles(df, cols, qs)
    moments = df.agg(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                *[F.lit(v).cast("double").alias(quantile_name(q)) for q, v in zip(qs, edges[c])],
                F.max(c).cast("double").alias("max"),
            ).alias(f"c{i}")
            for i, c in enumerate(cols)
        ]
    )
    return moments.select(
        F.inline(F.array(*[F.col(f"c{i}") for i in range(len(cols))]))
    )


def num_summary(df: DataFrame, col: str, qs: Sequence[float] = TWELVE_QUANTILES) -> DataFrame:
    return describe(df, [col], qs)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first; null is not counted."""
    present = df.where(F.col(col).isNotNull())
    return present.groupBy(col).count().orderBy(F.desc("count"), col)


def nunique(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(count.alias("nunique"))


def unique_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def distinct_counts(df: DataFrame, cols: Sequence[str], settle_below: int) -> dict[str, int]:
    """Distinct non-null values per column, exact where they may be below ``settle_below``.

    A sketch of all columns in one pass tells the wide columns from the narrow ones; the sketch's
    value stands for columns at least four times over the limit. Only narrow columns are counted
    exactly, so no wide column is ever shuffled.
    """
    row = df.agg(
        *[approx_distinct(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)]
    ).first()
    found = {c: row[f"c{i}"] for i, c in enumerate(cols)}
    narrow = [c for c in cols if found[c] < 4 * settle_below]
    if narrow:
        levels = melt(df, narrow).where(F.col("value").isNotNull()).distinct()
        exact = dict(levels.groupBy("variable").count().collect())
        found.update({c: exact.get(c, 0) for c in narrow})
    return found


@dataclass(frozen=True)
class ColumnRoles:
    categorical: list[str]
    numeric: list[str]
    cardinal: list[str]
    numeric_but_categorical: list[str]
    distinct: dict[str, int] = field(repr=False)


def grab_col_names(df: DataFrame, cat_th: int = 10, car_th: int = 20) -> ColumnRoles:
    """Sort columns into categorical, numeric, and text with too many values to be categorical.

    Text is categorical up to ``car_th`` distinct values and cardinal above; every other type is
    numeric, or categorical when it has fewer than ``cat_th`` values. ``distinct`` is exact for
    the columns that are near either limit.
    """
    distinct = distinct_counts(df, df.columns, max(cat_th, car_th + 1))
    text = string_columns(df)
    few = [c for c in df.columns if c not in text and distinct[c] < cat_th]
    cardinal = [c for c in text if distinct[c] > car_th]
    return ColumnRoles(
        [c for c in text if c not in cardinal] + few,
        [c for c in df.columns if c not in text and c not in few],
        cardinal,
        few,
        distinct,
    )


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between min and max; the maximum belongs to the last bin."""
    low, high = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (high - low) / bins or 1.0
    place = F.floor((F.col(col) - F.lit(low)) / F.lit(width)).cast("int")
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("lo"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("hi"),
            "n",
        )
    )


def box_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends (last values within 1.5 IQR) and outlier counts per column."""
    edges = exact_quantiles(df, cols, QUARTILES)
    parts = []
    for i, c in enumerate(cols):
        q1, q2, q3 = edges[c]
        x = F.col(c).cast("double")
        if q1 is None:
            inside = F.lit(False)
        else:
            inside = x.between(F.lit(q1 - 1.5 * (q3 - q1)), F.lit(q3 + 1.5 * (q3 - q1)))
        parts.append(
            F.struct(
                F.lit(c).alias("variable"),
                *[
                    F.lit(v).cast("double").alias(n)
                    for n, v in (("q1", q1), ("median", q2), ("q3", q3))
                ],
                F.min(F.when(inside, x)).alias("whisker_low"),
                F.max(F.when(inside, x)).alias("whisker_high"),
                F.count_if(~inside).alias("outliers"),
            ).alias(f"c{i}")
        )
    return df.agg(*parts).select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(cols))])))
