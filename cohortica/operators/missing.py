"""Counting and filling missing values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.functions.columns import zero_to_null as zero_as_null
from cohortica.operators.binning import group_transform
from cohortica.operators.profile import distinct_counts, melt, numeric_columns, string_columns
from cohortica.operators.quantiles import exact_quantiles
from cohortica.operators.relational import corr_pairs


def null_counts(df: DataFrame) -> DataFrame:
    """Null and present values per column, and whether there are any nulls; one pass."""
    parts = [
        F.struct(
            F.lit(c).alias("variable"),
            F.count_if(F.col(f"`{c}`").isNull()).alias("n_null"),
            F.count(f"`{c}`").alias("n_present"),
        ).alias(f"c{i}")
        for i, c in enumerate(df.columns)
    ]
    counts = df.agg(*parts).select(
        F.inline(F.array(*[F.col(f"c{i}") for i in range(len(parts))]))
    )
    return counts.withColumn("any_null", F.col("n_null") > 0)


def null_total(df: DataFrame) -> DataFrame:
    """Nulls in the whole table."""
    return null_counts(df).agg(
        F.sum("n_null").alias("n_null"),
        F.sum("n_present").alias("n_present"),
        F.bool_or("any_null").alias("any_null"),
    )


def incomplete_rows(df: DataFrame) -> DataFrame:
    return df.where(reduce(or_, [F.col(f"`{c}`").isNull() for c in df.columns]))


def missing_table(df: DataFrame) -> DataFrame:
    """Columns with nulls: count and percent of rows to two digits, most missing first."""
    total = F.col("n_null") + F.col("n_present")
    return (
        null_counts(df)
        .where("any_null")
        .select(
            "variable",
            F.col("n_null").alias("n_miss"),
            F.bround(F.col("n_null") * 100.0 / total, 2).alias("ratio"),
        )
        .orderBy(F.desc("n_miss"), "variable")
    )


def missing_vs_target(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Target mean and rows by null flag of each column."""
    flags = df.select(target, *[F.col(c).isNull().cast("int").alias(c) for c in cols])
    return (
        melt(flags, cols, keep=[target], kind="int")
        .groupBy("variable", F.col("value").alias("is_null"))
        .agg(F.avg(target).alias("target_mean"), F.count(target).alias("n"))
    )


def nullity_corr(df: DataFrame) -> DataFrame:
    """Correlation of the null flags of columns that have some, but not only, nulls."""
    counts = null_counts(df).collect()
    cols = [r["variable"] for r in counts if r["n_null"] and r["n_present"]]
    flags = df.select(*[F.col(f"`{c}`").isNull().cast("double").alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    rows = [(a, b, v) for (a, b), v in corr_pairs(flags, pairs).items()] if pairs else []
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def fill_numeric(df: DataFrame, cols: Sequence[str], how: str | float) -> DataFrame:
    """Fill with the exact mean, the exact median, or a constant."""
    if how == "mean":
        row = df.agg(*[F.avg(c).alias(f"c{i}") for i, c in enumerate(cols)]).first()
        fill = {c: row[f"c{i}"] for i, c in enumerate(cols)}
    elif how == "median":
        fill = {c: v[0] for c, v in exact_quantiles(df, cols, [0.5]).items()}
    else:
        fill = dict.fromkeys(cols, float(how))
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items() if v is not None}
    )


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """The most frequent text of each column, the smallest of ties."""
    counts = melt(df, cols).where(F.col("value").isNotNull()).groupBy("variable", "value").count()
    best = counts.groupBy("variable").agg(F.min(F.struct(-F.col("count"), "value")).alias("best"))
    return {r["variable"]: r["best"]["value"] for r in best.collect()}


def fill_categorical(
    df: DataFrame, how: str = "mode", max_unique: int = 10, cols: Sequence[str] | None = None
) -> DataFrame:
    """Fill text columns with their mode, if they have at most ``max_unique`` values.

    Null counts as one of the values. Any other ``how`` is the text to fill in, in every column.
    """
    cols = string_columns(df) if cols is None else list(cols)
    if how != "mode":
        return df.na.fill(how, subset=cols)
    if not cols:
        return df
    distinct = distinct_counts(df, cols, max_unique + 1)
    nulls = {r["variable"]: r["any_null"] for r in null_counts(df.select(*cols)).collect()}
    few = [c for c in cols if nulls[c] and distinct[c] + 1 <= max_unique]
    return df.na.fill(modes(df, few)) if few else df


def fill_by_group(df: DataFrame, key: str, col: str, how: str) -> DataFrame:
    """Fill with the mean or median of the row's group."""
    names = df.columns
    filled = group_transform(df, key, col, how, "_fill")
    return filled.withColumn(col, F.coalesce(F.col(col).cast("double"), "_fill")).select(*names)


def zero_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: zero_as_null(F.col(c).cast("double")) for c in cols})


def correlated_cols(
    df: DataFrame,
    col: str,
    target: str | None = None,
    th: float = 0.25,
    exclude: Sequence[str] = (),
    compat: bool = False,
) -> list[str]:
    """The two columns that correlate most with ``col``, ``abs(corr) >= th``, ties by name.

    ``compat=True`` takes the two largest signed correlations and applies no threshold.
    """
    others = [c for c in numeric_columns(df) if c not in {col, target, *exclude}]
    found = {b: v for (_, b), v in corr_pairs(df, [(col, c) for c in others]).items()}
    known = {c: v for c, v in found.items() if v is not None}
    if compat:
        return sorted(known, key=lambda c: (-known[c], c))[:2]
    strong = [c for c in known if abs(known[c]) >= th]
    return sorted(strong, key=lambda c: (-abs(known[c]), c))[:2]


def linear_fit(df: DataFrame, y: str, feats: Sequence[str]) -> tuple[float, list[float]] | None:
    """Least squares with intercept from centred second moments of the complete rows."""
    rows = df.na.drop("any", subset=[y, *feats])
    names = [*feats, y]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    moments = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"s{i}_{j}") for i, j in pairs],
    ).first()
    if not moments["n"]:
        return None
    k = len(feats)
    cov = np.zeros((k + 1, k + 1))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = moments[f"s{i}_{j}"]
    slopes = np.linalg.lstsq(cov[:k, :k], cov[:k, k], rcond=None)[0]
    intercept = moments[f"m{k}"] - sum(s * moments[f"m{i}"] for i, s in enumerate(slopes))
    return float(intercept), [float(s) for s in slopes]


def linear_value(intercept: float, slopes: Sequence[float], feats: Sequence[str]) -> Column:
    total = F.lit(intercept)
    for slope, feat in zip(slopes, feats):
        total = total + F.lit(slope) * F.col(feat)
    return total


def regression_impute(
    df: DataFrame,
    col: str,
    target: str | None = None,
    th: float = 0.25,
    exclude: Sequence[str] = (),
    feats: Sequence[str] | None = None,
    compat: bool = False,
) -> DataFrame:
    """Fill nulls by regression on the two most correlated columns, then by the median.

    With fewer than two such columns only the median is used. After a regression the column is
    clipped at 0. The median is that of the column after the regression filled it.
    """
    if feats is None:
        feats = correlated_cols(df, col, target, th, exclude, compat)
    fit = linear_fit(df, col, feats) if len(feats) == 2 else None
    usable = F.col(col).isNull()
    for f in feats:
        usable = usable & F.col(f).isNotNull()
    if fit is None or df.where(usable).isEmpty():
        return fill_numeric(df, [col], "median")
    filled = df.withColumn(col, F.coalesce(F.col(col), linear_value(*fit, feats)))
    filled = fill_numeric(filled, [col], "median")
    return filled.withColumn(col, F.greatest(F.col(col), F.lit(0.0)))


def regression_impute_all(
    df: DataFrame,
    cols: Sequence[str],
    target: str | None = None,
    th: float = 0.25,
    exclude: Sequence[str] = (),
    compat: bool = False,
) -> DataFrame:
    """Impute column by column; a column filled earlier helps to fill the later ones."""
    for c in cols:
        df = regression_impute(df, c, target, th, exclude, compat=compat)
    return df
