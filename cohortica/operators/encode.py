"""Turning categories into numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.operators.profile import distinct_counts, grab_col_names, melt, string_columns
from cohortica.operators.ranking import global_rank
from cohortica.session import settle, small_side

# Most levels that are used as literals; longer level lists stay in a table.
MANY_LEVELS = 1_000


def _levels(df: DataFrame, col: str, limit: int) -> list | None:
    """Sorted non-null levels, or None if there are more than ``limit``."""
    rows = (
        df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).limit(limit + 1)
    ).collect()
    return [r[0] for r in rows] if len(rows) <= limit else None


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Codes 0..n-1 in the order of the levels; a null gets the next code, n."""
    out = out or col
    levels = _levels(df, col, MANY_LEVELS)
    if levels is None:
        return _label_encode_wide(df, col, out)
    code = F.lit(len(levels))
    if levels:
        known = F.array(*[F.lit(x) for x in levels])
        code = F.coalesce(F.nullif(F.array_position(known, F.col(col)), F.lit(0)) - 1, code)
    return df.withColumn(out, code.cast("int"))


def _label_encode_wide(df: DataFrame, col: str, out: str) -> DataFrame:
    """The same for any number of levels: the levels are ranked as a table and joined back."""
    levels = df.where(F.col(col).isNotNull()).select(col).distinct()
    codes = global_rank(levels, [col], "_code")
    n = codes.count()
    code = F.coalesce(F.col("_code") - 1, F.lit(n)).cast("int").alias(out)
    names = df.columns if out in df.columns else [*df.columns, out]
    return df.join(codes, col, "left").select(*[code if c == out else c for c in names])


def label_decode(df: DataFrame, code: str, levels: Sequence, out: str) -> DataFrame:
    """Levels of codes 0..n-1; any other code gives null."""
    known = F.array(*[F.lit(x) for x in levels])
    return df.withColumn(out, F.try_element_at(known, F.col(code).cast("int") + 1))


def levels_of(df: DataFrame, cols: Sequence[str], limit: int = MANY_LEVELS) -> dict[str, list]:
    """Sorted non-null levels of each column, as text, in one pass; an error above the limit."""
    most = limit * len(cols)
    cells = melt(df, cols).where(F.col("value").isNotNull()).distinct().limit(most + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in cols}
    for variable, value in cells:
        found[variable].append(value)
    texts = string_columns(df)
    for c, levels in found.items():
        if len(cells) > most or len(levels) > limit:
            raise ValueError(f"one of {list(cols)} has more than {limit} levels")
        levels.sort(key=(lambda x: x) if c in texts else _as_number)
    return found


def _as_number(level: str) -> tuple[float, str]:
    try:
        return float(level), level
    except ValueError:
        return 0.0, level


def binary_columns(df: DataFrame, distinct: Mapping[str, int] | None = None) -> list[str]:
    """Columns that are neither integer nor floating point and have two values."""
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double")
    other = [c for c, t in df.dtypes if t not in numbers]
    if not other:
        return []
    distinct = distinct or distinct_counts(df, other, 3)
    return [c for c in other if distinct[c] == 2]


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    drop_first: bool = False,
    dummy_na: bool = False,
    max_levels: int = 100,
) -> DataFrame:
    """Replace each column by 0/1 columns ``col_level``, levels in order.

    A null is 0 everywhere, or 1 in ``col_nan`` with ``dummy_na``. More than ``max_levels`` levels
    are an error: they would make the table wider than anyone wants.
    """
    added: list[Column] = []
    types = dict(df.dtypes)
    levels = levels_of(df, cols, max_levels) if cols else {}
    for c in cols:
        hits = [
            (x, F.coalesce(F.col(c) == F.lit(x).cast(types[c]), F.lit(False))) for x in levels[c]
        ]
        if dummy_na:
            hits.append(("nan", F.col(c).isNull()))
        for name, hit in hits[1:] if drop_first else hits:
            added.append(hit.cast("int").alias(f"{c}_{name}"))
    return df.select(*[c for c in df.columns if c not in cols], *added)


def ohe_columns(df: DataFrame, categorical_only: bool = False, most: int = 10) -> list[str]:
    """Columns with more than two and at most ``most`` distinct values."""
    roles = grab_col_names(df)
    cols = roles.categorical if categorical_only else df.columns
    return [c for c in df.columns if c in cols and 2 < roles.distinct[c] <= most]


def rare_encode(df: DataFrame, cols: Sequence[str] | None, share: float) -> DataFrame:
    """Rename levels held by less than ``share`` of all rows to "Rare"; null stays null.

    At most ``1 / share`` levels of a column are not rare. Where that is at most MANY_LEVELS they are a
    list in the plan; else they stay a table that the rows are joined to, so nothing passes the driver.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    cols = string_columns(df) if cols is None else list(cols)
    if not cols:
        return df
    total = df.count()
    counts = melt(df, cols).where(F.col("value").isNotNull()).groupBy("variable", "value").count()
    if 1 / share > MANY_LEVELS:
        common = settle(counts.where(F.col("count") / F.lit(total) >= share))
        names = df.columns
        for c in cols:
            levels = common.where(F.col("variable") == c).select(F.col("value").alias("_level"))
            df = df.join(small_side(levels), F.col(f"`{c}`") == F.col("_level"), "left").withColumn(
                c, F.when(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")).otherwise(F.coalesce("_level", F.lit("Rare")))
            ).drop("_level")
        return df.select(*[F.col(f"`{n}`") for n in names])
    kept: dict[str, list[str]] = {c: [] for c in cols}
    for variable, value, _ in counts.where(F.col("count") / F.lit(total) >= share).collect():
        kept[variable].append(value)
    return df.withColumns(
        {
            c: F.when(F.col(c).isNull() | F.col(c).isin(kept[c]), F.col(c)).otherwise(
                F.lit("Rare")
            )
            for c in cols
        }
    )


def useless_columns(
    df: DataFrame, share: float = 0.01, distinct: Mapping[str, int] | None = None
) -> list[str]:
    """Columns with two values of which one is held by less than ``share`` of all rows.

    Distinct counts that are known already can be given.
    """
    distinct = distinct or distinct_counts(df, df.columns, 3)
    two = [c for c in df.columns if distinct[c] == 2]
    if not two:
        return []
    total = df.count()
    counts = melt(df, two).where(F.col("value").isNotNull()).groupBy("variable", "value").count()
    smallest = dict(counts.groupBy("variable").agg(F.min("count")).collect())
    return [c for c in two if smallest[c] / total < share]
