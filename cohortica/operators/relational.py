"""Filters, joins, unions, top-k and group summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.operators.moments import co_moments
from cohortica.operators.profile import melt
from cohortica.session import small_side

# Filters and projections


def add_total(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, reduce(lambda a, b: a + b, [F.col(c) for c in cols]))


def line_revenue(
    df: DataFrame, quantity: str = "quantity", price: str = "price", out: str = "revenue"
) -> DataFrame:
    return df.withColumn(out, F.col(quantity) * F.col(price))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(cols) if cols else None)


def drop_cancelled(df: DataFrame, col: str, mark: str = "C") -> DataFrame:
    """Drop rows whose id contains ``mark``; a missing id stays."""
    return df.where(~F.coalesce(F.col(col).contains(mark), F.lit(False)))


def filter_min(df: DataFrame, col: str, low: float = 0, strict: bool = True) -> DataFrame:
    return df.where(F.col(col) > F.lit(low) if strict else F.col(col) >= F.lit(low))


def exclude(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows equal to ``value``; a missing value stays."""
    return df.where(F.coalesce(F.col(col) != F.lit(value), F.lit(True)))


def select_audience(
    df: DataFrame,
    segments: Sequence[str],
    pattern: str,
    key: str = "master_id",
    segment: str = "segment",
    interests: str = "categories",
    known: Sequence[str] | None = None,
) -> DataFrame:
    """Ids of customers in ``segments`` whose interests match the regular expression.

    With ``known`` a misspelt segment is an error; otherwise it would silently select nobody.
    """
    unknown = set(segments) - set(known) if known is not None else set()
    if unknown:
        raise ValueError(f"unknown segments: {sorted(unknown)}")
    return df.where(F.col(segment).isin(list(segments)) & F.col(interests).rlike(pattern)).select(
        key
    )


def parse_dates(df: DataFrame, part: str = "_date") -> DataFrame:
    """Parse every text column whose name contains ``part``."""
    names = [c for c, t in df.dtypes if part in c and t == "string"]
    return df.withColumns({c: F.to_timestamp_ntz(F.col(c)) for c in names}) if names else df


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def lookup_name(wanted: DataFrame, df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """The smallest name of each wanted id, or "not found"."""
    names = (
        df.join(wanted.select(id_col).distinct(), id_col, "left_semi")
        .groupBy(id_col)
        .agg(F.min(name_col).alias(name_col))
    )
    return wanted.join(names, id_col, "left").withColumn(
        name_col, F.coalesce(F.col(name_col), F.lit("not found"))
    )


# Joins and unions. A side computed here is counted before it is broadcast. The size of a given
# dimension is the caller's: Spark broadcasts it if its files are small.


def enrich(fact: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join of facts to a dimension."""
    return fact.join(dim, key, "left")


def attach_scores(df: DataFrame, scores: DataFrame, key: str = "master_id") -> DataFrame:
    """Join one row of scores per customer back to the customer table."""
    return df.join(scores, key, "left")


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on all columns the two tables share."""
    shared = [c for c in a.columns if c in b.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return a.join(b, shared, "inner")


def tag_union(groups: Mapping[str, DataFrame], tag: str = "grp") -> DataFrame:
    """Stack tables of one shape, naming each row's table in ``tag``."""
    return reduce(
        DataFrame.unionByName, [df.withColumn(tag, F.lit(name)) for name, df in groups.items()]
    )


def drop_rare_items(df: DataFrame, key: str, min_n: int) -> DataFrame:
    """Drop rows whose key occurs fewer than ``min_n`` times; rows without a key stay."""
    rare = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .where(F.col("count") < min_n)
        .select(key)
    )
    return df.join(small_side(rare), key, "left_anti")


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key is among the members."""
    return df.join(small_side(members.select(key)), key, "left_semi")


def attach_country(
    customers: DataFrame, lines: DataFrame, key: str = "customer_id", attribute: str = "country"
) -> DataFrame:
    """Add an attribute of the order lines, one value (the smallest) per customer.

    Joining the lines themselves would repeat each customer once per line.
    """
    one = lines.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(attribute).alias(attribute))
    return customers.join(one, key, "left")


def top_k(df: DataFrame, col: str, k: int, key: str) -> DataFrame:
    """The k largest by ``col``, ties by ``key``."""
    return df.orderBy(F.col(col).desc_nulls_last(), key).limit(k)


def top_groups(df: DataFrame, group: str, col: str, k: int, out: str) -> DataFrame:
    """The k groups with the largest sum."""
    return top_k(df.groupBy(group).agg(F.sum(col).alias(out)), out, k, group)


# Group summaries


def group_profile(
    df: DataFrame, group: str | Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Named aggregates per group; groups with a null key are left out."""
    keys = [group] if isinstance(group, str) else list(group)
    return df.na.drop("any", subset=keys).groupBy(*keys).agg(
        *[m.alias(name) for name, m in measures.items()]
    )


def channel_summary(
    df: DataFrame,
    channel: str = "order_channel",
    key: str = "master_id",
    orders: str = "total_orders",
    value: str = "total_value",
) -> DataFrame:
    """Customers, orders and value per channel."""
    return group_profile(
        df,
        channel,
        {"customers": F.count(key), "orders": F.sum(orders), "value": F.sum(value)},
    )


def segment_profile(df: DataFrame, segment: str, cols: Sequence[str]) -> DataFrame:
    return group_profile(df, segment, {f"mean_{c}": F.avg(c) for c in cols})


def segment_range(df: DataFrame, segment: str, col: str) -> DataFrame:
    return group_profile(df, segment, {"min": F.min(col), "mean": F.avg(col), "max": F.max(col)})


def target_by_category(df: DataFrame, cats: Sequence[str], target: str) -> DataFrame:
    """Mean of the target for every level of every categorical column."""
    cells = melt(df, cats, keep=[target]).where(F.col("value").isNotNull())
    return cells.groupBy("variable", F.col("value").alias("level")).agg(
        F.avg(target).alias("target_mean")
    )


def num_by_target(df: DataFrame, nums: Sequence[str], target: str) -> DataFrame:
    return segment_profile(df, target, nums)


def cat_summary(df: DataFrame, col: str) -> DataFrame:
    """Rows and percent of all rows per level; null has no level but counts as a row."""
    total = df.count()
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).cast("string").alias("level"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("percent", F.col("n") * F.lit(100.0) / F.lit(max(total, 1)))
    )


def rare_analysis(
    df: DataFrame, target: str, cats: Sequence[str], percent: bool = False
) -> DataFrame:
    """Count, share of all rows and target mean for every level of every categorical column."""
    total = df.count()
    scale = 100.0 if percent else 1.0
    cells = melt(df, cats, keep=[target]).where(F.col("value").isNotNull())
    return (
        cells.groupBy("variable", F.col("value").alias("level"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("target_mean"))
        .withColumn("ratio", F.col("n") * F.lit(scale) / F.lit(max(total, 1)))
    )


def corr_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> dict:
    """Pearson correlation over rows where both are present: ``{(a, b): value}``.

    None where a correlation is undefined: fewer than two rows, or a constant column. One pass for all
    pairs together.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    if not cols:
        return {}
    found = co_moments(df, cols).correlation()
    at = {c: i for i, c in enumerate(cols)}
    values = {pair: float(found[at[pair[0]], at[pair[1]]]) for pair in pairs}
    return {pair: None if v != v else v for pair, v in values.items()}


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairwise correlations as rows ``(a, b, corr)``, from one pass."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    found = corr_pairs(df, pairs)
    rows = [(a, b, found.get((a, b), found.get((b, a)))) for a in cols for b in cols]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def rating_pivot(
    df: DataFrame, items: Sequence[str], user: str = "user_id", item: str = "movie_id"
) -> DataFrame:
    """Users by a named, bounded list of items, with the mean rating in each cell."""
    wanted = df.where(F.col(item).isin(list(items)))
    return wanted.groupBy(user).pivot(item, list(items)).agg(F.avg("rating"))
