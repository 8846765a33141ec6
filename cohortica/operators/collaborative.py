"""User-based and item-based recommendations from ratings in long form.

A rating table has one row per (user, item) with the mean rating; the user by item matrix is never
built. Similarities are computed against one target user or item only, so the work grows with the
ratings and not with the square of the users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.operators.relational import drop_rare_items, top_k
from cohortica.session import small_side


def rating_table(
    ratings: DataFrame, min_n: int = 1000, user: str = "user_id", item: str = "movie_id"
) -> DataFrame:
    """Mean rating per user and item, without items rated fewer than ``min_n`` times."""
    common = drop_rare_items(ratings, item, min_n)
    return (
        common.na.drop("any", subset=[user, item])
        .groupBy(user, item)
        .agg(F.avg("rating").alias("rating"))
    )


def watched(table: DataFrame, target: int, user: str = "user_id", item: str = "movie_id"):
    """Items the target user rated."""
    return table.where((F.col(user) == F.lit(target)) & F.col("rating").isNotNull()).select(item)


def overlap_users(
    table: DataFrame,
    target: int,
    pct: float = 60,
    user: str = "user_id",
    item: str = "movie_id",
) -> DataFrame:
    """Users who rated at least ``pct`` percent of the target's items, the target included."""
    seen = small_side(watched(table, target, user, item))
    least = seen.count() * pct / 100
    return (
        table.join(seen, item, "left_semi")
        .groupBy(user)
        .agg(F.count("rating").alias("n"))
        .where(F.col("n") >= F.lit(least))
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; null with a constant side or one row."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.when(spread > 0, F.try_divide(F.covar_pop(x, y), spread))


def similar_users(
    table: DataFrame,
    target: int,
    th: float = 0.65,
    pct: float = 60,
    user: str = "user_id",
    item: str = "movie_id",
) -> DataFrame:
    """Users with enough shared items whose ratings correlate with the target's, ``corr >= th``.

    One join with the target's own ratings gives both the overlap and the correlation.
    """
    own = small_side(
        table.where(F.col(user) == F.lit(target)).select(item, F.col("rating").alias("_own"))
    )
    least = own.where(F.col("_own").isNotNull()).count() * pct / 100
    return (
        table.where(F.col(user) != F.lit(target))
        .join(own, item)
        .groupBy(user)
        .agg(
            F.count("rating").alias("n"),
            pearson(F.col("rating"), F.col("_own")).alias("corr"),
        )
        .where((F.col("n") >= F.lit(least)) & (F.col("corr") >= F.lit(th)))
        .select(user, "corr")
    )


def user_based_recommend(
    ratings: DataFrame,
    similar: DataFrame,
    titles: DataFrame,
    min_score: float = 2.5,
    k: int = 5,
    user: str = "user_id",
    item: str = "movie_id",
) -> DataFrame:
    """Top items by the mean of correlation times rating over the similar users' ratings."""
    weighted = (
        ratings.join(small_side(similar), user)
        .groupBy(item)
        .agg(F.avg(F.col("corr") * F.col("rating")).alias("weighted_rating"))
        .where(F.col("weighted_rating") > F.lit(min_score))
    )
    return top_k(weighted.join(titles, item), "weighted_rating", k, item)


def item_correlations(
    table: DataFrame, target: str, user: str = "user_id", item: str = "movie_id"
) -> DataFrame:
    """Correlation of every other item's ratings with the target item's, over shared users."""
    own = small_side(
        table.where(F.col(item) == F.lit(target)).select(user, F.col("rating").alias("_own"))
    )
    return (
        table.where(F.col(item) != F.lit(target))
        .join(own, user)
        .groupBy(item)
        .agg(pearson(F.col("rating"), F.col("_own")).alias("corr"))
        .where(F.col("corr").isNotNull())
    )


def latest_favourite(
    ratings: DataFrame,
    best: float = 5,
    user: str = "user_id",
    item: str = "movie_id",
    ts: str = "ts",
) -> DataFrame:
    """The item each user gave the best rating to most recently, ties by item.

    A two-step minimum, so a user with very many ratings is reduced before the shuffle.
    """
    favourites = ratings.where(F.col("rating") == F.lit(best))
    latest = favourites.groupBy(user, item).agg(F.max(ts).alias("_ts"))
    age = F.lit("9999-01-01").cast("timestamp_ntz") - F.col("_ts").cast("timestamp_ntz")
    return (
        latest.groupBy(user)
        .agg(F.min(F.struct(age.alias("age"), F.col(item).alias("item"))).alias("_b"))
        .select(user, F.col("_b.item").alias(item))
    )


def item_based_recommend(
    table: DataFrame,
    ratings: DataFrame,
    target_user: int,
    k: int = 5,
    user: str = "user_id",
    item: str = "movie_id",
) -> DataFrame:
    """Items that correlate most with the target user's latest favourite, itself excluded."""
    own = ratings.where(F.col(user) == F.lit(target_user))
    row = latest_favourite(own, user=user, item=item).first()
    favourite = row[item] if row else None
    return top_k(item_correlations(table, favourite, user, item), "corr", k, item)
