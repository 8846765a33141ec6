"""Rating averages and review ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.functions.columns import (
    average_rating_score,
    helpful_no,
    pos_neg_diff,
    wilson_lower_bound,
)
from cohortica.operators.binning import qcut
from cohortica.operators.relational import top_k


def avg_rating(df: DataFrame, rating: str = "overall") -> DataFrame:
    return df.agg(F.avg(rating).alias("avg_rating"))


def rating_by_recency(
    df: DataFrame, rating: str = "overall", age: str = "day_diff", k: int = 4
) -> DataFrame:
    """Mean rating per recency quantile, 1 the most recent."""
    return (
        qcut(df, age, k, out="recency_bin")
        .groupBy("recency_bin")
        .agg(F.avg(rating).alias("avg_rating"), F.count(F.lit(1)).alias("n"))
    )


def time_weighted_rating(
    df: DataFrame,
    weights: Sequence[float] = (28, 26, 24, 22),
    rating: str = "overall",
    age: str = "day_diff",
) -> DataFrame:
    """Mean ratings of the recency quantiles, weighted in percent, most recent first."""
    binned = qcut(df, age, len(weights), out="_bin")
    total = F.lit(0.0)
    for i, w in enumerate(weights, 1):
        total = total + F.avg(F.when(F.col("_bin") == i, F.col(rating))) * F.lit(w / 100)
    return binned.agg(total.alias("time_weighted_rating"))


def review_scores(
    df: DataFrame, helpful: str = "helpful_yes", total: str = "total_vote", confidence: float = 0.95
) -> DataFrame:
    """Not-helpful votes and the three scores of each review."""
    down = F.col("helpful_no")
    return df.withColumn("helpful_no", helpful_no(total, helpful)).withColumns(
        {
            "score_pos_neg_diff": pos_neg_diff(helpful, down),
            "score_average_rating": average_rating_score(helpful, down),
            "wilson_lower_bound": wilson_lower_bound(helpful, down, confidence),
        }
    )


def top_reviews(df: DataFrame, k: int = 20, key: str = "review_id") -> DataFrame:
    """The k reviews with the highest Wilson bound, ties by key."""
    return top_k(review_scores(df), "wilson_lower_bound", k, key)
