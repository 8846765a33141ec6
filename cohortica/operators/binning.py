"""Quantile and fixed-edge bins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.operators.quantiles import exact_quantiles, grouped_quantile, order_statistics
from cohortica.operators.ranking import global_rank
from cohortica.session import small_side


def quantile_edges(df: DataFrame, cols: Sequence[str], k: int) -> dict[str, list[float]]:
    """The k + 1 quantile edges of each column; equal edges are an error, as bins would be empty."""
    found = exact_quantiles(df, cols, [i / k for i in range(k + 1)])
    for col, edges in found.items():
        if None in edges:
            raise ValueError(f"{col} has no values to bin")
        if len(set(edges)) != len(edges):
            raise ValueError(f"{col} has equal quantile edges {edges}; use rank_qcut")
    return found


def edge_bin(value: Column, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """Bin of ``value`` among ``(a, b]`` edges that span the data; the lowest edge is included."""
    k = len(edges) - 1
    labels = list(range(1, k + 1)) if labels is None else list(labels)
    if len(labels) != k:
        raise ValueError("one label per bin is needed")
    picked = F
    for edge, label in zip(edges[1:-1], labels):
        picked = picked.when(value <= F.lit(edge), F.lit(label))
    return picked.when(value.isNotNull(), F.lit(labels[-1]))


def qcut(
    df: DataFrame, col: str, k: int, labels: Sequence | None = None, out: str = "bin"
) -> DataFrame:
    """Equal-frequency bins by exact quantile edges; equal values share a bin, null stays null."""
    return df.withColumn(out, edge_bin(F.col(col), quantile_edges(df, [col], k)[col], labels))


def qcut_interval(df: DataFrame, col: str, k: int) -> DataFrame:
    """``qcut`` with the bin number and the two edges of its interval."""
    edges = quantile_edges(df, [col], k)[col]
    return (
        df.withColumn("bin", edge_bin(F.col(col), edges))
        .withColumn("lo", edge_bin(F.col(col), edges, edges[:-1]))
        .withColumn("hi", edge_bin(F.col(col), edges, edges[1:]))
    )


def rank_cuts(df: DataFrame, col: str, k: int, tie: str) -> list[tuple]:
    """The last row of each bin but the highest, as ``(value, tie)``, when rows are ranked by ``(col, tie)``
    and their ranks binned into ``k`` quantile bins.

    The values are order statistics, found by counting. Only where a cut falls among equal values are the
    ties of those rows ranked, and nothing else of the rows is moved.
    """
    n = df.agg(F.count(f"`{col}`")).first()[0]
    if n < 2:
        return []
    places = [b * (n - 1) // k for b in range(1, k)]
    values = order_statistics(df, col, places)
    x = F.col(f"`{col}`").cast("double")
    counts = df.agg(*[F.count_if(x < v) for v in values], *[F.count_if(x == v) for v in values]).first()
    inside = {v: [] for v in values}
    for place, v, below, equal in zip(places, values, counts, counts[len(values) :]):
        inside[v].append((place - below, equal))
    asked = F.lit(None).cast("int")
    for i, v in enumerate(inside):
        asked = F.when(x == v, F.lit(i)).otherwise(asked)
    wanted = [(i, m + 1) for i, cuts in enumerate(inside.values()) for m, _ in cuts]
    tied = df.select(asked.alias("_v"), F.col(f"`{col}`").alias("_x"), F.col(f"`{tie}`").alias("_tie")).where("_v is not null")
    ranked = global_rank(tied, ["_x", "_tie"], "_rank", group=["_v"])
    chosen = reduce(or_, [(F.col("_v") == i) & (F.col("_rank") == r) for i, r in wanted])
    found = {(r._v, r._rank): (r._x, r._tie) for r in ranked.where(chosen).collect()}  # a row per cut
    return [found[w] for w in wanted]


def rank_qcut(
    df: DataFrame, col: str, k: int, tie: str, labels: Sequence | None = None, out: str = "bin"
) -> DataFrame:
    """Bins of equal size: rows are ranked first, ties split by the unique key ``tie``, null stays null.

    Rows are compared with the ``k - 1`` rows that end the lower bins; they are neither sorted nor moved.
    """
    value, key = F.col(f"`{col}`"), F.col(f"`{tie}`")
    bins = F.lit(1)
    for v, t in rank_cuts(df, col, k, tie):
        later = key.isNotNull() if t is None else F.coalesce(key > F.lit(t), F.lit(False))
        bins = bins + ((value > F.lit(v)) | ((value == F.lit(v)) & later)).cast("int")
    if labels is not None:
        bins = F.element_at(F.array(*[F.lit(x) for x in labels]), bins)
    return df.withColumn(out, F.when(value.isNotNull(), bins))


def cut(value: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Fixed ``(a, b]`` bins; a value outside every bin is null."""
    picked = F
    for low, high, label in zip(edges, edges[1:], labels):
        picked = picked.when((value > F.lit(low)) & (value <= F.lit(high)), F.lit(label))
    return picked


def group_transform(df: DataFrame, key: str, col: str, how: str, out: str) -> DataFrame:
    """Put each group's mean or median next to its rows; rows with a null key get null.

    The statistic is aggregated and joined back. A window over the key would send a large group
    to one task.
    """
    if how == "mean":
        stats = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(col).alias(out))
    elif how == "median":
        stats = grouped_quantile(df, [key], col, 0.5, out)
    else:
        raise ValueError(how)
    return df.join(small_side(stats), key, "left")
