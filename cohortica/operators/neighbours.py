"""Exact nearest neighbours as a distributed join, and the two operators built on it.

No cross join: donors are put into the cells of a k-d tree, which is split level by level until a cell
holds few of them. Its nodes are tables, and queries descend by joins, so the tree may have any size. A query
meets its home cell first and then, nearest first and more of them in each round, the cells whose
boxes can still hold a closer donor than those it has found; what it finds shrinks the reach of the
next round. Cells are cut into blocks of bounded size, so no cell, however crowded, is one task's work. Copies
of a point are reduced before the join to the few that can be anybody's neighbour.

Distances between points with missing coordinates use the shared coordinates only, scaled up to
all of them. Ties go to the smaller donor key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.operators.encode import one_hot
from cohortica.operators.profile import string_columns
from cohortica.operators.relational import drop_incomplete
from cohortica.operators.scale import minmax_inverse, minmax_scale, minmax_stats
from cohortica.session import parallelism, settle, small_side

# Donors per cell aimed at, and rows per side of a block.
CELL_ROWS = 1_000
BLOCK_ROWS = 4_000
# Donors that steer the splits of a node, and halvings of a node per level of the tree. Any choice gives the same
# neighbours.
SAMPLE_ROWS = 4_000
HALVINGS = 6
# Cells that a query meets in the first round after its home; each further round has so many times as many.
FIRST_ROUND = 4
# Most numbers in one distance matrix.
MATRIX_CELLS = 4_000_000


def _matrix(pdf: pd.DataFrame, feats: Sequence[str]) -> np.ndarray:
    return pdf[list(feats)].to_numpy(dtype=float, na_value=np.nan)


def _slices(pdf: pd.DataFrame, width: int) -> Iterator[pd.DataFrame]:
    """Rows in steps small enough for a matrix of ``width`` columns."""
    step = max(1, MATRIX_CELLS // max(1, width))
    for at in range(0, len(pdf), step):
        yield pdf.iloc[at : at + step]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances over shared coordinates; infinite when two points share none."""
    total = np.zeros((len(x), len(y)))
    shared = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        gap = x[:, j, None] - y[None, :, j]
        known = ~np.isnan(gap)
        total += np.where(known, gap * gap, 0.0)
        shared += known
    with np.errstate(divide="ignore", invalid="ignore"):
        scaled = np.where(shared == x.shape[1], total, total * x.shape[1] / shared)
    return np.where(shared > 0, np.sqrt(scaled), np.inf)


def knn_join(
    queries: DataFrame,
    donors: DataFrame,
    feats: Sequence[str],
    k: int,
    key: str = "key",
    skip_self: bool = False,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest donors of each query: ``key, donor, dist`` with up to k rows per query.

    Both tables have a unique ``key`` of one type and the coordinates ``feats``. With
    ``skip_self`` a query is not its own neighbour. Donors that share no coordinate with a query
    are not neighbours.
    """
    feats = list(feats)
    columns = [key, *[F.col(c).cast("double").alias(c) for c in feats]]
    # New names for the donors' columns: queries and donors may be one table.
    queries, donors = settle(queries.select(*columns)), settle(donors.select(*columns)).toDF(key, *feats)
    kind = dict(donors.dtypes)[key]
    found = f"`{key}` {kind}, donor {kind}, dist double"
    if not donors.limit(1).count():
        return queries.sparkSession.createDataFrame([], found)
    placed, levels = cell_tree(donors, feats, key, cell_rows)
    sizes = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    sizes = settle(sizes)

    home = settle(_at_home(queries, levels, feats, key))
    best = settle(_nearest(home, placed, sizes, feats, k, key, skip_self, found, block_rows))
    if sizes.limit(2).count() == 1:
        return best
    around = _open_cells(queries.join(_reach(best, key, k), key, "left"), levels, feats)
    order = Window.partitionBy(key).orderBy("_bound", "_c", "_cell")
    around = around.join(home.select(key, "_cell"), [key, "_cell"], "left_anti")
    open_ = settle(around.withColumn("_place", F.row_number().over(order)))
    met, more = 0, FIRST_ROUND
    while True:
        now = settle(open_.where((F.col("_place") > met) & (F.col("_place") <= met + more)))
        if not now.limit(1).count():
            return best
        nearer = _nearest(now, placed, sizes, feats, k, key, skip_self, found, block_rows)
        best = settle(_best(best.unionByName(nearer), key, k))
        met, more = met + more, more * FIRST_ROUND
        left = open_.drop("_reach").where(F.col("_place") > met).join(_reach(best, key, k), key, "left")
        open_ = settle(left.where(F.col("_reach").isNull() | (F.col("_bound") <= F.col("_reach"))))


def _reach(best: DataFrame, key: str, k: int) -> DataFrame:
    """How far a closer donor may be: null where fewer than k are found."""
    return best.groupBy(key).agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("_reach"))


def cell_tree(donors: DataFrame, feats: Sequence[str], key: str, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, list[DataFrame]]:
    """Donors with their ``_cell``, and the levels of the tree as ``_parent, _cell, _leaf`` and boxes.

    The first level has a node per pattern of missing coordinates, which keeps every split on coordinates
    that all donors of a node have. A node with more than ``cell_rows`` donors is split by planes that
    halve a sample of it, HALVINGS times over, always across its widest side. A node whose donors all lie at
    one point is not split.
    """
    holes = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in feats])
    rows = settle(donors.withColumns({"_cell": holes, "_parent": F.lit(""), "_done": F.lit(False)}))
    levels = []
    boxes = [*[F.min(c).alias(f"l{i}") for i, c in enumerate(feats)], *[F.max(c).alias(f"h{i}") for i, c in enumerate(feats)]]
    widest = F.greatest(F.lit(0.0), *[F.coalesce(F.col(f"h{i}") - F.col(f"l{i}"), F.lit(0.0)) for i in range(len(feats))])
    while True:
        nodes = rows.where(~F.col("_done")).groupBy("_parent", "_cell").agg(F.count(F.lit(1)).alias("_n"), *boxes)
        nodes = settle(nodes.withColumn("_leaf", (F.col("_n") <= cell_rows) | (widest <= 0)))
        levels.append(nodes.drop("_n"))
        big = settle(nodes.where(~F.col("_leaf")).drop("_parent", "_leaf"))
        if not big.limit(1).count():
            return rows.select(key, *feats, "_cell"), levels
        rate = F.greatest(F.lit(1), F.floor(F.col("_n") / SAMPLE_ROWS)).cast("long")
        sample = rows.join(small_side(big), "_cell").where(F.pmod(F.xxhash64(F.col(key), F.lit(len(levels))), rate) == 0)
        drawn = sample.groupBy("_cell").applyInPandas(_planner(feats, cell_rows), "_cell string, _dims array<int>, _cuts array<double>")
        # A node of which nothing was drawn is halved in the middle of its widest side.
        sides = F.array(*[F.struct(F.coalesce(F.col(f"h{i}") - F.col(f"l{i}"), F.lit(-1.0)).alias("w"), F.lit(i).alias("d"), ((F.col(f"h{i}") + F.col(f"l{i}")) / 2).alias("m")) for i in range(len(feats))])
        middle = big.join(settle(drawn).select("_cell"), "_cell", "left_anti").withColumn("_s", F.array_max(sides))
        plans = drawn.unionByName(middle.select("_cell", F.array("_s.d").alias("_dims"), F.array("_s.m").alias("_cuts")))
        walked = rows.join(small_side(plans), "_cell", "left").withColumn("_at", F.lit(1))
        point = F.array(*[F.col(c) for c in feats])
        for _ in range(HALVINGS):
            dim = F.try_element_at("_dims", F.col("_at"))
            beyond = F.try_element_at(point, dim + 1) > F.try_element_at("_cuts", F.col("_at"))
            walked = walked.withColumn("_at", F.when(dim >= 0, 2 * F.col("_at") + F.coalesce(beyond.cast("int"), F.lit(0))).otherwise(F.col("_at")))
        split = F.col("_dims").isNotNull()
        rows = settle(
            walked.select(
                key, *feats, F.when(split, F.col("_cell")).otherwise(F.col("_parent")).alias("_parent"),
                F.when(split, F.concat("_cell", F.lit("."), F.col("_at").cast("string"))).otherwise(F.col("_cell")).alias("_cell"),
                (~split).alias("_done"),
            )
        )


def _planner(feats: Sequence[str], cell_rows: int):
    """Planes of a node from a sample of it, in heap order; -1 where there is no further split."""

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_n"].iloc[0])
        box = np.array([[pdf[f"l{i}"].iloc[0], pdf[f"h{i}"].iloc[0]] for i in range(len(feats))], float)
        depth = min(HALVINGS, max(1, int(np.ceil(np.log2(n / cell_rows)))))
        dims, cuts = [-1] * ((1 << depth) - 1), [0.0] * ((1 << depth) - 1)
        parts = {1: _matrix(pdf, feats)}
        for at in range(1, 1 << depth):
            x = parts.pop(at, None)
            if x is None or not len(x):
                continue
            spread = np.nan_to_num(x.max(0) - x.min(0), nan=-1.0)
            d = int(spread.argmax())
            if spread[d] > 0:
                cut = float(np.median(x[:, d]))
                if cut >= x[:, d].max():
                    cut = float(x[x[:, d] < cut, d].max())
            elif at == 1:  # the sample lies at one point, the node does not
                d = int(np.nan_to_num(box[:, 1] - box[:, 0], nan=-1.0).argmax())
                cut = float(box[d].mean())
            else:
                continue
            dims[at - 1], cuts[at - 1] = d, cut
            right = x[:, d] > cut
            parts[2 * at], parts[2 * at + 1] = x[~right], x[right]
        return pd.DataFrame({"_cell": [pdf["_cell"].iloc[0]], "_dims": [dims], "_cuts": [cuts]})

    return plan


def _to_box(feats: Sequence[str], centre: bool = False) -> Column:
    """Least distance of a query to any donor in a box, or the distance to its centre; null if they share
    no coordinate. A hair below the true one, so that rounding never hides a cell."""
    gaps, shared = [], []
    for i, c in enumerate(feats):
        x, low, high = F.col(f"`{c}`"), F.col(f"l{i}"), F.col(f"h{i}")
        gap = x - (low + high) / 2 if centre else F.greatest(low - x, x - high, F.lit(0.0))
        gaps.append(F.when(x.isNotNull() & low.isNotNull(), gap * gap).otherwise(0.0))
        shared.append((x.isNotNull() & low.isNotNull()).cast("int"))
    total, n = sum(gaps[1:], gaps[0]), sum(shared[1:], shared[0])
    return F.when(n > 0, F.sqrt(total * len(feats) / n) * (1 - 1e-12))


def _at_home(queries: DataFrame, levels: Sequence[DataFrame], feats: Sequence[str], key: str) -> DataFrame:
    """Queries with ``_cell``, the leaf reached by always taking the nearest box."""
    at, homes = queries.withColumn("_parent", F.lit("")), []
    for level in levels:
        pairs = at.join(small_side(level), "_parent").withColumn("_bound", _to_box(feats)).where("_bound is not null")
        first = F.min(F.struct("_bound", _to_box(feats, centre=True).alias("_c"), "_cell", "_leaf"))
        best = pairs.groupBy(key, *feats).agg(first.alias("_b")).select(key, *feats, "_b._cell", "_b._leaf")
        best = settle(best)
        homes.append(best.where("_leaf").drop("_leaf"))
        at = best.where("not _leaf").select(key, *feats, F.col("_cell").alias("_parent"))
    return reduce(DataFrame.unionByName, homes)


def _open_cells(queries: DataFrame, levels: Sequence[DataFrame], feats: Sequence[str]) -> DataFrame:
    """Queries with ``_cell, _bound, _c`` (distances to box and centre) for every leaf that may hold a donor
    within ``_reach``."""
    at, leaves = queries.withColumn("_parent", F.lit("")), []
    for level in levels:
        pairs = at.join(small_side(level), "_parent").withColumn("_bound", _to_box(feats))
        near = pairs.where(F.col("_bound").isNotNull() & (F.col("_reach").isNull() | (F.col("_bound") <= F.col("_reach"))))
        near = settle(near.select(*queries.columns, "_cell", "_leaf", "_bound", _to_box(feats, centre=True).alias("_c")))
        leaves.append(near.where("_leaf").drop("_leaf"))
        at = near.where("not _leaf").select(*queries.columns, F.col("_cell").alias("_parent"))
    return reduce(DataFrame.unionByName, leaves)


def _nearest(queries, placed, sizes, feats, k, key, skip_self, found, block_rows) -> DataFrame:
    """The k nearest donors within the cells that the queries were sent to.

    A cell's queries and donors are cut into parts of about ``block_rows``; every pair of parts is
    one group. Parts are chosen by hash of the key.
    """
    spark = queries.sparkSession
    parts = queries.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).join(sizes, "_cell")
    parts = parts.select("_cell", F.ceil(F.col("_n") / block_rows).alias("_nq"), F.ceil(F.col("_size") / block_rows).alias("_nd"))
    parts = settle(parts)
    blocks_ = parts.agg(F.sum(F.col("_nq") * F.col("_nd"))).first()[0] or 1
    parts = small_side(parts)
    left = (
        queries.join(parts, "_cell")
        .withColumn("_q", F.pmod(F.xxhash64(key), F.col("_nq")))
        .withColumn("_d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nd") - 1)))
        .select("_cell", "_q", "_d", key, *feats)
    )
    right = (
        placed.join(parts, "_cell")
        .withColumn("_d", F.pmod(F.xxhash64(key), F.col("_nd")))
        .withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nq") - 1)))
        .select("_cell", "_q", "_d", key, *feats)
    )

    def match(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        d = d.sort_values(key, kind="stable")
        ids, y = d[key].to_numpy(), _matrix(d, feats)
        for part in _slices(q, len(d)):
            own = part[key].to_numpy()
            dist = _distances(_matrix(part, feats), y)
            if skip_self:
                dist[own[:, None] == ids[None, :]] = np.inf
            limit = np.full(len(own), np.inf)
            if len(ids) > k:
                limit = np.partition(dist, k - 1, axis=1)[:, k - 1]
            # Donors are in key order, so the sort leaves ties to the smaller key.
            rows, places = np.nonzero((dist <= limit[:, None]) & np.isfinite(dist))
            near = dist[rows, places]
            order = np.lexsort((places, near, rows))
            rows, places, near = rows[order], places[order], near[order]
            first = np.searchsorted(rows, np.arange(len(own)))
            kept = np.arange(len(rows)) - first[rows] < k
            out.append(
                pd.DataFrame(
                    {key: own[rows[kept]], "donor": ids[places[kept]], "dist": near[kept]}
                )
            )
        empty = pd.DataFrame({key: [], "donor": [], "dist": []})
        return pd.concat(out) if out else empty

    blocks = ["_cell", "_q", "_d"]
    spread = parallelism(spark, blocks_)
    left, right = left.repartition(spread, *blocks), right.repartition(spread, *blocks)
    pairs = left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInPandas(match, found)
    return _best(pairs, key, k)


def _best(pairs: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy("dist", "donor")
    return pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def _first_copies(df: DataFrame, feats: Sequence[str], key: str, k: int) -> DataFrame:
    """Of the rows at one point, the k with the smallest keys."""
    order = Window.partitionBy(*feats).orderBy(key)
    return df.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def lof(df: DataFrame, cols: Sequence[str], key: str, k: int = 20, **sizes: int) -> DataFrame:
    """Local outlier factor (Breunig et al. 2000) with exactly k neighbours, ties by key.

    Adds ``lof_score``, the negative factor: about -1 inside, far below for outliers. Rows with a
    missing coordinate are left out. Rows at one point share a score, so of more than k + 1 copies
    only k + 1 are searched.
    """
    cols = list(cols)
    rows = drop_incomplete(df, cols)
    points = rows.select(F.col(key).alias("key"), *[F.col(c).cast("double") + 0.0 for c in cols])
    points = points.toDF("key", *cols)
    points = settle(_first_copies(points, cols, "key", k + 1))
    pairs = settle(knn_join(points, points, cols, k, skip_self=True, **sizes))
    reach = pairs.groupBy("key").agg(F.max("dist").alias("_kdist"))
    # The tiny constant keeps the density of coinciding points finite.
    density = settle(
        pairs.join(reach.withColumnRenamed("key", "donor"), "donor")
        .groupBy("key")
        .agg((1 / (F.avg(F.greatest("_kdist", "dist")) + F.lit(1e-10))).alias("_lrd"))
    )
    scores = (
        pairs.join(density.toDF("donor", "_around"), "donor")
        .groupBy("key")
        .agg(F.avg("_around").alias("_around"))
        .join(density, "key")
        .select("key", (-F.col("_around") / F.col("_lrd")).alias("lof_score"))
    )
    by_point = points.join(scores, "key").groupBy(*cols).agg(F.max("lof_score").alias("lof_score"))
    near = small_side(by_point).alias("s")
    return rows.alias("r").join(
        near,
        reduce(and_, [F.col(f"r.{c}").cast("double") == F.col(f"s.{c}") for c in cols]),
    ).select("r.*", "s.lof_score")


def lof_threshold(scores: DataFrame, rank: int = 3) -> float:
    """The score at 0-based ``rank`` from the lowest."""
    lowest = scores.orderBy("lof_score").select("lof_score").limit(rank + 1).collect()
    return lowest[-1][0]


def lof_filter(scores: DataFrame, rank: int = 3, outliers: bool = True) -> DataFrame:
    """Rows scoring below the threshold at ``rank``, or the rows that are left without them."""
    limit = F.lit(lof_threshold(scores, rank))
    below = F.col("lof_score") < limit
    return scores.where(below if outliers else ~below)


def knn_impute(
    df: DataFrame, target: str, feats: Sequence[str], key: str, k: int = 5, max_levels: int = 100,
    **sizes: int,
) -> DataFrame:
    """Fill ``target`` with the mean of the k nearest rows that have it.

    Text features become 0/1 columns without their first level (``max_levels`` at most), everything is scaled to 0..1, and
    the fill is scaled back. A row with no neighbour gets the column mean.
    """
    names = df.columns
    text = [c for c in feats if c in string_columns(df)]
    wide = one_hot(df.select(key, target, *feats), text, drop_first=True, max_levels=max_levels)
    points = [c for c in wide.columns if c not in (key, target)]
    stats = minmax_stats(wide, [target, *points])
    scaled = minmax_scale(wide, [target, *points], stats)
    scaled = settle(
        scaled.select(F.col(key).alias("key"), target, *[F.col(c) + 0.0 for c in points])
        .toDF("key", target, *points)
    )
    donors = _first_copies(scaled.where(F.col(target).isNotNull()), points, "key", k)
    # One query per distinct point, under its smallest key.
    missing = scaled.where(F.col(target).isNull())
    asked = missing.groupBy(*points).agg(F.min("key").alias("key"))
    pairs = knn_join(asked, donors, points, k, **sizes)
    fills = (
        pairs.join(scaled.select(F.col("key").alias("donor"), target), "donor")
        .groupBy("key")
        .agg(F.avg(target).alias(target))
    )
    fills = minmax_inverse(fills, {target: stats[target]}).withColumnRenamed(target, "_fill")
    mean = df.agg(F.avg(target)).first()[0]
    filled = (
        missing.alias("m")
        .join(
            small_side(asked.join(fills, "key", "left").drop("key")).alias("a"),
            _same("m", "a", points),
        )
        .select(F.col("m.key").alias(key), F.coalesce("a._fill", F.lit(mean)).alias("_fill"))
    )
    return (
        df.join(filled, key, "left")
        .withColumn(target, F.coalesce(F.col(target).cast("double"), "_fill"))
        .select(*names)
    )
