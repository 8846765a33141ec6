"""Exact, linearly interpolated quantiles that never gather a column in one place.

``percentile`` keeps every distinct value of a group in one buffer. Here a column is narrowed
instead: an approximate sketch brackets the wanted rank, one pass counts the rows below and inside
the bracket, and this repeats until the bracket holds few distinct values. Only those come to the
driver. Nothing is sampled, and every bracket is proved by counting before it is used.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.functions.columns import approx_distinct
from cohortica.operators.ranking import running_total
from cohortica.session import settle

# Most distinct values of one bracket that may come to the driver.
FEW_VALUES = 20_000
SKETCH_ACCURACY = 10_000
# Quantiles sought in one pass; more columns take more passes, which keeps plans small.
TARGETS_PER_PASS = 120


@dataclass
class _Target:
    column: str
    prob: float
    first: int = 0
    second: int = 0
    share: float = 0.0
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0
    distinct: int = 0
    exact: float | None = None

    def value(self) -> Column:
        return F.col(f"`{self.column}`").cast("double")

    def within(self) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (self.value() >= F.lit(self.low))
        if self.high is not None:
            inside = inside & (self.value() <= F.lit(self.high))
        return F.when(inside, self.value())


def exact_quantiles(
    df: DataFrame, cols: Iterable[str], probs: Sequence[float], few: int = FEW_VALUES
) -> dict[str, list[float | None]]:
    """Quantiles of several columns, nulls skipped: ``{column: [value per probability]}``.

    Runs a fixed, small number of passes over ``df`` for all columns together. An empty column
    gives None. The result is a few numbers, so callers use them as literals, which filters can
    push down to the scan.
    """
    cols = list(dict.fromkeys(cols))
    width = max(1, TARGETS_PER_PASS // max(1, len(probs)))
    if len(cols) > width:
        found: dict[str, list[float | None]] = {}
        for at in range(0, len(cols), width):
            found.update(exact_quantiles(df, cols[at : at + width], probs, few))
        return found
    targets = [_Target(c, float(p)) for c in cols for p in probs]
    row = df.agg(
        *[F.count(t.value()).alias(f"n{i}") for i, t in enumerate(targets[:: len(probs)])],
        *[
            approx_distinct(t.value()).alias(f"d{i}")
            for i, t in enumerate(targets[:: len(probs)])
        ],
    ).first()
    for i, t in enumerate(targets):
        t.inside, t.distinct = row[f"n{i // len(probs)}"], row[f"d{i // len(probs)}"]
        place = max(t.inside - 1, 0) * t.prob
        t.first, t.second = math.floor(place), math.ceil(place)
        t.share = place - t.first
    picked = _settled(df, targets, few)
    return {c: [picked.get((c, float(p))) for p in probs] for c in cols}


def order_statistics(df: DataFrame, col: str, places: Sequence[int], few: int = FEW_VALUES) -> list[float]:
    """The values at 0-based ``places`` of the column in ascending order, nulls left out, exactly."""
    row = df.agg(F.count(f"`{col}`").alias("n"), approx_distinct(F.col(f"`{col}`").cast("double")).alias("d")).first()
    if places and not 0 <= min(places) <= max(places) < row.n:
        raise ValueError(f"{col} has {row.n} values")
    targets = [_Target(col, float(p), p, p, 0.0, inside=row.n, distinct=row.d) for p in dict.fromkeys(places)]
    found: dict[tuple[str, float], float] = {}
    for at in range(0, len(targets), TARGETS_PER_PASS):
        found.update(_settled(df, targets[at : at + TARGETS_PER_PASS], few))
    return [found[col, float(p)] for p in places]


def _settled(df: DataFrame, targets: list[_Target], few: int) -> dict[tuple[str, float], float]:
    """Narrow all brackets, then pick: the value of every target that has rows."""
    live = [t for t in targets if t.inside]
    wide = [t for t in live if t.distinct > few]
    while wide:
        _narrow(df, wide)
        wide = [
            t for t in wide if t.exact is None and t.distinct > few and t.low != t.high
        ]
    picked = _pick(df, [t for t in live if t.exact is None])
    picked.update({(t.column, t.prob): t.exact for t in live if t.exact is not None})
    return picked


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    """Shrink each bracket around its rank, then prove the new bracket by counting."""
    slack = 2.0 / SKETCH_ACCURACY
    sketches = []
    for i, t in enumerate(targets):
        fractions = [
            max(0.0, (t.first - t.below) / t.inside - slack),
            min(1.0, (t.second - t.below + 1) / t.inside + slack),
        ]
        sketches.append(
            F.percentile_approx(t.within(), fractions, SKETCH_ACCURACY).alias(f"s{i}")
        )
    found = df.agg(*sketches).first()
    tried = [
        _Target(t.column, t.prob, t.first, t.second, t.share, *found[f"s{i}"])
        for i, t in enumerate(targets)
    ]
    counts = df.agg(
        *[F.count_if(t.value() < F.lit(t.low)).alias(f"b{i}") for i, t in enumerate(tried)],
        *[F.count(t.within()).alias(f"i{i}") for i, t in enumerate(tried)],
        *[approx_distinct(t.within()).alias(f"d{i}") for i, t in enumerate(tried)],
    ).first()
    for i, (old, new) in enumerate(zip(targets, tried)):
        below, inside, distinct = counts[f"b{i}"], counts[f"i{i}"], counts[f"d{i}"]
        holds = below <= old.first and old.second < below + inside
        if not holds or (old.low, old.high) == (new.low, new.high):
            old.exact = _by_sorting(df, old)
            continue
        old.low, old.high = new.low, new.high
        old.below, old.inside, old.distinct = below, inside, distinct


def _by_sorting(df: DataFrame, target: _Target) -> float:
    """The way out when a sketch cannot bracket a rank: the range-partitioned path."""
    values = df.select(target.value().alias("_x")).where("_x is not null").groupBy("_x").agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(values, ["_x"], "_n", "_upto")
    lower, upper = (upto.where(F.col("_upto") > p).agg(F.min("_x")).first()[0] for p in (target.first, target.second))
    return lower + target.share * (upper - lower)


def _pick(df: DataFrame, targets: list[_Target]) -> dict[tuple[str, float], float]:
    brackets: dict[tuple, list[_Target]] = {}
    for t in targets:
        brackets.setdefault((t.column, t.low, t.high), []).append(t)
    if not brackets:
        return {}
    groups = list(brackets.values())
    tagged = F.array(
        *[F.struct(F.lit(i).alias("g"), ts[0].within().alias("v")) for i, ts in enumerate(groups)]
    )
    counts = (
        df.select(F.explode(tagged).alias("e"))
        .select("e.g", "e.v")
        .where(F.col("v").isNotNull())
        .groupBy("g", "v")
        .count()
        .collect()
    )
    values: list[list[tuple[float, int]]] = [[] for _ in groups]
    for g, v, n in counts:
        values[g].append((v, n))
    picked = {}
    for g, ts in enumerate(groups):
        values[g].sort()
        for t in ts:
            a = _at(values[g], t.first - t.below)
            b = _at(values[g], t.second - t.below)
            picked[t.column, t.prob] = a + (b - a) * t.share
    return picked


def _at(values: list[tuple[float, int]], rank: int) -> float:
    for value, n in values:
        if rank < n:
            return value
        rank -= n
    raise IndexError(rank)


def grouped_quantile(
    df: DataFrame, group: Sequence[str], col: str, prob: float, out: str
) -> DataFrame:
    """One exact quantile of ``col`` per group, for any number of groups and any skew.

    Equal values are counted first, so ties cost one row. The (group, value) rows are
    range-partitioned, and ranks are the running count inside a block plus the count of earlier
    blocks of the group; no group has to fit in one task. Null groups and null values are skipped.
    """
    value = F.col(f"`{col}`").cast("double")
    present = value.isNotNull()
    for name in group:
        present = present & F.col(name).isNotNull()
    counted = df.where(present).groupBy(*group, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    blocks = settle(
        counted.repartitionByRange(*group, "_v").withColumn("_block", F.spark_partition_id())
    )
    earlier = Window.partitionBy(*group).orderBy("_block")
    offsets = (
        blocks.groupBy(*group, "_block")
        .agg(F.sum("_n").alias("_rows"))
        .select(
            *group,
            "_block",
            (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(*group)).alias("_total"),
        )
    )
    inside = Window.partitionBy(*group, "_block").orderBy("_v")
    place = (F.col("_total") - 1) * F.lit(prob)
    ranked = (
        blocks.withColumn("_upto", F.sum("_n").over(inside))
        .join(offsets, [*group, "_block"])
        .withColumn("_end", F.col("_before") + F.col("_upto"))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_place", place)
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    picked = ranked.groupBy(*group).agg(
        at(F.floor("_place")).alias("_a"),
        at(F.ceil("_place")).alias("_b"),
        F.max("_place").alias("_place"),
    )
    share = F.col("_place") - F.floor("_place")
    return picked.select(*group, (F.col("_a") + (F.col("_b") - F.col("_a")) * share).alias(out))
