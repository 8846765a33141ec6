"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.session import settle

ROUNDS = 60


class UnionFind:
    """Disjoint sets of numbers; the smallest of a set is its root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while (above := up.get(x, x)) != root:
            up[x], x = root, above
        return root

    def union(self, a: int, b: int) -> bool:
        """Whether two sets became one."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        a, b = min(a, b), max(a, b)
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


def _forest(edges: DataFrame) -> DataFrame:
    """Union-find inside each partition: one edge to its root for every node that is not a root."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sets = UnionFind()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sets.union(a, b)
        nodes = [x for x in sets.up if sets.find(x) != x]
        for k in range(0, len(nodes), 50_000):
            part = nodes[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array([sets.find(x) for x in part], pa.int64())], ["u", "v"]
            )

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (two long columns): the smallest node it is
    connected with.

    Every partition first reduces its edges to a forest. Then large-star and small-star steps
    alternate until nothing changes: each moves neighbours to the smallest neighbour, so depth falls
    by a factor per round and edges never multiply. A node with very many neighbours is one row of a
    map-side minimum, and its edges stay where they are.
    """
    a, b = edges.columns
    edges = settle(_forest(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")).distinct())
    before = None
    for _ in range(ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = settle(small.where("u <> v").distinct())
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
