"""Row numbers over a total order without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortica.session import settle, small_side


def global_rank(
    df: DataFrame, order: Sequence[str], out: str = "rn", group: Sequence[str] = ()
) -> DataFrame:
    """Number rows 1..n by ``order`` (ascending), per ``group`` if one is given.

    ``order`` must be total (end it with a key). Rows are range-partitioned by group and order, so
    a group that holds most of the table is spread over many tasks. A row's number is its place in
    its block plus the number of rows in earlier blocks; there is one offset per block and group.
    The blocks are settled first because range bounds are sampled and must not be drawn twice.
    Rows with a null group are dropped.
    """
    for name in group:
        df = df.where(F.col(name).isNotNull())
    keys = [*group, *order]
    placed = settle(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_block", F.shiftright("_slot", 33))
    )
    earlier = Window.partitionBy(*group).orderBy("_block")
    offsets = (
        placed.groupBy(*group, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first"))
        .select(
            *group,
            "_block",
            (F.sum("_rows").over(earlier) - F.col("_rows") - F.col("_first") + 1).alias("_shift"),
        )
    )
    return (
        placed.join(small_side(offsets), [*group, "_block"])
        .withColumn(out, F.col("_slot") + F.col("_shift"))
        .select(*df.columns, out)
    )


def running_total(df: DataFrame, order: Sequence[str], amount: str, out: str) -> DataFrame:
    """Sum of ``amount`` over this row and all rows before it; ``order`` must be total.

    A block's sum starts from the total of the earlier blocks, as in ``global_rank``.
    """
    placed = settle(
        df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id())
    )
    earlier = Window.orderBy("_block")  # one row per block
    offsets = (
        placed.groupBy("_block")
        .agg(F.sum(amount).alias("_sum"))
        .select("_block", (F.sum("_sum").over(earlier) - F.col("_sum")).alias("_before"))
    )
    inside = Window.partitionBy("_block").orderBy(*order)
    return (
        placed.withColumn("_in", F.sum(amount).over(inside))
        .join(small_side(offsets), "_block")
        .withColumn(out, F.col("_in") + F.col("_before"))
        .select(*df.columns, out)
    )
