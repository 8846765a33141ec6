"""Shards of nearly equal bytes by a k-d tree over document metadata.

A node of the tree that is to become ``k`` shards is split at the weighted quantile ``floor(k/2)/k``
(the median for even ``k``) of the dimension in which its documents spread widest, until every leaf
is one shard of about the target size. Quantiles are exact and distributed: the position of a point
along the chosen dimension is a 52-bit number, and each of four rounds sums the bytes per node and
13-bit digit, and follows the digit that holds the quantile. No node's rows meet in one task, however
large the node or however many rows share a coordinate.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.operators.ranking import global_rank
from cohortica.session import settle, small_side

# A position is 26 bits of the coordinate, then 26 bits that spread equal coordinates.
COORDINATE_BITS = 26
DIGIT_BITS = 13
DIGITS = 4
# Copies of a text stay in one shard unless they weigh more than this share of a shard; then they
# are cut into runs of about that weight.
GROUP_SHARE = 0.05


def _scaled(value: Column, low: float, high: float) -> Column:
    """``value`` between its bounds as an integer of COORDINATE_BITS bits; null is the lowest."""
    if low is None or high is None or high <= low:
        return F.lit(0).cast("long")
    top = (1 << COORDINATE_BITS) - 1
    return F.coalesce(((value - low) / (high - low) * top).cast("long"), F.lit(0).cast("long"))


def _name_position(value: Column) -> Column:
    """Where a name stands between 0 and 1: its first six bytes as a number."""
    head = F.rpad(F.hex(F.substring(F.encode(value, "utf-8"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double") / F.lit(float(1 << 48))


def kd_points(
    docs: DataFrame, shards: int, id_col: str, text_col: str, dimensions: Mapping[str, Column]
) -> DataFrame:
    """A row per document: id, size, checksum, group of equal texts and its place in every dimension.

    All copies of a text stand where the copy with the smallest id does, so that no split parts them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("_text"),
        *[c.cast("double").alias(f"_d{i}") for i, c in enumerate(dimensions.values())],
    )
    rows = settle(rows)
    copies = (
        rows.groupBy("_text")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("size").alias("_bytes"),
            F.min(F.struct("doc_id", *[f"_d{i}" for i in range(len(dimensions))])).alias("_first"),
        )
        .where("_n > 1")
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    run = max(1.0, GROUP_SHARE * total / shards)  # bytes of a run of copies
    joined = rows.join(small_side(copies), "_text", "left")
    run_of = F.when(
        F.col("_bytes") > run,
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("_bytes") / F.lit(run))),
    ).otherwise(0)
    return joined.select(
        "doc_id", "size", "text_crc32",
        F.xxhash64("_text", F.when(F.col("_n") > 1, run_of)).alias("_tie"),
        *[
            F.when(F.col("_n") > 1, F.col(f"_first._d{i}")).otherwise(F.col(f"_d{i}")).alias(f"_d{i}")
            for i in range(len(dimensions))
        ],
    )


def kd_shards(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", dimensions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the number of UTF-8 bytes of the text (null: none) plus 1. Give the number of
    ``shards`` or the ``target_bytes`` of one. ``slot`` numbers a shard's documents by id from 0
    without gaps. Default dimensions: id, logarithm of the size, source and language; nulls are
    lowest. Null ids come first in their shard, repeated rows are kept. Equal texts stay together
    (see GROUP_SHARE). With fewer documents than shards some shards are empty.
    """
    if dimensions is None:
        size = F.octet_length(F.coalesce(F.col(text_col), F.lit("")))
        dimensions = {
            "id": F.col(id_col), "size": F.log2(size + 1.0),
            "source": _name_position(F.col("source")), "lang": _name_position(F.col("lang")),
        }
    if shards is None:
        if target_bytes is None:
            raise ValueError("give shards or target_bytes")
        text = F.coalesce(F.col(text_col), F.lit(""))
        total = docs.agg(F.sum(F.octet_length(text).cast("long") + 1)).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    points = settle(kd_points(docs, shards, id_col, text_col, dimensions))
    names = [f"_d{i}" for i in range(len(dimensions))]
    bounds = points.agg(
        *[f(n).alias(f"{k}{n}") for n in names for k, f in (("min", F.min), ("max", F.max))]
    ).first()
    points = settle(points.select(
        "doc_id", "size", "text_crc32",
        (F.col("_tie").bitwiseAND((1 << (DIGITS * DIGIT_BITS - COORDINATE_BITS)) - 1)).alias("_tie"),
        *[_scaled(F.col(n), bounds[f"min{n}"], bounds[f"max{n}"]).alias(n) for n in names],
        F.lit(0).alias("_from"), F.lit(shards).alias("_to"),  # the node: its first shard and its end
    ))
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        points = _split_level(points, names)
    out = points.select("doc_id", "size", "text_crc32", F.col("_from").alias("shard"))
    ranked = global_rank(
        out.withColumn("_id", F.coalesce("doc_id", F.lit(-(1 << 63)))),
        ["_id", "text_crc32", "size"], "slot", ["shard"],
    )
    return ranked.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).cast("long").alias("slot")
    )


def _split_level(points: DataFrame, names: list[str]) -> DataFrame:
    """Split every node that is to become more than one shard."""
    width = lambda n: F.max(n) - F.min(n)
    nodes = (
        points.where("_to - _from > 1")
        .groupBy("_from", "_to")
        .agg(F.sum("size").alias("bytes"), F.array(*[width(n) for n in names]).alias("widths"))
        .withColumn("_axis", F.array_position("widths", F.array_max("widths")).cast("int"))
        .withColumn("_mid", F.expr("_from + (_to - _from) div 2"))
        .withColumn("_want", F.expr("bytes * (_mid - _from) / (_to - _from)"))
        .withColumn("_prefix", F.lit(0).cast("long"))
        .select("_from", "_axis", "_mid", "_want", "_prefix")
    )
    nodes = small_side(nodes)
    low = DIGITS * DIGIT_BITS - COORDINATE_BITS
    key = F.shiftleft(F.element_at(F.array(*names), F.col("_axis")), low) + F.col("_tie")
    for digit in range(DIGITS):
        rest = (DIGITS - 1 - digit) * DIGIT_BITS
        found = points.join(nodes, "_from").withColumn("_key", key)
        if digit:
            found = found.where(F.shiftright("_key", rest + DIGIT_BITS) == F.col("_prefix"))
        bins = (
            found.groupBy("_from", F.shiftright("_key", rest).alias("_bin"))
            .agg(F.sum("size").alias("_sum"), *[F.first(c).alias(c) for c in ("_axis", "_mid", "_want")])
            .withColumn(
                "_before",
                F.sum("_sum").over(Window.partitionBy("_from").orderBy("_bin")) - F.col("_sum"),
            )
        )
        # The digit in which the running sum comes to the wanted bytes; bins are few per node.
        nodes = small_side(
            bins.where("_before < _want")
            .groupBy("_from")
            .agg(F.max(F.struct("_bin", "_before", "_sum", "_axis", "_mid", "_want")).alias("b"))
            .select(
                "_from", "b._axis", "b._mid", (F.col("b._want") - F.col("b._before")).alias("_want"),
                F.col("b._bin").alias("_prefix"), F.col("b._sum").alias("_sum"),
            )
        )
    # The points on the quantile itself go to the side that leaves less over.
    left = (F.col("_key") < F.col("_prefix")) | (
        (F.col("_key") == F.col("_prefix")) & (2 * F.col("_want") >= F.col("_sum"))
    )
    return settle(
        points.join(nodes, "_from", "left")
        .withColumn("_key", key)
        .select(
            "doc_id", "size", "text_crc32", "_tie", *names,
            F.when(F.col("_mid").isNull() | left, F.col("_from")).otherwise(F.col("_mid")).alias("_from"),
            F.when(F.col("_mid").isNotNull() & left, F.col("_mid")).otherwise(F.col("_to")).alias("_to"),
        )
    )
