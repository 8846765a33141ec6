"""Whole rows carried through a join, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.session import small_side


def wrapped(docs: DataFrame, id_col: str) -> DataFrame:
    """``key`` and ``row``: the id as a long, and the row as it is."""
    return docs.select(
        F.col(id_col).cast("long").alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``ids``; null ids stay."""
    gone = ids.select(F.col(ids.columns[0]).alias("key")).distinct()
    return wrapped(docs, id_col).join(small_side(gone), "key", "left_anti").select("row.*")
