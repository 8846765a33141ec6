"""Register queries next to the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: Mapping[str, int] | None = None):
    """Register a query. ``digits`` rounds doubles, in Spark and in SQL alike: sums of doubles
    differ in their last digits with the order of the rows."""
    digits = dict(digits or {})

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(spark, sf_dir)
            return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in digits.items()})

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            rounded = ", ".join(f"round({c}, {d}) + 0e0 as {c}" for c, d in digits.items())
            ORACLES[name] = f"select * replace ({rounded}) from ({sql})" if rounded else sql
        return run

    return register
