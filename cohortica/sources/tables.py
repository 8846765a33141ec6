"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    nan_as_null: bool | None = None,
) -> DataFrame:
    """Read a table by its file ending: delimited text with a header, or parquet.

    Give text a ``schema``: inferring one reads the data twice. Every operator here treats null as
    missing, while Spark counts NaN as a number, so NaN becomes null; for parquet only on request,
    as the replacement keeps filters on those columns from reaching the scan.
    """
    text = path.rstrip("/").endswith((".csv", ".csv.gz"))
    reader = spark.read.schema(schema) if schema else spark.read
    if text:
        reader = reader.option("header", True).option("inferSchema", schema is None)
    df = reader.csv(path) if text else reader.parquet(path)
    return nan_to_null(df) if (text if nan_as_null is None else nan_as_null) else df


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_groups(
    spark: SparkSession, paths: Mapping[str, str], schema: StructType | str | None = None
) -> dict[str, DataFrame]:
    """One table per group, as from a workbook with one sheet each."""
    return {name: read_table(spark, path, schema) for name, path in paths.items()}


def write_audience(df: DataFrame, path: str) -> None:
    """Write customer ids as delimited text with a header, one part file per partition."""
    df.write.mode("errorifexists").option("header", True).csv(path)
