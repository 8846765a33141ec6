"""From order lines to product recommendations by association rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.operators.baskets import (
    arl_recommend,
    association_rules,
    frequent_itemsets,
    invoice_presence,
)
from cohortica.operators.outliers import clip_outliers, outlier_thresholds
from cohortica.operators.relational import (
    drop_cancelled,
    drop_incomplete,
    exclude,
    filter_min,
    lookup_name,
)


def basket_rules(
    lines: DataFrame,
    country: str,
    item: str = "description",
    not_products: tuple[str, ...] = ("POST",),
    min_support: float = 0.01,
    max_len: int | None = None,
) -> DataFrame:
    """Clean the lines, clip quantity and price, keep one country, and mine its rules."""
    lines = drop_cancelled(drop_incomplete(lines), "invoice")
    for code in not_products:
        lines = exclude(lines, "stock_code", code)
    lines = filter_min(lines, "price")
    lines = clip_outliers(lines, outlier_thresholds(lines, ["quantity", "price"], 0.05, 0.95))
    cells = invoice_presence(lines.where(F.col("country") == F.lit(country)), item=item)
    return association_rules(frequent_itemsets(cells, min_support, max_len))


def recommend_for_codes(
    lines: DataFrame, rules: DataFrame, wanted: DataFrame, n: int = 3
) -> DataFrame:
    """Recommendations for stock codes: ``wanted`` has one column, ``stock_code``."""
    named = lookup_name(wanted, lines, "stock_code", "description")
    picks = arl_recommend(rules, named.select(F.col("description").alias("target")), n)
    return named.join(picks, named["description"] == picks["target"], "left").drop("target")
