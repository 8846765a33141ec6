"""Recency, frequency and monetary value per customer, and the segments built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.functions.columns import whole_days
from cohortica.operators.binning import edge_bin, quantile_edges, rank_qcut
from cohortica.session import settle

# Segment names by recency and frequency score.
SEGMENTS = {
    r"[1-2][1-2]": "hibernating",
    r"[1-2][3-4]": "at_Risk",
    r"[1-2][5]": "cant_loose",
    r"[3][1-2]": "about_to_sleep",
    r"[3][3]": "need_attention",
    r"[3-4][4-5]": "loyal_customers",
    r"[4][1]": "promising",
    r"[5][1]": "new_customers",
    r"[4-5][2-3]": "potential_loyalist",
    r"[5][4-5]": "champions",
}


def at(ref_date: str):
    """A reference date such as ``2001-08-03`` as a time without zone."""
    return F.lit(ref_date).cast("timestamp_ntz")


def rfm_from_lines(
    lines: DataFrame,
    ref_date: str,
    customer: str = "customer_id",
    invoice: str = "invoice",
    date: str = "invoice_date",
    quantity: str = "quantity",
    price: str = "price",
) -> DataFrame:
    """One aggregate over order lines: whole days since the last order, distinct invoices, revenue.

    Lines without a customer do not count; customers with a revenue of 0 or less are left out.
    """
    return (
        lines.where(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            whole_days(F.max(date), at(ref_date)).alias("recency"),
            F.count_distinct(invoice).alias("frequency"),
            F.sum(F.col(quantity) * F.col(price)).alias("monetary"),
        )
        .where(F.col("monetary") > 0)
    )


def rfm_from_totals(
    customers: DataFrame,
    ref_date: str,
    customer: str = "master_id",
    last: str = "last_order_date",
    orders: str = "total_orders",
    value: str = "total_value",
) -> DataFrame:
    """The same from one row of totals per customer, cut to whole numbers."""
    return customers.select(
        customer,
        whole_days(F.col(last), at(ref_date)).alias("recency"),
        F.col(orders).cast("long").alias("frequency"),
        F.col(value).cast("long").alias("monetary"),
    )


def rfm_scores(rfm: DataFrame, customer: str, k: int = 5) -> DataFrame:
    """Scores 1..k: recency (k is most recent) and monetary by value, frequency by rank.

    The base is settled first: its edges, ranks and rows must come from the same sums.
    """
    rfm = settle(rfm)
    edges = quantile_edges(rfm, ["recency", "monetary"], k)
    recent = rfm.withColumn("recency_score", edge_bin(F.col("recency"), edges["recency"], range(k, 0, -1)))
    ranked = rank_qcut(recent, "frequency", k, customer, out="frequency_score")
    return ranked.withColumn("monetary_score", edge_bin(F.col("monetary"), edges["monetary"])).withColumn(
        "rf_score", F.concat(F.col("recency_score").cast("string"), F.col("frequency_score").cast("string"))
    )


def rfm_segments(
    scores: DataFrame, segments: Mapping[str, str] = SEGMENTS, score: str = "rf_score"
) -> DataFrame:
    """Name the segment of each score pair; a score that fits no pattern keeps its digits."""
    picked = F
    for pattern, name in segments.items():
        picked = picked.when(F.col(score).rlike(f"^(?:{pattern})$"), F.lit(name))
    return scores.withColumn("segment", picked.otherwise(F.col(score)))


def segment_names(segments: Mapping[str, str] = SEGMENTS) -> Sequence[str]:
    return list(segments.values())
