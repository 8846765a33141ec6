"""From customers to the ids of an audience."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortica.operators.relational import add_total, attach_scores, parse_dates, select_audience
from cohortica.operators.rfm import (
    rfm_from_totals,
    rfm_scores,
    rfm_segments,
    segment_names,
)


def rfm_audience(
    customers: DataFrame,
    ref_date: str,
    segments: Sequence[str],
    pattern: str,
    key: str = "master_id",
) -> DataFrame:
    """Ids of customers in the segments whose interests match: totals, scores, segments, filter."""
    customers = parse_dates(customers)
    customers = add_total(customers, ["order_num_online", "order_num_offline"], "total_orders")
    customers = add_total(customers, ["value_online", "value_offline"], "total_value")
    scores = rfm_segments(rfm_scores(rfm_from_totals(customers, ref_date, key), key))
    joined = attach_scores(customers, scores.select(key, "segment"), key)
    return select_audience(joined, segments, pattern, key, known=segment_names())
