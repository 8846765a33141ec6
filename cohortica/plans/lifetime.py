"""From order lines to customer lifetime values and their segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.operators.cltv import (
    BgNbd,
    GammaGamma,
    cltv,
    cltv_base,
    cltv_segments,
    fit_bgnbd,
    fit_gamma_gamma,
)
from cohortica.operators.outliers import clip_outliers, outlier_thresholds
from cohortica.operators.relational import drop_cancelled, filter_min
from cohortica.session import settle


@dataclass(frozen=True)
class Lifetime:
    purchases: BgNbd
    value: GammaGamma
    customers: DataFrame


def lifetime_values(
    lines: DataFrame, ref_date: str, months: int = 6, rate: float = 0.01, penalizer: float = 0.001
) -> Lifetime:
    """Clean and clip the lines, fit both models, value every customer and cut into quartiles.

    The lines are read again for the fences, two columns only, rather than written a second time.
    """
    lines = drop_cancelled(lines, "invoice")
    lines = filter_min(filter_min(lines, "quantity"), "price")
    lines = lines.where(F.col("customer_id").isNotNull())
    lines = clip_outliers(
        lines, outlier_thresholds(lines, ["quantity", "price"], 0.01, 0.99, "outward")
    )
    base = settle(cltv_base(lines, ref_date))
    base = base.where(F.col("monetary") > 0)
    purchases, value = fit_bgnbd(base, penalizer), fit_gamma_gamma(base, penalizer)
    return Lifetime(
        purchases, value, cltv_segments(cltv(base, purchases, value, months, rate))
    )
