"""Customer lifetime value: BG/NBD for purchases, Gamma-Gamma for their value.

BG/NBD is Fader, Hardie and Lee (2005), Gamma-Gamma is Fader and Hardie (2013). Likelihoods and
predictions are evaluated where the rows are. A fit compresses customers to distinct histories with
counts, and each step evaluates many parameter points in one pass over them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.functions.columns import whole_days
from cohortica.functions.special import ARRAYS, COLUMNS
from cohortica.operators.binning import edge_bin, quantile_edges
from cohortica.operators.relational import top_k
from cohortica.operators.rfm import at
from cohortica.session import parallelism, settle

WEEKS_PER_MONTH = 365 / 84
HISTORIES_PER_TASK = 4_000


@dataclass(frozen=True)
class BgNbd:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class GammaGamma:
    p: float
    q: float
    v: float


def cltv_base(
    lines: DataFrame,
    ref_date: str,
    customer: str = "customer_id",
    invoice: str = "invoice",
    date: str = "invoice_date",
    quantity: str = "quantity",
    price: str = "price",
) -> DataFrame:
    """Weeks from first to last order and from first order to ``ref_date``, invoices, mean value.

    Only customers with more than one invoice.
    """
    return (
        lines.where(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            (whole_days(F.min(date), F.max(date)) / F.lit(7.0)).alias("recency"),
            (whole_days(F.min(date), at(ref_date)) / F.lit(7.0)).alias("tenure"),
            F.count_distinct(invoice).alias("frequency"),
            F.sum(F.col(quantity) * F.col(price)).alias("_total"),
        )
        .where(F.col("frequency") > 1)
        .withColumn("monetary", F.col("_total") / F.col("frequency"))
        .drop("_total")
    )


def cltv_base_totals(
    customers: DataFrame,
    ref_date: str,
    customer: str = "master_id",
    first: str = "first_order_date",
    last: str = "last_order_date",
    orders: str = "total_orders",
    value: str = "total_value",
) -> DataFrame:
    """The same from one row of totals per customer, without a filter on frequency."""
    return customers.select(
        customer,
        (whole_days(F.col(first), F.col(last)) / F.lit(7.0)).alias("recency"),
        (whole_days(F.col(first), at(ref_date)) / F.lit(7.0)).alias("tenure"),
        F.col(orders).alias("frequency"),
        F.try_divide(F.col(value), F.col(orders)).alias("monetary"),
    )


# Likelihoods, on columns or on arrays as ``m`` says. A parameter is a number, or an array with one
# entry per parameter point.


def bgnbd_loglik(p: Mapping, x, tx, t, m=COLUMNS):
    """ln of the likelihood of x purchases, the last at tx, in a history of length t."""
    r, alpha, a, b = p["r"], p["alpha"], p["a"], p["b"]
    start = m.lgamma(r + x) - m.lgamma(r) + r * m.log(alpha)
    alive = m.lgamma(b + x) - m.lgamma(a + b + x) - m.lgamma(b) + m.lgamma(a + b)
    active = -(r + x) * m.log(alpha + t)
    # Without a purchase the second term is 0 and any positive stand-in for b + x - 1 will do.
    left = m.where(x > 0, b + x - 1, m.number(1))
    gap = m.log(a) - m.log(left) - (r + x) * m.log(alpha + tx) - active
    both = m.largest(gap, m.number(0)) + m.log1p(m.exp(-m.abs(gap)))
    return start + alive + active + m.where(x > 0, both, m.number(0))


def gamma_gamma_loglik(p: Mapping, x, value, m=COLUMNS):
    """ln of the likelihood of a mean value over x purchases."""
    px = p["p"] * x
    q, v = p["q"], p["v"]
    return (
        m.lgamma(px + q)
        - m.lgamma(px)
        - m.lgamma(q)
        + q * m.log(v)
        + (px - 1) * m.log(value)
        + px * m.log(x)
        - (px + q) * m.log(v + x * value)
    )


def literals(params: BgNbd | GammaGamma) -> dict[str, Column]:
    return {k: F.lit(float(v)) for k, v in vars(params).items()}


def _minimize(
    evaluate: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int = 40
) -> np.ndarray:
    """Damped Newton steps on finite differences; each call of ``evaluate`` is one Spark job.

    The job that tries the steps also evaluates the points around the full step, so an iteration
    that takes the full step needs no second job. Raises if ``steps`` do not get to a minimum.
    """
    n, h = len(start), 1e-3
    unit = np.eye(n) * h
    pairs = [(i, j) for i in range(n) for j in range(i)]
    offsets = [np.zeros(n)]
    offsets += [s * u for u in unit for s in (1, -1)]
    offsets += [s * (unit[i] + unit[j]) for i, j in pairs for s in (1, -1)]
    around = np.array(offsets)

    theta, f = start, evaluate(start + around)
    for _ in range(steps):
        up, down = f[1 : 2 * n + 1 : 2], f[2 : 2 * n + 1 : 2]
        slope = (up - down) / (2 * h)
        curve = np.diag((up - 2 * f[0] + down) / h**2)
        for place, (i, j) in enumerate(pairs):
            plus, minus = f[2 * n + 1 + 2 * place], f[2 * n + 2 + 2 * place]
            mixed = plus - up[i] - up[j] + 2 * f[0] - down[i] - down[j] + minus
            curve[i, j] = curve[j, i] = mixed / (2 * h**2)
        sizes, axes = np.linalg.eigh(curve)
        newton = -axes @ ((axes.T @ slope) / np.maximum(np.abs(sizes), 1e-6))
        newton *= min(1.0, 2.0 / max(np.abs(newton).max(), 1e-300))
        full = theta + newton
        tries = [theta + s * newton for s in (2.0, 0.5, 0.25, 0.06, 0.015)]
        tries += [theta - s * slope for s in (1.0, 0.1, 0.01)]
        values = evaluate(np.vstack([full + around, tries]))
        at_full, others = values[: len(around)], values[len(around) :]
        best = int(np.nanargmin(others))
        gain = f[0] - np.nanmin([at_full[0], others[best]])
        if not gain > 0:
            return theta
        if at_full[0] <= others[best]:
            theta, f = full, at_full
        else:
            theta = tries[best]
            f = evaluate(theta + around) if gain >= 1e-6 else f
        if gain < 1e-6:
            return theta
    raise ArithmeticError(f"the fit has not converged in {steps} steps, last gain {gain:.3g}")


def _fit(
    histories: DataFrame,
    loglik: Callable[[dict[str, np.ndarray], pd.DataFrame], np.ndarray],
    names: Sequence[str],
    start: Sequence[float],
    penalizer: float,
) -> np.ndarray:
    """Parameters with the least mean negative log-likelihood plus the L2 penalty.

    Each task sums its histories for all parameter points; a point's partial sums are added by
    Spark, and one number per point comes back.
    """
    total = histories.agg(F.sum("n")).first()[0]

    def evaluate(thetas: np.ndarray) -> np.ndarray:
        params = np.exp(thetas)
        columns = {k: params[:, i, None] for i, k in enumerate(names)}

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                values = loglik(columns, pdf) @ pdf["n"].to_numpy(dtype=float)
                yield pd.DataFrame({"i": np.arange(len(values)), "ll": values})

        parts = histories.mapInPandas(partial, "i int, ll double")
        sums = dict(parts.groupBy("i").agg(F.sum("ll")).collect())
        fits = np.array([sums[i] for i in range(len(thetas))])
        return -fits / total + penalizer * (params**2).sum(axis=1)

    return np.exp(_minimize(evaluate, np.log(np.array(start, dtype=float))))


def _spread(histories: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Settle the histories in parts of a few thousand rows, or a few parts per core."""
    histories = settle(histories)
    parts = parallelism(histories.sparkSession, -(-histories.count() // HISTORIES_PER_TASK))
    return settle(histories.repartition(parts, *keys)) if parts > 1 else histories


def fit_bgnbd(base: DataFrame, penalizer: float = 0.001, repeat_only: bool = False) -> BgNbd:
    """Fit r, alpha, a and b by penalized maximum likelihood.

    ``repeat_only`` counts purchases after the first, as the model defines them; the default
    counts all. Customers with the same history share one row of the likelihood. Time is brought
    to a longest history of 10 for the fit, so that the penalty does not depend on its unit.
    """
    x = F.col("frequency").cast("double") - (1 if repeat_only else 0)
    histories = (
        base.select(x.alias("x"), F.col("recency").alias("tx"), F.col("tenure").alias("t"))
        .na.drop()
        .groupBy("x", "tx", "t")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    histories = _spread(histories, ["x", "tx", "t"])
    unit = 10.0 / (histories.agg(F.max("t")).first()[0] or 10.0)
    histories = histories.withColumns({"tx": F.col("tx") * unit, "t": F.col("t") * unit})
    r, alpha, a, b = _fit(
        histories,
        lambda p, h: bgnbd_loglik(
            p, h["x"].to_numpy(), h["tx"].to_numpy(), h["t"].to_numpy(), ARRAYS
        ),
        ("r", "alpha", "a", "b"),
        (1.0, 1.0, 1.0, 1.5),
        penalizer,
    )
    return BgNbd(float(r), float(alpha / unit), float(a), float(b))


def fit_gamma_gamma(base: DataFrame, penalizer: float = 0.001) -> GammaGamma:
    """Fit p, q and v on customers with a positive frequency and mean value."""
    histories = (
        base.select(F.col("frequency").cast("double").alias("x"), F.col("monetary").alias("m"))
        .where((F.col("x") > 0) & (F.col("m") > 0))
        .groupBy("x", "m")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    p, q, v = _fit(
        _spread(histories, ["x", "m"]),
        lambda p, h: gamma_gamma_loglik(p, h["x"].to_numpy(), h["m"].to_numpy(), ARRAYS),
        ("p", "q", "v"),
        (1.0, 1.0, 1.0),
        penalizer,
    )
    return GammaGamma(float(p), float(q), float(v))


# Predictions


# Up to here 2F1 is summed as it stands, a few hundred terms at most; beyond, in powers of 1 - z.
NEAR_ONE = 0.9
# How far the parameters are moved where the two sums of that form are infinite and cancel.
APART = 1e-5


def _plain_series(a, b, c, z) -> np.ndarray:
    """The terms of 2F1 for arrays with z well below 1, summed until none matters."""
    term, total, k = np.ones_like(z), np.ones_like(z), 0
    while True:
        term = term * ((a + k) * (b + k) / ((c + k) * (k + 1.0))) * z
        total = total + term
        k += 1
        if not np.any(np.abs(term) > 1e-17 * np.abs(total)):
            return total


def _log_gamma(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of the size of the gamma function, and its sign; infinite at its poles."""
    pole = (v <= 0) & (v == np.floor(v))
    size = np.vectorize(math.lgamma, otypes=[float])(np.where(pole, 1.0, v))
    return np.where(pole, np.inf, size), np.where((v > 0) | (np.floor(v) % 2 == 0), 1.0, -1.0)


def _around_one(a, b, c, z) -> np.ndarray:
    """2F1 for z near 1 as two sums in powers of 1 - z; c - a - b is no integer."""
    s = c - a - b

    def weight(above, below) -> tuple[np.ndarray, np.ndarray]:
        sizes = [_log_gamma(np.asarray(v, float)) for v in (*above, *below)]
        log = sum(x for x, _ in sizes[: len(above)]) - sum(x for x, _ in sizes[len(above) :])
        return log, np.prod([sign for _, sign in sizes], axis=0)

    near, sign = weight((c, s), (c - a, c - b))
    first = sign * np.exp(near) * _plain_series(a, b, 1 - s, 1 - z)
    far, sign = weight((c, -s), (a, b))
    second = sign * np.exp(far + s * np.log1p(-z)) * _plain_series(c - a, c - b, 1 + s, 1 - z)
    return first + second


def _gauss_series(a: float, b: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss's 2F1(a, b; c; z) for 0 <= z < 1 and c > 0, in a few hundred terms for any z.

    Where c - a - b is (nearly) an integer, both sums around 1 are huge and cancel; there the mean of the values
    for c a little larger and a little smaller is taken.
    """
    a, b, c, z = np.broadcast_arrays(float(a), float(b), np.asarray(c, float), np.asarray(z, float))
    out = np.empty(z.shape)
    plain = ~(z > NEAR_ONE)
    out[plain] = _plain_series(a[plain], b[plain], c[plain], z[plain])
    a, b, c, z = (x[~plain] for x in (a, b, c, z))
    if len(z):
        s = c - a - b
        move = np.where(np.abs(s - np.round(s)) < APART, APART, 0.0)
        out[~plain] = (_around_one(a, b, c + move, z) + _around_one(a, b, c - move, z)) / 2
    return out


def expected_purchases(
    params: BgNbd, times: Sequence[float], x: Column, tx: Column, tenure: Column
) -> Column:
    """Purchases expected within each of ``times`` periods, as an array, given a history.

    The hypergeometric term is summed after Euler's transformation; the plain series loses all
    digits for customers with many purchases. The sum runs over Arrow batches: as nested column
    functions it would be interpreted term by term.
    """
    r, alpha, a, b = params.r, params.alpha, params.a, params.b
    if abs(a - 1) < 1e-9:
        a = 1 + 1e-6
    times = [float(t) for t in times]

    @F.pandas_udf("array<double>")
    def expected(x: pd.Series, tx: pd.Series, tenure: pd.Series) -> pd.Series:
        x, tx, tenure = (s.to_numpy(dtype=float, na_value=np.nan)[:, None] for s in (x, tx, tenure))
        t = np.array(times)[None, :]
        now, later = alpha + tenure, alpha + tenure + t
        z = t / later
        c = np.broadcast_to(x + (a + b - 1), z.shape)
        gauss = (1 - z) ** (a - 1 - r - x) * _gauss_series(a + b - 1 - r, a - 1, c, z)
        top = c / (a - 1) * (1 - (now / later) ** (x + r) * gauss)
        left = np.where(x > 0, b + x - 1, 1.0)
        odds = np.where(x > 0, a / left * (now / (alpha + tx)) ** (x + r), 0.0)
        values = np.where(t > 0, top / (1 + odds), 0.0)
        return pd.Series([None if np.isnan(v).any() else v for v in values])

    return expected(x.cast("double"), tx, tenure)


def expected_avg_value(params: GammaGamma, x: Column, m: Column) -> Column:
    """Expected mean value of a customer's purchases; null where it is undefined."""
    p, q, v = params.p, params.q, params.v
    return F.try_divide(p * (v + x * m), p * x + (q - 1))


def cltv(
    base: DataFrame,
    bg: BgNbd,
    gg: GammaGamma,
    months: int,
    rate: float = 0.01,
    periods_per_month: float = WEEKS_PER_MONTH,
    out: str = "cltv",
) -> DataFrame:
    """Discounted value of the purchases expected in the next months, at a monthly rate."""
    times = [i * periods_per_month for i in range(months + 1)]
    ahead = expected_purchases(bg, times, F.col("frequency"), F.col("recency"), F.col("tenure"))
    worth = expected_avg_value(gg, F.col("frequency"), F.col("monetary"))
    curves = base.withColumn("_ahead", ahead).withColumn("_value", worth)
    total = F.lit(0.0)
    for i in range(1, months + 1):
        bought = F.col("_ahead")[i] - F.col("_ahead")[i - 1]
        total = total + F.col("_value") * bought / F.lit((1 + rate) ** i)
    return curves.withColumn(out, total).drop("_value", "_ahead")


def cltv_segments(
    df: DataFrame, col: str = "cltv", labels: Sequence[str] = ("D", "C", "B", "A")
) -> DataFrame:
    """Quartiles of lifetime value, A the highest. The values are settled before they are cut."""
    df = settle(df)
    edges = quantile_edges(df, [col], len(labels))[col]
    return df.withColumn("segment", edge_bin(F.col(col), edges, labels))


def top_overlap(df: DataFrame, a: str, b: str, k: int, key: str) -> DataFrame:
    """The top k by each of two measures side by side; null where a customer is in only one."""
    left = top_k(df, a, k, key).select(key, a)
    right = top_k(df, b, k, key).select(key, b)
    return left.join(right, key, "full")
