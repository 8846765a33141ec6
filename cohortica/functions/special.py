"""Special functions: as Column expressions for all rows, as floats for single test statistics."""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Stirling series of ln Gamma, B_2k / (2k (2k - 1)).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)

# Rational approximation of the normal quantile (Acklam), centre and tail.
CENTRE_TOP = (
    -3.969683028665376e01,
    2.209460984245205e02,
    -2.759285104469687e02,
    1.383577518672690e02,
    -3.066479806614716e01,
    2.506628277459239e00,
)
CENTRE_BOTTOM = (
    -5.447609879822406e01,
    1.615858368580409e02,
    -1.556989798598866e02,
    6.680131188771972e01,
    -1.328068155288572e01,
    1.0,
)
TAIL_TOP = (
    -7.784894002430293e-03,
    -3.223964580411365e-01,
    -2.400758277161838e00,
    -2.549732539343734e00,
    4.374664141464968e00,
    2.938163982698783e00,
)
TAIL_BOTTOM = (
    7.784695709041462e-03,
    3.224671290700398e-01,
    2.445134137142996e00,
    3.754408661907416e00,
    1.0,
)
TAIL_FROM = 0.02425


def _stirling(z, log):
    """ln Gamma for z > 0, from operations that columns and arrays share: z is shifted up by 8."""
    w = z + 8.0
    y = z * (z + 7.0)
    shifted = y * (y + 6.0) * (y + 10.0) * (y + 12.0)  # z (z + 1) ... (z + 7)
    series = STIRLING[-1] / (w * w)
    for term in reversed(STIRLING[1:-1]):
        series = (series + term) / (w * w)
    series = (series + STIRLING[0]) / w
    return (w - 0.5) * log(w) - w + 0.5 * math.log(2 * math.pi) + series - log(shifted)


# The same formula runs on columns, in a query, and on arrays, inside a task.
COLUMNS = SimpleNamespace(
    lgamma=lambda z: _stirling(z, F.log),
    log=F.log,
    exp=F.exp,
    log1p=F.log1p,
    abs=F.abs,
    largest=F.greatest,
    where=lambda test, a, b: F.when(test, a).otherwise(b),
    number=lambda x: F.lit(float(x)),
)
ARRAYS = SimpleNamespace(
    lgamma=lambda z: _stirling(z, np.log),
    log=np.log,
    exp=np.exp,
    log1p=np.log1p,
    abs=np.abs,
    largest=np.maximum,
    where=np.where,
    number=float,
)


def _horner(coefficients, x: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def normal_quantile(p: Column) -> Column:
    """Inverse normal distribution function, relative error about 1e-9."""
    q = p - 0.5
    centre = _horner(CENTRE_TOP, q * q) * q / _horner(CENTRE_BOTTOM, q * q)

    def tail(x: Column) -> Column:
        t = F.sqrt(-2 * F.log(x))
        return _horner(TAIL_TOP, t) / _horner(TAIL_BOTTOM, t)

    return (
        F.when(p < TAIL_FROM, tail(p)).when(p > 1 - TAIL_FROM, -tail(1 - p)).otherwise(centre)
    )


def quantile_sql(p: str) -> str:
    """``normal_quantile`` as a SQL expression over the expression ``p``."""

    def horner(coefficients, x):
        text = f"({coefficients[0]!r}::double)"
        for c in coefficients[1:]:
            text = f"({text} * {x} + ({c!r}::double))"
        return text

    def tail(x):
        t = f"sqrt(-2e0 * ln({x}))"
        return f"{horner(TAIL_TOP, t)} / {horner(TAIL_BOTTOM, t)}"

    q = f"({p} - 5e-1)"
    qq = f"({q} * {q})"
    return (
        f"case when {p} < {TAIL_FROM!r} then {tail(p)} "
        f"when {p} > 1 - {TAIL_FROM!r} then -({tail(f'(1 - {p})')}) "
        f"else {horner(CENTRE_TOP, qq)} * {q} / {horner(CENTRE_BOTTOM, qq)} end"
    )


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def normal_upper(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def _ln_gamma_ratio(a: float, b: float) -> float:
    """ln of Gamma(a + b) / (Gamma(a) a**b), without cancellation for large ``a``."""
    if a < 20:
        return math.lgamma(a + b) - math.lgamma(a) - b * math.log(a)

    def rest(z: float) -> float:
        return sum(c / z ** (2 * k + 1) for k, c in enumerate(STIRLING))

    return (a + b - 0.5) * math.log1p(b / a) - b + rest(a + b) - rest(a)


# Gauss-Legendre points on a panel.
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(24)


def beta_tail(a: float, b: float, w: float) -> float:
    """Regularized incomplete beta function I_x(a, b) at ``x = exp(-w)``.

    With ``s = a w`` it is the integral of ``exp(-s) g(s)**(b - 1)`` from ``a w`` on, over a constant
    that tends to Gamma(b), where ``g(s) = a (1 - exp(-s / a))`` tends to ``s``. So nothing cancels
    however large ``a`` is, and the limit for ``a`` without bound is the chi-square tail. Below
    ``s = 1`` the power series of the complement is summed, above it panels of bounded width.
    """
    if w <= 0:
        return 1.0
    if math.isinf(w):
        return 0.0
    ratio, start = _ln_gamma_ratio(a, b), a * w
    if start < 1:
        y = -math.expm1(-w)
        term, total = 1.0, 1 / b
        for n in range(1, 10_000):
            term *= (n - a) / n * y
            total += term / (b + n)
            if abs(term) <= 1e-17 * abs(total) * (b + n):
                return 1 - math.exp(ratio + b * math.log(a * y) - math.lgamma(b)) * total
        raise ArithmeticError(f"the series has not converged at a={a}, b={b}, w={w}")
    last = max(start, b) + 60 + 12 * math.sqrt(2 * b)
    panels = np.linspace(0, math.sqrt(last - start), 2 + int(2 * math.sqrt(last - start)))
    half = np.diff(panels)[:, None] / 2
    y = panels[:-1, None] + half * (1 + _NODES)
    s = start + y**2
    power = (b - 1) * np.log(-a * np.expm1(-s / a))
    values = np.exp(ratio - math.lgamma(b) + power - s) * 2 * y
    return float(min(1.0, (values * _WEIGHTS * half).sum()))


def t_two_sided(t: float, df: float) -> float:
    return beta_tail(df / 2, 0.5, math.log1p(t * t / df))


def f_upper(f: float, df1: float, df2: float) -> float:
    return beta_tail(df2 / 2, df1 / 2, math.log1p(df1 * f / df2)) if f > 0 else 1.0
