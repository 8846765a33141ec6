"""A/B test statistics over all rows; p-values from the few numbers that remain.

Every test first reduces the rows to one row per group. A statistic that is undefined (a group of
one, no variance) is None, and so is its p-value.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.functions.special import (
    f_upper,
    normal_quantile,
    normal_two_sided,
    normal_upper,
    t_two_sided,
)
from cohortica.operators.quantiles import grouped_quantile
from cohortica.operators.ranking import global_rank
from cohortica.session import small_side

# Royston's polynomials (AS R94, 1995) in 1/sqrt(n), highest power first.
ROYSTON_LAST = (-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0)
ROYSTON_NEXT = (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0)
# Mean and log spread of ln(1 - W) in ln(n) for n >= 12, highest power first.
ROYSTON_MEAN = (0.0038915, -0.083751, -0.31082, -1.5861)
ROYSTON_SPREAD = (0.0030302, -0.082676, -0.4803)
# Mean and log spread in n, and the bound gamma, for 4 <= n <= 11.
ROYSTON_SMALL_MEAN = (-0.0006714, 0.025054, -0.39978, 0.5440)
ROYSTON_SMALL_SPREAD = (-0.0020322, 0.062767, -0.77857, 1.3822)
ROYSTON_SMALL_GAMMA = (0.459, -2.273)


def _poly(coefficients, x: float) -> float:
    total = 0.0
    for c in coefficients:
        total = total * x + c
    return total


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def ab_means(df: DataFrame, group: str = "grp", col: str = "purchase") -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(col).alias("mean"))


def shapiro_w(df: DataFrame, key: str, group: str = "grp", col: str = "purchase") -> DataFrame:
    """Shapiro-Wilk W and p-value per group, by Royston's approximation.

    Ranks come from range partitions, and the sums W needs from one aggregate, so all rows of any
    group take part. Royston's p-value is published for 3 <= n <= 5000; above that ``p_value`` is
    an extrapolation and ``p_in_range`` is false.
    """
    x = F.col("_x")
    present = df.select(group, F.col(col).cast("double").alias("_x"), key).where(x.isNotNull())
    ranked = global_rank(present, ["_x", key], "_i", [group])
    sizes = (
        present.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"), F.avg("_x").alias("_mean"))
    )
    i, n = F.col("_i"), F.col("_n")
    m = normal_quantile((i - 0.375) / (n + 0.25))
    inner = (i >= 3) & (i <= n - 2)
    sums = (
        ranked.join(small_side(sizes), group)
        .withColumn("_m", m)
        .groupBy(group)
        .agg(
            F.max("_n").alias("n"),
            F.sum(F.col("_m") * F.col("_m")).alias("mm"),
            F.sum(F.when(inner, F.col("_m") * x)).alias("inner"),
            F.max(F.when(i == n, F.col("_m"))).alias("m_last"),
            F.max(F.when(i == n - 1, F.col("_m"))).alias("m_next"),
            F.max(F.when(i == n, x)).alias("x_last"),
            F.max(F.when(i == n - 1, x)).alias("x_next"),
            F.max(F.when(i == 1, x)).alias("x_first"),
            F.max(F.when(i == 2, x)).alias("x_second"),
            F.sum((x - F.col("_mean")) * (x - F.col("_mean"))).alias("ss"),
        )
    )
    rows = []
    for r in sums.collect():  # one row per test group
        w = _royston_w(r)
        p = _royston_p(w, r["n"])
        rows.append((r[group], r["n"], w, p, 3 <= r["n"] <= 5000))
    kind = dict(df.dtypes)[group]
    schema = f"`{group}` {kind}, n bigint, w double, p_value double, p_in_range boolean"
    return _table(df, rows, schema)


def _royston_w(r) -> float | None:
    n, mm, ss = r["n"], r["mm"], r["ss"]
    if n < 3 or not ss:
        return None
    if n == 3:
        return max(0.75, min(1.0, 0.5 * (r["x_last"] - r["x_first"]) ** 2 / ss))
    u = 1 / math.sqrt(n)
    last = r["m_last"] / math.sqrt(mm) + _poly(ROYSTON_LAST, u)
    top = last * (r["x_last"] - r["x_first"])
    if n > 5:
        nxt = r["m_next"] / math.sqrt(mm) + _poly(ROYSTON_NEXT, u)
        top += nxt * (r["x_next"] - r["x_second"])
        rest = (mm - 2 * r["m_last"] ** 2 - 2 * r["m_next"] ** 2) / (1 - 2 * last**2 - 2 * nxt**2)
        top += r["inner"] / math.sqrt(rest)
    else:
        rest = (mm - 2 * r["m_last"] ** 2) / (1 - 2 * last**2)
        top += r["m_next"] * (r["x_next"] - r["x_second"]) / math.sqrt(rest)
    return min(1.0, top * top / ss)


def _royston_p(w: float | None, n: int) -> float | None:
    if w is None:
        return None
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return min(1.0, max(0.0, p))
    if w >= 1:
        return 1.0
    y = math.log1p(-w)
    if n <= 11:
        gamma = _poly(ROYSTON_SMALL_GAMMA, n)
        if y >= gamma:
            return 0.0
        y = -math.log(gamma - y)
        mean, spread = _poly(ROYSTON_SMALL_MEAN, n), math.exp(_poly(ROYSTON_SMALL_SPREAD, n))
    else:
        ln = math.log(n)
        mean, spread = _poly(ROYSTON_MEAN, ln), math.exp(_poly(ROYSTON_SPREAD, ln))
    return normal_upper((y - mean) / spread)


def levene(df: DataFrame, group: str = "grp", col: str = "purchase") -> DataFrame:
    """Equality of variances by absolute distances to the group medians (Brown-Forsythe)."""
    rows = df.where(F.col(group).isNotNull() & F.col(col).isNotNull())
    medians = grouped_quantile(rows, [group], col, 0.5, "_med")
    stats = (
        rows.join(small_side(medians), group)
        .withColumn("_z", F.abs(F.col(col) - F.col("_med")))
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_z").alias("z"),
            F.var_pop("_z").alias("v"),
        )
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("z")).alias("nz"),
            F.sum(F.col("n") * F.col("z") * F.col("z")).alias("nzz"),
            F.sum(F.col("n") * F.col("v")).alias("within"),
        )
        .first()
    )
    k, n = stats["k"], stats["n"] or 0
    f = p = None
    if k > 1 and n > k and stats["within"]:
        between = stats["nzz"] - stats["nz"] ** 2 / n
        f = (n - k) / (k - 1) * max(between, 0.0) / stats["within"]
        p = f_upper(f, k - 1, n - k)
    rows = [(f, k - 1, n - k, p)]
    return _table(df, rows, "statistic double, df1 bigint, df2 bigint, p_value double")


def ttest_ind(
    df: DataFrame,
    group: str = "grp",
    col: str = "purchase",
    first: str = "control",
    second: str = "test",
) -> DataFrame:
    """Two-sample t-test with pooled variance, two-sided."""
    stats = {
        r[group]: r
        for r in df.where(F.col(group).isin(first, second))
        .groupBy(group)
        .agg(F.count(col).alias("n"), F.avg(col).alias("m"), F.var_samp(col).alias("v"))
        .collect()
    }
    t = p = dof = None
    a, b = stats.get(first), stats.get(second)
    if a and b and a["n"] and b["n"]:
        dof = a["n"] + b["n"] - 2
        pooled = sum((r["n"] - 1) * (r["v"] or 0.0) for r in (a, b)) / dof if dof else 0.0
        if pooled:
            t = (a["m"] - b["m"]) / math.sqrt(pooled * (1 / a["n"] + 1 / b["n"]))
            p = t_two_sided(t, dof)
    return _table(df, [(t, dof, p)], "statistic double, dof bigint, p_value double")


def ab_decide(
    df: DataFrame,
    key: str,
    alpha: float = 0.05,
    group: str = "grp",
    col: str = "purchase",
    first: str = "control",
    second: str = "test",
) -> DataFrame:
    """Normality of each group, equality of variances, then the t-test and its verdict."""
    normal = {r[group]: r["p_value"] for r in shapiro_w(df, key, group, col).collect()}
    equal = levene(df, group, col).first()["p_value"]
    test = ttest_ind(df, group, col, first, second).first()
    is_normal = all(p is not None and p >= alpha for p in normal.values())
    is_equal = equal is not None and equal >= alpha
    if test["p_value"] is None:
        verdict = "undefined"
    else:
        verdict = "different" if test["p_value"] < alpha else "no difference"
    row = (is_normal, is_equal, test["statistic"], test["p_value"], verdict)
    return _table(
        df,
        [row],
        "groups_normal boolean, equal_variance boolean, statistic double, p_value double, "
        "verdict string",
    )


def proportions_ztest(df: DataFrame, flag: str, target: str) -> DataFrame:
    """Pooled two-proportion z-test of a 0/1 target between flag 1 and flag 0, two-sided."""
    stats = {
        r[flag]: r
        for r in df.where(F.col(flag).isin(0, 1))
        .groupBy(flag)
        .agg(F.sum(target).alias("hits"), F.count(target).alias("n"))
        .collect()
    }
    z = p = None
    a, b = stats.get(1), stats.get(0)
    if a and b and a["n"] and b["n"]:
        share = (a["hits"] + b["hits"]) / (a["n"] + b["n"])
        spread = share * (1 - share) * (1 / a["n"] + 1 / b["n"])
        if spread > 0:
            z = (a["hits"] / a["n"] - b["hits"] / b["n"]) / math.sqrt(spread)
            p = normal_two_sided(z)
    return _table(df, [(z, p)], "statistic double, p_value double")

