"""RFM, lifetime value, reviews and A/B tests on small cases worked out by hand."""

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.functions import columns as c
from cohortica.functions import special
from cohortica.operators import abtest, cltv, relational, reviews, rfm

REF = "2024-02-01"


@pytest.fixture(scope="module")
def lines(spark):
    rows = [
        ("1", "a", "2024-01-01 10:00:00", 2.0, 5.0),
        ("1", "a", "2024-01-01 10:00:00", 1.0, 5.0),
        ("2", "a", "2024-01-15 09:00:00", 1.0, 10.0),
        ("3", "b", "2024-01-31 12:00:00", 4.0, 1.0),
        ("C4", "c", "2024-01-20 00:00:00", 1.0, 9.0),
        ("5", None, "2024-01-20 00:00:00", 1.0, 9.0),
        ("6", "d", "2024-01-20 00:00:00", 1.0, 0.0),
    ]
    df = spark.createDataFrame(
        rows, "invoice string, customer_id string, d string, quantity double, price double"
    )
    df = df.withColumn("invoice_date", F.col("d").cast("timestamp_ntz")).drop("d")
    return relational.drop_cancelled(df, "invoice")


def test_rfm_from_lines(lines):
    got = rfm.rfm_from_lines(lines, REF).orderBy("customer_id").collect()
    # b ordered 12 hours before the reference date: 0 whole days.
    assert got == [("a", 16, 2, 25.0), ("b", 0, 1, 4.0)]


def test_rfm_from_totals_truncates(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 30, 12), 2.9, 99.99)],
        "master_id string, last_order_date timestamp_ntz, total_orders double, total_value double",
    )
    assert rfm.rfm_from_totals(df, REF).first() == ("a", 1, 2, 99)


def test_segments_cover_each_score_once(spark):
    scores = [f"{r}{f}" for r in range(1, 6) for f in range(1, 6)]
    df = spark.createDataFrame([(s,) for s in scores], "rf_score string")
    got = {r["rf_score"]: r["segment"] for r in rfm.rfm_segments(df).collect()}
    assert set(got.values()) == set(rfm.SEGMENTS.values())
    assert got["55"] == got["54"] == "champions" and got["11"] == "hibernating"
    assert got["13"] == "at_Risk" and got["15"] == "cant_loose" and got["41"] == "promising"


def test_unknown_segment_is_an_error(spark):
    df = spark.createDataFrame([("a", "at_Risk", "MEN")], "master_id string, segment string, categories string")
    with pytest.raises(ValueError):
        relational.select_audience(df, ["atrisk"], "MEN", known=rfm.segment_names())
    assert relational.select_audience(df, ["at_Risk"], "MEN").count() == 1


def test_cltv_base(lines):
    got = cltv.cltv_base(lines, REF).collect()
    assert len(got) == 1 and got[0]["customer_id"] == "a"
    assert got[0]["recency"] == 13 / 7 and got[0]["tenure"] == 30 / 7
    assert (got[0]["frequency"], got[0]["monetary"]) == (2, 12.5)


def test_lgamma(spark):
    z = [1e-6, 0.3, 1.0, 2.0, 7.5, 123.4, 1e6]
    df = spark.createDataFrame([(v,) for v in z], "z double")
    got = [r[0] for r in df.select(special.COLUMNS.lgamma(F.col("z"))).collect()]
    assert got == pytest.approx([math.lgamma(v) for v in z], rel=1e-12, abs=1e-13)
    assert special.ARRAYS.lgamma(np.array(z)) == pytest.approx(got, rel=1e-14, abs=1e-13)


def bgnbd_by_hand(p, x, tx, t):
    def beta(a, b):
        return math.exp(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))

    g = math.gamma(p.r + x) * p.alpha**p.r / math.gamma(p.r)
    value = beta(p.a, p.b + x) / beta(p.a, p.b) * g / (p.alpha + t) ** (p.r + x)
    if x > 0:
        value += beta(p.a + 1, p.b + x - 1) / beta(p.a, p.b) * g / (p.alpha + tx) ** (p.r + x)
    return math.log(value)


HISTORIES = [(0.0, 0.0, 20.0), (1.0, 3.0, 20.0), (7.0, 19.0, 30.0)]


def test_likelihoods(spark):
    p = cltv.BgNbd(0.7, 12.0, 1.3, 0.4)
    df = spark.createDataFrame(HISTORIES, "x double, tx double, t double")
    got = df.select(cltv.bgnbd_loglik(cltv.literals(p), F.col("x"), F.col("tx"), F.col("t")))
    want = [bgnbd_by_hand(p, *h) for h in HISTORIES]
    assert [r[0] for r in got.collect()] == pytest.approx(want, rel=1e-10)
    arrays = [np.array(v) for v in zip(*HISTORIES)]
    assert cltv.bgnbd_loglik(vars(p), *arrays, special.ARRAYS) == pytest.approx(want, rel=1e-10)


def test_expected_purchases(spark):
    p = cltv.BgNbd(0.7, 12.0, 1.3, 2.4)
    df = spark.createDataFrame(HISTORIES, "x double, tx double, t double")
    got = df.select(
        cltv.expected_purchases(p, [0, 5, 40], F.col("x"), F.col("tx"), F.col("t")).alias("e")
    ).collect()
    for (x, tx, t), row in zip(HISTORIES, got):
        assert row["e"][0] == 0.0
        for ahead, value in zip((5, 40), row["e"][1:]):
            z, term, total = ahead / (p.alpha + t + ahead), 1.0, 1.0
            for k in range(400):  # the plain series, which is good enough for small x
                up = (p.r + x + k) * (p.b + x + k) / ((p.a + p.b + x - 1 + k) * (k + 1)) * z
                term *= up
                total += term
            shrink = ((p.alpha + t) / (p.alpha + t + ahead)) ** (p.r + x)
            want = (p.a + p.b + x - 1) / (p.a - 1) * (1 - shrink * total)
            if x > 0:
                want /= 1 + p.a / (p.b + x - 1) * ((p.alpha + t) / (p.alpha + tx)) ** (p.r + x)
            assert value == pytest.approx(want, rel=1e-9)


def test_expected_purchases_is_smooth_at_one(spark):
    df = spark.createDataFrame(HISTORIES, "x double, tx double, t double")
    args = F.col("x"), F.col("tx"), F.col("t")
    at_one, near = (
        [r[0][0] for r in df.select(cltv.expected_purchases(p, [12], *args)).collect()]
        for p in (cltv.BgNbd(0.7, 12.0, 1.0, 2.4), cltv.BgNbd(0.7, 12.0, 1.001, 2.4))
    )
    assert at_one == pytest.approx(near, rel=1e-2)


def test_cltv_of_no_months_is_zero(spark):
    df = spark.createDataFrame(
        [(3, 5.0, 9.0, 20.0)], "frequency long, recency double, tenure double, monetary double"
    )
    bg, gg = cltv.BgNbd(0.7, 12.0, 1.3, 2.4), cltv.GammaGamma(6.0, 4.0, 15.0)
    assert cltv.cltv(df, bg, gg, 0).first()["cltv"] == 0.0
    free, dear = (cltv.cltv(df, bg, gg, 6, rate).first()["cltv"] for rate in (0.0, 0.05))
    assert free > dear > 0


def test_fits_find_a_maximum(spark):
    """Simulated customers: the fit beats every nearby point and lands near the truth."""
    rng = np.random.default_rng(7)
    n = 4000
    rate, gone = rng.gamma(2.0, 1 / 10.0, n), rng.beta(1.5, 4.0, n)
    tenure = rng.integers(20, 60, n).astype(float)
    rows = []
    for lam, p, t in zip(rate, gone, tenure):
        now, x, last = rng.exponential(1 / lam), 0, 0.0
        while now <= t:
            x, last = x + 1, now
            if rng.random() < p:
                break
            now += rng.exponential(1 / lam)
        worth = rng.gamma(6.0 * max(x, 1), 1 / rng.gamma(4.0, 1 / 15.0)) / max(x, 1)
        rows.append((float(x), float(round(last, 2)), float(t), float(worth)))
    df = spark.createDataFrame(rows, "frequency double, recency double, tenure double, monetary double")
    bg = cltv.fit_bgnbd(df, 0.0)
    assert bg.r == pytest.approx(2.0, rel=0.35) and bg.alpha == pytest.approx(10.0, rel=0.35)
    x, tx, t, worth = (np.array(v) for v in zip(*rows))

    def score(**p):
        return cltv.bgnbd_loglik({**vars(bg), **p}, x, tx, t, special.ARRAYS).mean()

    best = score()
    for name, value in vars(bg).items():
        assert best >= score(**{name: value * 1.05}) and best >= score(**{name: value * 0.95})
    gg = cltv.fit_gamma_gamma(df, 0.0)
    some = x > 0

    def worth_score(**p):
        return cltv.gamma_gamma_loglik(
            {**vars(gg), **p}, x[some], worth[some], special.ARRAYS
        ).mean()

    best = worth_score()
    for name, value in vars(gg).items():
        assert best >= worth_score(**{name: value * 1.05})
        assert best >= worth_score(**{name: value * 0.95})
    assert gg.p == pytest.approx(6.0, rel=0.35) and gg.q == pytest.approx(4.0, rel=0.35)


def test_top_overlap(spark):
    df = spark.createDataFrame([(1, 3.0, 1.0), (2, 2.0, 2.0), (3, 1.0, 3.0)], "id long, a double, b double")
    got = cltv.top_overlap(df, "a", "b", 2, "id").orderBy("id").collect()
    assert got == [(1, 3.0, None), (2, 2.0, 2.0), (3, None, 3.0)]


def test_review_scores(spark):
    df = spark.createDataFrame(
        [(1, 600, 1000), (2, 0, 0), (3, 5, 5), (4, 0, 5)],
        "review_id long, helpful_yes long, total_vote long",
    )
    got = reviews.review_scores(df).orderBy("review_id").collect()
    assert [r["score_pos_neg_diff"] for r in got] == [200, 0, 5, -5]
    assert [r["score_average_rating"] for r in got] == [0.6, 0.0, 1.0, 0.0]
    wilson = [r["wilson_lower_bound"] for r in got]
    assert wilson == pytest.approx([0.5693094, 0.0, 0.5655175, 0.0], abs=1e-6)
    assert all(w <= r["score_average_rating"] + 1e-12 for w, r in zip(wilson, got))
    assert [r["review_id"] for r in reviews.top_reviews(df, 2).collect()] == [1, 3]


def ab(spark, groups):
    rows = [(i, g, float(v)) for g, vs in groups.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(
        [(i, g, v) for i, (_, g, v) in enumerate(rows)], "id long, grp string, purchase double"
    )


# Weights of eleven men, the example of Shapiro and Wilk (1965).
WEIGHTS = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


def test_shapiro_published_example(spark):
    row = abtest.shapiro_w(ab(spark, {"m": WEIGHTS}), "id").first()
    assert row["n"] == 11 and row["w"] == pytest.approx(0.78881, abs=2e-4)
    assert row["p_value"] == pytest.approx(0.006704, abs=3e-4)


def test_shapiro_edges(spark):
    groups = {"one": [1], "flat": [2, 2, 2, 2], "three": [1, 2, 4], "big": range(6000)}
    got = {r["grp"]: r for r in abtest.shapiro_w(ab(spark, groups), "id").collect()}
    assert got["one"]["w"] is None and got["flat"]["w"] is None
    assert got["three"]["w"] == pytest.approx(0.9642857, abs=1e-6)
    assert got["big"]["n"] == 6000 and not got["big"]["p_in_range"]


def test_ttest_and_levene(spark):
    df = ab(spark, {"control": [1, 2, 3, 4, 5], "test": [2, 4, 6, 8, 10]})
    row = abtest.ttest_ind(df).first()
    assert row["statistic"] == pytest.approx(-1.8973666) and row["dof"] == 8
    assert row["p_value"] == pytest.approx(0.0943497, abs=1e-6)
    row = abtest.levene(df).first()
    # Distances to the medians 2,1,0,1,2 and 4,2,0,2,4.
    assert row["statistic"] == pytest.approx(2.0571429, abs=1e-6) and row["df2"] == 8
    equal = ab(spark, {"control": [1, 2, 3], "test": [1, 2, 3]})
    assert abtest.ttest_ind(equal).first()["statistic"] == 0.0
    assert abtest.ab_decide(equal, "id").first()["verdict"] == "no difference"


def test_undefined_tests_are_null(spark):
    flat = ab(spark, {"control": [1, 1], "test": [1, 1]})
    assert abtest.ttest_ind(flat).first()["p_value"] is None
    assert abtest.levene(flat).first()["p_value"] is None
    assert abtest.ttest_ind(ab(spark, {"control": [1]})).first()["statistic"] is None


def test_proportions(spark):
    rows = [(1, 1)] * 30 + [(1, 0)] * 70 + [(0, 1)] * 20 + [(0, 0)] * 80
    df = spark.createDataFrame(rows, "flag int, hit int")
    row = abtest.proportions_ztest(df, "flag", "hit").first()
    assert row["statistic"] == pytest.approx(1.6329932) and row["p_value"] == pytest.approx(0.1024704)


def test_published_critical_values():
    assert special.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert special.f_upper(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert special.f_upper(3.325835, 5, 10) == pytest.approx(0.05, abs=1e-6)
    assert special.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)


def test_tails_at_any_size():

    for t in (0.001, 1.0, 12.0):
        assert special.t_two_sided(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-9)
        assert special.t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
        for df in (1e12, 1e14, 1e15):
            assert special.t_two_sided(t, df) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-7)
    values = [special.t_two_sided(1.0, 10.0**k) for k in range(16)]
    assert values == sorted(values, reverse=True)
    for x in (0.5, 4.0, 40.0):  # chi-square with 4 degrees of freedom in the limit
        assert special.f_upper(x / 4, 4, 1e15) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-9)
    # F with 2 degrees of freedom above has a closed form.
    assert special.f_upper(3.0, 2, 50) == pytest.approx((1 + 3.0 * 2 / 50) ** -25, rel=1e-12)
    assert special.f_upper(0.0, 3, 50) == 1.0
    assert special.normal_upper(12.0) == pytest.approx(1.776482112077679e-33, rel=1e-9)


def test_fits_say_when_they_have_not_converged():

    with pytest.raises(ArithmeticError):
        cltv._minimize(lambda x: (x**2).sum(axis=1) ** 0.5, np.array([1e6, 1e6]), steps=2)
    # The series needs no such end any more: it is summed around 1 there.
    pole = math.gamma(2.5) * math.gamma(1.6) / math.gamma(3.2) / math.gamma(0.9) * 1e-9**-1.6
    assert cltv._gauss_series(3.2, 0.9, np.array([2.5]), np.array([1 - 1e-9]))[0] == pytest.approx(pole, rel=1e-5)


def test_normal_quantile(spark):
    from statistics import NormalDist

    p = [1e-6, 0.01, 0.024, 0.3, 0.5, 0.9, 0.9999]
    df = spark.createDataFrame([(v,) for v in p], "p double")
    got = [r[0] for r in df.select(special.normal_quantile(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(v) for v in p], abs=2e-8)


def test_days_and_months(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 31, 23), datetime(2024, 2, 1, 1))], "a timestamp_ntz, b timestamp_ntz"
    )
    row = df.select(c.whole_days("a", "b"), c.months_apart("a", "b"), c.day_name("a")).first()
    assert tuple(row) == (0, 1, "Wednesday")


def by_many_digits(a, b, c, z):
    """2F1 term by term with 60 digits."""
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    a, b, c, z = (Decimal(v) for v in (a, b, c, z))
    term = total = Decimal(1)
    k = 0
    while abs(term) > abs(total) * Decimal("1e-25"):
        term *= (a + k) * (b + k) / ((c + k) * (k + 1)) * z
        total += term
        k += 1
    return float(total)


@pytest.mark.parametrize("a,b,c", [(0.3, 1.7, 2.9), (2.6, 3.1, 4.2), (1.5, 2.5, 6.0), (2.0, 1.0, 3.0), (-0.4, 0.7, 30.0), (5.2, 6.3, 3.5)])
def test_gauss_series_near_one(a, b, c):
    for z in (0.0, 0.5, 0.89, 0.91, 0.99, 0.999):
        got = cltv._gauss_series(a, b, np.array([c]), np.array([z]))[0]
        assert got == pytest.approx(by_many_digits(a, b, c, z), rel=2e-8)
    # At the edge: what is left is the pole, or the value at 1.
    z = 1 - 1e-9
    got = cltv._gauss_series(a, b, np.array([c]), np.array([z]))[0]
    import math

    if c > a + b + 0.5:
        assert got == pytest.approx(math.gamma(c) * math.gamma(c - a - b) / math.gamma(c - a) / math.gamma(c - b), rel=1e-3)
    elif c < a + b - 0.5:
        assert got == pytest.approx(math.gamma(c) * math.gamma(a + b - c) / math.gamma(a) / math.gamma(b) * (1 - z) ** (c - a - b), rel=1e-3)
