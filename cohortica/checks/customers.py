"""Queries on binning, RFM, lifetime value, reviews and A/B tests."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from cohortica.checks.fixtures import load, table, with_fixture
from cohortica.checks.registry import query
from cohortica.checks.tables import REF, omnichannel, segment_sql
from cohortica.functions.special import quantile_sql
from cohortica.operators import abtest, binning, cltv, relational, reviews, rfm
from cohortica.operators.collaborative import latest_favourite
from cohortica.plans.audience import rfm_audience
from cohortica.plans.lifetime import lifetime_values


def edges_sql(col: str, k: int, source: str) -> str:
    probs = ", ".join(f"{i}e0 / {k}" for i in range(k + 1))
    return f"select quantile_cont({col}::double, [{probs}]) as e from {source}"


def bin_sql(col: str, edges: str, labels) -> str:
    labels = list(labels)
    whens = " ".join(
        f"when {col} <= {edges}[{i + 2}] then {x}" for i, x in enumerate(labels[:-1])
    )
    return f"case {whens} when {col} is not null then {labels[-1]} end"


# Binning


@query(
    "q_qcut",
    f"with q as ({edges_sql('o_totalprice', 5, 'orders')}) select o_orderkey, "
    f"{bin_sql('o_totalprice', 'e', range(1, 6))} as bin from orders, q",
)
def qcut(spark, sf):
    return binning.qcut(table(spark, sf, "orders"), "o_totalprice", 5).select("o_orderkey", "bin")


@query(
    "q_qcut_interval",
    f"with q as ({edges_sql('value', 4, 'events')}) select event_id, "
    f"{bin_sql('value', 'e', range(1, 5))} as bin, "
    f"{bin_sql('value', 'e', [f'e[{i}]' for i in range(1, 5)])} as lo, "
    f"{bin_sql('value', 'e', [f'e[{i}]' for i in range(2, 6)])} as hi from events, q",
    {"lo": 6, "hi": 6},
)
def qcut_interval(spark, sf):
    return binning.qcut_interval(table(spark, sf, "events"), "value", 4).select(
        "event_id", "bin", "lo", "hi"
    )


@query(
    "q_rank_qcut",
    with_fixture("fx_omnichannel")
    + "select master_id, greatest(1, ceil(5e0 * (row_number() over "
    "(order by order_num_online + order_num_offline, master_id) - 1) / (count(*) over () - 1)))"
    "::int as bin from fx_omnichannel",
)
def rank_qcut(spark, sf):
    return binning.rank_qcut(omnichannel(spark, sf), "total_orders", 5, "master_id").select(
        "master_id", "bin"
    )


@query(
    "q_cut",
    with_fixture("fx_health")
    + "select id, case when bmi > 0 and bmi <= 18.5 then 'under' when bmi > 18.5 and bmi <= 24.9 "
    "then 'healthy' when bmi > 24.9 and bmi <= 29.9 then 'over' when bmi > 29.9 and bmi <= 100 "
    "then 'obese' end as band from fx_health",
)
def cut(spark, sf):
    band = binning.cut(
        F.col("bmi"), [0.0, 18.5, 24.9, 29.9, 100.0], ["under", "healthy", "over", "obese"]
    )
    return load(spark, sf, "fx_health").select("id", band.alias("band"))


@query(
    "q_group_transform",
    with_fixture("fx_people")
    + "select id, avg(age) over (partition by sex) as mean_age, m.median_age from fx_people p "
    "left join (select embarked, quantile_cont(age::double, 0.5) as median_age from fx_people "
    "where embarked is not null group by embarked) m on p.embarked = m.embarked",
    {"mean_age": 6, "median_age": 6},
)
def group_transform(spark, sf):
    people = load(spark, sf, "fx_people")
    people = binning.group_transform(people, "sex", "age", "mean", "mean_age")
    people = binning.group_transform(people, "embarked", "age", "median", "median_age")
    return people.select("id", "mean_age", "median_age")


@query(
    "q_latest_favourite",
    with_fixture("fx_ratings")
    + "select user_id, movie_id from (select user_id, movie_id, row_number() over "
    "(partition by user_id order by ts desc, movie_id) as r from fx_ratings where rating = 5) "
    "where r = 1",
)
def favourite(spark, sf):
    return latest_favourite(load(spark, sf, "fx_ratings"))


# RFM


def live_lines(spark, sf):
    return relational.drop_cancelled(load(spark, sf, "fx_retail"), "invoice")


RFM_BASE = (
    "rfm as (select customer_id, "
    f"date_sub('day', max(invoice_date), timestamp '{REF}') as recency, "
    "count(distinct invoice) as frequency, sum(quantity * price) as monetary from fx_retail "
    "where not contains(invoice, 'C') and customer_id is not null group by customer_id "
    "having sum(quantity * price) > 0)"
)


def scores_sql(base: str, key: str) -> str:
    return (
        f"er as ({edges_sql('recency', 5, base)}), em as ({edges_sql('monetary', 5, base)}), "
        f"scored as (select b.*, {bin_sql('recency', 'er.e', range(5, 0, -1))} as recency_score, "
        f"greatest(1, ceil(5e0 * (row_number() over (order by frequency, {key}) - 1) "
        "/ (count(*) over () - 1)))::int as frequency_score, "
        f"{bin_sql('monetary', 'em.e', range(1, 6))} as monetary_score from {base} b, er, em), "
        "named as (select *, cast(recency_score as varchar) || cast(frequency_score as varchar) "
        "as rf_score from scored) "
    )


RETAIL_SCORES = (
    with_fixture("fx_retail").rstrip() + ", " + RFM_BASE + ", " + scores_sql("rfm", "customer_id")
)


@query(
    "q_rfm_base",
    with_fixture("fx_retail").rstrip() + ", " + RFM_BASE + " select * from rfm",
    {"monetary": 2},
)
def rfm_base(spark, sf):
    return rfm.rfm_from_lines(live_lines(spark, sf), REF)


OMNI = (
    "t as (select *, order_num_online + order_num_offline as total_orders, "
    "value_online + value_offline as total_value from fx_omnichannel), "
    f"totals as (select master_id, date_sub('day', last_order_date, timestamp '{REF}') as recency, "
    "trunc(total_orders)::bigint as frequency, trunc(total_value)::bigint as monetary from t)"
)


@query(
    "q_rfm_totals",
    with_fixture("fx_omnichannel").rstrip() + ", " + OMNI + " select * from totals",
)
def rfm_totals(spark, sf):
    return rfm.rfm_from_totals(omnichannel(spark, sf), REF)


@query("q_rfm_scores", RETAIL_SCORES + "select * from named", {"monetary": 2})
def rfm_scores(spark, sf):
    return rfm.rfm_scores(rfm.rfm_from_lines(live_lines(spark, sf), REF), "customer_id")


@query(
    "q_rfm_segments",
    RETAIL_SCORES
    + "select customer_id, recency, frequency, monetary, rf_score, "
    + f"{segment_sql('rf_score')} as segment from named",
    {"monetary": 2},
)
def rfm_segments(spark, sf):
    return segments(spark, sf).select(
        "customer_id", "recency", "frequency", "monetary", "rf_score", "segment"
    )


def segments(spark, sf):
    base = rfm.rfm_from_lines(live_lines(spark, sf), REF)
    return rfm.rfm_segments(rfm.rfm_scores(base, "customer_id"))


@query(
    "q_segment_profile",
    RETAIL_SCORES
    + f", s as (select *, {segment_sql('rf_score')} as segment from named) "
    "select segment, avg(recency) as mean_recency, avg(frequency) as mean_frequency, "
    "avg(monetary) as mean_monetary from s group by segment",
    {"mean_recency": 6, "mean_frequency": 6, "mean_monetary": 3},
)
def segment_profile(spark, sf):
    return relational.segment_profile(
        segments(spark, sf), "segment", ["recency", "frequency", "monetary"]
    )


OMNI_SCORES = (
    with_fixture("fx_omnichannel").rstrip()
    + ", "
    + OMNI
    + ", "
    + scores_sql("totals", "master_id")
    + f", s as (select master_id, {segment_sql('rf_score')} as segment from named) "
)


@query(
    "q_attach_scores",
    OMNI_SCORES
    + "select t.master_id, t.order_channel, t.total_orders, s.segment from t "
    "left join (select * from s where segment <> 'champions') s on t.master_id = s.master_id",
)
def attach_scores(spark, sf):
    customers = omnichannel(spark, sf)
    scored = rfm.rfm_segments(rfm.rfm_scores(rfm.rfm_from_totals(customers, REF), "master_id"))
    some = scored.where("segment <> 'champions'").select("master_id", "segment")
    return relational.attach_scores(customers, some).select(
        "master_id", "order_channel", "total_orders", "segment"
    )


@query(
    "q_rfm_audience",
    OMNI_SCORES
    + "select t.master_id from t join s on t.master_id = s.master_id where s.segment in "
    "('cant_loose', 'at_Risk', 'hibernating', 'new_customers') "
    "and regexp_matches(categories, 'MEN|KIDS')",
)
def audience(spark, sf):
    return rfm_audience(
        load(spark, sf, "fx_omnichannel"),
        REF,
        ["cant_loose", "at_Risk", "hibernating", "new_customers"],
        "MEN|KIDS",
    )


# Lifetime value, at fixed parameters


PURCHASES = cltv.BgNbd(0.8, 20.0, 1.6, 2.5)
VALUE = cltv.GammaGamma(6.0, 4.0, 15.0)

CLTV_BASE = (
    with_fixture("fx_retail").rstrip() + ", base as (select customer_id, "
    "date_sub('day', min(invoice_date), max(invoice_date)) / 7e0 as recency, "
    f"date_sub('day', min(invoice_date), timestamp '{REF}') / 7e0 as tenure, "
    "count(distinct invoice) as frequency, "
    "sum(quantity * price) / count(distinct invoice) as monetary from fx_retail "
    "where not contains(invoice, 'C') and customer_id is not null group by customer_id "
    "having count(distinct invoice) > 1) "
)


def cltv_base(spark, sf):
    return cltv.cltv_base(live_lines(spark, sf), REF)


@query(
    "q_cltv_base",
    CLTV_BASE + "select * from base",
    {"recency": 6, "tenure": 6, "monetary": 6},
)
def base(spark, sf):
    return cltv_base(spark, sf)


@query(
    "q_cltv_base_totals",
    with_fixture("fx_omnichannel").rstrip()
    + ", "
    + OMNI
    + " select master_id, date_sub('day', first_order_date, last_order_date) / 7e0 as recency, "
    f"date_sub('day', first_order_date, timestamp '{REF}') / 7e0 as tenure, "
    "total_orders as frequency, total_value / total_orders as monetary from t",
    {"recency": 6, "tenure": 6, "monetary": 6},
)
def base_totals(spark, sf):
    return cltv.cltv_base_totals(omnichannel(spark, sf), REF)


_P = PURCHASES
_BG_SQL = (
    f"lgamma({_P.r} + x) - lgamma({_P.r}) + {_P.r} * ln({_P.alpha}) "
    f"+ lgamma({_P.b} + x) - lgamma({_P.a} + {_P.b} + x) "
    f"- lgamma({_P.b}) + lgamma({_P.a} + {_P.b})"
)


@query(
    "q_bgnbd_loglik",
    CLTV_BASE
    + ", h as (select customer_id, frequency::double as x, recency as tx, tenure as t from base), "
    f"g as (select *, {_BG_SQL} as common, -({_P.r} + x) * ln({_P.alpha} + t) as active, "
    f"ln({_P.a}) - ln({_P.b} + x - 1) - ({_P.r} + x) * ln({_P.alpha} + tx) as dropped from h) "
    "select customer_id, common + active + case when x > 0 then greatest(dropped - active, 0) "
    "+ ln(1 + exp(-abs(dropped - active))) else 0 end as loglik from g",
    {"loglik": 6},
)
def bgnbd_loglik(spark, sf):
    value = cltv.bgnbd_loglik(
        cltv.literals(PURCHASES),
        F.col("frequency").cast("double"),
        F.col("recency"),
        F.col("tenure"),
    )
    return cltv_base(spark, sf).select("customer_id", value.alias("loglik"))


@query("q_bgnbd_fit")
def bgnbd_fit(spark, sf):
    fit = cltv.fit_bgnbd(cltv_base(spark, sf), 0.001)
    return spark.createDataFrame([(k, v) for k, v in vars(fit).items()], "name string, value double")


_E_TERMS = (
    "list_sum([exp(lgamma(ca + k) - lgamma(ca) + lgamma(cb + k) - lgamma(cb) "
    "- lgamma(c + k) + lgamma(c) - lgamma(k + 1e0) + k * ln(z)) for k in range(200)])"
)


def expected_sql(source: str, t: str) -> str:
    """Expected purchases within ``t`` for the histories in ``source``; keeps its columns."""
    p = PURCHASES
    return (
        f"(select * exclude (z, c, ca, cb), case when {t} <= 0 then 0e0 else "
        f"c / ({p.a} - 1e0) * (1 - pow(({p.alpha} + tenure) / ({p.alpha} + tenure + {t}), "
        f"frequency + {p.r}) * pow(1 - z, {p.a} - 1e0 - {p.r} - frequency) * {_E_TERMS}) "
        f"/ (1 + case when frequency > 0 then {p.a} / ({p.b} + frequency - 1e0) * "
        f"pow(({p.alpha} + tenure) / ({p.alpha} + recency), frequency + {p.r}) else 0e0 end) end "
        f"as expected from (select *, {p.a}::double + {p.b} + frequency - 1 as c, "
        f"{p.a}::double + {p.b} - 1 - {p.r} as ca, {p.a}::double - 1 as cb, "
        f"greatest({t}, 1e-9) / ({p.alpha} + tenure + {t}) as z from {source}))"
    )


@query(
    "q_expected_purchases",
    CLTV_BASE
    + "select a.customer_id, a.expected as in_12_weeks, b.expected as in_24_weeks from "
    + expected_sql("base", "12e0")
    + " a join "
    + expected_sql("base", "24e0")
    + " b on a.customer_id = b.customer_id",
    {"in_12_weeks": 6, "in_24_weeks": 6},
)
def expected_purchases(spark, sf):
    x, tx, t = F.col("frequency"), F.col("recency"), F.col("tenure")
    ahead = cltv.expected_purchases(PURCHASES, [12, 24], x, tx, t)
    return (
        cltv_base(spark, sf)
        .withColumn("ahead", ahead)
        .select(
            "customer_id",
            F.col("ahead")[0].alias("in_12_weeks"),
            F.col("ahead")[1].alias("in_24_weeks"),
        )
    )


_V = VALUE


@query(
    "q_gg_loglik",
    CLTV_BASE
    + ", h as (select customer_id, frequency::double as x, monetary as m from base) "
    f"select customer_id, lgamma({_V.p} * x + {_V.q}) - lgamma({_V.p} * x) - lgamma({_V.q}) "
    f"+ {_V.q} * ln({_V.v}) + ({_V.p} * x - 1) * ln(m) + {_V.p} * x * ln(x) "
    f"- ({_V.p} * x + {_V.q}) * ln({_V.v} + x * m) as loglik from h",
    {"loglik": 6},
)
def gg_loglik(spark, sf):
    value = cltv.gamma_gamma_loglik(
        cltv.literals(VALUE), F.col("frequency").cast("double"), F.col("monetary")
    )
    return cltv_base(spark, sf).select("customer_id", value.alias("loglik"))


@query("q_gg_fit")
def gg_fit(spark, sf):
    fit = cltv.fit_gamma_gamma(cltv_base(spark, sf), 0.001)
    return spark.createDataFrame([(k, v) for k, v in vars(fit).items()], "name string, value double")


@query(
    "q_expected_avg_value",
    CLTV_BASE
    + f"select customer_id, {_V.p} * ({_V.v} + frequency * monetary) "
    f"/ ({_V.p} * frequency + {_V.q} - 1e0) as expected_value from base",
    {"expected_value": 3},
)
def expected_avg_value(spark, sf):
    return cltv_base(spark, sf).select(
        "customer_id",
        cltv.expected_avg_value(VALUE, F.col("frequency"), F.col("monetary")).alias(
            "expected_value"
        ),
    )


def cltv_sql(months: int, out: str) -> str:
    """Lifetime value of each customer in ``base``, as a table."""
    week = f"({cltv.WEEKS_PER_MONTH!r}::double * i)"
    ahead = "(select base.*, i from base, (select unnest(range(" + str(months + 1) + ")) as i))"
    return (
        f"(select customer_id, sum(worth * gain / pow(1.01e0, i)) as {out} from (select "
        "customer_id, i, expected - lag(expected) over (partition by customer_id order by i) "
        f"as gain, {_V.p} * ({_V.v} + frequency * monetary) / ({_V.p} * frequency + {_V.q} - 1e0) "
        f"as worth from {expected_sql(ahead, week)}) where i > 0 group by customer_id)"
    )


def valued(spark, sf, months: int, out: str = "cltv"):
    return cltv.cltv(cltv_base(spark, sf), PURCHASES, VALUE, months, 0.01, out=out)


@query("q_cltv", CLTV_BASE + f"select * from {cltv_sql(6, 'cltv')}", {"cltv": 3})
def cltv_six(spark, sf):
    return valued(spark, sf, 6).select("customer_id", "cltv")


CLTV_CUT = (
    CLTV_BASE
    + f", v as {cltv_sql(6, 'cltv')}, q as ({edges_sql('cltv', 4, 'v')}), cuts as (select v.*, "
    + bin_sql("cltv", "q.e", ["'D'", "'C'", "'B'", "'A'"])
    + " as segment from v, q) "
)


@query("q_cltv_segments", CLTV_CUT + "select * from cuts", {"cltv": 3})
def cltv_segments(spark, sf):
    return cltv.cltv_segments(valued(spark, sf, 6).select("customer_id", "cltv"))


@query(
    "q_segment_range",
    CLTV_CUT
    + "select segment, min(cltv) as min, avg(cltv) as mean, max(cltv) as max from cuts "
    "group by segment",
    {"min": 3, "mean": 3, "max": 3},
)
def segment_range(spark, sf):
    cuts = cltv.cltv_segments(valued(spark, sf, 6).select("customer_id", "cltv"))
    return relational.segment_range(cuts, "segment", "cltv")


@query(
    "q_cltv_top_overlap",
    CLTV_BASE
    + f", a as {cltv_sql(1, 'cltv_1')}, b as {cltv_sql(12, 'cltv_12')}, "
    "ta as (select * from a order by cltv_1 desc, customer_id limit 10), "
    "tb as (select * from b order by cltv_12 desc, customer_id limit 10) "
    "select coalesce(ta.customer_id, tb.customer_id) as customer_id, cltv_1, cltv_12 "
    "from ta full join tb on ta.customer_id = tb.customer_id",
    {"cltv_1": 3, "cltv_12": 3},
)
def cltv_top_overlap(spark, sf):
    both = cltv.cltv(
        valued(spark, sf, 1, "cltv_1"), PURCHASES, VALUE, 12, 0.01, out="cltv_12"
    )
    return cltv.top_overlap(both, "cltv_1", "cltv_12", 10, "customer_id")


@query("q_lifetime_values")
def lifetime(spark, sf):
    customers = lifetime_values(load(spark, sf, "fx_retail"), REF).customers
    return customers.select("customer_id", "cltv", "segment")


# Reviews


@query(
    "q_avg_rating",
    with_fixture("fx_reviews") + "select avg(overall) as avg_rating from fx_reviews",
    {"avg_rating": 6},
)
def avg_rating(spark, sf):
    return reviews.avg_rating(load(spark, sf, "fx_reviews"))


REVIEW_BINS = (
    with_fixture("fx_reviews").rstrip()
    + f", q as ({edges_sql('day_diff', 4, 'fx_reviews')}), cuts as (select r.*, "
    + bin_sql("day_diff", "q.e", range(1, 5))
    + " as recency_bin from fx_reviews r, q) "
)


@query(
    "q_rating_by_recency",
    REVIEW_BINS
    + "select recency_bin, avg(overall) as avg_rating, count(*) as n from cuts group by 1",
    {"avg_rating": 6},
)
def rating_by_recency(spark, sf):
    return reviews.rating_by_recency(load(spark, sf, "fx_reviews"))


@query(
    "q_time_weighted_rating",
    REVIEW_BINS
    + "select sum(a * w) as time_weighted_rating from (select avg(overall) as a, "
    "case recency_bin when 1 then 28e-2 when 2 then 26e-2 when 3 then 24e-2 else 22e-2 end as w "
    "from cuts group by recency_bin)",
    {"time_weighted_rating": 6},
)
def time_weighted_rating(spark, sf):
    return reviews.time_weighted_rating(load(spark, sf, "fx_reviews"))


_VOTES = (
    with_fixture("fx_reviews").rstrip()
    + ", v as (select *, total_vote - helpful_yes as helpful_no from fx_reviews) "
)
_Z95 = repr(NormalDist().inv_cdf(0.975))
_WILSON = (
    "case when total_vote = 0 then 0e0 else (helpful_yes::double / total_vote "
    f"+ {_Z95}::double * {_Z95} / (2 * total_vote) - {_Z95}::double * sqrt((helpful_yes::double / "
    "total_vote * (1 - helpful_yes::double / total_vote) "
    f"+ {_Z95}::double * {_Z95} / (4 * total_vote)) / total_vote)) "
    f"/ (1 + {_Z95}::double * {_Z95} / total_vote) end"
)


@query(
    "q_pos_neg_diff",
    _VOTES + "select review_id, helpful_no, helpful_yes - helpful_no as score_pos_neg_diff from v",
)
def pos_neg_diff(spark, sf):
    return reviews.review_scores(load(spark, sf, "fx_reviews")).select(
        "review_id", "helpful_no", "score_pos_neg_diff"
    )


@query(
    "q_average_rating_score",
    _VOTES
    + "select review_id, case when total_vote = 0 then 0e0 else helpful_yes::double / total_vote "
    "end as score_average_rating from v",
    {"score_average_rating": 6},
)
def average_rating_score(spark, sf):
    return reviews.review_scores(load(spark, sf, "fx_reviews")).select(
        "review_id", "score_average_rating"
    )


@query(
    "q_wilson_lower_bound",
    _VOTES + f"select review_id, {_WILSON} as wilson_lower_bound from v",
    {"wilson_lower_bound": 6},
)
def wilson_lower_bound(spark, sf):
    return reviews.review_scores(load(spark, sf, "fx_reviews")).select(
        "review_id", "wilson_lower_bound"
    )


@query(
    "q_top_reviews",
    _VOTES
    + f", w as (select review_id, asin, helpful_yes, helpful_no, {_WILSON} as wilson_lower_bound "
    "from v) select * from w order by wilson_lower_bound desc, review_id limit 20",
    {"wilson_lower_bound": 6},
)
def top_reviews(spark, sf):
    return reviews.top_reviews(load(spark, sf, "fx_reviews")).select(
        "review_id", "asin", "helpful_yes", "helpful_no", "wilson_lower_bound"
    )


# A/B tests


@query(
    "q_ab_means",
    with_fixture("fx_ab") + "select grp, avg(purchase) as mean from fx_ab group by grp",
    {"mean": 6},
)
def ab_means(spark, sf):
    return abtest.ab_means(load(spark, sf, "fx_ab"))


def _poly_sql(coefficients, x: str) -> str:
    text = "0e0"
    for value in coefficients:
        text = f"({text} * {x} + ({value!r}::double))"
    return text


_LAST, _NEXT = (_poly_sql(p, "u") for p in (abtest.ROYSTON_LAST, abtest.ROYSTON_NEXT))


@query(
    "q_shapiro_w",
    with_fixture("fx_ab").rstrip()
    + ", r as (select grp, purchase as x, row_number() over (partition by grp order by purchase, "
    "event_id) as i, count(*) over (partition by grp) as n, avg(purchase) over (partition by grp) "
    "as mu from fx_ab), p as (select *, (i - 375e-3) / (n + 25e-2) as pr from r), "
    f"m as (select *, {quantile_sql('pr')} as m from p), "
    "s as (select grp, max(n) as n, 1 / sqrt(max(n)) as u, sum(m * m) as mm, "
    "max(case when i = n then m end) as ml, max(case when i = n - 1 then m end) as mn, "
    "sum((x - mu) * (x - mu)) as ss from m group by grp), "
    f"a as (select *, ml / sqrt(mm) + {_LAST} as al, mn / sqrt(mm) + {_NEXT} as an from s), "
    "f as (select *, (mm - 2 * ml * ml - 2 * mn * mn) / (1 - 2 * al * al - 2 * an * an) as phi "
    "from a) select f.grp, f.n, pow(sum(x * case when i = 1 then -al when i = 2 then -an "
    "when i = f.n then al when i = f.n - 1 then an else m / sqrt(phi) end), 2) / max(ss) as w "
    "from m join f on m.grp = f.grp group by f.grp, f.n",
    {"w": 6},
)
def shapiro_w(spark, sf):
    return abtest.shapiro_w(load(spark, sf, "fx_ab"), "event_id").select("grp", "n", "w")


@query(
    "q_levene",
    with_fixture("fx_ab").rstrip()
    + ", m as (select grp, quantile_cont(purchase, 0.5) as med from fx_ab group by grp), "
    "z as (select f.grp, abs(purchase - med) as z from fx_ab f join m on f.grp = m.grp), "
    "g as (select grp, count(*) as n, avg(z) as zg, var_pop(z) as v from z group by grp), "
    "t as (select count(*) as k, sum(n)::bigint as n, sum(n * zg) / sum(n) as zz, "
    "sum(n * v) as within from g) "
    "select (n - k)::double / (k - 1) * (select sum(g.n * (zg - t.zz) * (zg - t.zz)) from g) "
    "/ within as statistic, k - 1 as df1, n - k as df2 from t",
    {"statistic": 6},
)
def levene(spark, sf):
    return abtest.levene(load(spark, sf, "fx_ab")).select("statistic", "df1", "df2")


@query(
    "q_ttest",
    with_fixture("fx_ab").rstrip()
    + ", g as (select grp, count(purchase) as n, avg(purchase) as m, var_samp(purchase) as v "
    "from fx_ab group by grp) select (a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) "
    "/ (a.n + b.n - 2) * (1e0 / a.n + 1e0 / b.n)) as statistic, a.n + b.n - 2 as dof "
    "from g a, g b where a.grp = 'control' and b.grp = 'test'",
    {"statistic": 6},
)
def ttest(spark, sf):
    return abtest.ttest_ind(load(spark, sf, "fx_ab")).select("statistic", "dof")


@query("q_ab_decide")
def ab_decide(spark, sf):
    return abtest.ab_decide(load(spark, sf, "fx_ab"), "event_id")


@query(
    "q_ztest",
    with_fixture("fx_people").rstrip()
    + ", g as (select case when cabin is null then 0 else 1 end as f, sum(survived)::double as h, "
    "count(survived)::double as n from fx_people group by 1), t as (select sum(h) / sum(n) as p "
    "from g) select (a.h / a.n - b.h / b.n) / sqrt(p * (1 - p) * (1 / a.n + 1 / b.n)) "
    "as statistic from g a, g b, t where a.f = 1 and b.f = 0",
    {"statistic": 6},
)
def ztest(spark, sf):
    people = load(spark, sf, "fx_people").withColumn("flag", F.col("cabin").isNotNull().cast("int"))
    return abtest.proportions_ztest(people, "flag", "survived").select("statistic")
