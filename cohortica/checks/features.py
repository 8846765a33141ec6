"""Queries on outliers, missing values, encoding, scaling, derived features and models."""

from __future__ import annotations

from pyspark.sql import functions as F


from cohortica.checks.customers import bin_sql, edges_sql
from cohortica.checks.fixtures import load, table, with_fixture
from cohortica.checks.registry import query
from cohortica.checks.tables import HEALTH_NULLS, corr_sql
from cohortica.functions import columns as c
from cohortica.operators import encode, missing, model, neighbours, outliers, profile, scale
from cohortica.plans import features

PEOPLE = with_fixture("fx_people")
NUMBERS = ["age", "fare", "sibsp"]


def people(spark, sf):
    return load(spark, sf, "fx_people")


def health(spark, sf):
    return missing.zero_to_null(load(spark, sf, "fx_health"), ["glucose", "insulin", "skin", "bmi"])


def names_frame(spark, names):
    return spark.createDataFrame([(x,) for x in names], "variable string")


# Column roles and outliers

_PEOPLE_TEXT = ["name", "sex", "cabin", "embarked"]
_PEOPLE_OTHER = ["id", "age", "pclass", "sibsp", "parch", "fare", "survived"]


def _counts_sql(cols, kind: str) -> str:
    return " union all ".join(
        f"select '{x}' as variable, '{kind}' as kind, count(distinct {x}) as d from fx_people"
        for x in cols
    )


@query(
    "q_col_types",
    PEOPLE.rstrip()
    + f", d as ({_counts_sql(_PEOPLE_TEXT, 'text')} union all "
    f"{_counts_sql(_PEOPLE_OTHER, 'other')}) select variable, case when kind = 'text' and d > 20 "
    "then 'cardinal' when kind = 'text' then 'categorical' when d < 10 "
    "then 'numeric_but_categorical' else 'numeric' end as role from d",
)
def col_types(spark, sf):
    roles = profile.grab_col_names(people(spark, sf))
    rows = [(x, "numeric") for x in roles.numeric] + [(x, "cardinal") for x in roles.cardinal]
    for x in roles.categorical:
        few = x in roles.numeric_but_categorical
        rows.append((x, "numeric_but_categorical" if few else "categorical"))
    return spark.createDataFrame(rows, "variable string, role string")


def fences_sql(cols, q1: float, q3: float, source: str = "fx_people") -> str:
    return " union all ".join(
        f"select '{x}' as variable, a - 15e-1 * (b - a) as low, b + 15e-1 * (b - a) as up from "
        f"(select quantile_cont({x}::double, {q1}) as a, quantile_cont({x}::double, {q3}) as b "
        f"from {source})"
        for x in cols
    )


@query(
    "q_outlier_thresholds",
    PEOPLE.rstrip()
    + f", f as ({fences_sql(NUMBERS, 0.25, 0.75)}) select variable, low, up, "
    "round_even(low, 0) as low_round, round_even(up, 0) as up_round, floor(low) as low_outward, "
    "ceil(up) as up_outward from f",
    {"low": 6, "up": 6},
)
def outlier_thresholds(spark, sf):
    df = people(spark, sf)
    exact = outliers.outlier_thresholds(df, NUMBERS)
    near = outliers.outlier_thresholds(df, NUMBERS, rounding="round")
    outward = outliers.outlier_thresholds(df, NUMBERS, rounding="outward")
    return spark.createDataFrame(
        [(x, *exact[x], *near[x], *outward[x]) for x in NUMBERS],
        "variable string, low double, up double, low_round double, up_round double, "
        "low_outward double, up_outward double",
    )


def people_fences(spark, sf):
    return outliers.outlier_thresholds(people(spark, sf), NUMBERS)


_OUT = " union all ".join(
    f"select '{x}' as variable, {x}::double as x, low, up from fx_people, f "
    f"where variable = '{x}'"
    for x in NUMBERS
)
OUTLIERS = PEOPLE.rstrip() + f", f as ({fences_sql(NUMBERS, 0.25, 0.75)}), o as ({_OUT}) "


@query(
    "q_check_outliers",
    OUTLIERS
    + "select variable, bool_or(coalesce(x < low or x > up, false)) as has_outliers from o "
    "group by variable",
)
def check_outliers(spark, sf):
    return outliers.check_outliers(people(spark, sf), people_fences(spark, sf))


@query(
    "q_grab_outliers",
    OUTLIERS
    + "select id, fare from fx_people, f where variable = 'fare' and (fare < low or fare > up)",
    {"fare": 6},
)
def grab_outliers(spark, sf):
    fence = people_fences(spark, sf)["fare"]
    return outliers.grab_outliers(people(spark, sf), "fare", fence, ["id", "fare"])


@query(
    "q_outlier_summary",
    OUTLIERS
    + "select variable, count(*) filter (x < low or x > up) as outliers, "
    "count(*) filter (x < low or x > up) / count(*)::double as ratio from o group by variable",
    {"ratio": 6},
)
def outlier_summary(spark, sf):
    return outliers.outlier_summary(people(spark, sf), people_fences(spark, sf))


_WIDE_FENCES = (
    ", w as (select max(low) filter (variable = 'age') as age_low, "
    "max(up) filter (variable = 'age') as age_up, max(low) filter (variable = 'fare') as fare_low, "
    "max(up) filter (variable = 'fare') as fare_up from f) "
)


@query(
    "q_remove_outliers",
    OUTLIERS
    + _WIDE_FENCES
    + "select id, age, fare from fx_people, w "
    "where not coalesce(age < age_low or age > age_up, false) "
    "and not coalesce(fare < fare_low or fare > fare_up, false)",
    {"age": 6, "fare": 6},
)
def remove_outliers(spark, sf):
    fences = people_fences(spark, sf)
    kept = outliers.remove_outliers(people(spark, sf), {x: fences[x] for x in ("age", "fare")})
    return kept.select("id", "age", "fare")


@query(
    "q_clip_outliers",
    OUTLIERS
    + _WIDE_FENCES
    + "select id, case when age < age_low then age_low when age > age_up then age_up else age end "
    "as age, case when fare < fare_low then fare_low when fare > fare_up then fare_up else fare "
    "end as fare from fx_people, w",
    {"age": 6, "fare": 6},
)
def clip_outliers(spark, sf):
    fences = people_fences(spark, sf)
    clipped = outliers.clip_outliers(people(spark, sf), {x: fences[x] for x in ("age", "fare")})
    return clipped.select("id", "age", "fare")


LOF = (
    "with pairs as (select a.p_partkey as key, b.p_partkey as donor, sqrt((a.p_size - b.p_size) * "
    "(a.p_size - b.p_size) + (a.p_retailprice - b.p_retailprice) * "
    "(a.p_retailprice - b.p_retailprice)) as dist from part a join part b "
    "on a.p_partkey <> b.p_partkey), near as (select * from pairs "
    "qualify row_number() over (partition by key order by dist, donor) <= 20), "
    "kd as (select key, max(dist) as kdist from near group by key), "
    "lrd as (select near.key, 1 / (avg(greatest(kdist, dist)) + 1e-10) as lrd from near "
    "join kd on near.donor = kd.key group by near.key), "
    "score as (select near.key as p_partkey, -avg(o.lrd) / max(s.lrd) as lof_score from near "
    "join lrd o on near.donor = o.key join lrd s on near.key = s.key group by near.key) "
)


def part_lof(spark, sf):
    return neighbours.lof(table(spark, sf, "part"), ["p_size", "p_retailprice"], "p_partkey", 20)


@query("q_lof", LOF + "select p_partkey, lof_score from score", {"lof_score": 6})
def lof(spark, sf):
    return part_lof(spark, sf).select("p_partkey", "lof_score")


@query(
    "q_lof_filter",
    LOF
    + "select p_partkey from score where lof_score < "
    "(select lof_score from score order by lof_score limit 1 offset 3)",
)
def lof_filter(spark, sf):
    from cohortica.session import settle

    return neighbours.lof_filter(settle(part_lof(spark, sf))).select("p_partkey")


# Missing values


def _null_sql(cols) -> str:
    return " union all ".join(
        f"select '{x}' as variable, count(*) - count({x}) as n_null, count({x}) as n_present, "
        f"count(*) > count({x}) as any_null from fx_people"
        for x in cols
    )


_PEOPLE_COLS = (
    "id name age sex pclass sibsp parch fare cabin embarked survived".split()
)


@query("q_null_counts", PEOPLE + _null_sql(_PEOPLE_COLS))
def null_counts(spark, sf):
    return missing.null_counts(people(spark, sf))


@query(
    "q_null_total",
    PEOPLE
    + "select sum(n_null)::bigint as n_null, sum(n_present)::bigint as n_present, "
    f"bool_or(any_null) as any_null from ({_null_sql(_PEOPLE_COLS)})",
)
def null_total(spark, sf):
    return missing.null_total(people(spark, sf))


@query(
    "q_incomplete_rows",
    PEOPLE
    + "select id, age, cabin, embarked from fx_people "
    "where age is null or cabin is null or embarked is null",
    {"age": 6},
)
def incomplete_rows(spark, sf):
    return missing.incomplete_rows(people(spark, sf)).select("id", "age", "cabin", "embarked")


@query(
    "q_missing_table",
    PEOPLE
    + "select variable, n_null as n_miss, round_even(1e2 * n_null / (n_null + n_present), 2) "
    f"as ratio from ({_null_sql(_PEOPLE_COLS)}) where n_null > 0",
    {"ratio": 2},
)
def missing_table(spark, sf):
    return missing.missing_table(people(spark, sf))


@query(
    "q_missing_vs_target",
    PEOPLE
    + " union all ".join(
        f"select '{x}' as variable, case when {x} is null then 1 else 0 end as is_null, "
        "avg(survived) as target_mean, count(survived) as n from fx_people group by 2"
        for x in ("age", "cabin", "embarked")
    ),
    {"target_mean": 6},
)
def missing_vs_target(spark, sf):
    return missing.missing_vs_target(people(spark, sf), "survived", ["age", "cabin", "embarked"])


@query(
    "q_nullity_corr",
    PEOPLE.rstrip()
    + ", b as (select case when age is null then 1e0 else 0e0 end as age, "
    "case when cabin is null then 1e0 else 0e0 end as cabin, "
    "case when embarked is null then 1e0 else 0e0 end as embarked from fx_people) "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as corr from b"
        for a, b in (("age", "cabin"), ("age", "embarked"), ("cabin", "embarked"))
    ),
    {"corr": 6},
)
def nullity_corr(spark, sf):
    return missing.nullity_corr(people(spark, sf))


@query(
    "q_fill_mean",
    PEOPLE
    + "select id, coalesce(age, (select avg(age) from fx_people)) as age from fx_people",
    {"age": 6},
)
def fill_mean(spark, sf):
    return missing.fill_numeric(people(spark, sf), ["age"], "mean").select("id", "age")


@query(
    "q_fill_median",
    PEOPLE
    + "select id, coalesce(age, (select quantile_cont(age::double, 0.5) from fx_people)) as age "
    "from fx_people",
    {"age": 6},
)
def fill_median(spark, sf):
    return missing.fill_numeric(people(spark, sf), ["age"], "median").select("id", "age")


@query(
    "q_fill_constant",
    PEOPLE + "select id, coalesce(age, 0e0) as age, coalesce(cabin, 'missing') as cabin "
    "from fx_people",
    {"age": 6},
)
def fill_constant(spark, sf):
    filled = missing.fill_numeric(people(spark, sf), ["age"], 0)
    return missing.fill_categorical(filled, "missing", cols=["cabin"]).select("id", "age", "cabin")


@query(
    "q_fill_mode",
    PEOPLE
    + "select id, coalesce(embarked, (select embarked from fx_people where embarked is not null "
    "group by embarked order by count(*) desc, embarked limit 1)) as embarked, cabin "
    "from fx_people",
)
def fill_mode(spark, sf):
    return missing.fill_categorical(people(spark, sf)).select("id", "embarked", "cabin")


@query(
    "q_fill_by_group",
    PEOPLE.rstrip()
    + ", t as (select *, nullif(regexp_extract(name, '([A-Za-z]+)\\.', 1), '') as title "
    "from fx_people), m as (select title, quantile_cont(age::double, 0.5) as med from t "
    "where title is not null group by title) select id, "
    "coalesce(age, avg(age) over (partition by sex)) as by_sex, coalesce(age, med) as by_title "
    "from t left join m on t.title = m.title",
    {"by_sex": 6, "by_title": 6},
)
def fill_by_group(spark, sf):
    df = people(spark, sf).withColumns(
        {
            "title": c.regex_feature("name", r"([A-Za-z]+)\."),
            "by_sex": F.col("age"),
            "by_title": F.col("age"),
        }
    )
    df = missing.fill_by_group(df, "sex", "by_sex", "mean")
    df = missing.fill_by_group(df, "title", "by_title", "median")
    return df.select("id", "by_sex", "by_title")


_SCALED = ", ".join(
    f"({x} - min({x}) over ()) / (max({x}) over () - min({x}) over ()) as {x}"
    for x in ("pclass", "sibsp", "parch", "fare")
)
_GAPS = " + ".join(
    f"(q.{x} - d.{x}) * (q.{x} - d.{x})" for x in ("pclass", "sibsp", "parch", "fare", "male")
)


@query(
    "q_knn_impute",
    PEOPLE.rstrip()
    + f", s as (select id, age, {_SCALED}, case when sex = 'male' then 1e0 else 0e0 end as male "
    "from fx_people), pairs as (select q.id, d.age, row_number() over (partition by q.id "
    f"order by sqrt({_GAPS}), d.id) as r from s q join s d on q.age is null "
    "and d.age is not null), fills as (select id, avg(age) as fill from pairs where r <= 5 "
    "group by id) select s.id, coalesce(s.age, fill) as age from s left join fills on s.id = fills.id",
    {"age": 6},
)
def knn_impute(spark, sf):
    filled = neighbours.knn_impute(
        people(spark, sf), "age", ["pclass", "sibsp", "parch", "fare", "sex"], "id", 5
    )
    return filled.select("id", "age")


@query(
    "q_zero_to_null",
    with_fixture("fx_health").rstrip()
    + ", "
    + HEALTH_NULLS
    + "select id, glucose, insulin, skin, bmi from h",
    {"glucose": 6, "insulin": 6, "skin": 6, "bmi": 6},
)
def zero_to_null(spark, sf):
    return health(spark, sf).select("id", "glucose", "insulin", "skin", "bmi")


_OTHERS = ["pregnancies", "age", "glucose", "skin", "bmi"]
INSULIN_CORR = (
    with_fixture("fx_health").rstrip()
    + ", "
    + HEALTH_NULLS
    + ", cs as ("
    + " union all ".join(
        f"select '{x}' as variable, {corr_sql('insulin', x)} as corr from h" for x in _OTHERS
    )
    + "), feats as (select variable, row_number() over (order by abs(corr) desc, variable) as r "
    "from cs where abs(corr) >= 25e-2) "
)


@query("q_correlated_cols", INSULIN_CORR + "select variable, r as place from feats where r <= 2")
def correlated_cols(spark, sf):
    found = missing.correlated_cols(health(spark, sf), "insulin", "outcome", 0.25, exclude=["id"])
    return spark.createDataFrame(
        [(x, i) for i, x in enumerate(found, 1)], "variable string, place bigint"
    )


_PICK = {
    i: "case (select variable from feats where r = " + str(i) + ") "
    + " ".join(f"when '{x}' then {x}::double" for x in _OTHERS)
    + " end"
    for i in (1, 2)
}


@query(
    "q_regression_impute",
    INSULIN_CORR
    + f", x as (select id, insulin as y, {_PICK[1]} as u, {_PICK[2]} as v, "
    "(select count(*) from feats where r <= 2) = 2 as usable from h), "
    "s as (select avg(y) as my, avg(u) as mu, avg(v) as mv, var_pop(u) as uu, var_pop(v) as vv, "
    "covar_pop(u, v) as uv, covar_pop(u, y) as uy, covar_pop(v, y) as vy from x "
    "where y is not null and u is not null and v is not null), "
    "b as (select *, (uy * vv - vy * uv) / (uu * vv - uv * uv) as b1, "
    "(vy * uu - uy * uv) / (uu * vv - uv * uv) as b2 from s), "
    "f as (select id, usable, coalesce(y, case when usable then my + b1 * (u - mu) + b2 * (v - mv) "
    "end) as y from x, b), m as (select quantile_cont(y, 0.5) as med from f) "
    "select id, case when usable then greatest(coalesce(y, med), 0) else coalesce(y, med) end "
    "as insulin from f, m",
    {"insulin": 6},
)
def regression_impute(spark, sf):
    filled = missing.regression_impute(
        health(spark, sf), "insulin", "outcome", 0.25, exclude=["id"]
    )
    return filled.select("id", "insulin")


# Encoding and scaling


@query(
    "q_label_encode",
    PEOPLE.rstrip()
    + ", l as (select embarked, row_number() over (order by embarked) - 1 as code from "
    "(select distinct embarked from fx_people where embarked is not null)) "
    "select id, case when sex = 'male' then 1 else 0 end as sex, "
    "coalesce(code, (select count(*) from l))::int as embarked from fx_people p "
    "left join l on p.embarked = l.embarked",
)
def label_encode(spark, sf):
    df = encode.label_encode(people(spark, sf), "sex")
    return encode.label_encode(df, "embarked").select("id", "sex", "embarked")


@query("q_label_decode", PEOPLE + "select id, embarked from fx_people")
def label_decode(spark, sf):
    df = people(spark, sf)
    levels = encode.levels_of(df, ["embarked"])["embarked"]
    coded = encode.label_encode(df, "embarked", "code")
    return encode.label_decode(coded, "code", levels, "embarked").select("id", "embarked")


@query(
    "q_binary_columns",
    PEOPLE.rstrip()
    + f", d as ({_counts_sql(_PEOPLE_TEXT, 'text')}) select variable from d where d = 2",
)
def binary_columns(spark, sf):
    return names_frame(spark, encode.binary_columns(people(spark, sf)))


def _hot_sql(col: str, levels) -> str:
    return ", ".join(
        f"case when {col} = '{x}' then 1 else 0 end as \"{col}_{x}\"" for x in levels
    )


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "q_one_hot",
    PEOPLE
    + "select id, case when sex = 'male' then 1 else 0 end as sex_male, "
    + ", ".join(
        f"case when pclass = {x} then 1 else 0 end as pclass_{x}" for x in (2, 3)
    )
    + " from fx_people",
)
def one_hot(spark, sf):
    df = people(spark, sf).select("id", "sex", "pclass")
    return encode.one_hot(df, ["sex", "pclass"], drop_first=True)


@query(
    "q_one_hot_na",
    PEOPLE.rstrip()
    + ", e as (select id, case when embarked <> 'RAREPORT' then embarked end as embarked "
    f"from fx_people) select id, {_hot_sql('embarked', _SEGMENTS)}, "
    "case when embarked is null then 1 else 0 end as embarked_nan from e",
)
def one_hot_na(spark, sf):
    df = people(spark, sf).select(
        "id", F.when(F.col("embarked") != "RAREPORT", F.col("embarked")).alias("embarked")
    )
    return encode.one_hot(df, ["embarked"], dummy_na=True)


_ALL_COUNTS = f"{_counts_sql(_PEOPLE_TEXT, 'text')} union all {_counts_sql(_PEOPLE_OTHER, 'other')}"


@query(
    "q_ohe_columns",
    PEOPLE.rstrip()
    + f", d as ({_ALL_COUNTS}) select variable from d where d > 2 and d <= 10",
)
def ohe_columns(spark, sf):
    return names_frame(spark, encode.ohe_columns(people(spark, sf)))


@query(
    "q_rare_encode",
    PEOPLE.rstrip()
    + ", n as (select embarked, count(*) as n from fx_people group by embarked) "
    "select id, case when p.embarked is null then null "
    "when n.n::double / (select count(*) from fx_people) < 0.01::double then 'Rare' "
    "else p.embarked end as embarked from fx_people p left join n on p.embarked = n.embarked",
)
def rare_encode(spark, sf):
    return encode.rare_encode(people(spark, sf), ["embarked"], 0.01).select("id", "embarked")


_DOCTOR = "(case when id % 205 = 0 then 1 else 0 end)"


@query(
    "q_useless_columns",
    PEOPLE.rstrip()
    + f", u as (select id, {_DOCTOR} as rare_flag, survived, sex from fx_people), "
    "n as (select 'rare_flag' as variable, count(*) as n from u group by rare_flag union all "
    "select 'survived', count(*) from u group by survived union all "
    "select 'sex', count(*) from u group by sex) select variable from n group by variable "
    "having count(*) = 2 and min(n)::double / (select count(*) from u) < 0.01::double",
)
def useless_columns(spark, sf):
    df = people(spark, sf).select(
        "id", F.expr(_DOCTOR).alias("rare_flag"), "survived", "sex"
    )
    return names_frame(spark, encode.useless_columns(df))


@query(
    "q_standard_scale",
    PEOPLE
    + "select id, (age - avg(age) over ()) / stddev_pop(age) over () as age, "
    "(fare - avg(fare) over ()) / stddev_pop(fare) over () as fare from fx_people",
    {"age": 6, "fare": 6},
)
def standard_scale(spark, sf):
    return scale.standard_scale(people(spark, sf), ["age", "fare"]).select("id", "age", "fare")


@query(
    "q_robust_scale",
    PEOPLE.rstrip()
    + ", q as (select quantile_cont(age::double, [0.25, 0.5, 0.75]) as a, "
    "quantile_cont(fare::double, [0.25, 0.5, 0.75]) as f from fx_people) "
    "select id, (age - a[2]) / (a[3] - a[1]) as age, (fare - f[2]) / (f[3] - f[1]) as fare "
    "from fx_people, q",
    {"age": 6, "fare": 6},
)
def robust_scale(spark, sf):
    return scale.robust_scale(people(spark, sf), ["age", "fare"]).select("id", "age", "fare")


@query(
    "q_minmax_scale",
    PEOPLE
    + "select id, (age - min(age) over ()) / (max(age) over () - min(age) over ()) as age, "
    "(fare - min(fare) over ()) / (max(fare) over () - min(fare) over ()) as fare from fx_people",
    {"age": 6, "fare": 6},
)
def minmax_scale(spark, sf):
    return scale.minmax_scale(people(spark, sf), ["age", "fare"]).select("id", "age", "fare")


@query("q_minmax_inverse", PEOPLE + "select id, age, fare from fx_people", {"age": 6, "fare": 6})
def minmax_inverse(spark, sf):
    df = people(spark, sf)
    stats = scale.minmax_stats(df, ["age", "fare"])
    back = scale.minmax_inverse(scale.minmax_scale(df, ["age", "fare"], stats), stats)
    return back.select("id", "age", "fare")


# Derived features


@query(
    "q_notnull_flag",
    PEOPLE + "select id, case when cabin is null then 0 else 1 end as has_cabin from fx_people",
)
def notnull_flag(spark, sf):
    return people(spark, sf).select("id", c.notnull_flag("cabin").alias("has_cabin"))


@query(
    "q_text_counts",
    "select doc_id, length(text) as chars, len(string_split(text, ' ')) as words, "
    "len([t for t in regexp_split_to_array(text, '\\s+') if starts_with(t, 'th')]) as th_words "
    "from documents",
)
def text_counts(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        c.char_count("text").alias("chars"),
        c.word_count("text").alias("words"),
        c.prefix_count("text", "th").alias("th_words"),
    )


@query(
    "q_regex_feature",
    PEOPLE
    + "select id, nullif(regexp_extract(name, '([A-Za-z]+)\\.', 1), '') as title from fx_people",
)
def regex_feature(spark, sf):
    return people(spark, sf).select("id", c.regex_feature("name", r"([A-Za-z]+)\.").alias("title"))


@query(
    "q_count_flags",
    PEOPLE
    + "select id, sibsp + parch + 1 as family_size, "
    "case when sibsp + parch > 0 then 'NO' else 'YES' end as is_alone from fx_people",
)
def count_flags(spark, sf):
    df = features.family_features(people(spark, sf), "sibsp", "parch")
    return df.select(
        "id",
        F.col("NEW_FAMILY_SIZE").alias("family_size"),
        F.col("NEW_IS_ALONE").alias("is_alone"),
    )


@query(
    "q_interaction", PEOPLE + "select id, age * pclass as x from fx_people", {"x": 6}
)
def interaction(spark, sf):
    return people(spark, sf).select("id", c.interact("age", "pclass").alias("x"))


_YEARS = ["0-1 Year", "1-2 Year", "2-3 Year", "3-4 Year", "4-5 Year", "5-6 Year"]


@query(
    "q_range_label",
    with_fixture("fx_telco")
    + "select customer_id, case when tenure <= 12 then '0-1 Year' when tenure <= 24 then "
    "'1-2 Year' when tenure <= 36 then '2-3 Year' when tenure <= 48 then '3-4 Year' "
    "when tenure <= 60 then '4-5 Year' else '5-6 Year' end as tenure_year, "
    "case when tenure < 12 then 'new' else 'known' end as newness from fx_telco",
)
def range_label(spark, sf):
    return load(spark, sf, "fx_telco").select(
        "customer_id",
        c.range_label("tenure", [12, 24, 36, 48, 60], _YEARS).alias("tenure_year"),
        c.range_label("tenure", [12], ["new", "known"], closed="left").alias("newness"),
    )


@query(
    "q_cross_label",
    with_fixture("fx_health")
    + "select id, (case when age < 50 then 'mature' else 'senior' end) || '_' || "
    "(case when bmi <= 18.5 then 'under' when bmi <= 24.9 then 'healthy' "
    "when bmi <= 29.9 then 'over' else 'obese' end) as age_bmi from fx_health",
)
def cross_label(spark, sf):
    return load(spark, sf, "fx_health").select(
        "id",
        c.cross_label(
            c.range_label("age", [50], ["mature", "senior"], closed="left"),
            c.range_label("bmi", [18.5, 24.9, 29.9], ["under", "healthy", "over", "obese"]),
            sep="_",
        ).alias("age_bmi"),
    )


@query(
    "q_range_flag",
    with_fixture("fx_health").rstrip()
    + ", "
    + HEALTH_NULLS
    + "select id, case when insulin between 16 and 166 then 'Normal' else 'Abnormal' end "
    "as insulin_score from h",
)
def range_flag(spark, sf):
    return health(spark, sf).select("id", c.range_flag("insulin", 16, 166).alias("insulin_score"))


TELCO = with_fixture("fx_telco")


@query(
    "q_flags",
    TELCO
    + "select customer_id, case when contract in ('One year', 'Two year') then 1 else 0 end "
    "as engaged, case when contains(payment, '(automatic)') then 1 else 0 end as auto_payment "
    "from fx_telco",
)
def flags(spark, sf):
    return load(spark, sf, "fx_telco").select(
        "customer_id",
        c.flag_in("contract", ["One year", "Two year"]).alias("engaged"),
        c.flag_contains("payment", "(automatic)").alias("auto_payment"),
    )


_SERVICES = ["phone", "lines", "security", "backup", "protection", "support", "tv", "movies"]
_N_SERVICES = " + ".join(f"(case when {x} = 'Yes' then 1 else 0 end)" for x in _SERVICES)


@query(
    "q_service_features",
    TELCO
    + "select customer_id, case when backup <> 'Yes' or protection <> 'Yes' or support <> 'Yes' "
    "then 1 else 0 end as no_prot, case when senior = 0 and contract = 'Month-to-month' "
    "then 1 else 0 end as young_not_engaged, "
    f"{_N_SERVICES} as services, case when tv = 'Yes' or movies = 'Yes' then 1 else 0 end "
    "as any_streaming from fx_telco",
)
def service_features(spark, sf):
    engaged = c.flag_in("contract", ["One year", "Two year"])
    return load(spark, sf, "fx_telco").select(
        "customer_id",
        (c.count_equal(["backup", "protection", "support"], "Yes") < 3).cast("int").alias("no_prot"),
        (c.is_value("senior", 0) & (engaged == 0)).cast("int").alias("young_not_engaged"),
        c.count_equal(_SERVICES, "Yes").alias("services"),
        (c.count_equal(["tv", "movies"], "Yes") > 0).cast("int").alias("any_streaming"),
    )


@query(
    "q_ratio_features",
    TELCO.rstrip()
    + ", t as (select *, try_cast(trim(total_charges) as double) / (tenure + 1) as average "
    f"from fx_telco) select customer_id, average as avg_charge, average / monthly_charges "
    f"as increase, monthly_charges / ({_N_SERVICES} + 1) as service_fee from t",
    {"avg_charge": 6, "increase": 6, "service_fee": 6},
)
def ratio_features(spark, sf):
    average = c.ratio(c.to_numeric("total_charges"), F.col("tenure") + 1)
    return load(spark, sf, "fx_telco").select(
        "customer_id",
        average.alias("avg_charge"),
        c.ratio(average, "monthly_charges").alias("increase"),
        c.ratio("monthly_charges", c.count_equal(_SERVICES, "Yes") + 1).alias("service_fee"),
    )


# Models

_IS_TEST = f"((id % {model.PLACES}) * 7919 + {17 * 104729}) % {model.PLACES} < 300000"
_GUESS = "(case when glucose + age > 180 then 1 else 0 end)"


@query(
    "q_split",
    with_fixture("fx_health")
    + f"select id, case when {_IS_TEST} then 'test' else 'train' end as part from fx_health",
)
def split(spark, sf):
    train, test = model.split(load(spark, sf, "fx_health").select("id"), "id")
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


CONFUSION = (
    with_fixture("fx_health").rstrip()
    + f", p as (select outcome as truth, {_GUESS} as prediction from fx_health), "
    "m as (select count(*) filter (truth = 1 and prediction = 1)::double as tp, "
    "count(*) filter (truth = 0 and prediction = 1)::double as fp, "
    "count(*) filter (truth = 1 and prediction = 0)::double as fn, "
    "count(*) filter (truth = 0 and prediction = 0)::double as tn from p) "
)


def guesses(spark, sf):
    return load(spark, sf, "fx_health").select(
        F.col("outcome").alias("truth"),
        F.expr(_GUESS).alias("prediction"),
        (F.col("glucose") + F.col("age")).alias("score"),
    )


@query(
    "q_class_metrics",
    CONFUSION
    + "select (tp + tn) / (tp + fp + fn + tn) as accuracy, tp / (tp + fn) as recall, "
    "tp / (tp + fp) as precision, 2 * tp / (2 * tp + fp + fn) as f1 from m",
    {"accuracy": 6, "recall": 6, "precision": 6, "f1": 6},
)
def class_metrics(spark, sf):
    return model.classification_metrics(guesses(spark, sf))


@query(
    "q_auc", CONFUSION + "select (tp / (tp + fn) + tn / (tn + fp)) / 2 as auc from m", {"auc": 6}
)
def auc(spark, sf):
    return model.roc_auc(guesses(spark, sf))


@query(
    "q_auc_scores",
    with_fixture("fx_health").rstrip()
    + ", s as (select outcome, glucose + age as s from fx_health), r as (select outcome, "
    "rank() over (order by s) + (count(*) over (partition by s) - 1) / 2e0 as r from s), "
    "n as (select sum(outcome)::double as pos, sum(1 - outcome)::double as neg from s) "
    "select (sum(r) filter (outcome = 1) - max(pos) * (max(pos) + 1) / 2) / (max(pos) * max(neg)) "
    "as auc from r, n",
    {"auc": 6},
)
def auc_scores(spark, sf):
    return model.roc_auc_scores(guesses(spark, sf))


_FEATS = ["pregnancies", "age", "glucose", "insulin", "skin", "bmi"]


def forest(spark, sf):
    train, test = model.split(load(spark, sf, "fx_health"), "id")
    return model.fit_forest(train, _FEATS, "outcome"), test


@query("q_forest")
def fit_forest(spark, sf):
    fitted, test = forest(spark, sf)
    scored = model.predict(fitted, test)
    return scored.select("id", F.col("outcome").alias("truth"), "prediction", "score")


@query("q_gbt")
def fit_gbt(spark, sf):
    df = load(spark, sf, "fx_telco").withColumn("churned", c.yes_flag("churn"))
    df = encode.one_hot(df, ["contract", "payment"], drop_first=True)
    feats = ["tenure", "monthly_charges", "senior"]
    feats += [x for x in df.columns if x.startswith(("contract_", "payment_"))]
    train, test = model.split(df, "customer_id")
    fitted = model.fit_gbt(train, feats, "churned")
    return model.predict(fitted, test).select("customer_id", "churned", "prediction", "score")


@query("q_importances")
def importances(spark, sf):
    return model.importances(forest(spark, sf)[0], _FEATS)


@query("q_baseline_model")
def baseline_model(spark, sf):
    return features.baseline_model(people(spark, sf), "id", "survived")


@query("q_histogram",
    "with b as (select min(o_totalprice) as low, (max(o_totalprice) - min(o_totalprice)) / 20 "
    "as width from orders), h as (select least(floor((o_totalprice - low) / width), 19)::int as bin, "
    "count(*) as n, max(low) as low, max(width) as width from orders, b group by 1) "
    "select bin, low + bin * width as lo, low + (bin + 1) * width as hi, n from h",
    {"lo": 4, "hi": 4},
)
def histogram(spark, sf):
    return profile.histogram(table(spark, sf, "orders"), "o_totalprice", 20)


_BOX = ["o_totalprice"]


@query(
    "q_box_stats",
    "with q as (select quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) as e from orders), "
    "f as (select e, e[1] - 15e-1 * (e[3] - e[1]) as low, e[3] + 15e-1 * (e[3] - e[1]) as up from q) "
    "select 'o_totalprice' as variable, max(e[1]) as q1, max(e[2]) as median, max(e[3]) as q3, "
    "min(o_totalprice) filter (o_totalprice between low and up) as whisker_low, "
    "max(o_totalprice) filter (o_totalprice between low and up) as whisker_high, "
    "count(*) filter (not o_totalprice between low and up) as outliers from orders, f",
    {"q1": 4, "median": 4, "q3": 4, "whisker_low": 4, "whisker_high": 4},
)
def box_stats(spark, sf):
    return profile.box_stats(table(spark, sf, "orders"), _BOX)




def _mode_sql(col: str) -> str:
    return (
        f"(select {col} from g where {col} is not null group by {col} "
        f"order by count(*) desc, {col} limit 1)"
    )


def _levels_sql(out: str, col: str, levels) -> str:
    return ", ".join(
        f"case when {col} = {x!r} then 1 else 0 end as \"{out}_{x}\"" for x in levels
    )


def _scaled_sql(col: str) -> str:
    return f"({col} - avg({col}) over ()) / stddev_pop({col}) over ()"


# The columns are those that the data of the checked scale factor has levels for.
FEATURE_TABLE = (
    PEOPLE.rstrip()
    + ", q as (select quantile_cont(age::double, [0.05, 0.95]) as a, "
    "quantile_cont(fare::double, [0.05, 0.95]) as f from fx_people), "
    "fence as (select a[1] - 15e-1 * (a[2] - a[1]) as al, a[2] + 15e-1 * (a[2] - a[1]) as au, "
    "f[1] - 15e-1 * (f[2] - f[1]) as fl, f[2] + 15e-1 * (f[2] - f[1]) as fu from q), "
    "d as (select * replace (case when age < al then al when age > au then au else age end as age, "
    "case when fare < fl then fl when fare > fu then fu else fare end as fare), "
    "nullif(regexp_extract(name, '([A-Za-z]+)\\.', 1), '') as title from fx_people, fence), "
    "m as (select title, quantile_cont(age, 0.5) as med from d where title is not null "
    "group by title), "
    "e as (select d.* replace (coalesce(age, med) as age) from d left join m on d.title = m.title), "
    "g as (select *, age * pclass as age_pclass, case when age <= 18 then 'young' "
    "when age <= 56 then 'mature' when age is not null then 'senior' end as age_cat, "
    "case when age <= 18 then 'young' when age <= 56 then 'mature' when age is not null "
    "then 'senior' end || sex as sex_cat from e), "
    f"h as (select * replace (coalesce(embarked, {_mode_sql('embarked')}) as embarked, "
    f"coalesce(title, {_mode_sql('title')}) as title, "
    f"coalesce(age_cat, {_mode_sql('age_cat')}) as age_cat, "
    f"coalesce(sex_cat, {_mode_sql('sex_cat')}) as sex_cat) from g) "
    f'select id as "ID", {_scaled_sql("age")} as "AGE", '
    'case when sex = \'male\' then 1 else 0 end as "SEX", '
    f'{_scaled_sql("fare")} as "FARE", survived as "SURVIVED", '
    'case when cabin is null then 0 else 1 end as "NEW_CABIN_BOOL", '
    "len(string_split(name, ' ')) as \"NEW_NAME_WORD_COUNT\", "
    "case when contains(name, ' Dr') then 1 else 0 end as \"NEW_NAME_DR\", "
    'case when sibsp + parch = 0 then 1 else 0 end as "NEW_IS_ALONE", '
    f'{_scaled_sql("age_pclass")} as "NEW_AGE_PCLASS", '
    "case when age_cat = 'senior' then 1 else 0 end as \"NEW_AGE_CAT\", "
    + ", ".join(
        [
            _levels_sql("EMBARKED", "embarked", _SEGMENTS[1:]),
            _levels_sql("NEW_TITLE", "title", ["Mr", "Mrs"]),
            _levels_sql("NEW_SEX_CAT", "sex_cat", ["maturemale", "seniorfemale", "seniormale"]),
            _levels_sql("PCLASS", "pclass", [2, 3]),
            _levels_sql("SIBSP", "sibsp", [1, 2, 3]),
            _levels_sql("PARCH", "parch", [1, 2]),
            _levels_sql("NEW_NAME_COUNT", "length(name)", [27, 28]),
            _levels_sql("NEW_FAMILY_SIZE", "(sibsp + parch + 1)", [2, 3, 4, 5, 6]),
        ]
    )
    + " from h"
)


@query("q_feature_table", FEATURE_TABLE, {"AGE": 6, "FARE": 6, "NEW_AGE_PCLASS": 6})
def feature_table(spark, sf):
    return features.feature_table(people(spark, sf))


@query("q_feature_model")
def feature_model(spark, sf):
    return features.judge(features.feature_table(people(spark, sf)), "ID", "SURVIVED")


@query(
    "q_health_features",
    with_fixture("fx_health").rstrip()
    + ", "
    + HEALTH_NULLS
    + ", b as (select *, case when bmi > 0 and bmi <= 18.5 then 'Underweight' when bmi <= 24.9 "
    "then 'Healthy' when bmi <= 29.9 then 'Overweight' when bmi > 29.9 then 'Obese' end "
    "as bmi_category, case when age >= 50 then 'senior' when age >= 21 then 'mature' end "
    "as age_category, case when glucose < 70 then 'low' when glucose < 100 then 'normal' "
    "when glucose < 125 then 'hidden' when glucose >= 125 then 'high' end as sugar from h) "
    "select id, bmi_category, age_category, case when glucose > 0 and glucose <= 140 then 'Normal' "
    "when glucose > 140 and glucose <= 200 then 'Prediabetes' when glucose > 200 and "
    "glucose <= 300 then 'Diabetes' end as glucose_category, lower(bmi_category) || age_category "
    "as age_bmi, sugar || age_category as age_glucose, case when insulin between 16 and 166 "
    "then 'Normal' else 'Abnormal' end as insulin_score, glucose * insulin as glucose_insulin, "
    "glucose * pregnancies as glucose_pregnancies from b",
    {"glucose_insulin": 6, "glucose_pregnancies": 6},
)
def health_features(spark, sf):
    return features.health_features(health(spark, sf)).select(
        "id",
        "bmi_category",
        "age_category",
        "glucose_category",
        "age_bmi",
        "age_glucose",
        "insulin_score",
        "glucose_insulin",
        "glucose_pregnancies",
    )


@query("q_health_table")
def health_table(spark, sf):
    return features.health_table(load(spark, sf, "fx_health"))


@query(
    "q_churn_features",
    TELCO.rstrip()
    + ", n as (select *, try_cast(trim(total_charges) as double) as charges from fx_telco), "
    f"q as ({edges_sql('monthly_charges', 3, 'fx_telco')}), "
    "t as (select *, coalesce(charges, (select quantile_cont(charges, 0.5) from n)) as total, "
    f"{_N_SERVICES} as services from n) "
    "select customer_id, "
    + bin_sql("monthly_charges", "e", ["'low'", "'medium'", "'high'"])
    + " as charges_level, case when lower(trim(churn)) = 'yes' then 1 else 0 end as churned, "
    "case when contract in ('One year', 'Two year') then 1 else 0 end as engaged, services, "
    "total / (tenure + 1) as avg_charge, total / (tenure + 1) / monthly_charges as increase, "
    "monthly_charges / (services + 1) as service_fee from t, q",
    {"avg_charge": 6, "increase": 6, "service_fee": 6},
)
def churn_features(spark, sf):
    return features.churn_features(load(spark, sf, "fx_telco")).select(
        "customer_id",
        "charges_level",
        "churned",
        "engaged",
        "services",
        "avg_charge",
        "increase",
        "service_fee",
    )


# The churn and health flows to their end


@query("q_churn_table")
def churn_table(spark, sf):
    return features.churn_table(load(spark, sf, "fx_telco"))


@query("q_churn_model")
def churn_model(spark, sf):
    """Boosted trees before and after the engineering."""
    raw = load(spark, sf, "fx_telco").withColumn("churned", c.yes_flag("churn")).drop("churn")
    raw = raw.withColumn("total_charges", c.to_numeric("total_charges"))
    before = features.baseline_model(raw, "customer_id", "churned", boosted=True)
    after = features.judge(features.churn_table(load(spark, sf, "fx_telco")), "customer_id", "churned", boosted=True)
    return before.select(F.lit("before").alias("table"), "*").union(after.select(F.lit("after").alias("table"), "*"))


@query("q_health_model_table")
def health_model_table(spark, sf):
    return features.health_model_table(load(spark, sf, "fx_health"))


@query("q_health_model")
def health_model(spark, sf):
    return features.judge(features.health_model_table(load(spark, sf, "fx_health")), "id", "outcome")


@query("q_table_importances")
def table_importances(spark, sf):
    return features.table_importances(features.churn_table(load(spark, sf, "fx_telco")), "customer_id", "churned", boosted=True)


# Three trees over the parts, as literals on both sides: tree, node, feature, threshold, left, right, value, weight.
_TREES = [
    (0, 0, "p_size", 24.5, 1, 2, None, 1.0), (0, 1, "p_retailprice", 1200.0, 3, 4, None, 1.0),
    (0, 2, None, None, None, None, 0.75, 1.0), (0, 3, None, None, None, None, -0.5, 1.0),
    (0, 4, "p_size", 10.0, 5, 6, None, 1.0), (0, 5, None, None, None, None, 0.125, 1.0),
    (0, 6, None, None, None, None, -0.25, 1.0), (1, 0, "p_retailprice", 1500.0, 1, 2, None, 0.5),
    (1, 1, None, None, None, None, 1.0, 0.5), (1, 2, None, None, None, None, -1.0, 0.5),
    (2, 0, None, None, None, None, 0.25, 0.5),
]
_TREE_VALUES = ", ".join("(" + ", ".join("null" if v is None else f"'{v}'" if isinstance(v, str) else f"{v!r}" + ("" if isinstance(v, int) else "e0") for v in r) + ")" for r in _TREES)


@query(
    "q_tree_walk",
    f"with recursive nodes(tree, node, feature, threshold, l, r, v, weight) as (values {_TREE_VALUES}), "
    "place(p_partkey, p_size, p_retailprice, tree, node) as (select p_partkey, p_size, p_retailprice, tree, 0 from part, "
    "(select distinct tree from nodes) union all select p_partkey, p_size, p_retailprice, place.tree, "
    "case when case feature when 'p_size' then cast(p_size as double) else cast(p_retailprice as double) end <= threshold then l else r end "
    "from place join nodes on place.tree = nodes.tree and place.node = nodes.node where l is not null) "
    "select p_partkey, cast(count(*) as bigint) as leaves, 1 / (1 + exp(-2 * sum(v * weight))) as score "
    "from place join nodes on place.tree = nodes.tree and place.node = nodes.node where l is null group by p_partkey",
    {"score": 9},
)
def tree_walk(spark, sf):
    from cohortica.operators import trees

    leaves = trees.walk(table(spark, sf, "part"), spark.createDataFrame(_TREES, trees.NODES), "p_partkey", ["p_size", "p_retailprice"])
    score = 1 / (1 + F.exp(-2 * F.sum(F.col("value") * F.col("weight"))))
    return leaves.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("leaves"), score.alias("score"))
