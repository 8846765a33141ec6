"""Queries on tables: sources, profiles, expressions, joins and summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortica.checks.fixtures import load, table, with_fixture
from cohortica.checks.registry import query
from cohortica.functions import columns as c
from cohortica.operators import profile, relational
from cohortica.operators.rfm import SEGMENTS
from cohortica.session import shared_dir
from cohortica.sources.tables import read_groups, read_table, write_audience

REF = "2001-08-03"
EVENT_REF = "2024-06-15"


def ref(date: str):
    return F.lit(date).cast("timestamp_ntz")


# Sources, sinks and profiles


@query(
    "q_scan",
    "select l_returnflag, count(*) as n, sum(l_quantity) as quantity, "
    "sum(l_extendedprice) as price from lineitem where l_shipdate < timestamp '1998-01-01' "
    "group by l_returnflag",
    {"quantity": 2, "price": 2},
)
def scan(spark, sf):
    lines = read_table(spark, f"{sf}/lineitem.parquet")
    return (
        lines.where(F.col("l_shipdate") < ref("1998-01-01"))
        .groupBy("l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").alias("quantity"),
            F.sum("l_extendedprice").alias("price"),
        )
    )


@query(
    "q_tag_union",
    "select 'orders' as grp, count(*) as n, sum(o_totalprice) as value from orders "
    "union all select 'lines', count(*), sum(l_extendedprice) from lineitem",
    {"value": 2},
)
def tag_union(spark, sf):
    sheets = read_groups(
        spark, {"orders": f"{sf}/orders.parquet", "lines": f"{sf}/lineitem.parquet"}
    )
    groups = {
        "orders": sheets["orders"].select(F.col("o_totalprice").alias("value")),
        "lines": sheets["lines"].select(F.col("l_extendedprice").alias("value")),
    }
    return (
        relational.tag_union(groups)
        .groupBy("grp")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    )


@query("q_audience_roundtrip", "select c_custkey as master_id from customer where c_acctbal > 0")
def audience_roundtrip(spark, sf):
    ids = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("master_id")
    )
    path = f"{shared_dir(spark)}/audience-{uuid.uuid4().hex}.csv"
    write_audience(ids, path)
    return read_table(spark, path, "master_id bigint")


@query("q_head", "select * from orders order by o_orderkey limit 5", {"o_totalprice": 2})
def head(spark, sf):
    return profile.table_profile(table(spark, sf, "orders"), ["o_orderkey"]).first


def _describe_sql(source: str, cols, names) -> str:
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75} if names is None else names
    parts = []
    for x in cols:
        quantiles = ", ".join(f"quantile_cont({x}::double, {q}) as {n}" for n, q in probs.items())
        parts.append(
            f"select '{x}' as variable, count({x}) as count, avg({x}) as mean, "
            f"stddev_samp({x}) as std, min({x})::double as min, {quantiles}, "
            f"max({x})::double as max from {source}"
        )
    return " union all ".join(parts)


@query(
    "q_describe",
    _describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"], None),
    {"mean": 4, "std": 4, "p25": 4, "p50": 4, "p75": 4, "min": 4, "max": 4},
)
def describe(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return profile.describe(table(spark, sf, "lineitem").select(*cols))


_TWELVE = {f"p{round(q * 100):02d}": q for q in profile.TWELVE_QUANTILES}


@query(
    "q_num_summary",
    _describe_sql("events", ["value"], _TWELVE),
    {"mean": 6, "std": 6, **dict.fromkeys(_TWELVE, 6)},
)
def num_summary(spark, sf):
    return profile.num_summary(table(spark, sf, "events"), "value")


@query(
    "q_value_counts",
    "select o_orderpriority, count(*) as count from orders group by o_orderpriority",
)
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("q_nunique", "select count(distinct l_partkey) as nunique from lineitem")
def nunique(spark, sf):
    return profile.nunique(table(spark, sf, "lineitem"), "l_partkey")


@query("q_unique", with_fixture("fx_people") + "select distinct embarked from fx_people")
def unique(spark, sf):
    return profile.unique_values(load(spark, sf, "fx_people"), "embarked")


# Projections, filters and scalar expressions


@query(
    "q_omnichannel_totals",
    with_fixture("fx_omnichannel")
    + "select master_id, order_num_online + order_num_offline as total_orders, "
    "value_online + value_offline as total_value from fx_omnichannel",
    {"total_value": 2},
)
def omnichannel_totals(spark, sf):
    return omnichannel(spark, sf).select("master_id", "total_orders", "total_value")


def omnichannel(spark, sf):
    df = load(spark, sf, "fx_omnichannel")
    df = relational.add_total(df, ["order_num_online", "order_num_offline"], "total_orders")
    return relational.add_total(df, ["value_online", "value_offline"], "total_value")


@query(
    "q_line_revenue",
    with_fixture("fx_retail")
    + "select country, sum(quantity * price) as revenue from fx_retail group by country",
    {"revenue": 2},
)
def line_revenue(spark, sf):
    lines = relational.line_revenue(load(spark, sf, "fx_retail"))
    return lines.groupBy("country").agg(F.sum("revenue").alias("revenue"))


@query(
    "q_dropna",
    with_fixture("fx_people")
    + "select id, age, embarked, cabin from fx_people "
    "where age is not null and embarked is not null and cabin is not null",
    {"age": 2},
)
def dropna(spark, sf):
    people = load(spark, sf, "fx_people").select("id", "age", "embarked", "cabin")
    return relational.drop_incomplete(people)


@query(
    "q_drop_cancelled",
    with_fixture("fx_retail")
    + "select invoice, count(*) as n from (select case when description = 'red widget' then null "
    "else invoice end as invoice from fx_retail) "
    "where not coalesce(contains(invoice, 'C'), false) group by invoice",
)
def drop_cancelled(spark, sf):
    lines = load(spark, sf, "fx_retail").select(
        F.when(F.col("description") == "red widget", F.lit(None))
        .otherwise(F.col("invoice"))
        .alias("invoice")
    )
    return relational.drop_cancelled(lines, "invoice").groupBy("invoice").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "q_filter_positive",
    "select c_custkey, c_acctbal from customer where c_acctbal > 0 and c_nationkey >= 0",
    {"c_acctbal": 2},
)
def filter_positive(spark, sf):
    df = relational.filter_min(table(spark, sf, "customer"), "c_acctbal")
    return relational.filter_min(df, "c_nationkey", 0, strict=False).select(
        "c_custkey", "c_acctbal"
    )


@query(
    "q_exclude_code",
    with_fixture("fx_people")
    + "select id, embarked, sex from fx_people "
    "where (embarked is null or embarked <> 'MACHINERY') and sex = 'female'",
)
def exclude_code(spark, sf):
    people = relational.exclude(load(spark, sf, "fx_people"), "embarked", "MACHINERY")
    return people.where(F.col("sex") == "female").select("id", "embarked", "sex")


@query(
    "q_audience",
    with_fixture("fx_omnichannel")
    + "select master_id from fx_omnichannel where order_channel in ('Mobile', 'Desktop') "
    "and regexp_matches(categories, 'MEN|KIDS')",
)
def audience(spark, sf):
    return relational.select_audience(
        load(spark, sf, "fx_omnichannel"),
        ["Mobile", "Desktop"],
        "MEN|KIDS",
        segment="order_channel",
    )


@query(
    "q_parse_dates",
    "select o_orderkey, cast(strftime(o_orderdate, '%Y-%m-%d') as timestamp) as first_date, "
    "o_orderdate as last_date from orders",
)
def parse_dates(spark, sf):
    text = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_date"),
        F.col("o_orderdate").cast("string").alias("last_date"),
    )
    return relational.parse_dates(text)


@query(
    "q_parse_ts",
    "select event_id, date_trunc('second', ts) as parsed, "
    "timestamp '1970-01-01' + to_seconds(event_id * 60) as from_epoch from events",
)
def parse_ts(spark, sf):
    text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        c.to_ts(text, "dd/MM/yyyy HH:mm:ss").alias("parsed"),
        c.from_epoch(F.col("event_id") * 60).alias("from_epoch"),
    )


@query(
    "q_date_parts",
    "select event_id, year(ts)::int as y, month(ts)::int as m, dayname(ts) as d from events",
)
def date_parts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), c.day_name("ts").alias("d")
    )


@query(
    "q_date_diffs",
    "select o_orderkey, (2001 - year(o_orderdate))::int as years, "
    "((2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate))::int as months from orders",
)
def date_diffs(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        c.years_between("o_orderdate", ref(REF)).alias("years"),
        c.months_apart("o_orderdate", ref(REF)).alias("months"),
    )


@query(
    "q_concat_key",
    with_fixture("fx_services")
    + "select k, count(*) as n from (select cast(service_id as varchar) || '_' || "
    "cast(category_id as varchar) || '_' || strftime(create_date, '%Y-%m') as k from fx_services) "
    "group by k",
)
def concat_key(spark, sf):
    services = load(spark, sf, "fx_services")
    key = c.concat_key("service_id", "category_id", c.month_key("create_date"))
    return services.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_to_numeric",
    with_fixture("fx_telco")
    + "select customer_id, try_cast(trim(total_charges) as double) as charges from fx_telco",
)
def to_numeric(spark, sf):
    return load(spark, sf, "fx_telco").select(
        "customer_id", c.to_numeric("total_charges").alias("charges")
    )


@query(
    "q_yes_flag",
    with_fixture("fx_telco")
    + "select customer_id, case when lower(trim(churn)) = 'yes' then 1 else 0 end as churned "
    "from fx_telco",
)
def yes_flag(spark, sf):
    return load(spark, sf, "fx_telco").select("customer_id", c.yes_flag("churn").alias("churned"))


@query("q_upper_columns", 'select r_regionkey as "R_REGIONKEY", r_name as "R_NAME" from region')
def upper_columns(spark, sf):
    return relational.upper_columns(table(spark, sf, "region"))


@query(
    "q_rename_drop",
    "select n_nationkey as nation_id, n_name as nation from nation",
)
def rename_drop(spark, sf):
    named = relational.rename(
        table(spark, sf, "nation"), {"n_nationkey": "nation_id", "n_name": "nation"}
    )
    return relational.drop_cols(named, "n_regionkey")


@query(
    "q_lookup_name",
    with_fixture("fx_retail")
    + ", wanted as (select distinct p_brand || '_' || p_type as stock_code from part "
    "union all select 'missing') select w.stock_code, coalesce(min(r.description), 'not found') "
    "as description from wanted w left join fx_retail r on w.stock_code = r.stock_code "
    "group by w.stock_code",
)
def lookup_name(spark, sf):
    codes = table(spark, sf, "part").select(
        F.concat_ws("_", "p_brand", "p_type").alias("stock_code")
    )
    wanted = codes.distinct().union(spark.createDataFrame([("missing",)], "stock_code string"))
    return relational.lookup_name(wanted, load(spark, sf, "fx_retail"), "stock_code", "description")


# Joins, unions and top-k


@query(
    "q_join_left",
    "select o_orderkey, c_name, c_mktsegment from orders left join "
    "(select * from customer where c_custkey % 3 = 0) on o_custkey = c_custkey",
)
def join_left(spark, sf):
    some = relational.rename(
        table(spark, sf, "customer").where("c_custkey % 3 = 0"), {"c_custkey": "o_custkey"}
    )
    return relational.enrich(table(spark, sf, "orders"), some, "o_custkey").select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query(
    "q_join_natural",
    "select l_orderkey as order_id, l_linenumber, l_quantity, o_custkey from lineitem "
    "join orders on l_orderkey = o_orderkey where o_orderstatus = 'F'",
)
def join_natural(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_quantity"
    )
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_id"), "o_custkey"
    )
    return relational.natural_join(lines, orders)


@query(
    "q_drop_rare_items",
    with_fixture("fx_ratings")
    + ", r as (select user_id, case when user_id % 50 = 0 then null else movie_id end as movie_id "
    "from fx_ratings) select movie_id, count(*) as n from r where movie_id is null or movie_id in "
    "(select movie_id from r group by movie_id having count(*) >= (select quantile_disc(n, 0.5) from "
    "(select count(*) as n from r group by movie_id))) group by movie_id",
)
def drop_rare_items(spark, sf):
    ratings = load(spark, sf, "fx_ratings").select(
        "user_id", F.when(F.col("user_id") % 50 != 0, F.col("movie_id")).alias("movie_id")
    )
    counts = ratings.groupBy("movie_id").count()
    median = counts.agg(F.expr("percentile_disc(0.5) within group (order by count)")).first()[0]
    kept = relational.drop_rare_items(ratings, "movie_id", int(median or 0))
    return kept.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_semi_filter",
    "select o_orderkey, o_custkey from orders where o_custkey in "
    "(select o_custkey from orders group by o_custkey having sum(o_totalprice) > 3000000)",
)
def semi_filter(spark, sf):
    orders = table(spark, sf, "orders")
    big = orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v")).where("v > 3000000")
    return relational.keep_members(orders, big, "o_custkey").select("o_orderkey", "o_custkey")


@query(
    "q_attach_country",
    with_fixture("fx_retail")
    + ", s as (select customer_id, count(distinct invoice) as invoices from fx_retail "
    "where customer_id is not null group by customer_id) select s.customer_id, s.invoices, "
    "c.country from s left join (select customer_id, min(country) as country from fx_retail "
    "group by customer_id) c on s.customer_id = c.customer_id",
)
def attach_country(spark, sf):
    lines = load(spark, sf, "fx_retail")
    scores = (
        lines.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count_distinct("invoice").alias("invoices"))
    )
    return relational.attach_country(scores, lines).select("customer_id", "invoices", "country")


@query(
    "q_top_k",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
    {"o_totalprice": 2},
)
def top_k(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return relational.top_k(orders, "o_totalprice", 10, "o_orderkey")


@query(
    "q_top_products",
    with_fixture("fx_retail")
    + "select description, sum(quantity) as quantity from fx_retail group by description "
    "order by quantity desc, description limit 5",
)
def top_products(spark, sf):
    lines = load(spark, sf, "fx_retail")
    return relational.top_groups(lines, "description", "quantity", 5, "quantity")


# Summaries


@query(
    "q_channel_summary",
    with_fixture("fx_omnichannel")
    + "select order_channel, count(master_id) as customers, "
    "sum(order_num_online + order_num_offline) as orders, "
    "sum(value_online + value_offline) as value from fx_omnichannel group by order_channel",
    {"value": 2},
)
def channel_summary(spark, sf):
    return relational.channel_summary(omnichannel(spark, sf))


@query(
    "q_target_by_category",
    with_fixture("fx_people")
    + "select 'sex' as variable, sex as level, avg(survived) as target_mean from fx_people "
    "group by sex union all select 'embarked', embarked, avg(survived) from fx_people "
    "where embarked is not null group by embarked",
    {"target_mean": 6},
)
def target_by_category(spark, sf):
    return relational.target_by_category(
        load(spark, sf, "fx_people"), ["sex", "embarked"], "survived"
    )


@query(
    "q_num_by_target",
    with_fixture("fx_people")
    + "select survived, avg(age) as mean_age, avg(fare) as mean_fare from fx_people "
    "group by survived",
    {"mean_age": 6, "mean_fare": 6},
)
def num_by_target(spark, sf):
    return relational.num_by_target(load(spark, sf, "fx_people"), ["age", "fare"], "survived")


@query(
    "q_group_profile",
    with_fixture("fx_people")
    + "select case when sibsp + parch > 0 then 'NO' else 'YES' end as alone, "
    "count(survived) as n, avg(survived) as mean_survived, avg(age) as mean_age "
    "from fx_people group by 1",
    {"mean_survived": 6, "mean_age": 6},
)
def group_profile(spark, sf):
    people = load(spark, sf, "fx_people").withColumn(
        "alone", F.when(F.col("sibsp") + F.col("parch") > 0, "NO").otherwise("YES")
    )
    return relational.group_profile(
        people,
        "alone",
        {
            "n": F.count("survived"),
            "mean_survived": F.avg("survived"),
            "mean_age": F.avg("age"),
        },
    )


@query(
    "q_cat_summary",
    with_fixture("fx_people")
    + "select embarked as level, count(*) as n, "
    "100e0 * count(*) / (select count(*) from fx_people) as percent from fx_people "
    "where embarked is not null group by embarked",
    {"percent": 6},
)
def cat_summary(spark, sf):
    return relational.cat_summary(load(spark, sf, "fx_people"), "embarked")


def _rare_sql(scale: str) -> str:
    return with_fixture("fx_people") + " union all ".join(
        f"select '{x}' as variable, cast({x} as varchar) as level, count(*) as n, "
        f"avg(survived) as target_mean, "
        f"{scale} * count(*) / (select count(*) from fx_people) as ratio "
        f"from fx_people where {x} is not null group by {x}"
        for x in ("embarked", "pclass")
    )


@query("q_rare_analysis", _rare_sql("1e0"), {"target_mean": 6, "ratio": 6})
def rare_analysis(spark, sf):
    return relational.rare_analysis(
        load(spark, sf, "fx_people"), "survived", ["embarked", "pclass"]
    )


@query("q_rare_analysis_percent", _rare_sql("1e2"), {"target_mean": 6, "ratio": 6})
def rare_analysis_percent(spark, sf):
    return relational.rare_analysis(
        load(spark, sf, "fx_people"), "survived", ["embarked", "pclass"], percent=True
    )


_HEALTH = ["age", "glucose", "insulin", "skin", "bmi"]


def corr_sql(a: str, b: str) -> str:
    return (
        f"case when stddev_pop(case when {b} is not null then {a} end) * "
        f"stddev_pop(case when {a} is not null then {b} end) > 0 then covar_pop({a}, {b}) / "
        f"(stddev_pop(case when {b} is not null then {a} end) * "
        f"stddev_pop(case when {a} is not null then {b} end)) end"
    )


HEALTH_NULLS = (
    "h as (select id, pregnancies, age, outcome, nullif(glucose, 0) as glucose, "
    "nullif(insulin, 0) as insulin, nullif(skin, 0) as skin, nullif(bmi, 0) as bmi "
    "from fx_health) "
)


@query(
    "q_corr_matrix",
    with_fixture("fx_health").rstrip()
    + ", "
    + HEALTH_NULLS
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, {corr_sql(a, b)} as corr from h"
        for a in _HEALTH
        for b in _HEALTH
    ),
    {"corr": 6},
)
def corr_matrix(spark, sf):
    from cohortica.operators.missing import zero_to_null

    health = zero_to_null(load(spark, sf, "fx_health"), ["glucose", "insulin", "skin", "bmi"])
    return relational.corr_matrix(health, _HEALTH)


@query(
    "q_rating_pivot",
    with_fixture("fx_ratings")
    + "select user_id, "
    + ", ".join(
        f"avg(case when movie_id = '{m}' then rating end) as \"{m}\""
        for m in ("Brand#1", "Brand#2", "Brand#3")
    )
    + " from fx_ratings where movie_id in ('Brand#1', 'Brand#2', 'Brand#3') group by user_id",
)
def rating_pivot(spark, sf):
    pivot = relational.rating_pivot(
        load(spark, sf, "fx_ratings"), ["Brand#1", "Brand#2", "Brand#3"]
    )
    return pivot.select("user_id", *[F.col(f"`{m}`") for m in pivot.columns[1:]])


def segment_sql(score: str) -> str:
    whens = " ".join(
        f"when regexp_full_match({score}, '{p}') then '{n}'" for p, n in SEGMENTS.items()
    )
    return f"case {whens} else {score} end"
