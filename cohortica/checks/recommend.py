"""Queries on baskets, rules and collaborative filtering."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortica.checks.fixtures import load, table, with_fixture
from cohortica.checks.registry import query
from cohortica.operators import baskets, collaborative
from cohortica.plans.shelf import basket_rules, recommend_for_codes
from cohortica.session import settle

MIN_SUPPORT = 0.004
OVERLAP = 60
MIN_CORR = 0.3
MIN_SCORE = 1.2


# Baskets and rules


@query(
    "q_monthly_baskets",
    with_fixture("fx_services")
    + "select basket, string_agg(item, '|' order by item) as items from (select distinct "
    "cast(user_id as varchar) || '_' || strftime(create_date, '%Y-%m') as basket, "
    "cast(service_id as varchar) || '_' || cast(category_id as varchar) as item "
    "from fx_services) group by basket",
)
def monthly_baskets(spark, sf):
    found = baskets.monthly_baskets(load(spark, sf, "fx_services"))
    return found.select("basket", F.array_join("items", "|").alias("items"))


@query(
    "q_basket_presence",
    with_fixture("fx_services")
    + "select cast(user_id as varchar) || '_' || strftime(create_date, '%Y-%m') as basket, "
    "cast(service_id as varchar) || '_' || cast(category_id as varchar) as item, count(*) as n "
    "from fx_services group by 1, 2",
)
def basket_presence(spark, sf):
    return baskets.basket_presence(baskets.monthly_items(load(spark, sf, "fx_services")))


@query(
    "q_invoice_presence",
    with_fixture("fx_retail")
    + "select basket, item from (select invoice as basket, description as item, "
    "avg(case when contains(invoice, 'C') then -quantity else quantity end) as q "
    "from fx_retail group by 1, 2) where q > 0",
)
def invoice_presence(spark, sf):
    lines = load(spark, sf, "fx_retail").withColumn(
        "quantity",
        F.when(F.col("invoice").contains("C"), -F.col("quantity")).otherwise(F.col("quantity")),
    )
    return baskets.invoice_presence(lines)


def itemsets_sql(cells: str, min_support: float) -> str:
    """Table ``sets`` from the table ``cells`` with one row per basket and item: frequent sets of
    any size, each grown from a frequent set by a later item."""
    return (
        f"total as (select count(distinct basket) as baskets from {cells}), "
        "held as (select basket, [item] as items from "
        f"(select *, count(*) over (partition by item) as n from {cells}), total "
        f"where n::double / baskets >= {min_support}::double "
        "union all select basket, items from (select h.basket, list_append(h.items, c.item) as items, "
        "count(*) over (partition by list_append(h.items, c.item)) as n "
        f"from held h join {cells} c on h.basket = c.basket and c.item > h.items[-1]), total "
        f"where n::double / baskets >= {min_support}::double), "
        "sets as (select items, count(*) as n, count(*)::double / any_value(baskets) as support "
        "from held, total group by items) "
    )


# Every set of two or more items is split by every mask that leaves neither side empty.
RULES_FROM_SETS = (
    ", masks as (select items, support, unnest(range(1, (1 << len(items)) - 1)) as mask from sets "
    "where len(items) >= 2), "
    "splits as (select list_filter(items, lambda x, i: (mask >> cast(i - 1 as bigint)) & 1 = 1) as antecedent, "
    "list_filter(items, lambda x, i: (mask >> cast(i - 1 as bigint)) & 1 = 0) as consequent, support from masks), "
    "rules as (select antecedent, consequent, s.support, s.support / a.support as confidence, "
    "s.support / a.support / c.support as lift from splits s join sets a "
    "on s.antecedent = a.items join sets c on s.consequent = c.items) "
)


def recursive(sql: str) -> str:
    return sql.replace("with ", "with recursive ", 1)


ITEMSETS = recursive(
    with_fixture("fx_baskets").rstrip() + ", " + itemsets_sql("fx_baskets", MIN_SUPPORT)
)
RULES = ITEMSETS + RULES_FROM_SETS
PICKS = (
    ", reached as (select t.target, i.item, lift, support, antecedent from rules, "
    "unnest(antecedent) as t(target), unnest(consequent) as i(item)), "
    "best as (select *, row_number() over (partition by target, item "
    "order by lift desc, support desc, antecedent) as r from reached), "
    "ranked as (select target, item, lift, row_number() over (partition by target "
    "order by lift desc, support desc, antecedent, item) as rank from best where r = 1), "
    "picks as (select target, rank, item, lift from ranked where rank <= 3) "
)


def itemsets(spark, sf):
    return baskets.frequent_itemsets(load(spark, sf, "fx_baskets"), MIN_SUPPORT)


def rules(spark, sf):
    return baskets.association_rules(itemsets(spark, sf), "support", MIN_SUPPORT)


@query(
    "q_itemsets",
    ITEMSETS + "select array_to_string(items, '|') as items, n, support from sets",
    {"support": 6},
)
def frequent_itemsets(spark, sf):
    return itemsets(spark, sf).select(F.array_join("items", "|").alias("items"), "n", "support")


@query(
    "q_itemsets_up_to_two",
    ITEMSETS + "select array_to_string(items, '|') as items, n, support from sets where len(items) <= 2",
    {"support": 6},
)
def itemsets_up_to_two(spark, sf):
    found = baskets.frequent_itemsets(load(spark, sf, "fx_baskets"), MIN_SUPPORT, max_len=2)
    return found.select(F.array_join("items", "|").alias("items"), "n", "support")


@query(
    "q_confident_rules",
    RULES
    + "select array_to_string(antecedent, '|') as antecedent, "
    "array_to_string(consequent, '|') as consequent, support, confidence, lift from rules where confidence >= 0.18e0",
    {"support": 6, "confidence": 6, "lift": 6},
)
def confident_rules(spark, sf):
    found = baskets.association_rules(itemsets(spark, sf), "confidence", 0.18)
    return found.withColumns({c: F.array_join(c, "|") for c in ("antecedent", "consequent")})


@query(
    "q_assoc_rules",
    RULES
    + "select array_to_string(antecedent, '|') as antecedent, "
    "array_to_string(consequent, '|') as consequent, support, confidence, lift from rules",
    {"support": 6, "confidence": 6, "lift": 6},
)
def assoc_rules(spark, sf):
    return rules(spark, sf).select(
        F.array_join("antecedent", "|").alias("antecedent"),
        F.array_join("consequent", "|").alias("consequent"),
        "support",
        "confidence",
        "lift",
    )


@query(
    "q_arl_recommend",
    RULES + PICKS + "select * from picks",
    {"lift": 6},
)
def arl_recommend(spark, sf):
    targets = table(spark, sf, "part").select(F.col("p_brand").alias("target"))
    return baskets.arl_recommend(rules(spark, sf), targets, 3)


@query(
    "q_shelf_recommend",
    recursive(with_fixture("fx_retail")).rstrip()
    + ", cells as (select distinct invoice as basket, description as item from fx_retail "
    "where customer_id is not null and not contains(invoice, 'C') and price > 0 "
    "and quantity > 0 and country = 'NATION_7'), "
    + itemsets_sql("cells", 0.005)
    + RULES_FROM_SETS.replace("rules as (select", "every_rule as (select")
    + ", rules as (select * from every_rule where support >= 0.01::double) "
    + PICKS
    + ", wanted as (select p_brand || '_' || p_type as stock_code, min(p_name) as any_name "
    "from part group by 1), named as (select w.stock_code, "
    "coalesce(min(r.description), 'not found') as description from wanted w left join fx_retail r "
    "on w.stock_code = r.stock_code group by w.stock_code) "
    "select stock_code, description, rank, item, lift from named "
    "left join picks on description = target",
    {"lift": 6},
)
def shelf_recommend(spark, sf):
    lines = settle(load(spark, sf, "fx_retail"))
    found = settle(basket_rules(lines, "NATION_7", min_support=0.005))
    wanted = table(spark, sf, "part").select(
        F.concat_ws("_", "p_brand", "p_type").alias("stock_code")
    )
    return recommend_for_codes(lines, found, wanted.distinct(), 3)


# Collaborative filtering


RATINGS = (
    with_fixture("fx_ratings").rstrip()
    + ", t as (select user_id, movie_id, avg(rating) as rating from fx_ratings where movie_id in "
    "(select movie_id from fx_ratings group by movie_id having count(*) >= (select "
    "quantile_disc(n, 0.5) from (select count(*) as n from fx_ratings group by movie_id))) "
    "group by user_id, movie_id), target as (select user_id from t group by user_id "
    "order by count(*) desc, user_id limit 1), own as (select movie_id, rating as mine from t "
    "where user_id = (select user_id from target)) "
)


def ratings(spark, sf):
    return load(spark, sf, "fx_ratings")


def rating_table(spark, sf):
    """Items with at least as many ratings as the median item has."""
    counts = ratings(spark, sf).groupBy("movie_id").count()
    median = counts.agg(F.expr("percentile_disc(0.5) within group (order by count)")).first()[0]
    return collaborative.rating_table(ratings(spark, sf), int(median or 0))


def table_and_target(spark, sf):
    """The rating table, settled, and its user with the most items (the smallest id of several)."""
    ratings_by_user = settle(rating_table(spark, sf))
    counts = ratings_by_user.groupBy("user_id").count()
    return ratings_by_user, counts.orderBy(F.desc("count"), "user_id").first()["user_id"]


@query("q_rating_table", RATINGS + "select * from t", {"rating": 6})
def whole_rating_table(spark, sf):
    return rating_table(spark, sf)


@query("q_watched", RATINGS + "select movie_id from own")
def watched(spark, sf):
    return collaborative.watched(*table_and_target(spark, sf))


@query(
    "q_overlap_users",
    RATINGS
    + "select user_id, count(*) as n from t join own using (movie_id) group by user_id "
    f"having count(*) >= (select count(*) from own) * {OVERLAP} / 1e2",
)
def overlap_users(spark, sf):
    return collaborative.overlap_users(*table_and_target(spark, sf), OVERLAP)


SIMILAR = (
    RATINGS
    + ", m as (select user_id, count(*) as n, covar_pop(rating, mine) as c, "
    "stddev_pop(rating) * stddev_pop(mine) as s from t join own using (movie_id) "
    "where user_id <> (select user_id from target) group by user_id), "
    "similar_users as (select user_id, c / s as corr from m where s > 0 and "
    f"n >= (select count(*) from own) * {OVERLAP} / 1e2 and c / s >= {MIN_CORR}::double) "
)


def similar(spark, sf):
    return collaborative.similar_users(*table_and_target(spark, sf), MIN_CORR, OVERLAP)


@query("q_similar_users", SIMILAR + "select * from similar_users", {"corr": 6})
def similar_users(spark, sf):
    return similar(spark, sf)


@query(
    "q_user_based_recommend",
    SIMILAR
    + ", titles as (select p_brand as movie_id, min(p_name) as title from part group by p_brand), "
    "w as (select movie_id, avg(corr * rating) as weighted_rating from fx_ratings "
    "join similar_users using (user_id) group by movie_id) "
    "select movie_id, weighted_rating, title from w join titles using (movie_id) "
    f"where weighted_rating > {MIN_SCORE}::double order by weighted_rating desc, movie_id limit 5",
    {"weighted_rating": 6},
)
def user_based_recommend(spark, sf):
    titles = (
        table(spark, sf, "part")
        .groupBy(F.col("p_brand").alias("movie_id"))
        .agg(F.min("p_name").alias("title"))
    )
    return collaborative.user_based_recommend(
        ratings(spark, sf), similar(spark, sf), titles, MIN_SCORE
    )


@query(
    "q_item_correlations",
    RATINGS
    + "select movie_id, c / s as corr from (select a.movie_id, "
    "covar_pop(a.rating, b.rating) as c, stddev_pop(a.rating) * stddev_pop(b.rating) as s "
    "from t a join t b on a.user_id = b.user_id and b.movie_id = (select min(movie_id) from t) "
    "and a.movie_id <> b.movie_id group by a.movie_id) where s > 0",
    {"corr": 6},
)
def item_correlations(spark, sf):
    ratings_by_user = settle(rating_table(spark, sf))
    first = ratings_by_user.agg(F.min("movie_id")).first()[0]
    return collaborative.item_correlations(ratings_by_user, first)


@query(
    "q_item_based_recommend",
    RATINGS
    + ", fav as (select movie_id from fx_ratings where user_id = (select user_id from target) "
    "and rating = 5 order by ts desc, movie_id limit 1) "
    "select movie_id, c / s as corr from (select a.movie_id, "
    "covar_pop(a.rating, b.rating) as c, stddev_pop(a.rating) * stddev_pop(b.rating) as s "
    "from t a join t b on a.user_id = b.user_id and b.movie_id = (select movie_id from fav) "
    "and a.movie_id <> b.movie_id group by a.movie_id) where s > 0 "
    "order by corr desc, movie_id limit 5",
    {"corr": 6},
)
def item_based_recommend(spark, sf):
    ratings_by_user, target = table_and_target(spark, sf)
    return collaborative.item_based_recommend(ratings_by_user, ratings(spark, sf), target)
