"""Itemsets, rules and collaborative filtering against hand-made cases and brute force."""

from datetime import datetime
from itertools import combinations

import numpy as np
import pytest

from cohortica.operators import baskets, collaborative


def cells(spark, groups):
    rows = [(str(i), x) for i, items in enumerate(groups) for x in items]
    return spark.createDataFrame(rows, "basket string, item string")


def test_four_baskets(spark):
    df = cells(spark, ["abc", "abc", "a", "bc"])
    sets = {"".join(r["items"]): r["n"] for r in baskets.frequent_itemsets(df, 0.25).collect()}
    assert sets == {"a": 3, "b": 3, "c": 3, "ab": 2, "ac": 2, "bc": 3, "abc": 2}
    found = baskets.association_rules(baskets.frequent_itemsets(df, 0.25), "support", 0.25)
    rules = {("".join(r["antecedent"]), "".join(r["consequent"])): r for r in found.collect()}
    assert len(rules) == 12
    row = rules["a", "bc"]
    assert (row["support"], row["confidence"], row["lift"]) == pytest.approx((0.5, 2 / 3, 8 / 9))
    assert rules["b", "c"]["lift"] == pytest.approx(4 / 3)


def test_itemsets_by_brute_force(spark):
    rng = np.random.default_rng(2)
    groups = [sorted({f"i{v}" for v in rng.zipf(1.5, 6) if v < 12}) for _ in range(150)]
    groups = [g for g in groups if g]
    want = {}
    for g in groups:
        for n in (1, 2, 3):
            for s in combinations(g, n):
                want[s] = want.get(s, 0) + 1
    want = {s: n for s, n in want.items() if n / len(groups) >= 0.1}
    got = baskets.frequent_itemsets(cells(spark, groups), 0.1, 3).collect()
    more = baskets.frequent_itemsets(cells(spark, groups), 0.1)
    assert more.where("size(items) <= 3").count() == len(got) <= more.count()
    assert {tuple(r["items"]): r["n"] for r in got} == want
    supports = {tuple(r["items"]): r["support"] for r in got}
    assert all(supports[s] <= supports[t] for s in supports for t in combinations(s, len(s) - 1) if t)


def test_no_frequent_items(spark):
    assert baskets.frequent_itemsets(cells(spark, ["a", "b", "c"]), 0.5).count() == 0
    assert baskets.frequent_itemsets(cells(spark, []), 0.5).count() == 0


def test_recommend(spark):
    rules = spark.createDataFrame(
        [
            (["a"], ["b", "c"], 0.1, 0.5, 2.0),
            (["a", "d"], ["b"], 0.1, 0.5, 3.0),
            (["a"], ["e"], 0.2, 0.5, 2.0),
            (["z"], ["a"], 0.2, 0.5, 9.0),
        ],
        "antecedent array<string>, consequent array<string>, support double, confidence double, "
        "lift double",
    )
    targets = spark.createDataFrame([("a",), ("q",)], "target string")
    got = baskets.arl_recommend(rules, targets, 3).orderBy("target", "rank").collect()
    assert [(r["target"], r["item"]) for r in got] == [("a", "b"), ("a", "e"), ("a", "c")]


def test_presence_by_mean_quantity(spark):
    df = spark.createDataFrame(
        [("1", "a", 3.0), ("1", "a", -2.0), ("1", "b", -1.0), ("2", None, 1.0)],
        "invoice string, description string, quantity double",
    )
    assert baskets.invoice_presence(df).collect() == [("1", "a")]


RATINGS = [
    # user 1 is the target; 2 agrees, 3 disagrees, 4 is constant, 5 shares one item
    (1, "a", 1.0), (1, "b", 3.0), (1, "c", 5.0),
    (2, "a", 2.0), (2, "b", 3.0), (2, "c", 4.0), (2, "d", 5.0), (2, "e", 2.0),
    (3, "a", 5.0), (3, "b", 3.0), (3, "c", 1.0), (3, "d", 1.0),
    (4, "a", 3.0), (4, "b", 3.0), (4, "c", 3.0),
    (5, "a", 1.0), (5, "d", 4.0),
]


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id long, movie_id string, rating double")


def test_user_based(spark, ratings):
    table = collaborative.rating_table(ratings, 1)
    seen = collaborative.watched(table, 1)
    assert sorted(r[0] for r in seen.collect()) == ["a", "b", "c"]
    overlap = {r["user_id"]: r["n"] for r in collaborative.overlap_users(table, 1).collect()}
    assert overlap == {1: 3, 2: 3, 3: 3, 4: 3}
    similar = collaborative.similar_users(table, 1, 0.65)
    assert [(r["user_id"], round(r["corr"], 9)) for r in similar.collect()] == [(2, 1.0)]
    titles = spark.createDataFrame([(m, m.upper()) for m in "abcde"], "movie_id string, title string")
    got = collaborative.user_based_recommend(ratings, similar, titles, 2.5, 2).collect()
    assert [(r["movie_id"], r["title"]) for r in got] == [("d", "D"), ("c", "C")]


def test_rare_items_leave_the_table(ratings):
    assert {r[0] for r in collaborative.rating_table(ratings, 3).select("movie_id").collect()} == set("abcd")


def test_item_correlations(ratings):
    table = collaborative.rating_table(ratings, 1)
    got = {r["movie_id"]: r["corr"] for r in collaborative.item_correlations(table, "a").collect()}
    # b is constant and e has one shared user: no correlation.
    assert set(got) == {"c", "d"} and got["c"] == pytest.approx(-1.0)


def test_latest_favourite(spark):
    rows = [
        (1, "x", 5.0, datetime(2020, 1, 1)),
        (1, "z", 5.0, datetime(2021, 1, 1)),
        (1, "y", 5.0, datetime(2021, 1, 1)),
        (1, "w", 4.0, datetime(2022, 1, 1)),
        (2, "x", 4.0, datetime(2022, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "user_id long, movie_id string, rating double, ts timestamp_ntz")
    assert collaborative.latest_favourite(df).collect() == [(1, "y")]


def test_long_itemsets_grow_only_confident_consequents(spark):
    from pyspark.sql import functions as F

    names = [f"i{k:02}" for k in range(40)]
    sets = [(names, 0.5)] + [([x for x in names if x != y], 0.5 if y == "i07" else 0.9) for y in names] + [([x], 0.9) for x in names]
    table = spark.createDataFrame(sets, "items array<string>, support double")
    got = baskets.association_rules(table, "confidence", 0.9).where(F.size("antecedent") == 39).collect()
    assert [(r.consequent, r.confidence) for r in got] == [(["i07"], 1.0)]


def test_rules_by_brute_force(spark):
    import random

    rng = random.Random(4)
    groups = ["".join(sorted(set(rng.choices("abcdef", [9, 8, 6, 4, 3, 2], k=6)))) for _ in range(60)]
    sets = {tuple(r["items"]): r["support"] for r in baskets.frequent_itemsets(cells(spark, groups), 0.05).collect()}
    table = baskets.frequent_itemsets(cells(spark, groups), 0.05)
    for metric, least in (("confidence", 0.4), ("lift", 1.05), ("support", 0.1)):
        got = {(tuple(r.antecedent), tuple(r.consequent)): getattr(r, metric) for r in baskets.association_rules(table, metric, least).collect()}
        want = {}
        for whole, support in sets.items():
            for mask in range(1, 2 ** len(whole) - 1):
                a = tuple(x for i, x in enumerate(whole) if mask >> i & 1)
                b = tuple(x for i, x in enumerate(whole) if not mask >> i & 1)
                value = {"support": support, "confidence": support / sets[a], "lift": support / sets[a] / sets[b]}[metric]
                if value >= least:
                    want[a, b] = value
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert baskets.association_rules(table.limit(0), "lift", 0.1).collect() == []
