"""Frequent itemsets, association rules and recommendations from rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortica.functions.columns import concat_key, month_key
from cohortica.operators.ranking import global_rank
from cohortica.session import settle, small_side


def monthly_items(
    df: DataFrame,
    user: str = "user_id",
    service: str = "service_id",
    category: str = "category_id",
    date: str = "create_date",
) -> DataFrame:
    """One row per service: a basket is a user's month, an item a service within a category."""
    return df.select(
        concat_key(user, month_key(date)).alias("basket"),
        concat_key(service, category).alias("item"),
    ).where(F.col("basket").isNotNull() & F.col("item").isNotNull())


def monthly_baskets(df: DataFrame, **columns: str) -> DataFrame:
    """Sorted distinct items of each user's month."""
    return gather(monthly_items(df, **columns))


def gather(items: DataFrame) -> DataFrame:
    """Baskets as sorted arrays. Repeats go before the arrays are built, so a basket holds at most
    as many entries as there are items."""
    return (
        items.select("basket", "item")
        .distinct()
        .groupBy("basket")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )


def basket_presence(items: DataFrame) -> DataFrame:
    """The non-empty cells of the basket by item table, with their row counts."""
    return items.groupBy("basket", "item").agg(F.count(F.lit(1)).alias("n"))


def invoice_presence(
    df: DataFrame, invoice: str = "invoice", item: str = "description", quantity: str = "quantity"
) -> DataFrame:
    """Items whose mean quantity on an invoice is above 0."""
    return (
        df.na.drop("any", subset=[invoice, item])
        .groupBy(F.col(invoice).alias("basket"), F.col(item).alias("item"))
        .agg(F.avg(quantity).alias("_mean"))
        .where(F.col("_mean") > 0)
        .select("basket", "item")
    )


def frequent_itemsets(
    items: DataFrame, min_support: float, max_len: int | None = None
) -> DataFrame:
    """Itemsets held by at least ``min_support`` of the baskets, of up to ``max_len`` items if given.

    ``items`` has one row per basket and item. Sets grow level by level, so a limit bounds the work. Items are
    coded by their rank, the rarest first, and infrequent ones dropped. Every frequent set keeps the *rests* of
    the baskets that hold it: their items after its last one, equal rests as one row with a count. The sets
    of the next level are a set and an item of its rests; from three items on only those are counted all of
    whose parts are frequent.
    """
    spark = items.sparkSession
    cells = settle(items.select("basket", "item").distinct())
    baskets = cells.agg(F.count_distinct("basket")).first()[0]
    least = max(1, _ceil(min_support * (baskets or 0)))
    frequent = cells.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    codes = settle(global_rank(settle(frequent), ["n", "item"], "code").withColumn("code", F.col("code").cast("int")))
    level = codes.select(F.col("code").cast("long").alias("id"), F.array("code").alias("codes"), "n")
    # A basket is the rest of the empty set; its items in order make the rests of the sets of one.
    coded = cells.join(small_side(codes.select("item", "code")), "item")
    rests = coded.groupBy("basket").agg(F.sort_array(F.collect_list("code")).alias("rest"))
    rests = rests.groupBy("rest").agg(F.count(F.lit(1)).alias("w"))
    rests = settle(
        rests.select(F.posexplode("rest").alias("_at", "code"), "rest", "w")
        .select(F.col("code").cast("long").alias("id"), F.expr("slice(rest, _at + 2, size(rest))").alias("rest"), "w")
        .where(F.size("rest") > 0)
        .groupBy("id", "rest").agg(F.sum("w").alias("w"))
    )
    levels, size = [level], 1
    while max_len is None or size < max_len:
        size += 1
        grown = rests.select("id", F.posexplode("rest").alias("_at", "code"), "rest", "w")
        if size > 2:
            grown = grown.join(small_side(_candidates(level)), ["id", "code"])
        counts = grown.groupBy("id", "code").agg(F.sum("w").alias("n")).where(F.col("n") >= least)
        counts = settle(counts.withColumn("next", F.monotonically_increasing_id()))
        if not counts.limit(1).count():
            break
        before = level.select("id", "codes")
        level = settle(
            counts.join(before, "id").select(F.col("next").alias("id"), F.concat("codes", F.array("code")).alias("codes"), "n")
        )
        levels.append(level)
        rests = settle(
            grown.where(F.expr("_at + 1 < size(rest)"))
            .join(small_side(counts.select("id", "code", "next")), ["id", "code"])
            .select(F.col("next").alias("id"), F.expr("slice(rest, _at + 2, size(rest))").alias("rest"), "w")
            .groupBy("id", "rest").agg(F.sum("w").alias("w"))
        )
    found = reduce(DataFrame.unionByName, levels).select(F.monotonically_increasing_id().alias("id"), "codes", "n")
    found = settle(found)
    names = (
        found.select("id", F.explode("codes").alias("code")).join(small_side(codes.select("code", "item")), "code")
        .groupBy("id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    return found.join(names, "id").select("items", "n", (F.col("n") / F.lit(max(baskets or 0, 1))).alias("support"))


def _candidates(level: DataFrame) -> DataFrame:
    """``id, code``: how a set of ``id, codes`` may grow. Two sets that differ in their last item make one
    larger set; it counts only if all its parts of the present size are there."""
    parts = level.select("id", "codes", F.expr("slice(codes, 1, size(codes) - 1)").alias("_prefix"), F.element_at("codes", -1).alias("_last"))
    other = parts.select("_prefix", F.col("_last").alias("code"))
    pairs = settle(parts.join(other, "_prefix").where("_last < code").select("id", "code", F.concat("codes", F.array("code")).alias("_all")))
    without = F.transform(F.sequence(F.lit(0), F.size("_all") - 3), lambda i: F.filter("_all", lambda _, j: j != i))
    needed = pairs.select("id", "code", F.explode(without).alias("codes"), (F.size("_all") - 2).alias("_parts"))
    known = needed.join(level.select("codes"), "codes").groupBy("id", "code", "_parts").agg(F.count(F.lit(1)).alias("_n"))
    return known.where(F.col("_n") == F.col("_parts")).select("id", "code")


def _ceil(x: float) -> int:
    """Smallest count at or above x, forgiving the last digit of a product such as 0.1 * 30."""
    near = round(x)
    return near if abs(x - near) < 1e-9 * max(1.0, abs(x)) else int(-(-x // 1))


def association_rules(
    itemsets: DataFrame, metric: str = "support", min_threshold: float = 0.01
) -> DataFrame:
    """Every split of a frequent itemset into antecedent and consequent, both of any size.

    Consequents grow item by item, one join per level. All parts of a frequent itemset are frequent, so
    supports come from the itemsets themselves. A rule's confidence can only fall as its consequent grows, so
    with that metric a consequent below the threshold is not grown further; and the support of all
    rules of a set is the set's.
    """
    if metric not in ("support", "confidence", "lift"):
        raise ValueError(metric)
    itemsets = settle(itemsets.select(F.sort_array("items").alias("items"), "support"))
    known = small_side(itemsets)
    whole = itemsets.where(F.size("items") >= 2)
    if metric == "support":
        whole = whole.where(F.col("support") >= F.lit(min_threshold))
    longest = whole.agg(F.max(F.size("items"))).first()[0] or 1
    grown = whole.select("items", "support", F.array().cast(dict(itemsets.dtypes)["items"]).alias("consequent"))
    levels = []
    for _ in range(longest - 1):
        more = F.filter("items", lambda x: (F.size("consequent") == 0) | (x > F.try_element_at("consequent", F.lit(-1))))
        grown = (
            grown.where(F.size("items") > F.size("consequent") + 1)
            .select("items", "support", "consequent", F.explode(more).alias("_item"))
            .select("items", "support", F.concat("consequent", F.array("_item")).alias("consequent"))
            .withColumn("antecedent", F.array_except("items", "consequent"))
            .join(known.select(F.col("items").alias("antecedent"), F.col("support").alias("_antecedent")), "antecedent")
            .withColumn("confidence", F.col("support") / F.col("_antecedent"))
        )
        if metric == "confidence":
            grown = grown.where(F.col("confidence") >= F.lit(min_threshold))
        grown = settle(grown)
        if not grown.limit(1).count():
            break
        levels.append(grown)
    if not levels:
        kind = dict(itemsets.dtypes)["items"]
        return itemsets.sparkSession.createDataFrame(
            [], f"antecedent {kind}, consequent {kind}, support double, confidence double, lift double"
        )
    rules = reduce(DataFrame.unionByName, levels).join(
        known.select(F.col("items").alias("consequent"), F.col("support").alias("_consequent")), "consequent"
    )
    return (
        rules.withColumn("lift", F.col("confidence") / F.col("_consequent"))
        .where(F.col(metric) >= F.lit(min_threshold))
        .select("antecedent", "consequent", "support", "confidence", "lift")
    )


def arl_recommend(rules: DataFrame, targets: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct items that rules about each target lead to.

    ``targets`` has one column, ``target``. Rules are taken by lift, then support, then
    antecedent, and the items of a consequent in order. An item counts once per target, with its
    best rule; that reduces the rules before targets are ranked.
    """
    order = [F.desc("lift"), F.desc("support"), "antecedent", "item"]
    reached = (
        rules.withColumn("target", F.explode("antecedent"))
        .withColumn("item", F.explode("consequent"))
        .select("target", "item", "lift", "support", "antecedent")
    )
    asked = small_side(targets.select("target").distinct())
    wanted = reached.join(asked, "target", "left_semi")
    best = (
        wanted.groupBy("target", "item")
        .agg(
            F.min(
                F.struct(
                    (-F.col("lift")).alias("l"), (-F.col("support")).alias("s"), "antecedent"
                )
            ).alias("_b")
        )
        .select(
            "target",
            "item",
            (-F.col("_b.l")).alias("lift"),
            (-F.col("_b.s")).alias("support"),
            F.col("_b.antecedent").alias("antecedent"),
        )
    )
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("target").orderBy(*order)))
    return ranked.where(F.col("rank") <= n).select("target", "rank", "item", "lift")
