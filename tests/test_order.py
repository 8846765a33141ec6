"""Quantiles, ranks and bins against pandas, on data that forces the paths meant for large data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortica.operators import binning
from cohortica.operators.quantiles import exact_quantiles, grouped_quantile
from cohortica.operators.ranking import global_rank, running_total

PROBS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.95, 1.0]


def skewed(n=5000, seed=1):
    """A third of the rows share one group and one value; some values are null."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "g": np.where(np.arange(n) % 3 == 0, "hot", rng.choice(list("abc"), n)),
            "x": np.round(rng.lognormal(0, 4, n), 3),
        }
    )
    pdf.loc[pdf.id % 3 == 1, "x"] = 7.0
    pdf.loc[pdf.id % 11 == 0, "x"] = np.nan
    return pdf


def as_spark(spark, pdf, schema):
    return spark.createDataFrame(
        [tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)], schema
    )


@pytest.fixture(scope="module")
def table(spark):
    return as_spark(spark, skewed(), "id long, g string, x double").repartition(7).cache()


@pytest.mark.parametrize("few", [3, 40, 20_000])
def test_quantiles_are_exact(table, few):
    found = exact_quantiles(table, ["x", "id"], PROBS, few=few)
    pdf = skewed()
    assert found["x"] == pytest.approx([pdf.x.quantile(p) for p in PROBS], rel=1e-12)
    assert found["id"] == pytest.approx([pdf.id.quantile(p) for p in PROBS], rel=1e-12)


def test_quantile_that_is_a_value_is_that_value(spark):
    df = spark.range(101).select((F.col("id") / 7).alias("x"))
    assert exact_quantiles(df, ["x"], [0.2], few=4)["x"] == [20 / 7]


def test_many_columns_take_several_passes(spark):
    df = spark.range(11).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(70)])
    found = exact_quantiles(df, df.columns, [0.1, 0.5, 0.9])
    assert found == {f"c{i}": [1.0 + i, 5.0 + i, 9.0 + i] for i in range(70)}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def test_grouped_quantile(table):
    got = {r["g"]: r["q"] for r in grouped_quantile(table, ["g"], "x", 0.3, "q").collect()}
    want = skewed().groupby("g").x.quantile(0.3)
    assert got == pytest.approx(want.to_dict(), rel=1e-12)


def test_grouped_quantile_skips_null_groups_and_values(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 2.0), (None, 9.0), ("b", None)], "g string, x double"
    )
    assert grouped_quantile(df, ["g"], "x", 0.5, "q").collect() == [("a", 1.5)]


def test_global_rank(table):
    present = table.where("x is not null")
    got = {r["id"]: r["rn"] for r in global_rank(present, ["x", "id"]).collect()}
    pdf = skewed().dropna().sort_values(["x", "id"])
    assert got == dict(zip(pdf.id, range(1, len(pdf) + 1)))


def test_rank_within_groups(table):
    present = table.where("x is not null")
    got = {r["id"]: r["rn"] for r in global_rank(present, ["x", "id"], "rn", ["g"]).collect()}
    pdf = skewed().dropna().sort_values(["x", "id"])
    assert got == dict(zip(pdf.id, pdf.groupby("g").cumcount() + 1))


def test_running_total(spark):
    df = spark.range(1000).select("id", (F.col("id") % 13).alias("n")).repartition(5)
    got = {r["id"]: r["s"] for r in running_total(df, ["id"], "n", "s").collect()}
    want = np.cumsum(np.arange(1000) % 13)
    assert got == dict(enumerate(want.tolist()))


@pytest.mark.parametrize("k", [2, 5])
def test_qcut_matches_pandas(spark, k):
    pdf = pd.DataFrame({"id": range(60), "x": np.random.default_rng(k).normal(size=60).round(3)})
    pdf.loc[5, "x"] = np.nan
    df = as_spark(spark, pdf, "id long, x double")
    got = {r["id"]: r["bin"] for r in binning.qcut(df, "x", k).collect()}
    want = pd.qcut(pdf.x, k, labels=False) + 1
    assert got == {i: None if pd.isna(v) else int(v) for i, v in enumerate(want)}


def test_qcut_edges_and_ties(spark):
    df = spark.createDataFrame([(v,) for v in (1, 1, 2, 3, 3)], "x long")
    assert [r["bin"] for r in binning.qcut(df, "x", 2).orderBy("x").collect()] == [1, 1, 1, 2, 2]
    with pytest.raises(ValueError):
        binning.qcut(df, "x", 5)
    row = binning.qcut_interval(df, "x", 2).where("x = 3").first()
    assert (row["bin"], row["lo"], row["hi"]) == (2, 2.0, 3.0)


@pytest.mark.parametrize("n,k", [(6, 4), (7, 5), (30, 4), (59, 5), (1, 5)])
def test_rank_qcut_sizes(spark, n, k):
    df = spark.createDataFrame([(i, 1.0) for i in range(n)], "id long, x double")
    got = binning.rank_qcut(df, "x", k, "id").orderBy("id").collect()
    want = [1] if n == 1 else (pd.qcut(pd.Series(range(1, n + 1)), k, labels=False) + 1).tolist()
    assert [r["bin"] for r in got] == want


@pytest.mark.parametrize("key", [str, int])
def test_rank_qcut_splits_ties_by_key_and_moves_no_row(spark, key):
    rng = np.random.default_rng(8)
    rows = [(key(int(i)), None if v == 9 else float(v)) for i, v in zip(rng.permutation(1000) + 1000, rng.integers(0, 10, 1000))]
    df = spark.createDataFrame(rows, f"id {'string' if key is str else 'long'}, x double").repartition(4)
    got = binning.rank_qcut(df, "x", 7, "id")
    assert "Exchange range" not in got._jdf.queryExecution().executedPlan().toString()
    ranked = pd.DataFrame(rows, columns=["id", "x"]).dropna().sort_values(["x", "id"]).reset_index(drop=True)
    want = dict(zip(ranked.id, pd.qcut(pd.Series(ranked.index + 1), 7, labels=False) + 1))
    assert {r.id: r.bin for r in got.where("x is not null").collect()} == {k: int(v) for k, v in want.items()}
    assert got.where("x is null and bin is not null").count() == 0 and got.columns == ["id", "x", "bin"]


def test_order_statistics(spark):
    from cohortica.operators.quantiles import order_statistics

    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=3000), 2)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    places = [0, 1, 17, 1500, 1501, 2999]
    for few in (10, 20_000):
        assert order_statistics(df, "x", places, few) == np.sort(x)[places].tolist()
    with pytest.raises(ValueError):
        order_statistics(df, "x", [3000])


def test_rank_qcut_keeps_nulls_and_labels(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, None)], "id long, x double")
    got = binning.rank_qcut(df, "x", 2, "id", labels=["low", "high"]).orderBy("id").collect()
    assert [r["bin"] for r in got] == ["low", "high", None]


def test_cut(spark):
    values = [0.0, 18.5, 18.6, 24.9, 100.0, 101.0, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    edges = [0.0, 18.5, 24.9, 100.0]
    got = [r[0] for r in df.select(binning.cut(F.col("x"), edges, list("abc"))).collect()]
    assert got == [None, "a", "b", "b", "c", None, None, None]


def test_result_does_not_depend_on_partitions(table):
    a = exact_quantiles(table.coalesce(1), ["x"], PROBS, few=10)
    assert a == exact_quantiles(table.repartition(13), ["x"], PROBS, few=10)


def test_group_transform(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 4.0), (3, "b", None), (4, None, 5.0)], "id long, g string, x double"
    )
    for how in ("mean", "median"):
        got = binning.group_transform(df, "g", "x", how, "m").orderBy("id").collect()
        assert [r["m"] for r in got] == [2.5, 2.5, None, None]
