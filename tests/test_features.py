"""Tables, outliers, missing values, encoders, scalers and models on small cases."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortica.functions import columns as c
from cohortica.operators import encode, missing, model, outliers, profile, relational, scale
from cohortica.plans import features
from cohortica.session import settle, shared_dir
from cohortica.sources.tables import read_groups, read_table, write_audience


def column(df, name, key="id"):
    return [r[name] for r in df.orderBy(key).collect()]


# Sources


def test_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "master_id long")
    path = str(tmp_path / "ids.csv")
    write_audience(df, path)
    assert read_table(spark, path).orderBy("master_id").collect() == [(1,), (2,)]
    groups = read_groups(spark, {"a": path, "b": path}, "master_id long")
    assert relational.tag_union(groups).groupBy("grp").count().orderBy("grp").collect() == [
        ("a", 2),
        ("b", 2),
    ]


def test_nan_is_missing(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.createDataFrame([(1.0,), (math.nan,)], "x double").write.parquet(path)
    assert read_table(spark, path, nan_as_null=True).where("x is null").count() == 1


def test_shared_dir_is_the_context_one(spark):
    settle(spark.range(3))
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


# Expressions


def test_text_features(spark):
    rows = [(1, "Ng, Dr.  Drew"), (2, None), (3, ""), (4, "NoTitle")]
    df = spark.createDataFrame(rows, "id long, name string").select(
        "id",
        c.char_count("name").alias("chars"),
        c.word_count("name").alias("words"),
        c.prefix_count("name", "Dr").alias("dr"),
        c.regex_feature("name", r"([A-Za-z]+)\.").alias("title"),
        c.notnull_flag("name").alias("known"),
    )
    assert df.orderBy("id").collect() == [
        (1, 13, 4, 2, "Dr", 1),
        (2, None, 1, 0, None, 0),
        (3, 0, 1, 0, None, 1),
        (4, 7, 1, 0, None, 1),
    ]


def test_flags_and_labels(spark):
    rows = [(1, 18.0, "Yes"), (2, 18.5, " yes "), (3, None, None), (4, 60.0, "no")]
    df = spark.createDataFrame(rows, "id long, x double, t string")
    got = df.select(
        "id",
        c.range_label("x", [18, 56], ["young", "mature", "senior"]).alias("right"),
        c.range_label("x", [18, 56], ["young", "mature", "senior"], "left").alias("left"),
        c.range_flag("x", 16, 50).alias("flag"),
        c.yes_flag("t").alias("yes"),
        c.count_equal(["t", "t"], "Yes").alias("n"),
        c.flag_in("t", ["no"]).alias("isin"),
        c.ratio("x", F.lit(0.0)).alias("ratio"),
    ).orderBy("id")
    assert got.collect() == [
        (1, "young", "mature", "Normal", 1, 2, 0, None),
        (2, "mature", "mature", "Normal", 1, 0, 0, None),
        (3, None, None, "Abnormal", 0, 0, 0, None),
        (4, "senior", "senior", "Abnormal", 0, 0, 1, None),
    ]


def test_parsing(spark):
    df = spark.createDataFrame([(" 1.5 ", "a"), (" ", None), ("x", "b")], "t string, k string")
    got = df.select(c.to_numeric("t").alias("v"), c.concat_key("k", F.lit(2)).alias("k")).collect()
    assert got == [(1.5, "a_2"), (None, None), (None, "b_2")]
    row = spark.range(1).select(c.from_epoch(F.lit(86461)).cast("string")).first()
    assert row[0] == "1970-01-02 00:01:01"


# Tables


def test_masks_keep_nulls(spark):
    df = spark.createDataFrame([("C1",), ("2",), (None,)], "k string")
    assert relational.drop_cancelled(df, "k").count() == 2
    assert relational.exclude(df, "k", "2").count() == 2
    assert relational.drop_rare_items(df, "k", 2).collect() == [(None,)]


def test_lookup_and_country(spark):
    df = spark.createDataFrame([("1", "b", "x"), ("1", "a", "y")], "k string, name string, country string")
    wanted = spark.createDataFrame([("1",), ("9",)], "k string")
    assert relational.lookup_name(wanted, df, "k", "name").orderBy("k").collect() == [
        ("1", "a"),
        ("9", "not found"),
    ]
    assert relational.attach_country(wanted, df, "k").orderBy("k").collect() == [("1", "x"), ("9", None)]


def test_natural_join_needs_a_shared_column(spark):
    with pytest.raises(ValueError):
        relational.natural_join(spark.range(1), spark.range(1).toDF("x"))


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 4.0, 8.0, np.nan], "y": [3, 1, 2, 5, 4]})
    df = spark.createDataFrame(
        [(None if pd.isna(x) else x, int(y)) for x, y in pdf.itertuples(index=False)], "x double, y long"
    )
    want = pdf.describe()
    for row in profile.describe(df).collect():
        mine = [row["count"], row["mean"], row["std"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]]
        assert mine == pytest.approx(want[row["variable"]].tolist())


def test_ratios_divide_by_all_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "k string, y int")
    got = {r["level"]: r["percent"] for r in relational.cat_summary(df, "k").collect()}
    assert got == {"a": 50.0, "b": 25.0}
    got = {r["level"]: r["ratio"] for r in relational.rare_analysis(df, "y", ["k"]).collect()}
    assert got == {"a": 0.5, "b": 0.25}


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(50, 3)), columns=list("abc"))
    pdf.loc[::7, "a"] = np.nan
    pdf["d"] = 1.0
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.values],
                               "a double, b double, c double, d double")
    want = pdf.corr()
    for r in relational.corr_matrix(df, list("abcd")).collect():
        expected = want.loc[r["a"], r["b"]]
        assert r["corr"] == (None if pd.isna(expected) else pytest.approx(expected))


def test_column_roles(spark):
    df = spark.range(100).select(
        "id",
        (F.col("id") % 9).alias("few"),
        (F.col("id") % 10).alias("ten"),
        (F.col("id") % 20).cast("string").alias("text20"),
        (F.col("id") % 21).cast("string").alias("text21"),
        F.lit(None).cast("double").alias("nothing"),
    )
    roles = profile.grab_col_names(df)
    assert roles.categorical == ["text20", "few", "nothing"] and roles.cardinal == ["text21"]
    assert roles.numeric == ["id", "ten"] and roles.distinct["few"] == 9


def test_zero_and_minus_zero_are_one_level(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert profile.distinct_counts(df, ["x"], 5) == {"x": 1}


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 10)] + [(None,)], "x double")
    got = profile.histogram(df, "x", 2).orderBy("bin").collect()
    assert got == [(0, 0.0, 5.0, 2), (1, 5.0, 10.0, 2)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert profile.histogram(flat, "x", 4).collect()[0]["n"] == 2


# Outliers


def test_fences(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])] + [(9, None)],
                               "id long, x double")
    fences = outliers.outlier_thresholds(df, ["x"])
    assert fences == {"x": (-1.0, 7.0)}
    assert outliers.check_outliers(df, fences).collect() == [("x", True)]
    assert outliers.outlier_summary(df, fences).first()["ratio"] == pytest.approx(1 / 6)
    assert column(outliers.grab_outliers(df, "x", fences["x"]), "x") == [100.0]
    assert column(outliers.remove_outliers(df, fences), "x") == [1.0, 2.0, 3.0, 4.0, None]
    assert column(outliers.clip_outliers(df, fences), "x") == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    # A value on the fence is inside.
    assert outliers.grab_outliers(df, "x", (1.0, 100.0)).count() == 0


def test_fence_rounding(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    # Quartiles .25 and .75: the fence is -0.5 to 1.5; half rounds to even.
    assert outliers.outlier_thresholds(df, ["x"], rounding="round") == {"x": (0.0, 2.0)}
    assert outliers.outlier_thresholds(df, ["x"], rounding="outward") == {"x": (-1.0, 2.0)}


# Missing values


@pytest.fixture(scope="module")
def holes(spark):
    rows = [
        (1, "a", 1.0, "m", None),
        (2, "b", None, "m", None),
        (3, None, 3.0, "f", None),
        (4, "b", 8.0, None, None),
        (5, "a", None, "f", None),
    ]
    return spark.createDataFrame(rows, "id long, k string, x double, sex string, void double")


def test_counting_nulls(holes):
    got = {r["variable"]: (r["n_null"], r["any_null"]) for r in missing.null_counts(holes).collect()}
    assert got == {"id": (0, False), "k": (1, True), "x": (2, True), "sex": (1, True), "void": (5, True)}
    table = missing.missing_table(holes.drop("void")).collect()
    assert table == [("x", 2, 40.0), ("k", 1, 20.0), ("sex", 1, 20.0)]
    assert missing.incomplete_rows(holes.drop("void")).count() == 4
    assert missing.null_total(holes).first()["n_null"] == 9
    pairs = {(r["a"], r["b"]): r["corr"] for r in missing.nullity_corr(holes).collect()}
    assert pairs["k", "x"] == pytest.approx(-0.4082483) and ("x", "void") not in pairs


def test_filling(holes):
    assert column(missing.fill_numeric(holes, ["x"], "mean"), "x") == [1.0, 4.0, 3.0, 8.0, 4.0]
    assert column(missing.fill_numeric(holes, ["x"], "median"), "x") == [1.0, 3.0, 3.0, 8.0, 3.0]
    assert column(missing.fill_numeric(holes, ["x", "void"], "median"), "void") == [None] * 5
    assert column(missing.fill_numeric(holes, ["x"], 0), "x") == [1.0, 0.0, 3.0, 8.0, 0.0]
    # a and b are tied: the smaller one is the mode.
    assert column(missing.fill_categorical(holes), "k") == ["a", "b", "a", "b", "a"]
    assert column(missing.fill_categorical(holes, max_unique=2), "k") == ["a", "b", None, "b", "a"]
    assert column(missing.fill_categorical(holes, "missing"), "sex")[3] == "missing"
    assert column(missing.fill_by_group(holes, "sex", "x", "mean"), "x") == [1.0, 1.0, 3.0, 8.0, 3.0]
    assert column(missing.fill_by_group(holes, "k", "x", "median"), "x") == [1.0, 8.0, 3.0, 8.0, 1.0]


def test_correlated_columns(spark):
    rng = np.random.default_rng(4)
    a, b, d = rng.normal(size=(3, 200))
    rows = [(int(i), float(v), float(w), float(-2 * v + 0.1 * w), float(u), 1) for i, (v, w, u) in enumerate(zip(a, b, d))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double, d double, t long")
    assert missing.correlated_cols(df, "y", "t", 0.25, ["id"]) == ["a"]
    # By sign only, the strongest (negative) column comes last.
    assert missing.correlated_cols(df, "y", "t", 0.25, ["id"], compat=True) != ["a"]


def test_regression_imputation(spark):
    rows = [(i, float(i), float(i * i % 7), 3.0 + 2.0 * i - (i * i % 7)) for i in range(20)]
    rows = [r if r[0] % 5 else (*r[:3], None) for r in rows] + [(20, None, 1.0, None), (21, -50.0, 0.0, None)]
    df = spark.createDataFrame(rows, "id long, u double, v double, y double")
    got = column(missing.regression_impute(df, "y", feats=["u", "v"]), "y")
    assert got[:20] == pytest.approx([3.0 + 2.0 * i - (i * i % 7) for i in range(20)])
    assert got[21] == 0.0  # clipped
    assert got[20] == pytest.approx(np.median([*got[:20], -97.0]))
    alone = missing.regression_impute(df, "y", feats=["u"])
    assert column(alone, "y")[20] == pytest.approx(np.median([r[3] for r in rows if r[3] is not None]))


# Encoders and scalers


def test_label_encoding(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id long, k string")
    assert column(encode.label_encode(df, "k"), "k") == [1, 0, 2, 1]
    assert column(encode._label_encode_wide(df, "k", "k2"), "k2") == [1, 0, 2, 1]
    assert column(encode._label_encode_wide(df, "k", "k"), "k") == [1, 0, 2, 1]
    coded = encode.label_encode(df, "k", "code")
    assert column(encode.label_decode(coded, "code", ["a", "b"], "back"), "back") == ["b", "a", None, "b"]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b", 10), (2, "a", 2), (3, None, 2)], "id long, k string, n long")
    wide = encode.one_hot(df, ["k", "n"], dummy_na=True)
    assert wide.columns == ["id", "k_a", "k_b", "k_nan", "n_2", "n_10", "n_nan"]
    assert [tuple(r)[1:4] for r in wide.orderBy("id").collect()] == [(0, 1, 0), (1, 0, 0), (0, 0, 1)]
    assert encode.one_hot(df, ["k", "n"], drop_first=True).columns == ["id", "k_b", "n_10"]
    want = pd.get_dummies(df.toPandas(), columns=["k"], drop_first=True, dummy_na=True)
    assert set(encode.one_hot(df, ["k"], True, True).columns) == set(want.columns)
    with pytest.raises(ValueError):
        encode.one_hot(df, ["k"], max_levels=1)


def test_rare_levels(spark):
    rows = [(i, "a") for i in range(6)] + [(6, "b"), (7, "b"), (8, "c"), (9, None)]
    df = spark.createDataFrame(rows, "id long, k string")
    got = column(encode.rare_encode(df, ["k"], 0.2), "k")
    assert got == ["a"] * 6 + ["b", "b", "Rare", None]  # b is at the limit and stays


def test_useless_and_binary_columns(spark):
    df = spark.range(300).select(
        "id",
        (F.col("id") == 5).alias("once"),
        (F.col("id") % 2).cast("string").alias("half"),
        F.lit("x").alias("one"),
    )
    assert encode.useless_columns(df) == ["once"]
    assert encode.binary_columns(df) == ["once", "half"]
    assert encode.ohe_columns(df.withColumn("five", F.col("id") % 5)) == ["five"]


def test_scalers(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 7.0, None), (2, 2.0, 7.0, None), (3, 4.0, 7.0, None), (4, None, 7.0, None)],
        "id long, x double, flat double, void double",
    )
    got = scale.standard_scale(df, ["x", "flat", "void"])
    x = np.array(column(got, "x")[:3])
    assert x.mean() == pytest.approx(0) and x.std() == pytest.approx(1)
    assert column(got, "x")[3] is None and column(got, "flat") == [0.0] * 4
    assert column(scale.robust_scale(df, ["x"]), "x")[:3] == pytest.approx([-2 / 3, 0, 4 / 3])
    assert column(scale.minmax_scale(df, ["x", "flat"]), "flat") == [0.0] * 4
    stats = scale.minmax_stats(df, ["x", "flat"])
    back = scale.minmax_inverse(scale.minmax_scale(df, ["x", "flat"], stats), stats)
    assert column(back, "x") == [1.0, 2.0, 4.0, None] and column(back, "flat") == [7.0] * 4


# Models


def test_split_is_repeatable(spark):
    df = spark.range(20_000).withColumnRenamed("id", "key")
    train, test = model.split(df, "key")
    assert train.count() + test.count() == 20_000
    assert test.count() / 20_000 == pytest.approx(0.3, abs=0.02)
    again = model.split(df.repartition(9), "key")[1]
    assert test.exceptAll(again).count() == 0


def pairs(spark, rows):
    return spark.createDataFrame(rows, "truth int, prediction int")


def test_metrics(spark):
    df = pairs(spark, [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4)
    row = model.classification_metrics(df).first()
    assert tuple(row) == pytest.approx((0.7, 0.75, 0.6, 2 / 3))
    assert model.roc_auc(df).first()[0] == pytest.approx((3 / 4 + 4 / 6) / 2)
    none = model.classification_metrics(pairs(spark, [(1, 0), (0, 0)])).first()
    assert tuple(none) == (0.5, 0.0, 0.0, 0.0)
    assert model.roc_auc(pairs(spark, [(1, 1), (1, 0)])).first()[0] is None


def test_auc_of_scores(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 20, 300)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "truth int, score double")
    up, down = s[y == 1], s[y == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in up for b in down])
    assert model.roc_auc_scores(df).first()[0] == pytest.approx(want)


def test_models_learn(spark):
    rows = [(i, float(i % 10), float(i % 7), int(i % 10 > 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    train, test = model.split(df, "id")
    forest = model.fit_forest(train, ["a", "b"], "y", trees=10)
    ranked = model.importances(forest, ["a", "b"]).collect()
    assert ranked[0]["feature"] == "a"
    for fitted in (forest, model.fit_gbt(train, ["a", "b"], "y", rounds=5)):
        scored = model.predict(fitted, test).withColumnRenamed("y", "truth")
        assert model.classification_metrics(scored).first()["accuracy"] > 0.95


def test_training_rows_are_dealt_to_tasks(spark, monkeypatch):
    rows = [(float(i % 10), float(i % 7), int(i % 10 > 4)) for i in range(400)]
    train = spark.createDataFrame(rows, "a double, b double, y int").coalesce(1)
    assert model.spread(train).rdd.getNumPartitions() == 1  # few rows stay as they are
    monkeypatch.setattr(model, "ROWS_A_TASK", 150)
    dealt = model.spread(train)
    assert dealt.rdd.getNumPartitions() == 3 and sorted(dealt.collect()) == sorted(train.collect())
    used = []
    monkeypatch.setattr(model, "spread", lambda df: used.append(df) or dealt)
    forest = model.fit_forest(train, ["a", "b"], "y", trees=10)
    assert used == [train] and forest.stages[-1].getCacheNodeIds()
    assert model.classification_metrics(model.predict(forest, train), "y").first()["accuracy"] == 1.0


def test_feature_table_is_scaled(spark):
    rng = np.random.default_rng(8)
    rows = [
        (
            i,
            ["Doe, Mr. A", "Roe, Mrs. B", "Ng, Dr. D", "Poe C"][i % 4],
            None if i % 6 == 0 else float(rng.integers(1, 80)),
            ["m", "f"][i % 2],
            i % 3 + 1,
            i % 4,
            i % 2,
            float(rng.lognormal(3, 1)),
            None if i % 4 else "C1",
            None if i % 50 == 0 else "SCQ"[i % 3],
            i % 2,
        )
        for i in range(300)
    ]
    df = spark.createDataFrame(
        rows,
        "id long, name string, age double, sex string, pclass long, sibsp long, parch long, "
        "fare double, cabin string, embarked string, survived long",
    )
    got = features.feature_table(df).toPandas()
    assert len(got) == 300 and not {"CABIN", "NAME", "EMBARKED", "NEW_TITLE"} & set(got.columns)
    assert got.FARE.mean() == pytest.approx(0, abs=1e-9) and got.FARE.std(ddof=0) == pytest.approx(1)
    assert set(got.columns) >= {"NEW_TITLE_Mrs", "EMBARKED_Q", "EMBARKED_S", "NEW_IS_ALONE"}


def test_rare_levels_of_a_tiny_share_are_joined(spark):
    rows = [(i, f"v{i % 500}") for i in range(3000)] + [(9000 + i, f"once{i}") for i in range(40)] + [(9999, None)]
    df = spark.createDataFrame(rows, "id long, `a b` string").withColumn("other", F.lit("x"))
    total = len(rows)
    got = encode.rare_encode(df, ["a b", "other"], 2 / total)
    listed = encode.rare_encode(df, ["a b", "other"], 1e-6)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert 1 / (2 / total) > encode.MANY_LEVELS and "v499" not in plan and got.columns == df.columns
    assert {r.id: r["a b"] for r in got.collect()} == {i: v if v is None or v[0] == "v" else "Rare" for i, v in rows}
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, df.collect()), key=lambda r: r[0])
