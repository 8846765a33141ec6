"""The ways taken above the size bounds give the same rows as those taken below them."""

import pytest
from compare import compare, connect

from cohortica import session
from cohortica.checks.all import ORACLES, QUERIES
from cohortica.operators import encode, neighbours, quantiles

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize(
    "name",
    "q_group_transform q_drop_rare_items q_semi_filter q_rank_qcut q_rfm_segments q_shapiro_w "
    "q_levene q_arl_recommend q_overlap_users q_similar_users q_user_based_recommend "
    "q_item_correlations q_knn_impute q_auc_scores".split(),
)
def test_nothing_is_broadcast(spark, con, monkeypatch, name):
    monkeypatch.setattr(session.small_side, "__defaults__", (0,))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(
    "name", "q_qcut q_describe q_outlier_thresholds q_robust_scale q_box_stats".split()
)
def test_quantiles_narrow(spark, con, monkeypatch, name):
    monkeypatch.setattr(quantiles.exact_quantiles, "__defaults__", (50,))
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_levels_stay_in_a_table(spark, con, monkeypatch):
    monkeypatch.setattr(encode, "MANY_LEVELS", 1)
    assert compare(QUERIES["q_label_encode"](spark, SF), con, ORACLES["q_label_encode"]) is None


def test_many_cells_and_blocks(spark, con, monkeypatch):
    monkeypatch.setattr(neighbours.knn_join, "__defaults__", ("key", False, 60, 150))
    assert compare(QUERIES["q_lof"](spark, SF), con, ORACLES["q_lof"]) is None


@pytest.mark.parametrize("limit", [1, 1_000])
def test_label_encode_keeps_the_columns_in_place(spark, monkeypatch, limit):
    monkeypatch.setattr(encode, "MANY_LEVELS", limit)
    df = spark.createDataFrame([(1, "b", 1.0), (2, "a", 2.0), (3, None, 3.0)], "id long, s string, z double")
    got = encode.label_encode(df, "s")
    assert got.dtypes == [("id", "bigint"), ("s", "int"), ("z", "double")]
    assert [r.s for r in got.orderBy("id").collect()] == [1, 0, 2]
    assert encode.label_encode(df, "s", "code").columns == ["id", "s", "z", "code"]


@pytest.mark.parametrize("name", "q_watched q_overlap_users q_similar_users q_rating_table q_drop_rare_items".split())
def test_smallest_tables(spark, name):
    small = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, small), connect(small), ORACLES[name]) is None
