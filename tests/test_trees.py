"""Walking node tables against the library's own predictions."""

import numpy as np
import pytest

from cohortica.operators import model, trees


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    return spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, `c d` double, y double")


@pytest.mark.parametrize("fit", [lambda r, f: model.fit_forest(r, f, "y", trees=7), lambda r, f: model.fit_gbt(r, f, "y", rounds=5, depth=3)])
def test_walked_scores_are_the_model_s(rows, fit):
    feats = ["a", "b", "c d"]
    fitted = fit(rows, feats)
    expected = {r.id: r.score for r in model.predict(fitted, rows).collect()}
    got = {r.id: r.score for r in trees.walked_scores(rows, fitted, "id", feats).collect()}
    assert got.keys() == expected.keys()
    assert max(abs(got[k] - expected[k]) for k in got) < 1e-9


def test_stumps_nulls_and_empty_tables(spark):
    nodes = spark.createDataFrame(
        [(0, 0, "a", 1.0, 1, 2, None, 1.0), (0, 1, None, None, None, None, 0.1, 1.0), (0, 2, None, None, None, None, 0.9, 1.0), (3, 0, None, None, None, None, 0.5, 1.0)],
        trees.NODES,
    )
    rows = spark.createDataFrame([(1, 1.0), (2, 1.5), (3, None), (None, 0.0)], "id long, a double")
    got = sorted(map(tuple, trees.walk(rows, nodes, "id", ["a"]).collect()), key=str)
    leaf = {1: (1, 0.1), 2: (2, 0.9), 3: (2, 0.9), None: (1, 0.1)}
    assert got == sorted([(k, 0, *v, 1.0) for k, v in leaf.items()] + [(k, 3, 0, 0.5, 1.0) for k in leaf], key=str)
    assert trees.walk(rows.limit(0), nodes, "id", ["a"]).collect() == []
    assert trees.depth(nodes) == 1
