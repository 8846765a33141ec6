"""One-pass correlations against numpy, and how many jobs they take."""

import numpy as np
import pandas as pd
import pytest

from cohortica.operators import relational
from cohortica.operators.moments import Moments, co_moments


def jobs(spark, run):
    """The jobs that a call starts."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        run()
    finally:
        context.setJobGroup("other", "other")
    return len(context.statusTracker().getJobIdsForGroup("counted"))


def table(seed=1, n=500, width=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(1e6, 1.0, (n, width)) + rng.normal(size=(n, 1))
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 2] = np.where(np.isnan(x[:, 2]), np.nan, 7.25)
    x[:, 3] = np.nan
    x[: n - 1, 4] = np.nan
    return x


def test_merged_parts_are_the_whole():
    x = table()
    whole, parts = Moments.of(x), Moments.empty(x.shape[1])
    for part in np.array_split(x, 7):
        parts = parts.merged(Moments.of(part))
    for a, b in zip((whole.n, whole.mean, whole.square, whole.product), (parts.n, parts.mean, parts.square, parts.product)):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-6)
    assert np.array_equal(Moments.unpacked(whole.packed(), 6).mean, whole.mean)


def test_correlations_equal_pandas(spark):
    x = table()
    names = [f"c {i}" for i in range(x.shape[1])]
    frame = pd.DataFrame(x, columns=names)
    rows = [tuple(None if v != v else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)).repartition(5)
    want = frame.corr(min_periods=2)
    for r in relational.corr_matrix(df, names).collect():
        expected = want.loc[r.a, r.b]
        if r.corr is None:
            assert expected != expected or frame[r.a].nunique() < 2 or frame[r.b].nunique() < 2
        else:
            assert r.corr == pytest.approx(expected, abs=1e-8)


def test_no_rows_no_columns(spark):
    df = spark.createDataFrame([], "a double, b long")
    assert [r.corr for r in relational.corr_matrix(df, ["a", "b"]).collect()] == [None] * 4
    assert relational.corr_pairs(df, []) == {}


def test_one_pass_for_three_hundred_columns(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 300))
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(300)]))
    found = {}
    count = jobs(spark, lambda: found.update(m=co_moments(df, df.columns)))
    assert count <= 4  # one for each exchange under adaptive execution, and the result
    assert np.allclose(found["m"].correlation(), np.corrcoef(x.T), atol=1e-9)
