"""Neighbour joins against brute force, with cells and blocks far smaller than the data."""

import numpy as np
import pandas as pd
import pytest

from cohortica.operators import neighbours as nb

SMALL = {"cell_rows": 6, "block_rows": 5}


def brute(queries, donors, k, skip_self):
    found = {}
    for q, x in queries:
        near = []
        for d, y in donors:
            if skip_self and q == d:
                continue
            shared = [(a - b) ** 2 for a, b in zip(x, y) if a is not None and b is not None]
            if shared:
                total = sum(shared)
                if len(shared) < len(x):
                    total = total * len(x) / len(shared)
                near.append((float(np.sqrt(total)), d))
        found[q] = sorted(near)[:k]
    return found


def points(n, seed, holes):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = [float(v) for v in rng.integers(0, 12, 3)]
        if i % 3 == 0:
            x = [4.0, 4.0, 4.0]  # a third of the points coincide
        if holes and i % 4 == 1:
            x[i % 3] = None
        rows.append((i, x))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, *x) for i, x in rows], "key long, a double, b double, c double")


@pytest.mark.parametrize("holes", [False, True])
@pytest.mark.parametrize("skip_self", [False, True])
def test_knn_join(spark, holes, skip_self):
    donors = points(90, 1, holes)
    queries = donors if skip_self else points(40, 2, holes)
    got = nb.knn_join(
        frame(spark, queries), frame(spark, donors), ["a", "b", "c"], 4, skip_self=skip_self, **SMALL
    )
    rows = {}
    for r in got.collect():
        rows.setdefault(r["key"], []).append((r["dist"], r["donor"]))
    want = brute(queries, donors, 4, skip_self)
    assert {q: sorted(v) for q, v in rows.items()} == {q: v for q, v in want.items() if v}


def test_fewer_donors_than_k(spark):
    rows = [(1, [0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0])]
    got = nb.knn_join(frame(spark, rows), frame(spark, rows), ["a", "b", "c"], 5).collect()
    assert len(got) == 4
    empty = frame(spark, [])
    assert nb.knn_join(frame(spark, rows), empty, ["a", "b", "c"], 5).count() == 0


def brute_lof(rows, k):
    near = brute(rows, rows, k, True)
    kdist = {q: v[-1][0] for q, v in near.items()}
    lrd = {
        q: 1 / (np.mean([max(kdist[d], dist) for dist, d in v]) + 1e-10) for q, v in near.items()
    }
    return {q: -np.mean([lrd[d] for _, d in v]) / lrd[q] for q, v in near.items()}


def test_lof_with_many_copies(spark):
    rows = points(80, 3, False)
    got = nb.lof(frame(spark, rows), ["a", "b", "c"], "key", 4, **SMALL)
    scores = {r["key"]: r["lof_score"] for r in got.collect()}
    assert scores == pytest.approx(brute_lof(rows, 4), rel=1e-9)
    below = nb.lof_filter(got, 3).count()
    threshold = sorted(scores.values())[3]
    assert below == sum(s < threshold for s in scores.values())
    assert nb.lof_filter(got, 3, outliers=False).count() == len(rows) - below


def test_knn_impute(spark):
    rng = np.random.default_rng(5)
    rows = [
        (
            i,
            None if i % 5 == 0 else float(rng.integers(1, 80)),
            ["f", "m"][i % 2],
            float(rng.integers(0, 4)),
            None if i % 7 == 0 else float(rng.integers(0, 50)),
        )
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "id long, age double, sex string, p double, fare double")
    got = nb.knn_impute(df, "age", ["sex", "p", "fare"], "id", 3, **SMALL).collect()
    pdf = pd.DataFrame(rows, columns=["id", "age", "sex", "p", "fare"])
    x = pd.DataFrame({"p": pdf.p, "fare": pdf.fare, "m": (pdf.sex == "m").astype(float)})
    x = (x - x.min()) / (x.max() - x.min())
    cells = [(i, [None if pd.isna(v) else v for v in r]) for i, r in enumerate(x.values.tolist())]
    known = [c for c in cells if not pd.isna(pdf.age[c[0]])]
    near = brute(cells, known, 3, False)
    for r in got:
        if pd.isna(pdf.age[r["id"]]):
            want = np.mean([pdf.age[d] for _, d in near[r["id"]]])
        else:
            want = pdf.age[r["id"]]
        assert r["age"] == pytest.approx(want, rel=1e-9)


def test_knn_impute_without_shared_features(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 1.0), (2, 20.0, 2.0), (3, None, None)], "id long, age double, p double"
    )
    got = nb.knn_impute(df, "age", ["p"], "id", 1).orderBy("id").collect()
    assert [r["age"] for r in got] == [10.0, 20.0, 15.0]


def test_eight_correlated_columns_meet_few_cells(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 1)) + 0.05 * rng.normal(size=(3000, 8))
    names = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "key long, " + ", ".join(f"{n} double" for n in names))
    met, nearest = [], nb._nearest

    def counted(queries, placed, sizes, *rest):
        met.append((queries.count(), sizes.count()))
        return nearest(queries, placed, sizes, *rest)

    monkeypatch.setattr(nb, "_nearest", counted)
    monkeypatch.setattr(nb, "HALVINGS", 3)  # a tree of several levels
    got = nb.knn_join(df, df, names, 5, skip_self=True, cell_rows=30).toPandas()
    cells = met[0][1]
    assert cells >= 100 and sum(n for n, _ in met) < 0.25 * cells * 3000  # cells met by all queries together
    some = rng.choice(3000, 40, replace=False)
    for q in some.tolist():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert sorted(got[got.key == q].donor) == sorted(np.argsort(d, kind="stable")[:5].tolist())


def test_cells_hold_few_donors_unless_they_are_one_point(spark):
    rows = points(400, 5, True)
    placed, levels = nb.cell_tree(frame(spark, rows), ["a", "b", "c"], "key", 8)
    sizes = placed.groupBy("_cell", "a", "b", "c").count().groupBy("_cell").agg({"count": "sum", "*": "count"}).toDF("cell", "n", "points").collect()
    assert sum(r.n for r in sizes) == 400 and all(r.n <= 8 or r.points == 1 for r in sizes)
    assert sum(level.where("_leaf").count() for level in levels) == len(sizes)
