import zlib

import numpy as np
import pyarrow as pa
from helpers import docs_table, odd_rows, prose, with_clashes

from cohortica.llm import quality_model as qm
from cohortica.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def walk(trees, row):
    """One row through the trees, node by node."""
    out = trees.start
    for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        out += value[node - len(feature)]
    return out


def test_flat_traversal_and_learning():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] < -0.5)).astype(float)
    trees = qm.fit_trees(x[:2000], y[:2000])
    assert np.allclose(trees.raw(x[:50]), [walk(trees, r) for r in x[:50]])
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_one_class_or_no_rows():
    assert qm.fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert qm.fit_trees(np.ones((4, 3)), np.ones(4)).score(np.zeros((1, 3)))[0] > 0.99


def test_statistics_of_single_texts_do_not_depend_on_neighbours():
    texts = pa.array([r[1] for r in odd_rows()] + ["a b\nA b\n\nlast line!!", "x | y | z"])
    alone = [qm.statistics(w, w.text_offsets) for t in texts for w in qm.word_reader.pieces(pa.array([t.as_py()], pa.string()))]
    (all_words,) = qm.word_reader.pieces(texts)
    together = qm.statistics(all_words, all_words.text_offsets)
    assert np.allclose(np.vstack(alone), together) and np.isfinite(together).all()
    last = dict(zip(qm.FEATURES, together[-1], strict=True))
    assert last["bars"] == 2 / 5 and last["distinct_words"] == 4 / 5


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_boosted_quality"](spark, SF).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in tested) / len(tested) > 0.95


def test_held_out_labels_do_not_matter(spark):
    rows = [(k, ("!! " if k % 2 else "") + prose(k, 30), "en", "a", 0) for k in range(200)]
    docs = docs_table(spark, rows)
    labels = [(k, 1 - k % 2) for k in range(200)]
    spoilt = [(k, q if zlib.crc32(str(k).encode()) % 5 else 1 - q) for k, q in labels]
    score = [
        sorted(qm.quality_scores(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect())
        for x in (labels, spoilt)
    ]
    assert score[0] == score[1]


def test_awkward_rows(spark):
    docs = with_clashes(docs_table(spark, odd_rows()))
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, None), (None, 1), (9, 1), (9, 1)], "doc_id long, quality int")
    got = qm.quality_scores(docs, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in qm.quality_scores(docs, none).collect()} == {0.5}
    assert qm.quality_scores(docs_table(spark, []), labels).collect() == []


def test_the_bound_on_labelled_rows(spark):
    stats = qm.document_statistics(docs_table(spark, [(k, prose(k, 5), "en", "a", 0) for k in range(300)])).cache()
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int")
    assert len(qm.fit_quality(stats, labels, rows=50).feature) == qm.ROUNDS
