"""Stages of the corpus pipeline against plain Python, each on its own input."""

import pytest
from helpers import prose, with_clashes, words
from test_near_duplicates import brute
from test_quality_rules import brute as measured

import corpus_pipeline

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((name, before, docs))
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [s[0] for s in stages] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "token_files"]
    for _, before, _ in stages:
        assert before.columns == COLUMNS


def test_quality_rules(stages):
    _, before, after = stages[0]
    kept = rows(after)
    for doc, text in rows(before).items():
        n, chars, symbols, _, repeats = measured(text)
        if n < 10 or 100 * repeats > 20 * n or 100 * symbols > 15 * n:
            assert doc not in kept
    clean = {
        r.doc_id for r in before.sparkSession.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()
    }
    lost = [d for d in clean if d not in kept and not measured(rows(before)[d])[0] < 10]
    assert len(lost) <= 0.03 * len(clean)


def test_near_duplicates(stages):
    _, before, after = stages[1]
    expected = {r[0] for r in brute([(d, t) for d, t in rows(before).items()], 5) if r[3]}
    assert set(rows(after)) == expected


def test_decontamination(spark, stages):
    _, before, after = stages[2]

    def grams(text):
        found = words(text)
        return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}

    items = [grams(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = rows(after)
    for doc, text in rows(before).items():
        own = grams(text)
        held = max(len(g & own) / len(g) for g in items)
        assert (doc in kept) == (held < 0.5), (doc, held)


def test_mixing(spark, stages):
    _, before, after = stages[3]
    kept, labels = rows(after), {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [d for d in rows(before) if d in labels]
    toxic = [d for d in judged if labels[d].toxic]
    clean = [d for d in judged if labels[d].quality and not labels[d].toxic]
    assert sum(d in kept for d in toxic) <= 0.2 * len(toxic)
    assert sum(d in kept for d in clean) >= 0.95 * len(clean)


def test_token_files(stages):
    _, before, after = stages[4]
    ids = sorted(r.doc_id for r in before.collect())
    got = sorted(after.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == ids
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_run_is_the_stages_in_order(spark, stages):
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_no_documents_and_awkward_rows(spark):
    from helpers import docs_table, odd_rows

    for made in ([], [*odd_rows(), (30, prose(30, 100), "en", "a", 0)]):
        docs = with_clashes(docs_table(spark, made)) if made else docs_table(spark, made)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= 2 * len(made)
