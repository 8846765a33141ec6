import random

import numpy as np
from helpers import docs_table, edited, odd_rows, prose, with_clashes

from cohortica.llm import decontaminate as dc

ITEMS = [(k, prose(1000 + k, 12 + 7 * (k % 9)) + ". " + prose(2000 + k, 8) + ".") for k in range(60)]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_wand_finds_what_full_scoring_finds():
    index = dc.build_index(ITEMS)
    rng = random.Random(1)
    found = 0
    for k in range(150):
        text = prose(3000 + k, 40) + " " + edited(ITEMS[k % 60][1], rng.random(), k)
        hashes = np.intersect1d(dc._words(text), index.terms)
        query = np.searchsorted(index.terms, hashes)
        score = np.zeros(len(index.owner))
        for t in query:
            docs, impact = index.postings[t]
            score[docs] += impact
        for threshold in (0.2, 0.5, 0.9):
            got = dict(index.search(query, threshold))
            assert set(got) == set(np.flatnonzero(score >= threshold - 1e-9).tolist())
            assert all(abs(score[p] - s) < 1e-9 for p, s in got.items())
            found += len(got)
    assert found > 100


def test_no_window_with_a_candidate_is_passed_over():
    index = dc.build_index(ITEMS)
    texts = [prose(4000 + k, 100) + " " + edited(ITEMS[k % 60][1], k % 7 / 10, k) + " " + prose(5000 + k, 90) for k in range(80)]
    hashes = [dc._words(t) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
    flat = np.concatenate(hashes)
    term = np.minimum(np.searchsorted(index.terms, flat), len(index.terms) - 1)
    known = index.terms[term] == flat
    chosen = {tuple(x) for x in dc.promising(index, term, known, bounds, 0.5).tolist()}
    needed = set()
    for t, h in enumerate(hashes):
        for w, a in enumerate(range(0, max(len(h) - (dc.WINDOW - dc.STEP), 1), dc.STEP)):
            part = slice(bounds[t] + a, bounds[t] + min(a + dc.WINDOW, len(h)))
            if index.search(np.unique(term[part][known[part]]), 0.5):
                needed.add((t, w))
    assert needed and needed <= chosen


def test_planted_items(spark):
    rows = [(k, prose(100 + k, 150), "en", "a", 0) for k in range(60)]
    planted = {}
    for k in range(0, 60, 2):
        item = ITEMS[k]
        text = [item[1], item[1].upper(), item[1].replace(" ", "\n"), edited(item[1], 0.05, k)][k // 2 % 4]
        w = rows[k][1].split()
        rows[k] = (k, " ".join([*w[: k + 1], text, *w[k + 1 :]]), "en", "a", 0)
        planted[k] = item[0]
    docs = with_clashes(docs_table(spark, rows))
    got = dc.contaminated(docs, items(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(planted.items())
    assert all(r.score >= 0.5 and r.question_overlap >= 0.6 and r.answer_overlap >= 0.5 for r in got)
    clean = dc.decontaminated(docs, items(spark))
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == set(range(60)) - set(planted)


def test_question_without_answer_is_no_leak(spark):
    question = ITEMS[3][1].split(". ")[0]
    rows = [(1, prose(1, 80) + " " + question, "en", "a", 0), (2, ITEMS[3][1], "en", "a", 0)]
    assert [r.doc_id for r in dc.contaminated(docs_table(spark, rows), items(spark)).collect()] == [2]


def test_long_items_are_found_by_their_pieces(spark):
    long = [(7, prose(70, 400))]
    rows = [(1, prose(1, 500) + " " + long[0][1] + " " + prose(2, 500), "en", "a", 0), (2, prose(3, 900), "en", "a", 0)]
    assert [(r.doc_id, r.item_id) for r in dc.contaminated(docs_table(spark, rows), items(spark, long)).collect()] == [(1, 7)]


def test_slices_of_the_index(spark, monkeypatch):
    rows = [(k, ITEMS[k][1], "en", "a", 0) for k in range(60)]
    monkeypatch.setattr(dc.slices, "__defaults__", (2_000,))
    got = dc.contaminated(docs_table(spark, rows), items(spark)).collect()
    assert len(list(dc.slices(items(spark), "item_id", "text"))) > 3
    assert {(r.doc_id, r.item_id) for r in got} == {(k, k) for k in range(60)}


def test_awkward_rows(spark):
    odd = odd_rows()
    strange = [(1, None), (2, ""), (None, odd[4][1]), (4, "one"), (5, odd[4][1]), (5, odd[4][1])]
    got = dc.contaminated(with_clashes(docs_table(spark, odd)), items(spark, strange)).collect()
    assert {r.doc_id for r in got if r.item_id == 5} == {5, 6}
    assert len([r for r in got if r.doc_id == 6]) == 2 * 3
    for docs, questions in ((docs_table(spark, []), items(spark)), (docs_table(spark, odd), items(spark, []))):
        assert dc.contaminated(docs, questions).collect() == []
        assert dc.decontaminated(docs, questions).count() == docs.count()
