from helpers import WORD, docs_table, odd_rows, prose, with_clashes
from pyspark.sql import functions as F

from cohortica.llm import quality_rules as q

EXTRA = [
    (20, "a b c d e a b c d e x", "en", "a", 0),
    (21, "a b c d e", "en", "a", 0),
    (22, "x a b c d e\nx a b c d e\n\nx a b c d e \n", "en", "a", 0),
    (23, "bad### words%%% all$$$ over&&& the*** place### here%%% and%%% there### too|", "en", "a", 0),
    (24, "a " * 40, "en", "a", 0),
    (25, prose(25, 300), "en", "a", 0),
    (26, "LOUD!! " + "WORDS!! " * 3 + prose(26, 8).upper().replace(" ", "!! "), "en", "a", 0),
]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {p + k for v in places.values() if len(v) > 1 for p in v for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def test_measurements_against_brute_force(spark):
    rows = odd_rows() + EXTRA
    got = q.ledger(with_clashes(docs_table(spark, rows))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures"
    )
    expected = sorted((r[0] or -1, *brute(r[1])) for r in rows)
    rows_got = sorted((r[0] or -1, *r[1:6]) for r in got.collect())
    assert rows_got == expected


def test_policies_and_kept_rows_agree(spark):
    docs = with_clashes(docs_table(spark, odd_rows() + EXTRA))
    rows = q.ledger(docs)
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows.where(q.passes()).collect())
    assert {r.doc_id for r in kept.collect()} >= {25} and not {20, 23, 24, 26} & {r.doc_id for r in kept.collect()}


def test_ablations_against_recounting(spark):
    rows = q.ledger(docs_table(spark, odd_rows() + EXTRA)).cache()
    failures = [r.failures for r in rows.collect()]
    found = {(r.policy, r.rule): r for r in q.ablations(rows).collect()}
    assert len(found) == sum(map(len, q.POLICIES.values()))
    for (policy, rule), r in found.items():
        bits, bit = q.mask(q.POLICIES[policy]), q.mask((rule,))
        assert r.fail == sum(bool(f & bit) for f in failures)
        assert r.kept == sum(not f & bits for f in failures)
        assert r.kept_without == sum(not f & (bits & ~bit) for f in failures)
        assert r.fail_alone == r.kept_without - r.kept


def test_empty_table(spark):
    docs = docs_table(spark, [])
    assert q.ledger(docs).count() == 0 and q.keep_good(docs).count() == 0
    assert q.ablations(q.ledger(docs)).count() == 0


def test_native_plan(spark):
    plan = q.ledger(docs_table(spark, EXTRA)).where(F.col("failures") == 0)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_filters_stay_above_the_measurements(spark):
    """Else the windows of a text are sorted once for each of its words."""
    docs = docs_table(spark, EXTRA)
    for df in (q.keep_good(docs), q.ledger(docs).where(q.passes())):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("sort_array(transform(sequence") == 1
