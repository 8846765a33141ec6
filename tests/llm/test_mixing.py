import numpy as np
import pytest
from helpers import docs_table, odd_rows, prose, with_clashes

from cohortica.llm import mixing as mx

NAMES = tuple(mx.DOMAINS)


def memberships(spark, n=400, seed=2):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.3, 0.3, 0.3], n)
    tokens = rng.integers(0, 900, n)
    rows = [(k, int(tokens[k]), *map(float, p[k])) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, tokens long, " + ", ".join(f"p_{x} double" for x in NAMES)), p, tokens


def test_expected_tokens_come_to_the_targets(spark):
    table, p, tokens = memberships(spark)
    targets = {"toxic": 0.1, "good": 0.6, "poor": 0.3}
    mix = mx.fit_rates(table, targets, epochs=0.8)
    rate = np.array([r[0] for r in table.orderBy("doc_id").select(mix.rate()).collect()])
    reached = (tokens * rate) @ p
    wanted = np.array([mix.targets[n] for n in NAMES])
    assert mix.converged and (rate >= 0).all()
    assert np.allclose(wanted / wanted.sum(), [targets[n] for n in NAMES])
    assert np.abs(reached - wanted).max() < 1e-3 * wanted.sum()
    assert np.allclose(reached, [mix.reached[n] for n in NAMES])


def solved(p, tokens, wanted, most, press=mx.PRESS):
    """The same objective by plain projected gradient over the rates, with exact line steps in numpy."""
    w, r = tokens / tokens.sum(), np.ones(len(p))
    y = np.zeros(p.shape[1])
    step = 1 / (1 / press + np.linalg.eigvalsh((p * w[:, None]).T @ p).max())
    for _ in range(200_000):  # gradient ascent on the dual, one number per domain
        r = np.clip(1 + p @ y, 0, most)
        y = y - step * (y / press + p.T @ (w * r) - wanted)
    return np.clip(1 + p @ y, 0, most)


@pytest.mark.parametrize("targets", [{"toxic": 0.15, "good": 0.65, "poor": 0.2}, {"toxic": 0.1, "good": 0.35, "poor": 0.55}])
def test_rates_equal_a_plain_solver(spark, targets):
    table, p, tokens = memberships(spark, 60, 3)
    mix = mx.fit_rates(table, targets, tolerance=1e-9, steps=200, most_push=50)
    got = np.array([r[0] for r in table.orderBy("doc_id").select(mix.rate()).collect()])
    wanted = np.array([mix.targets[n] for n in NAMES]) / tokens.sum()
    assert mix.converged and np.abs(got - solved(p, tokens, wanted, mx.MOST_RATE)).max() < 0.02


def test_a_mix_that_cannot_be_met_is_the_nearest_one(spark):
    table, p, tokens = memberships(spark, 60, 3)
    mix = mx.fit_rates(table, {"toxic": 0.0, "good": 0.9, "poor": 0.1}, tolerance=1e-9, steps=200, most_push=1e9)
    rate = np.clip(1 + p @ np.array(mix.slope), 0, mx.MOST_RATE)
    miss = (p.T @ (tokens * rate) - [mix.targets[n] for n in NAMES]) / tokens.sum()
    assert mix.converged and not mix.feasible
    assert np.allclose(mix.slope, -mx.PRESS * miss, atol=0.01 * np.abs(mix.slope).max())  # no rate can move
    soft = mx.fit_rates(table, {"toxic": 0.0, "good": 0.9, "poor": 0.1})
    assert soft.converged and min(soft.slope) == -mx.MOST_PUSH


def test_equal_memberships_have_equal_rates_and_good_ones_stay_together(spark):
    rng = np.random.default_rng(9)
    p = np.repeat([[0.01, 0.98, 0.01], [0.9, 0.05, 0.05], [0.02, 0.08, 0.9]], [600, 30, 120], axis=0)
    p = np.abs(p + rng.normal(0, 0.003, p.shape))
    p /= p.sum(1, keepdims=True)
    rows = [(k, int(t), *map(float, x)) for k, (t, x) in enumerate(zip(rng.integers(5, 3000, len(p)), p, strict=True))]
    table = spark.createDataFrame(rows, "doc_id long, tokens long, " + ", ".join(f"p_{x} double" for x in NAMES))
    for targets, feasible in ((mx.TARGETS, False), ({"toxic": 0.02, "good": 0.9, "poor": 0.08}, True)):
        mix = mx.fit_rates(table, targets)
        got = np.array([r[0] for r in table.orderBy("doc_id").select(mix.rate()).collect()])
        assert mix.converged and mix.feasible == feasible
        assert np.abs(got[:600] / got[:600].mean() - 1).max() < 0.05 and abs(got[:600].mean() - 1) < 0.1
        assert got[600:630].max() < 0.7 and got.max() < mx.MOST_RATE


def test_a_limited_domain_is_lowered_but_not_raised(spark):
    table, _, _ = memberships(spark)
    high = mx.fit_rates(table, {"toxic": 0.01, "good": 0.49, "poor": 0.5}, limited=["toxic"], most_push=50)
    assert high.feasible and high.targets["toxic"] < 0.1 * high.expected["toxic"]
    rare = mx.fit_rates(table, {"toxic": 0.98, "good": 0.01, "poor": 0.01}, limited=["toxic"])
    assert rare.targets["toxic"] == rare.expected["toxic"]


def test_unreachable_targets_are_reported(spark):
    table, _, _ = memberships(spark, 60, 3)
    mix = mx.fit_rates(table, {"toxic": 0.0, "good": 0.9, "poor": 0.1}, steps=1, tolerance=1e-12)
    assert not mix.converged
    with pytest.raises(ValueError):
        mx.fit_rates(table, {"toxic": 0.5, "good": 0.0, "poor": 0.5})


def corpus(spark):
    rows, labels = [], []
    for k in range(300):
        kind = k % 3
        text = prose(k, 60)
        if kind == 1:
            text = " ".join(w + "###" for w in text.split())
        if kind == 2:
            words = text.split()
            words[5:40:7] = ["vile", "rotten", "vile", "rotten", "vile"]
            text = " ".join(words)
        rows.append((k, text, "en", "a", 0))
        if k % 10 < 6:
            labels.append((k, int(kind != 1), int(kind == 2)))
    return docs_table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_domains_are_learnt_and_mixed(spark):
    docs, labels = corpus(spark)
    docs = with_clashes(docs)
    got = mx.mixed_rates(docs, labels).collect()
    assert len(got) == 300
    for kind, name in enumerate(("good", "poor", "toxic")):
        own = [r for r in got if r.doc_id % 3 == kind]
        assert np.mean([r[f"p_{name}"] > 0.5 for r in own]) > 0.95
        assert all(r.tokens == 60 and abs(r.copies - r.rate) < 1 for r in own)
    rate = [np.mean([r.rate for r in got if r.doc_id % 3 == k]) for k in range(3)]
    assert 1 <= rate[0] < 1.1 and rate[1] < 0.5 and rate[2] < 0.2
    good = [r.rate for r in got if r.doc_id % 3 == 0 and r.p_good > 0.95]
    assert len(good) > 90 and max(good) < 1.05 * np.mean(good) and min(good) > 0.95 * np.mean(good)
    mixed = mx.mixed_documents(docs, labels, nearest=True)
    assert mixed.columns == docs.columns
    ids = [r.doc_id for r in mixed.collect()]
    assert sorted(ids) == sorted(r.doc_id for r in got for _ in range(r.copies))


def test_awkward_rows(spark):
    docs = with_clashes(docs_table(spark, odd_rows()))
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 0, 0), (5, 1, 0), (6, None, None), (None, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int"
    )
    got = mx.mixed_rates(docs, labels).collect()
    assert len(got) == len(odd_rows()) and all(r.rate >= 0 for r in got)
    assert {r.doc_id: r.domain for r in mx.labelled_domains(labels).collect()} == {1: 1, 5: 1, 9: 0}
    none = labels.limit(0)
    same = mx.mixed_rates(docs, none).collect()
    assert all(abs(r[f"p_{n}"] - 1 / 3) < 1e-6 for r in same for n in NAMES)
    assert all(r.rate == r.copies == 1 and not r.feasible for r in same)
    with pytest.raises(ValueError):
        mx.mixed_documents(docs, none)
    assert sorted(map(str, mx.mixed_documents(docs, none, nearest=True).collect())) == sorted(map(str, docs.collect()))
    assert mx.mixed_rates(docs_table(spark, []), labels).collect() == []


def test_a_scarce_domain_keeps_its_share(spark):
    rng = np.random.default_rng(4)
    p = np.column_stack([rng.dirichlet([0.2, 0.2], 400), np.zeros(400)])
    p[:4] = [0, 0, 1]  # 1 % of the documents for a tenth of the tokens
    rows = [(k, 100, *map(float, x)) for k, x in enumerate(p)]
    table = spark.createDataFrame(rows, "doc_id long, tokens long, " + ", ".join(f"p_{x} double" for x in NAMES))
    targets = {"toxic": 0.3, "good": 0.6, "poor": 0.1}
    mix = mx.fit_rates(table, targets)
    total = sum(mix.reached.values())
    assert mix.converged and not mix.feasible
    assert all(abs(mix.reached[n] / total - targets[n]) < 1e-3 for n in NAMES)
    assert mix.targets["poor"] <= mx.MOST_REPEATS * mix.expected["poor"] * (1 + 1e-9)
    assert mx.fit_rates(table, {"toxic": 0.4, "good": 0.59, "poor": 0.01}).feasible


def test_the_mix_says_what_it_wanted_and_reached(spark):
    docs, labels = corpus(spark)
    got = mx.mixed_rates(docs, labels).first().asDict()
    total = sum(got[f"target_{n}"] for n in NAMES)
    assert all(abs(got[f"target_{n}"] / total - mx.TARGETS[n]) < 1e-9 for n in NAMES)
    miss = max(abs(got[f"reached_{n}"] - got[f"target_{n}"]) for n in NAMES)
    assert got["feasible"] == (miss <= mx.MISS * total)
    no_poor = mx.mixed_rates(docs, labels.where("quality = 1 or toxic = 1")).first()
    assert not no_poor.feasible and no_poor.reached_good > 0


def test_rows_that_share_an_id_are_taken_by_their_own_text(spark):
    docs, labels = corpus(spark)
    more = docs_table(spark, [(1, prose(501, 60), "en", "a", 0), (None, prose(502, 60), "en", "a", 0), (None, None, None, None, None)] * 2)
    both = docs.union(more)
    got = mx.mixed_rates(both, labels).collect()
    want = [(r.doc_id, r.mark) for r in got for _ in range(r.copies)]
    import hashlib

    mark = lambda t: None if t is None else hashlib.md5(t.encode()).hexdigest()
    mixed = [(r.doc_id, mark(r.text)) for r in mx.mixed_documents(both, labels, nearest=True).collect()]
    assert sorted(mixed, key=str) == sorted(want, key=str)
