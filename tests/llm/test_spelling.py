import random
import re
import zlib
from collections import Counter

import pytest
from helpers import LOWER, docs_table, odd_rows, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortica.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    """Words and occurrences, by the plain rule."""
    out = Counter()
    for row in rows:
        for run in RUN.findall(row[1] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def expected(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return sorted(out)


def variants(seed, alphabet, n=120):
    """Words with many variants, some of them frequent, in a shuffled text."""
    rng = random.Random(seed)
    words = Counter()
    for _ in range(n):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9)))
        words[word] += rng.choice([5, 6, 30, 200])
        for _ in range(rng.randint(0, 4)):
            p = rng.randrange(len(word) + 1)
            kind = rng.randrange(3)
            other = word[:p] + (rng.choice(alphabet) if kind else "") + word[p + (kind != 1) :]
            words[other] += rng.choice([1, 5, 7, 30])
            word = rng.choice([word, other])
    text = [w for w, k in words.items() for _ in range(k)]
    rng.shuffle(text)
    return text


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("alphabet", ["ab", "abcdeé", "aeioumnrstlé×ÿ"])
def test_variants_equal_brute_force(spark, alphabet):
    text = variants(len(alphabet), alphabet)
    rows = [(k, " ".join(text[k::40]) + ("! " + "abab" * 500 if k == 3 else ""), "en", "a", 0) for k in range(40)]
    assert rows_of(spelling.spelling_variants(docs_table(spark, rows))) == expected(counted(rows))


def test_forms_lead_to_a_root(spark):
    rows = [(1, "motorin " * 5 + "motoring " * 30 + "motorings " * 200, "en", "a", 0)]
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(docs_table(spark, rows)).collect()}
    assert got["motorin"] == ("motoring", "motorings") and got["motorings"] == (None, "motorings")


def test_awkward_rows(spark):
    rows = odd_rows() + [(None, "Straßenfest straßenfest STRAßENFEST", "de", "a", 0)] * 3 + [(77, "xÉcoles " * 9 + "xécoles " * 2000, "fr", "a", 0)]
    got = rows_of(spelling.spelling_variants(with_clashes(docs_table(spark, rows))))
    assert got == expected(counted(rows)) and len(got) > 100


def test_empty_table(spark):
    assert spelling.spelling_variants(docs_table(spark, [])).collect() == []


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs_table(spark, []), least_length=3)


@given(st.lists(st.integers(0, 6), min_size=3, max_size=12))
@settings(max_examples=300, deadline=None)
def test_pivots_are_the_cheapest_two_that_do_not_overlap(ranks):
    places = sorted(spelling.prefix(ranks))
    assert sorted(ranks[p] for p in places)[:3] == sorted(ranks)[:3]
    assert set(places) >= {i for i, r in enumerate(ranks) if r < max(ranks[p] for p in places)}
    chosen = spelling.pivots(ranks, places)
    pairs = [(a, b) for a in places for b in places if b - a >= 2]
    assert tuple(chosen) in pairs
    assert sum(ranks[p] for p in chosen) == min(ranks[a] + ranks[b] for a, b in pairs)


@given(st.text("abé", min_size=4, max_size=9), st.integers(0, 9), st.sampled_from("abcé"), st.integers(0, 2), st.randoms())
@settings(max_examples=500, deadline=None)
def test_near_words_meet_in_the_index(word, at, letter, kind, rng):
    at %= len(word) + 1
    other = word[:at] + (letter if kind else "") + word[at + (kind != 1) :]
    if len(other) < 4 or not one_edit(word, other):
        return
    grams = sorted({w[i : i + 2] for w in (word, other) for i in range(len(w) - 1)})
    rng.shuffle(grams)
    order = {g: k for k, g in enumerate(grams)}

    def sides(w):
        ranks = [order[w[i : i + 2]] for i in range(len(w) - 1)]
        places = spelling.prefix(ranks)
        keys = lambda ps: {k for p in ps for k in ("<" + w[: p + 2], ">" + w[p:])}
        return max(ranks[p] for p in places), keys(spelling.pivots(ranks, places)), keys(places)

    (last, index, probes), (last_2, index_2, probes_2) = sides(word), sides(other)
    if last <= last_2:
        assert index & probes_2
    if last_2 <= last:
        assert index_2 & probes


def test_the_query_equals_its_sql(spark):
    from compare import compare, connect

    from cohortica.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.01"
    name = "op13_pivotal_spelling"
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None
