import numpy as np
import pytest
from helpers import docs_table, edited, odd_rows, prose, with_clashes, words

from cohortica.llm import near_duplicates as nd
from cohortica.llm.components import UnionFind, components


def shingles(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n):
    sets = {}
    for doc, text, *_ in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingles(text, n))
    found = UnionFind()
    flat = [(d, s) for d, own in sets.items() for s in own if s]
    for k, (a, s) in enumerate(flat):
        for b, t in flat[:k]:
            both = len(s & t)
            if 100 * both >= 80 * (len(s) + len(t) - both):
                found.union(a, b)
    return sorted(
        (d, len(shingles(t, n)), d if d is None else found.find(d), d is None or found.find(d) == d)
        for d, t, *_ in rows
        if d is not None
    )


def family(first, size, share):
    """Near copies of one text, edited so that some pairs are links and some are not."""
    text = prose(first, 150)
    return [(first + k, edited(text, share * k / size, first + k) if k else text, "en", "a", 0) for k in range(size)]


CASES = {
    "families": family(100, 30, 0.06) + family(200, 20, 0.02) + [(k, prose(k, 60), "en", "a", 0) for k in range(300, 330)],
    "copies": [(k, prose(k % 3, 100), "en", "a", 0) for k in range(60)] + [(90, "A b c", "en", "a", 0), (91, "a B c", "en", "a", 0)],
    "odd": [r for r in odd_rows() if r[0] is not None],
    "one id, two texts": [(1, prose(1), "en", "a", 0), (1, prose(2), "en", "a", 0), (2, prose(1), "en", "a", 0), (3, prose(2), "en", "a", 0)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block", [256, 4])
def test_against_all_pairs(spark, monkeypatch, name, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    if block == 4 and name != "families":
        return
    rows = CASES[name]
    for n in (4, 5) if name == "families" and block == 256 else (4,):
        got = nd.near_duplicates(with_clashes(docs_table(spark, rows)), shingle=n)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, n)


def test_open_pairs_are_needed(spark):
    """The first member of a bucket is not similar enough to the others, which are linked."""
    text = prose(7, 200).split()
    tail = [f"w{k}" for k in range(30)]
    rows = [(1, " ".join(text), "en", "a", 0)] + [
        (k, " ".join(text[:165] + tail + [f"own{k}"]), "en", "a", 0) for k in range(2, 12)
    ]
    assert sorted(tuple(r) for r in nd.near_duplicates(docs_table(spark, rows), 4).collect()) == brute(rows, 4)


def test_null_ids_and_no_rows(spark):
    rows = [(None, prose(1), "en", "a", 0), (None, prose(1), "en", "a", 0), (5, prose(1), "en", "a", 0), (6, prose(1), "en", "a", 0)]
    docs = with_clashes(docs_table(spark, rows))
    got = {(r.doc_id, r.component_id, r.kept) for r in nd.near_duplicates(docs).collect() if r.doc_id}
    assert got == {(5, 5, True), (6, 5, False)}
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 5]
    assert nd.near_duplicates(docs_table(spark, [])).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    error = []
    for size in (3, 40, 400, 3000):
        for share in (0.2, 0.5, 0.8):
            both = int(size * share)
            common = rng.integers(0, 1 << 63, both, dtype=np.uint64)
            own = [np.concatenate([common, rng.integers(0, 1 << 63, size - both, dtype=np.uint64)]) for _ in range(2)]
            sig = nd.superminhash(np.concatenate(own), np.array([0, size, 2 * size]))
            error.append((sig[0] == sig[1]).mean() - both / (2 * size - both))
    assert max(map(abs, error)) < 0.12 and abs(np.mean(error)) < 0.03


def test_signature_of_a_set_stands_alone():
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 0, 7, 2000, 90)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    together = nd.superminhash(np.concatenate(sets), bounds)
    for k, s in enumerate(sets):
        assert (together[k] == nd.superminhash(s[::-1], np.array([0, len(s)]))[0]).all()
    # Every slot is taken, by a different draw of the one element.
    assert len(set(together[0].tolist())) == nd.SLOTS and (together[0] >> np.uint64(32)).max() == nd.SLOTS - 1


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(k, k + 1) for k in range(0, 400)] + [(1000, k) for k in range(1001, 1300)] + rng.integers(2000, 2600, (300, 2)).tolist()
    found = UnionFind()
    for a, b in edges:
        found.union(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: found.find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
