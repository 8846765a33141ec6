import numpy as np
import pyarrow as pa
from helpers import odd_rows, prose, words

from cohortica.llm.words import WordReader, windows

TEXTS = [r[1] for r in odd_rows()] + [prose(k, 50) for k in range(20)]


def test_words_and_hashes():
    reader, seen, n = WordReader(), {}, 0
    for size in (1, 100, 1 << 20):
        for w in reader.pieces(pa.array(TEXTS, pa.string()), size):
            for k in range(len(w)):
                a, b = w.bounds[k], w.bounds[k + 1]
                own = [bytes(w.data[s:e]).decode() for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)]
                expected = words(TEXTS[w.first + k])
                assert len(own) == len(expected)
                for text, h in zip(expected, w.hashes[a:b].tolist(), strict=True):
                    assert seen.setdefault(h, text) == text
                    n += 1
    assert len(set(seen.values())) == len(seen) and n > 1000


def test_windows_stay_inside_a_text():
    reader = WordReader()
    (w,) = reader.pieces(pa.array(["a b c d", "", "a b", "b c d e f"]))
    grams, bounds = windows(w.hashes, w.bounds, 3)
    assert np.diff(bounds).tolist() == [2, 0, 0, 3] and len(grams) == 5
    assert grams[1] == grams[2] and len(set(grams.tolist())) == 4


def test_accents_fold_on_request():
    (a,) = WordReader(latin=True).pieces(pa.array(["ÉTÉ É×", "été é×"]))
    assert a.hashes[:2].tolist() == a.hashes[2:].tolist()
    (b,) = WordReader().pieces(pa.array(["ÉTÉ", "été"]))
    assert b.hashes[0] != b.hashes[1]


def test_no_rows():
    assert list(WordReader().pieces(pa.array([], pa.string()))) == []
