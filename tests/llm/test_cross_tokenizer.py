import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import docs_table, odd_rows, prose, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortica.llm import cross_tokenizer as ct
from cohortica.llm.files import new_folder

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BYTE_LEVEL = Tokenizer.from_file(A)
BYTE_LEVEL.encode_special_tokens = True
ENCODE = ct.byte_level(A)
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)


def spans(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends], ends, strict=False))


def one(text):
    """Tokens, groups and links of a text by comparing all byte ranges."""
    if not text:
        return None
    a = BYTE_LEVEL.encode(" " + text, add_special_tokens=False).ids
    letters = ct.byte_letters()
    bytes_a = [bytes(letters[c] for c in BYTE_LEVEL.id_to_token(i)) for i in a]
    b = PIECES.encode(text)
    piece = lambda i: bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i) else PIECES.id_to_piece(i).replace("▁", " ").encode()
    bytes_b = [piece(i) for i in b]
    if b"".join(bytes_a) != b"".join(bytes_b) or b"".join(bytes_a) != b" " + text.encode():
        return None
    at_a, at_b = spans(list(map(len, bytes_a))), spans(list(map(len, bytes_b)))
    shared = sorted({e for _, e in at_a} & {e for _, e in at_b})
    groups, low = [], 0
    for high in shared:
        side = lambda ids, at, lo=low, hi=high: ",".join(str(i) for i, (s, e) in zip(ids, at, strict=True) if s >= lo and e <= hi)
        groups.append(f"{side(a, at_a)}|{side(b, at_b)}")
        low = high
    links = []
    for i, (s, e) in zip(a, at_a, strict=True):
        links += [(i, j) for j, (t, f) in zip(b, at_b, strict=True) if s < f and t < e]
    return len(a), len(b), groups, links


def expected(rows):
    found = [(r[0], one(r[1])) for r in rows]
    count = Counter(x for _, f in found if f for x in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for doc, f in found:
        if not f:
            out.append((doc, 0, 0, 0, 0, "", 0, 0))
            continue
        digest = hashlib.sha256(";".join(f[2]).encode()).hexdigest()
        best = sum(count[x] == most[x[0]] for x in f[3])
        out.append((doc, f[0], f[1], len(f[2]), len(f[3]), digest, best, sum(count[x] for x in f[3])))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()), key=str)


ODD = "it's  two  blanks\n\nand\ttabs 12345 67.5% naïve Ünï東京🙂 <|endoftext|> </s> <0x41> ▁mark á ﬁ  x​ y\x1cz "


def test_alignments_equal_all_pairs_of_byte_ranges(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(k, prose(k % 7, 60) + " " + "".join(rng.choice(ODD) for _ in range(80)), "en", "a", 0) for k in range(40)]
    rows += [(100 + k, word, "en", "a", 0) for k, word in enumerate(ODD.split(" "))] + [(900, ODD, "en", "a", 0), (901, " lead", "en", "a", 0), (902, "trail ", "en", "a", 0)]
    want = expected(rows)
    assert sum(r[1] > 0 for r in want) > 25
    assert rows_of(ct.aligned_table(docs_table(spark, rows), A, B)) == want


def test_awkward_rows(spark):
    rows = [r for r in odd_rows() if r[0] != 9] + [(9, prose(9, 2500), "en", "c", 0), (10, "x" * 3000, "en", "c", 0)]
    assert rows_of(ct.aligned_table(with_clashes(docs_table(spark, rows)), A, B)) == expected(rows)


def test_alignments_are_the_same_however_texts_are_taken():
    texts = [prose(k, 60) for k in range(4)] + ["", ODD]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
    code = ct.Aligner(A, B)
    whole = code.align(data, offsets)
    assert whole.groups.to_pylist() == [";".join((one(t) or [0, 0, []])[2]) for t in texts]
    for k, (x, y) in enumerate(zip(offsets, offsets[1:], strict=False)):
        alone = code.align(data[x:y], np.array([0, y - x]))
        assert alone.groups.to_pylist() == whole.groups.to_pylist()[k : k + 1]
        assert alone.links.tolist() == whole.links[whole.link_bounds[k] : whole.link_bounds[k + 1]].tolist()


@given(st.text(max_size=40) | st.text("aB'é.,!? \n <|>sit0", max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_are_those_of_the_file_s_own_library(text):
    assert ENCODE([text, "<|endoftext|>" + text]) == [
        e.ids for e in BYTE_LEVEL.encode_batch([text, "<|endoftext|>" + text], add_special_tokens=False)
    ]


def test_counts_in_many_files(spark, monkeypatch):
    monkeypatch.setattr(ct, "OPEN_FILES", 2)
    rows = [(k, prose(k, 40), "en", "a", 0) for k in range(12)]
    table = ct.align_documents(docs_table(spark, rows), A, B)
    counts = ct.link_counts(table, PIECES.get_piece_size())
    files = ct.write_counts(counts, new_folder(spark, "test"), parts=5)
    assert len(files.parts) == 5
    got = {r.doc_id: (r.n_best, r.count_sum) for r in ct.with_counts(table, files).collect()}
    assert got == {r[0]: (r[6], r[7]) for r in expected(rows)}


def test_links_are_counted_few_at_a_time(spark, monkeypatch):
    whole, repeat = ct._pieces, np.repeat

    def few(texts, size):
        assert len(texts) <= 1000
        return whole(texts, size)

    def texts_of(values, counts):
        assert counts.sum() <= max(50, counts.max() if len(counts) == 1 else 0)
        return repeat(values, counts)

    class Numpy:
        def __getattr__(self, name):
            return texts_of if name == "repeat" else getattr(np, name)

    rows = [(k, f"word {k}", "en", "a", 0) for k in range(1500)] + [(2000 + k, prose(k, 60 * k), "en", "a", 0) for k in range(4)]
    table = ct.align_documents(docs_table(spark, rows).coalesce(1), A, B)
    files = ct.write_counts(ct.link_counts(table, PIECES.get_piece_size()), new_folder(spark, "test"))
    with monkeypatch.context() as m:
        m.setattr(ct, "LOOKED_UP", 50)
        m.setattr(ct, "np", Numpy())
        got = {r.doc_id: (r.n_best, r.count_sum) for r in ct.with_counts(table, files).collect()}
    want = expected(rows)
    assert got == {r[0]: (r[6], r[7]) for r in want}
    monkeypatch.setattr(ct, "_pieces", few)
    made = ct.aligned_table(docs_table(spark, rows).coalesce(1), A, B)
    assert rows_of(made) == want
    assert "MapInArrow" not in made._jdf.queryExecution().executedPlan().toString()  # settled, few rows at a time


def test_empty_table_and_other_tokenizers(spark):
    assert ct.aligned_table(docs_table(spark, []), A, B).collect() == []
    with pytest.raises(ValueError):
        ct.Aligner(public_tokenizers.path("word_bpe_49k.json"), B)
