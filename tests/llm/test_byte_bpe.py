import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from helpers import docs_table, odd_rows, prose, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortica.llm import byte_bpe
from cohortica.llm.queries import byte_bpe_digests

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
WHOLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PATTERN = regex.compile(public_tokenizers.PATTERN)


def encoded(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, bounds = byte_bpe.encoder(PATH).encode(data, np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]


def cut(texts):
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    first = np.zeros(len(points), bool)
    at = np.cumsum([0, *map(len, texts)])
    first[[a for a, t in zip(at, texts, strict=False) if t]] = True
    starts = np.flatnonzero(byte_bpe.pretoken_starts(points, first)).tolist()
    whole = "".join(texts)
    return [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)], strict=False)]


PIECES = st.sampled_from(["'", "s", "re", "ll", "'ve", "'S", " ", "  ", "\n", "\t", " ", " ", "\x85", "\x1c", "a", "é", "1", "½", "!", "🙂", "東", "́", "d'd"])
TEXTS = st.lists(st.lists(PIECES, max_size=12).map("".join) | st.text(max_size=20), max_size=5)


@given(TEXTS)
@settings(max_examples=800, deadline=None)
def test_pretokens_are_the_matches_of_the_pattern(texts):
    assert cut(texts) == [m for t in texts for m in PATTERN.findall(t)]


@given(TEXTS)
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_library(texts):
    assert encoded(texts) == [WHOLE.encode_ordinary(t) for t in texts]


def test_characters_have_the_classes_that_the_library_gives_them():
    points = [chr(c) for c in [*range(0x3400), *range(0x3400, 0xD800, 13), *range(0xE000, 0x110000, 29)]]
    texts = ["a" + c + "b1" + c + "2!" + c + "? " + c + "\n" + c for c in points]
    assert encoded(texts) == WHOLE.encode_ordinary_batch(texts, num_threads=8)


def test_merges_equal_a_scan_for_the_smallest_rank():
    rng = np.random.default_rng(3)
    code = byte_bpe.encoder(PATH)
    for _ in range(300):
        piece = bytes(rng.choice([97, 101, 104, 110, 116, 195, 169], rng.integers(1, 40)).tolist())
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            ranks = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in RANKS]
            if not ranks:
                break
            _, i = min(ranks)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert byte_bpe.merged(piece, code.ranks) == [RANKS[p] for p in parts]


def test_the_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2)
    keys = np.unique(keys)
    table = byte_bpe.PerfectHash(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
    assert byte_bpe.PerfectHash(keys[:0]).find(keys[:3]).tolist() == [-1] * 3
    with pytest.raises(ValueError):
        byte_bpe.PerfectHash(keys[[0, 0]])


def test_the_perfect_hash_finds_exactly_the_vocabulary():
    code = byte_bpe.encoder(PATH)
    strings = [*RANKS, *[t + b"~" for t in RANKS], b"\xff\xfe\xfd"]
    found = code.whole(*byte_bpe.packed(strings))
    assert found.tolist() == [RANKS.get(s, -1) for s in strings]


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    texts = [prose(k, 80) for k in range(5)]
    assert encoded(texts) == [WHOLE.encode_ordinary(t) for t in texts]


def digests(rows):
    out = []
    for row in rows:
        ids = WHOLE.encode_ordinary(row[1] or "")
        out.append((row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_round_trip_of_awkward_rows(spark, monkeypatch):
    rows = odd_rows() + [(20, "a" * 50_000 + " " * 3000 + "!'s" * 4000, "en", "a", 0), (21, "\x00 \x1c\x85", "en", "a", 0)]
    got = byte_bpe_digests(with_clashes(docs_table(spark, rows)), PATH).collect()
    assert sorted(map(tuple, got), key=str) == digests(rows)


def test_ids_come_back_as_the_text(spark):
    rows = [(k, prose(k, 30) + " 東京🙂", "en", "a", 0) for k in range(20)]
    table = byte_bpe.encode_documents(docs_table(spark, rows), PATH)
    assert {r.doc_id: r.ids for r in table.collect()} == {r[0]: WHOLE.encode_ordinary(r[1]) for r in rows}
    assert {r.doc_id: bytes(r.decoded).decode() for r in byte_bpe.decode_documents(table, PATH).collect()} == {r[0]: r[1] for r in rows}


def test_foreign_ids_are_refused(spark):
    from pyspark.errors import PythonException

    rows = spark.createDataFrame([(1, [5, 60_000])], "doc_id long, ids array<int>")
    with pytest.raises(PythonException):
        byte_bpe.decode_documents(rows, PATH).collect()
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode_documents(empty, PATH).collect()] == [b"", b""]


def test_empty_table_and_other_patterns(spark):
    assert byte_bpe_digests(docs_table(spark, []), PATH).collect() == []
    with pytest.raises(ValueError):
        byte_bpe.ByteBpe(PATH, r"\w+")
