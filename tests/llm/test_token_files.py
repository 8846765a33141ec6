import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import docs_table, odd_rows, prose, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortica.llm import token_files as tf
from cohortica.llm.files import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def expected(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
    start, out = 0, []
    for row in sorted(rows, key=key):
        ids = WHOLE.encode(row[1] or "", add_special_tokens=False).ids + [2]
        out.append((row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@given(st.text(max_size=60) | st.text("aB'é.,!? \n <|>sit0", max_size=60))
@settings(max_examples=400, deadline=None)
def test_chunks_give_the_ids_of_the_whole_text(text):
    got = np.frombuffer(tf.encoder(PATH).encode(text.encode()), "<u2").tolist()
    assert got == WHOLE.encode(text, add_special_tokens=False).ids


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 20)
    code = tf.ChunkEncoder(PATH)
    for k in range(6):
        text = prose(k, 80) + " Foo, foo! FOO"
        got = np.frombuffer(code.encode(text.encode()), "<u2").tolist()
        assert got == WHOLE.encode(text, add_special_tokens=False).ids


def test_round_trip_of_awkward_rows(spark):
    rows = odd_rows()
    got = [tuple(r) for r in tf.token_table(with_clashes(docs_table(spark, rows)), PATH).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)


def test_offsets_and_mapped_ids(spark):
    rows = [(k, prose(k, k), "en", "a", 0) for k in range(60)]
    files = tf.write_token_files(docs_table(spark, rows), PATH, new_folder(spark, "test"), parts=4)
    assert len(files.parts) > 1 and files.dtype == "<u2"
    assert [r[:3] for r in sorted(map(tuple, tf.read_token_files(spark, files).collect()))] == [
        r[:3] for r in expected(rows)
    ]
    part = files.parts[-1][0]
    assert tf.read_ids(files, part, 0)[-1] == 2
    last = expected(rows)[-1]
    assert len(tf.read_ids(files, part, files.parts[-1][1] - 1)) == last[2]


def test_empty_table(spark):
    assert tf.token_table(docs_table(spark, []), PATH).collect() == []


def test_wide_vocabularies_take_32_bits():
    assert tf.id_type(65_536) == "<u2" and tf.id_type(65_537) == "<u4"


def test_tokenizers_without_word_ends_are_refused():
    with pytest.raises(ValueError):
        tf.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_many_texts_at_a_time():
    texts = ["", "One two,  two", " \n", "One\x0btwo! 東京", prose(1, 50)]
    raw = [t.encode() for t in texts]
    ids, at = tf.encoder(PATH).encode_texts(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])))
    got = [np.frombuffer(ids[x:y], "<u2").tolist() for x, y in zip(at, at[1:], strict=False)]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_come_to_the_encoder_few_at_a_time(spark, monkeypatch):
    whole = tf._pieces

    def few(texts, size):
        assert len(texts) <= 1000
        return whole(texts, size)

    monkeypatch.setattr(tf, "_pieces", few)
    rows = [(k, f"word {k}", "en", "a", 0) for k in range(3000)]
    files = tf.write_token_files(docs_table(spark, rows), PATH, new_folder(spark, "test"), parts=1)
    assert [n for _, n, _ in files.parts] == [3000]
    assert sorted(map(tuple, tf.read_token_files(spark, files).collect())) == expected(rows)


def test_idle_workers_keep_no_encoder(spark):
    def left(batches):
        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(tf._encoders)]})

    rows = [(k, f"word {k}", "en", "a", 0) for k in range(400)]
    files = tf.write_token_files(docs_table(spark, rows), PATH, new_folder(spark, "test"), parts=40)
    assert sorted(map(tuple, tf.read_token_files(spark, files).collect())) == expected(rows)
    found = spark.range(0, 40, numPartitions=40).mapInArrow(left, "n long").collect()
    assert len(found) == 40 and not any(r.n for r in found)
