import io
import struct

import pytest
import zstandard
from helpers import prose

from cohortica.llm import warc_zstd as wz
from cohortica.llm.files import new_folder

PAGES = "page_id long, url string, html string"


def pages(spark, rows, clash=False):
    df = spark.createDataFrame(rows, PAGES)
    return df.selectExpr("*", "'x' as id", "'x' as key", "'x' as response", "'x' as copies") if clash else df


def archived(spark, rows, **options):
    folder = new_folder(spark, "test")
    archives = wz.write_archives(wz.with_revisits(pages(spark, rows, True), **options), folder)
    return wz.read_archives(spark, folder, archives, payloads=True).collect()


ROWS = [
    (1, "http://a.example/1", "<p>same</p>"), (2, "http://a.example/ 2\n", "<p>same</p>"), (3, None, "<p>same</p>"),
    (4, "http://a.example/4", None), (5, "http://a.example/5", ""), (6, "http://a.example/6", "été \r\n\r\n 🙂"),
    (None, "http://a.example/n", "<p>no id</p>"), (None, "http://a.example/m", "<p>same</p>"),
    (8, "http://a.example/8", prose(8, 60_000)), (9, "u", "<p>twice</p>"), (9, "u", "<p>twice</p>"),
]


def test_round_trip_with_revisits(spark):
    got = archived(spark, ROWS)
    assert len(got) == len(ROWS)
    same = [r for r in got if r.payload_digest == wz.digest_of(b"<p>same</p>")]
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in same) == [
        (0, "revisit", 3), (1, "revisit", 3), (2, "revisit", 3), (3, "response", None),
    ]
    assert {r.page_id: r.refers_to for r in got if r.payload_bytes == 0} == {4: 5, 5: None}
    texts = {(r[0], r[2] or "") for r in ROWS}
    for r in got:
        if r.record_type == "response":
            assert (r.page_id, bytes(r.payload).decode()) in texts and len(r.payload) == r.payload_bytes
        else:
            assert r.payload is None and r.payload_bytes == len({"": "", 3: "<p>same</p>"}.get(r.refers_to, ""))
    assert [r.record_type for r in got if r.page_id == 9] == ["response", "response"]
    assert {r.url for r in got if r.page_id == 2} == {"http://a.example/%202%0A"}


def test_small_payloads_can_be_left_alone(spark):
    got = archived(spark, ROWS, least_bytes=12)
    assert all(r.record_type == "response" for r in got)


def test_no_rows(spark):
    assert archived(spark, []) == []


def archive(records, dictionary=b"", squeeze_dictionary=False):
    """An archive in memory."""
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    data = zstandard.ZstdCompressor().compress(dictionary) if squeeze_dictionary else dictionary
    out = struct.pack("<II", wz.SKIPPABLE_MAGIC, len(data)) + data if dictionary else b""
    return out + b"".join(zstandard.ZstdCompressor(dict_data=trained).compress(r) for r in records)


@pytest.mark.parametrize("squeezed", [False, True])
def test_dictionary_from_the_leading_frame(squeezed):
    records = [wz.record(k, "u", prose(k, 300).encode(), None, "2000-01-01T00:00:00Z") for k in range(40)]
    dictionary = zstandard.train_dictionary(4_000, records).as_bytes()
    data = archive(records, dictionary, squeezed)
    assert list(wz.frames(io.BytesIO(data))) == records
    with pytest.raises(wz.BadArchive):  # the same frames without it
        skip = 8 + struct.unpack("<II", data[:8])[1]
        list(wz.frames(io.BytesIO(data[skip:])))


GOOD = wz.record(1, "u", b"payload", None, "2000-01-01T00:00:00Z")
REVISIT = wz.record(1, "u", b"payload", 2, "2000-01-01T00:00:00Z")


@pytest.mark.parametrize(
    "bad",
    [
        GOOD + GOOD, GOOD[:-1], GOOD.replace(b"WARC/1.1", b"HTTP/1.1"), GOOD.replace(b"payload\r\n", b"pAyload\r\n"),
        GOOD.replace(b"WARC-Type: response", b"WARC-Type: metadata"), GOOD.replace(b"WARC-Date", b"WARC-When"),
        GOOD.replace(b"\nContent-Length: 7", b"\nContent-Length: 8"), GOOD.replace(b"WARC-Date:", b"WARC-Date"),
        REVISIT.replace(b"WARC-Refers-To", b"WARC-Other"), b"",
    ],
)
def test_bad_records_are_refused(bad):
    assert wz.parse(GOOD)["payload"] == b"payload" and wz.parse(REVISIT)["refers_to"] == 2
    with pytest.raises(wz.BadArchive):
        wz.parse(bad)


def test_cut_archives_are_refused():
    data = archive([GOOD, GOOD])
    with pytest.raises(wz.BadArchive):
        list(wz.frames(io.BytesIO(data[:-3])))
    with pytest.raises(wz.BadArchive):
        list(wz.frames(io.BytesIO(struct.pack("<II", wz.SKIPPABLE_MAGIC, 99) + b"short")))
