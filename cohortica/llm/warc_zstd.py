"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame per record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, raw or itself
compressed; every record after it is one Zstandard frame. Payloads that occur more than once are
stored once: the row with the largest id is a ``response``, the others are ``revisit`` records that
name it and carry the HTTP headers only.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.llm.files import opened, replacing

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# A dictionary is trained on the first payloads of a part, so many and so many bytes at most.
SAMPLES = 500
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 6
CHUNK = 1 << 20


class BadArchive(ValueError):
    """A frame, header or length that does not hold."""


def with_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """``id, url, html, response``: the id that a row's payload is stored under, null for its own.

    Payloads of fewer than ``least_bytes`` bytes are always stored. Equal payloads are found by
    SHA-1 and length; counting them is a map-side aggregate, and only digests that occur more than
    once are joined back, so a payload that makes up a third of the table is one row there. Null
    payloads are empty ones, a null id is a revisit if an equal payload has an id. Rows that repeat
    the largest id are all stored.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    size = F.octet_length("html")
    key = F.when(size >= least_bytes, F.concat_ws(":", F.sha1("html"), size.cast("string")))
    copies = (
        rows.select("id", key.alias("key"))
        .where("key is not null")
        .groupBy("key")
        .agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    return rows.withColumn("key", key).join(copies, "key", "left").select(
        "id", "url", "html",
        F.when(~F.col("id").eqNullSafe(F.col("largest")), F.col("largest")).alias("response"),
    )


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, response: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and leaves the payload out."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if response is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if response is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{response}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> list[tuple[str, int]]:
    """Write the rows of ``with_revisits``, an archive for each partition that has rows; returns
    (file name, records), which is one row per archive."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard as zs

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        samples, size = [], 0
        for html, response in zip(first.column(2), first.column(3), strict=True):
            if len(samples) < SAMPLES and size < SAMPLE_BYTES and not response.is_valid:
                samples.append(record(0, "", html.as_py().encode()[: SAMPLE_BYTES // 8], None, date))
                size += len(samples[-1])
        dictionary = None
        if samples:
            try:
                dictionary = zs.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
            except zs.ZstdError:  # too few or too small samples: frames without a dictionary
                dictionary = None
        squeeze = zs.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        name, n = f"pages-{TaskContext.get().partitionId():06d}.warc.zst", 0
        with replacing(f"{folder}/{name}") as (out,):
            if dictionary is not None:
                data = dictionary.as_bytes()
                out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(data)) + data)
            for batch in chain([first], batches):
                n += batch.num_rows
                _write_batch(out, squeeze, batch, date)
        yield pa.RecordBatch.from_pydict({"name": [name], "records": pa.array([n], pa.int64())})

    made = rows.select("id", "url", "html", "response").mapInArrow(write, "name string, records long")
    return sorted((r.name, r.records) for r in made.collect())


def _write_batch(out, squeeze, batch, date: str) -> None:
    for page, url, html, response in zip(*batch.columns, strict=True):
        data = record(page.as_py(), url.as_py(), html.as_py().encode(), response.as_py(), date)
        out.write(squeeze.compress(data))


def frames(stream) -> Iterator[bytes]:
    """The content of every frame of an archive, in bounded reads; the dictionary goes by unseen."""
    import zstandard as zs

    dictionary = None
    head = stream.read(8)
    if len(head) == 8 and struct.unpack("<II", head)[0] == SKIPPABLE_MAGIC:
        length = struct.unpack("<II", head)[1]
        data = stream.read(length)
        if len(data) != length:
            raise BadArchive("the dictionary is cut off")
        if data[:4] == FRAME_MAGIC:
            data = zs.ZstdDecompressor().decompressobj().decompress(data)
        dictionary, head = zs.ZstdCompressionDict(data), b""
    opener = zs.ZstdDecompressor(dict_data=dictionary)
    left = head
    while True:
        if not left:
            left = stream.read(CHUNK)
            if not left:
                return
        frame, pieces = opener.decompressobj(), []
        while not frame.eof:
            if not left:
                left = stream.read(CHUNK)
                if not left:
                    raise BadArchive("the last frame is cut off")
            try:
                pieces.append(frame.decompress(left))
            except zs.ZstdError as error:
                raise BadArchive(str(error)) from error
            left = frame.unused_data if frame.eof else b""
        yield b"".join(pieces)


def parse(frame: bytes) -> dict:
    """Check one record and return what it says; raises ``BadArchive``."""
    head, gap, rest = frame.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise BadArchive("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadArchive(f"not a header field: {line[:80]}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise BadArchive(f"{name} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4:
        raise BadArchive("the frame is not one record of the stated length")
    if rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the record has no end")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:[ ]*(\d+)\r?$", http)
    if not gap or not stated:
        raise BadArchive("no HTTP header")
    size, digest = int(stated[1]), fields["warc-payload-digest"].removeprefix("sha1:")
    number = lambda name: int(x) if (x := re.sub(r"\D", "", fields.get(name, ""))) else None
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != size or digest_of(payload) != digest:
            raise BadArchive("payload and header do not agree")
    elif kind == "revisit":
        if payload or number("warc-refers-to") is None:
            raise BadArchive("a revisit refers to a record and has no payload")
    else:
        raise BadArchive(f"unexpected record type {kind[:40]}")
    return {
        "page_id": number("warc-record-id"), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": number("warc-refers-to") if kind == "revisit" else None,
        "url": fields.get("warc-target-uri"), "payload": payload if kind == "response" else None,
    }


RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read_archives(spark: SparkSession, folder: str, archives: list[tuple[str, int]], payloads: bool = False) -> DataFrame:
    """A row per record, a task per archive; ``payloads`` adds ``url`` and ``payload``.

    Raises ``BadArchive`` if a frame is not exactly one valid record or an archive lacks records.
    """
    schema = RECORD + (", url string, payload binary" if payloads else "")
    if not archives:
        return spark.createDataFrame([], schema)
    names = spark.sparkContext.parallelize(archives, len(archives)).toDF("name string, records long")

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_one(f"{folder}/{row['name']}", row["records"], payloads)

    return names.mapInArrow(read, schema)


def _read_one(uri: str, expected: int, payloads: bool) -> Iterator:
    import pyarrow as pa

    kinds = [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ] + [("url", pa.string()), ("payload", pa.binary())] * payloads
    schema = pa.schema(kinds)
    system, path = opened(uri)
    rows, size, n = [], 0, 0
    with system.open_input_stream(path, compression=None) as stream:
        for frame in frames(stream):
            row = parse(frame)
            n, size = n + 1, size + len(frame)
            rows.append({k: row[k] for k in schema.names})
            if len(rows) >= 5_000 or payloads and size > 16 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
    if n != expected:
        raise BadArchive(f"{n} records, {expected} were written")
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)
