"""Token ids as flat unsigned integer files with 64-bit document offsets.

Part ``p`` of a data set is four files:

* ``ids-p.bin``      token ids, little-endian, 16 bits where the vocabulary allows it, else 32
* ``docs-p.bin``     signed 64-bit document ids, ascending; the lowest number is a null id
* ``lengths-p.bin``  64-bit number of tokens of each document
* ``offsets-p.bin``  64-bit start of each document in the whole data set, and the end of the last

Parts follow each other in ascending document id. A part's base is the number of tokens in all
parts before it; parts are encoded in one pass, the bases are the prefix sums over the parts (one
number per part), and offsets are written in a second pass that touches the lengths only. Any
document is then a slice of one memory-mapped file.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.llm.byte_bpe import _pieces
from cohortica.llm.files import mapped, new_folder, replacing
from cohortica.llm.words import SPACE
from cohortica.session import leanly

# The end of a document.
END_ID = 2
# Stands for a null id in the files.
NO_ID = -(1 << 63)
# Distinct chunks whose ids a worker remembers, twice over.
REMEMBERED = 500_000
# Bytes of text taken at a time; a longer text is taken alone and whole.
PIECE_BYTES = 2 << 20
_encoders: dict[str, ChunkEncoder] = {}


class ChunkEncoder:
    """Ids of whole texts, from the ids of their chunks between ASCII white space.

    Only for tokenizers that never join characters across white space, keep none of it, lower-case,
    part letters from punctuation and mark the last token of a piece, as the CLIP vocabulary does:
    then the ids of a text are those of its chunks one after the other, and a chunk seen before need
    not be encoded again. A new chunk of Latin letters and closing punctuation is taken apart there,
    so that a word is encoded once whatever its case and what follows it, and new words are encoded
    many at a time; any other chunk is encoded by itself. ``test_token_files.py`` holds all this
    against encoding whole texts.
    """

    # Punctuation that the tokenizer keeps together and parts from letters before it.
    CLOSING = ".,;:!?*#$%&|)"
    # Letters below this one are composed already and have a lower case of one letter.
    BEYOND = "\u0130"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark hands out the cores
        import numpy as np
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        steps = json.dumps([made["normalizer"], made["pre_tokenizer"]])
        if made["model"].get("end_of_word_suffix") != "</w>" or not all(x in steps for x in ('"Lowercase"', '"Split"', "\\\\s")):
            raise ValueError("texts are encoded chunk by chunk, for tokenizers with word ends, lower case and no white space")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = id_type(len(vocabulary))
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.inside = np.ones(256, bool)
        self.inside[list(SPACE)] = False
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        """The ids of a text in UTF-8, packed."""
        import numpy as np

        ids, _ = self.encode_texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        return bytes(ids)

    def encode_texts(self, data, offsets):
        """The packed ids of the texts ``data[offsets[i]:offsets[i+1]]`` one after the other, and the byte
        where each text's begin, with the end. Equal chunks are looked up once."""
        import numpy as np
        import pyarrow as pa

        inside = self.inside[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        starts = np.flatnonzero(starts)
        lengths = np.flatnonzero(ends) + 1 - starts
        bounds = np.append(0, np.cumsum(lengths)).astype(np.int64)
        chunks = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        found = [self.known.get(c) for c in distinct]
        if None in found:
            self._learn([c for c, f in zip(distinct, found, strict=True) if f is None])
            found = [self.known[c] if f is None else f for c, f in zip(distinct, found, strict=True)]
        taken = pa.array(found, pa.large_binary()).take(chunks.indices)
        _, place, content = taken.buffers()
        at = np.frombuffer(place, np.int64)[: len(taken) + 1]
        return memoryview(content or b""), at[np.searchsorted(starts, offsets)]

    def _learn(self, chunks: list[bytes]) -> None:
        if len(self.known) > REMEMBERED:  # what is in use moves over again from the older half
            self.older, self.known = self.known, {}
        if len(self.words) > REMEMBERED:
            self.words = {}
        split: list[tuple[bytes, str, str]] = []
        for chunk in chunks:
            ids = self.older.get(chunk)
            if ids is None:
                whole = chunk.decode()
                word = whole.rstrip(self.CLOSING)
                if word.isalpha() and max(word) < self.BEYOND:
                    split.append((chunk, word.lower(), whole[len(word) :]))
                    continue
                ids = self._alone(whole)
            self.known[chunk] = ids
        self._encode_words(list({w for _, w, _ in split if w not in self.words}))
        for chunk, word, closing in split:
            ids = self.words[word]
            if closing:
                if closing not in self.words:
                    self.words[closing] = self._alone(closing)
                ids += self.words[closing]
            self.known[chunk] = ids

    def _alone(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _encode_words(self, words: list[str]) -> None:
        import numpy as np

        if not words:
            return
        (encoded,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(encoded.ids, self.dtype)
        ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
        if len(ends) != len(words):
            raise ValueError("this tokenizer does not end every word with a token of its own")
        data, start = ids.tobytes(), 0
        for word, end in zip(words, ends.tolist(), strict=True):
            self.words[word] = data[start:end]
            start = end


def id_type(size: int) -> str:
    """The narrowest unsigned type for a vocabulary."""
    return "<u2" if size <= 1 << 16 else "<u4"


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop a worker's encoders and the memory that Arrow holds on to; an idle worker would keep both
    beside whatever its executor does next."""
    import pyarrow as pa

    _encoders.clear()
    pa.default_memory_pool().release_unused()


@dataclass(frozen=True)
class TokenFiles:
    """A written data set: its folder, the integer type of the ids, and rows and tokens of each part."""

    folder: str
    dtype: str
    parts: tuple[tuple[int, int, int], ...]  # part, documents, tokens

    def bases(self) -> list[tuple[int, int, int]]:
        """(part, documents, tokens before the part)."""
        out, before = [], 0
        for part, docs, tokens in self.parts:
            out.append((part, docs, before))
            before += tokens
        return out


def _name(folder: str, kind: str, part: int) -> str:
    return f"{folder}/{kind}-{part:06d}.bin"


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, parts: int | None = None,
) -> TokenFiles:
    """Encode every whole text and write the files; ``folder`` is a URI all executors can write to.

    Rows are range-partitioned by id, so ids ascend within and across parts. Rows with a null id
    come first and are read back with a null id; null texts count as empty and become the end id
    alone. Repeated rows are written as often as they occur, in no fixed order among each other.
    An empty table writes no part. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows = rows.repartitionByRange(parts, "id") if parts else rows.repartitionByRange("id")

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        part = TaskContext.get().partitionId()
        code = encoder(tokenizer)
        end = np.array([end_id], code.dtype).tobytes()
        width, n, total = len(end), 0, 0
        names = [_name(folder, k, part) for k in ("ids", "docs", "lengths")]
        with replacing(*names) as (ids, ids_of, lengths):
            for batch in batches:
                sizes = []
                for _, data, offsets in _pieces(batch.column(1), PIECE_BYTES):
                    made, at = code.encode_texts(data, offsets)
                    at = at.tolist()
                    for x, y in zip(at, at[1:], strict=False):
                        ids.write(made[x:y])
                        ids.write(end)
                        sizes.append((y - x) // width + 1)
                ids_of.write(batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                lengths.write(np.array(sizes, "<i8").tobytes())
                n, total = n + len(sizes), total + sum(sizes)
        if n:
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "docs": [n], "tokens": [total]},
                pa.schema([("part", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())]),
            )

    with leanly(spark):  # else a batch holds so many texts that its copies outweigh the encoder
        made = (
            rows.sortWithinPartitions("id")
            .mapInArrow(write, "part long, docs long, tokens long")
            .collect()  # a row per part
        )
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    files = TokenFiles(
        folder, id_type(size),
        tuple(sorted((r.part, r.docs, r.tokens) for r in made)),
    )
    _write_offsets(spark, files)
    return files


def _over_parts(spark: SparkSession, files: TokenFiles, work: Callable, schema: str) -> DataFrame:
    """Run ``work(part, base)``, which yields record batches, in a task for each part. All texts are
    encoded by then; idle workers take turns, so these tasks reach those that did it."""
    parts = [(p, base) for p, _, base in files.bases()]
    if not parts:
        return spark.createDataFrame([], schema)
    table = spark.sparkContext.parallelize(parts, len(parts)).toDF("part long, base long")

    def run(batches: Iterator) -> Iterator:
        forget()
        for batch in batches:
            for row in batch.to_pylist():
                yield from work(row["part"], row["base"])

    return table.mapInArrow(run, schema)


def _write_offsets(spark: SparkSession, files: TokenFiles) -> None:
    folder = files.folder

    def work(part: int, base: int) -> Iterator:
        import numpy as np

        lengths = mapped(_name(folder, "lengths", part), "<i8")
        with replacing(_name(folder, "offsets", part)) as (out,):
            out.write((base + np.concatenate([[0], np.cumsum(lengths)])).astype("<i8").tobytes())
        return iter(())

    _over_parts(spark, files, work, "part long").count()


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """A row per document, from the files: id, start in the whole data set, number of ids, and the
    CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    folder, dtype = files.folder, files.dtype

    def work(part: int, base: int) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        ids = mapped(_name(folder, "ids", part), dtype)
        docs = mapped(_name(folder, "docs", part), "<i8")
        offsets = mapped(_name(folder, "offsets", part), "<i8")
        for a in range(0, len(docs), 10_000):
            b = min(a + 10_000, len(docs))
            bounds = np.asarray(offsets[a : b + 1]) - base
            sums = [
                zlib.crc32(ids[x:y].astype("<u4").tobytes())
                for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.asarray(docs[a:b]), mask=np.asarray(docs[a:b] == NO_ID)),
                    pa.array(np.asarray(offsets[a:b])),
                    pa.array(np.diff(bounds)),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return _over_parts(
        spark, files, work, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_ids(files: TokenFiles, part: int, row: int):
    """The ids of one document, as a view of the memory-mapped file."""
    base = dict((p, b) for p, _, b in files.bases())[part]
    offsets = mapped(_name(files.folder, "offsets", part), "<i8")
    ids = mapped(_name(files.folder, "ids", part), files.dtype)
    return ids[offsets[row] - base : offsets[row + 1] - base]


def token_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to new token files in the shared folder and read them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, tokenizer, new_folder(spark, "tokens")))
