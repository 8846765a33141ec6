"""Which tokens of two tokenizers cover the same bytes, and how common each link is in a corpus.

1. Whole texts are tokenized by both, A with the blank in front that B adds by itself. Both token
   sequences must spell the blank and the text, byte by byte.
2. Places where tokens of both end, with a blank behind (or nothing), are anchors. They cut a text
   into windows, each a tuple of A ids and one of B ids.
3. A window's alignment depends on its ids alone: groups between shared ends, and a link for every two
   tokens that share bytes. Texts are taken many at a time, and of equal id tuples among them one is aligned.
4. Each text keeps its distinct links and how often it has them; an aggregate counts, per link, the
   texts that hold it, and another finds each A id's highest count.
5. Counts go to sorted binary files in the shared folder, which tasks map into memory to sum them up
   per text. So no link travels with its text, a hot link is one entry, and memory is bounded.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.byte_bpe import SPLIT, _pieces, gathered, joined, packed
from cohortica.llm.files import mapped, new_folder, replacing
from cohortica.session import leanly, settle

# Bytes of text taken at a time, whose alignments are shared; a longer text is taken alone and whole.
PIECE_BYTES = 2 << 20
# Counts in one file, and files that a worker keeps open.
FILE_ROWS = 4_000_000
OPEN_FILES = 8
# Links whose counts are looked up at a time; a text with more is taken alone and whole.
LOOKED_UP = 500_000
_aligners: dict[tuple[str, str], Aligner] = {}


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, and the byte: printable ones
    of Latin-1 stand for themselves, the others for 256 and up in their order."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + k): b for k, b in enumerate(other)}


def spread(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``counts[i]`` of them, for every ``i``."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


@dataclass
class Piece:
    """Alignments of some texts: numbers per text, their groups, and their distinct links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: object  # Arrow strings
    link_bounds: np.ndarray
    links: np.ndarray  # A id times the size of B's vocabulary, plus B id
    times: np.ndarray


def byte_level(path: str) -> Callable[[list[str]], list]:
    """The encoder of a byte-level JSON file: ids of every text, special tokens being plain text.

    A file whose merges stand in the order of their ids, with the byte-level split and nothing else around
    it, is a table of ranks, which the faster library reads; any other goes to the library it was made for.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark hands out the cores
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model, split = made["model"], made["pre_tokenizer"] or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    ids = [model["vocab"]["".join(m)] for m in merges]
    plain = (
        made["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split["add_prefix_space"] and model["type"] == "BPE" and not model.get("ignore_merges")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and all(a < b for a, b in zip(ids, ids[1:], strict=False))
    )
    if not plain:
        whole = Tokenizer.from_file(path)
        whole.encode_special_tokens = True
        return lambda texts: [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]
    letters = byte_letters()
    ranks = {bytes([b]): model["vocab"][c] for c, b in letters.items()}
    ranks |= {bytes(letters[c] for c in a + b): i for (a, b), i in zip(merges, ids, strict=True)}
    code = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [code.encode_ordinary(t) for t in texts]


class Aligner:
    """Tokenizer A (a byte-level JSON file) and B (a SentencePiece model with byte fallback)."""

    def __init__(self, path_a: str, path_b: str):
        import pyarrow as pa
        import sentencepiece
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(path_a).get_vocab()
        letters = byte_letters()
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if set(token) - set(letters):
                raise ValueError("tokenizer A is not byte-level")
            spelled[i] = bytes(letters[c] for c in token)
        self.a = byte_level(path_a)
        self.spelled_a = packed(spelled)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_b = self.b.get_piece_size()
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.spelled_b = packed([piece(i) for i in range(self.size_b)])
        self.size = max(len(spelled), self.size_b)
        self.decimal = pa.array([b"%d%c" % (k, c) for c in b",|;" for k in range(self.size)], pa.large_binary())
        probe = b"Two words, 1 probe."
        _, good = self._tokens([probe.decode()], np.frombuffer(probe, np.uint8), np.array([0, len(probe)]))
        if not good[0]:
            raise ValueError("the tokens of A and B do not spell a text with a blank before it")

    def _aligned(self, rows: np.ndarray, bounds: np.ndarray):
        """Windows ``rows[bounds[i]:bounds[i+1]]`` (the count of A ids, A ids, B ids): their groups as
        Arrow strings, their links as Arrow lists, and their numbers of groups. Both sides of a window have the same
        bytes, so bytes are counted through all windows at once."""
        import pyarrow as pa

        n_a = rows[bounds[:-1]].astype(np.int64)
        n_b = np.diff(bounds) - 1 - n_a
        a, b = rows[spread(n_a, bounds[:-1] + 1)], rows[spread(n_b, bounds[:-1] + 1 + n_a)]
        size_a = np.diff(self.spelled_a[1])[a]
        end_a, end_b = np.cumsum(size_a), np.cumsum(np.diff(self.spelled_b[1])[b])
        # Links: the B tokens from the first that ends behind a token's start to the first that reaches its end.
        first, last = np.searchsorted(end_b, end_a - size_a, "right"), np.searchsorted(end_b, end_a)
        linked = last - first + 1
        links = np.repeat(a.astype(np.int64), linked) * self.size_b + b[spread(linked, first)]
        edge = np.append(0, np.cumsum(n_a))
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(linked))[edge]), pa.array(links))
        # Groups: tokens in the order of group and side, each with the sign that follows it.
        ends = end_b[last] == end_a
        shared = end_a[ends]
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        signed = np.empty(len(a) + len(b), np.int64)
        signed[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + self.size * ends
        closes = np.append(group_b[1:] != group_b[:-1], True)
        signed[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = b + 2 * self.size * closes
        text, at = joined(self.decimal, pa.array(signed))
        at = at[np.append(0, np.cumsum(n_a + n_b))]
        groups = pa.Array.from_buffers(pa.large_binary(), len(n_a), [None, pa.py_buffer(at.copy()), pa.py_buffer(text)])
        return groups, lists, np.diff(np.append(0, np.cumsum(ends))[edge])

    def _tokens(self, texts: list[str], data: np.ndarray, offsets: np.ndarray):
        """Per side: ids, bounds per text, and the byte each token ends at; texts that cannot be spelled
        have none. Bytes are counted through all texts with a blank before each."""
        sides = [
            self.a([" " + t for t in texts]),
            self.b.encode(texts, num_threads=1),
        ]
        flat = [np.fromiter(chain.from_iterable(side), np.int64, sum(map(len, side))) for side in sides]
        bounds = [np.concatenate([[0], np.cumsum([len(r) for r in side], dtype=np.int64)]) for side in sides]
        whole = data.tobytes()
        good = np.diff(offsets) > 0
        for ids, at, spelled in zip(flat, bounds, (self.spelled_a, self.spelled_b), strict=True):
            joined, ends = gathered(ids, *spelled)
            joined, ends = joined.tobytes(), ends[at].tolist()
            for k in np.flatnonzero(good).tolist():
                good[k] = joined[ends[k] : ends[k + 1]] == b" " + whole[offsets[k] : offsets[k + 1]]
        out = []
        for ids, at, spelled in zip(flat, bounds, (self.spelled_a, self.spelled_b), strict=True):
            sizes = np.where(good, np.diff(at), 0)
            ids = ids[np.repeat(good, np.diff(at))]
            out.append((ids, np.concatenate([[0], np.cumsum(sizes)]), np.cumsum((spelled[1][1:] - spelled[1][:-1])[ids])))
        return out, good

    def align(self, data: np.ndarray, offsets: np.ndarray) -> Piece:
        """The texts ``data[offsets[i]:offsets[i+1]]``."""
        import pyarrow as pa
        import pyarrow.compute as pc

        raw = data.tobytes()
        texts = [raw[x:y].decode() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        ((a, at_a, end_a), (b, at_b, end_b)), good = self._tokens(texts, data, offsets)
        n = len(texts)
        if not len(a):
            none = np.zeros(n, np.int64)
            return Piece(none, none, none, none, pa.array([""] * n, pa.string()), np.zeros(n + 1, np.int64), np.zeros(0, np.int64), none[:0])
        # Anchors: shared ends with a blank behind them, or the end of a text.
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        after = np.searchsorted(end_a, shared) + 1  # the A token behind a shared end
        bytes_a, first_byte = self.spelled_a
        blank = np.append(bytes_a[first_byte[:-1]] == 32, True)[np.append(a, len(first_byte) - 1)[after]]
        blank[np.searchsorted(shared, end_a[at_a[1:][good] - 1])] = True
        anchors = shared[blank]
        cut_a, cut_b = (np.append(0, np.searchsorted(e, anchors) + 1) for e in (end_a, end_b))
        # Windows as strings of 32-bit numbers: how many A ids, those, the B ids.
        size_a, size_b = np.diff(cut_a), np.diff(cut_b)
        bounds = np.append(0, np.cumsum(1 + size_a + size_b))
        row = np.empty(bounds[-1], np.int32)
        row[bounds[:-1]] = size_a
        row[np.arange(len(a)) + np.repeat(bounds[:-1] + 1 - cut_a[:-1], size_a)] = a
        row[np.arange(len(b)) + np.repeat(bounds[:-1] + 1 + size_a - cut_b[:-1], size_b)] = b
        windows = pa.Array.from_buffers(
            pa.large_binary(), len(anchors), [None, pa.py_buffer(4 * bounds.astype(np.int64)), pa.py_buffer(row)]
        ).dictionary_encode()
        _, place, content = windows.dictionary.buffers()
        place = np.frombuffer(place, np.int64)[: len(windows.dictionary) + 1] // 4
        texts_of, links_of, groups_of = self._aligned(np.frombuffer(content, np.int32, place[-1]), place)
        index = windows.indices
        per_text = np.append(0, np.cumsum(np.where(good, 1, 0)))  # windows before each text
        ends = np.append(0, np.searchsorted(anchors, end_a[at_a[1:][good] - 1]) + 1)
        per_text = ends[per_text]
        strings = texts_of.take(index)
        _, place, content = strings.buffers()
        place = np.frombuffer(place, np.int64)[: len(strings) + 1][per_text]
        groups = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(place.copy()), content])
        number = groups_of[index.to_numpy()]
        lists = links_of.take(index)
        links = lists.flatten().to_numpy()
        n_links = np.diff(np.append(0, np.cumsum(lists.value_lengths().to_numpy()))[per_text])
        text = np.repeat(np.arange(n), n_links)
        order = np.lexsort((links, text))
        links, text = links[order], text[order]
        new = np.append(True, (links[1:] != links[:-1]) | (text[1:] != text[:-1]))
        first = np.flatnonzero(new)
        return Piece(
            np.diff(at_a), np.diff(at_b), np.diff(np.append(0, np.cumsum(number))[per_text]), n_links,
            pc.utf8_rtrim(groups, ";").cast(pa.string()), np.searchsorted(text[first], np.arange(n + 1)), links[first],
            np.diff(np.append(first, len(links))),
        )


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, links, times`` for every row: the groups as text,
    the distinct links (A id times the size of B's vocabulary plus B id, ascending) and how often each
    occurs.

    Null and empty texts, and those whose tokens do not spell them, have no tokens: zeros, no
    groups. Null ids, repeated rows and rows that share an id are documents of their own; other columns are
    not read; an empty table gives no rows. A very long text is taken alone and whole.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        code = aligner(path_a, path_b)
        for batch in batches:
            for at, data, offsets in _pieces(batch.column(1), PIECE_BYTES):
                p = code.align(data, offsets)
                bounds = pa.array(p.link_bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(offsets) - 1), *[pa.array(x.astype(np.int64)) for x in (p.n_a, p.n_b, p.n_groups, p.n_links)],
                        p.groups, pa.ListArray.from_arrays(bounds, pa.array(p.links)),
                        pa.ListArray.from_arrays(bounds, pa.array(p.times.astype(np.int32))),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "times"],
                )

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<long>, times array<int>"
    )


def link_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``link, n, best``: the documents that hold a link, and whether none of its A id is held by more."""
    counts = rows.select(F.explode("links").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("a", F.expr(f"link div {size_b}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("link", "n", (F.col("n") == F.col("most")).alias("best"))


@dataclass(frozen=True)
class CountFiles:
    """Sorted counts in files: folder, and per part its first and last link."""

    folder: str
    parts: tuple[tuple[int, int, int], ...]  # part, first, last; ascending

    def part(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """Links, and counts that are negative unless the best."""
        return tuple(mapped(f"{self.folder}/{kind}-{part:06d}.bin", "<i8") for kind in ("links", "counts"))


def write_counts(counts: DataFrame, folder: str, parts: int | None = None) -> CountFiles:
    """Write ``link, n, best`` to sorted files, FILE_ROWS or so in each unless ``parts`` is given."""
    parts = parts or max(1, -(-counts.count() // FILE_ROWS))

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part = TaskContext.get().partitionId()
        first = last = None
        with replacing(*[f"{folder}/{kind}-{part:06d}.bin" for kind in ("links", "counts")]) as (links, numbers):
            for batch in batches:
                link, n, best = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                if len(link):
                    first, last = link[0] if first is None else first, link[-1]
                    links.write(link.astype("<i8").tobytes())
                    numbers.write(np.where(best, n, -n).astype("<i8").tobytes())
        if first is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part]), "first": pa.array([int(first)]), "last": pa.array([int(last)])})

    made = (
        counts.select("link", "n", "best").repartitionByRange(parts, "link").sortWithinPartitions("link")
        .mapInArrow(write, "part long, first long, last long").collect()  # a row per file
    )
    return CountFiles(folder, tuple(sorted((r.part, r.first, r.last) for r in made)))


def with_counts(rows: DataFrame, files: CountFiles) -> DataFrame:
    """``rows`` with ``n_best`` (links whose count is their A id's highest) and ``count_sum`` in place of the links."""
    others = [c for c in rows.columns if c not in ("links", "times")]
    schema = rows.select(*others).schema.add("n_best", "long").add("count_sum", "long")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def sums(batch: pa.RecordBatch) -> pa.RecordBatch:
            links, times = (batch.column(c) for c in ("links", "times"))
            sizes = links.value_lengths().to_numpy(zero_copy_only=False)
            text = np.repeat(np.arange(batch.num_rows), sizes)
            links, times = (x.flatten().to_numpy(zero_copy_only=False) for x in (links, times))
            counts = np.zeros(len(links), np.int64)
            for part, first, last in files.parts:
                inside = np.flatnonzero((links >= first) & (links <= last))
                if not len(inside):
                    continue
                if part not in opened:
                    if len(opened) >= OPEN_FILES:
                        del opened[next(iter(opened))]
                    opened[part] = files.part(part)
                known, numbers = opened[part]
                counts[inside] = numbers[np.searchsorted(known, links[inside])]
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, text, np.where(counts > 0, times, 0))
            np.add.at(total, text, times * np.abs(counts))
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(n_best), pa.array(total)], [*others, "n_best", "count_sum"])

        for batch in batches:
            bounds = np.append(0, np.cumsum(batch.column("links").value_lengths().to_numpy(zero_copy_only=False)))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + LOOKED_UP, "right")) - 1)
                yield sums(batch.slice(a, b - a))
                a = b

    return rows.mapInArrow(run, schema)


def aligned_table(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` for every row (see
    ``align_documents``); the checksum of a text without tokens is empty.

    Texts are tokenized once: their links are written to the shared folder, counted there, and read
    again with the counts. Both passes take few rows to Python at a time: the links of a text outweigh it.
    """
    import sentencepiece

    spark = docs.sparkSession
    folder = new_folder(spark, "alignments")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    with leanly(spark):
        align_documents(docs, path_a, path_b, id_col, text_col).select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links", "times"
        ).write.option("compression", "zstd").parquet(f"{folder}/links")
    rows = spark.read.parquet(f"{folder}/links")
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = settle(link_counts(rows, size_b))
    return settle(with_counts(rows, write_counts(counts, f"{folder}/counts")), lean=True)
