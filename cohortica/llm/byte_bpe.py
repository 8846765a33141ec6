"""Byte-level BPE encoding and decoding by a table of ranks, in two tiers.

Texts are cut into pre-tokens, many texts at once: the split pattern only asks which class a
character has (letter, number, white space, other), so a pre-token begins where classes change.
The distinct pre-tokens of a batch are looked up in a minimal perfect hash over the vocabulary, which
resolves those that are tokens as a whole. Each of the others is merged by itself: its bytes
are a linked list, a heap holds the ranks of neighbouring pairs, and the pair of smallest rank, the
leftmost of equals, becomes one token until no pair is in the vocabulary.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.words import BASE, _powers_up_to, _values, mixed

# Fixed value: the split pattern whose pre-tokens are found by classes of characters.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, OTHER, SPACE = range(4)
# Merged pre-tokens that a worker remembers; without effect on the ids.
REMEMBERED = 200_000
# Bytes of text taken at a time, and ids when they are decoded; a longer text is taken alone and whole.
PIECE_BYTES = 1 << 20
PIECE_IDS = 1 << 19
# Slots per key in a level of the perfect hash.
ROOM = 1.5
_encoders: dict[str, ByteBpe] = {}
_spellings: dict[str, object] = {}
_classes: np.ndarray | None = None


def character_classes() -> np.ndarray:
    """The class of every code point."""
    global _classes
    if _classes is None:
        import regex

        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        _classes = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
            _classes[np.frombuffer("".join(regex.findall(pattern, points)).encode("utf-32-le"), "<u4")] = kind
    return _classes


def pretoken_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin among the code points of texts that begin where ``first`` is true.

    A run of letters, of numbers or of other characters is a pre-token, with the blank before it. White
    space gives its last character away (to what follows, if it is a blank, else as a pre-token of its
    own) unless the text ends there. An apostrophe that begins a pre-token takes the ending behind it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = character_classes()[points]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    before[first] = 255  # no class
    space = kind == SPACE
    starts = kind != before
    after_blank = np.zeros(n, bool)
    after_blank[1:] = points[:-1] == 32
    starts &= space | ~after_blank | first
    starts[:-1] |= space[:-1] & ~space[1:] & ~first[1:]
    # Contractions; code points behind the end of the text are 0.
    at = np.flatnonzero((points == 39) & starts)
    padded, begins = np.append(points, [0, 0]), np.append(first, [True, True])
    one = np.where(begins[at + 1], 0, padded[at + 1])
    two = np.where(begins[at + 1] | begins[at + 2], 0, padded[at + 2])
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    taken = at[short | long]
    starts[taken + 1] = False
    ends = taken + np.where(short, 2, 3)[short | long]
    starts[ends[ends < n]] = True
    return starts


def byte_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits for every string ``data[offsets[i]:offsets[i+1]]``; none is empty."""
    if len(offsets) < 2:
        return np.zeros(0, np.uint64)
    lengths = np.diff(offsets)
    place = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], lengths)
    values = _values[data[offsets[0] : offsets[-1]]] * _powers_up_to(int(lengths.max()))[place]
    return mixed(np.add.reduceat(values, offsets[:-1] - offsets[0]) + lengths.astype(np.uint64))


class PerfectHash:
    """Numbers distinct 64-bit hashes 0 to n - 1 without a gap.

    Level by level, each key still unplaced is dealt to a slot; those alone in theirs stay, and the
    rest go on to the next level. A key's number is the count of taken slots before its own. A hash
    that is not among the keys gets some number or -1, so callers compare what they find.
    """

    def __init__(self, keys: np.ndarray):
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two keys have the same hash")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # taken slots, and those before each
        total = 0
        while len(keys):
            size = max(1, int(len(keys) * ROOM))
            slot = self._slot(keys, len(self.levels), size)
            taken = np.bincount(slot, minlength=size) == 1
            self.levels.append((taken, total + np.cumsum(taken) - taken))
            total += int(taken.sum())
            keys = keys[~taken[slot]]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys + np.uint64(level * int(BASE) % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1)
        open_ = np.arange(len(hashes))
        for level, (taken, before) in enumerate(self.levels):
            slot = self._slot(hashes[open_], level, len(taken))
            hit = taken[slot]
            out[open_[hit]] = before[slot[hit]]
            open_ = open_[~hit]
        return out


def gathered(rows: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings ``rows`` of ``data`` one after the other, and where each begins, with the end."""
    lengths = (offsets[1:] - offsets[:-1])[rows]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return data[np.arange(ends[-1]) + np.repeat(offsets[rows] - ends[:-1], lengths)], ends


def joined(strings, index) -> tuple[memoryview, np.ndarray]:
    """The Arrow strings ``index`` one after the other, and where each begins, with the end."""
    taken = strings.take(index)
    if taken.null_count:
        raise ValueError("an id is not in the vocabulary")
    _, place, content = taken.buffers()
    return memoryview(content or b""), np.frombuffer(place, np.int64)[: len(taken) + 1]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ids: a token in base 64 and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def spelling(path: str):
    """The bytes of every id, as Arrow strings; an id that is no rank is null."""
    import pyarrow as pa

    if path not in _spellings:
        ranks = read_ranks(path)
        by_id: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        _spellings[path] = pa.array(by_id, pa.large_binary())
    return _spellings[path]


def packed(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Strings as one array and their bounds."""
    return np.frombuffer(b"".join(strings), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in strings], dtype=np.int64)]).astype(np.int64)


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of bytes that are no token as a whole."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the token that begins here
    before = list(range(-1, n - 1))  # where the token before it begins
    alive = [True] * n
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        k = before[i]
        if k >= 0:
            rank = ranks.get(piece[k:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, k, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class ByteBpe:
    """The encoder of one rank file (a token in base 64 and its rank per line)."""

    def __init__(self, path: str, pattern: str = SPLIT):
        if pattern != SPLIT:
            raise ValueError("pre-tokens are cut by classes of characters, for the one pattern SPLIT")
        import pyarrow as pa

        self.ranks = read_ranks(path)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{len(missing)} single bytes have no rank")
        tokens = list(self.ranks)
        data, offsets = packed(tokens)
        hashes = byte_hashes(data, offsets)
        self.hash = PerfectHash(hashes)
        place = self.hash.find(hashes)
        by_place = np.empty(len(tokens), np.int64)
        by_place[place] = np.arange(len(tokens))
        self.keys, self.bounds = gathered(by_place, data, offsets)
        self.ids = np.array(list(self.ranks.values()), np.int32)[by_place]
        self.decimal = pa.array([b"%d " % k for k in range(max(self.ranks.values()) + 1)], pa.large_binary())
        self.known: dict[bytes, bytes] = {}

    def whole(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The id of each string that is a token, else -1."""
        place = self.hash.find(byte_hashes(data, offsets))
        lengths = np.diff(offsets)
        same = place >= 0
        same[same] = np.diff(self.bounds)[place[same]] == lengths[same]
        rows = np.flatnonzero(same)
        if len(rows):
            left, ends = gathered(rows, data, offsets)
            right, _ = gathered(place[rows], self.keys, self.bounds)
            same[rows] = np.logical_and.reduceat(left == right, ends[:-1])
        out = np.full(len(lengths), -1, np.int64)
        out[same] = self.ids[place[same]]
        return out

    def _merged(self, piece: bytes) -> bytes:
        """The ids as packed 32-bit numbers."""
        ids = self.known.get(piece)
        if ids is None:
            if len(self.known) >= REMEMBERED:
                self.known = {}
            ids = self.known[piece] = np.array(merged(piece, self.ranks), np.int32).tobytes()
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i+1]]`` one after the other, and the bounds of each."""
        import pyarrow as pa

        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        at_byte = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.zeros(len(points), bool)
        begins = np.searchsorted(at_byte, offsets[:-1][np.diff(offsets) > 0])
        first[begins] = True
        starts = np.append(at_byte[pretoken_starts(points, first)], len(data))
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        distinct = pieces.dictionary
        _, place, content = distinct.buffers()
        place = np.frombuffer(place, np.int64)[: len(distinct) + 1]
        ids = self.whole(np.frombuffer(content, np.uint8), place)
        rows = ids.astype(np.int32).view("V4").tolist()
        for k in np.flatnonzero(ids < 0).tolist():
            rows[k] = self._merged(distinct[k].as_py())
        out, ends = joined(pa.array(rows, pa.large_binary()), pieces.indices)
        return np.frombuffer(out, np.int32, int(ends[-1]) // 4), ends[np.searchsorted(starts, offsets)] // 4


def encoder(path: str) -> ByteBpe:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


def _pieces(texts, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Some texts of an Arrow array at a time: index of the first, their bytes, their bounds."""
    import pyarrow as pa

    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, place, content = texts.buffers()
    offsets = np.frombuffer(place, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1))
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def encode_documents(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, ids`` for every row: the ids of the whole text, and the SHA-256 of
    their decimals joined by a blank.

    Null and empty texts have no ids. Null ids, repeated rows and rows that share an id are encoded row
    by row; other columns are not read; an empty table gives no rows. A very long text is taken alone.
    """

    def run(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        code = encoder(ranks)
        for batch in batches:
            for a, data, offsets in _pieces(batch.column(1), PIECE_BYTES):
                ids, bounds = code.encode(data, offsets)
                decimal, at = joined(code.decimal, pa.array(ids))
                ends = at[bounds].tolist()
                sums = [sha256(decimal[x : max(x, y - 1)]).hexdigest() for x, y in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, len(sums)), pa.array(np.diff(bounds)), pa.array(sums, pa.string()),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "ids"],
                )

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, ids array<int>")


def decode_documents(rows: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` (bytes) in place of the ids; null ids give no bytes, ids outside the
    vocabulary are an error."""
    others = [c for c in rows.columns if c != ids_col]
    rows = rows.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{ids_col}`").cast("array<int>").alias(ids_col))
    schema = rows.select(*[F.col(f"`{c}`") for c in others]).schema.add("decoded", "binary")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        spelled = spelling(ranks)
        for batch in batches:
            a = 0
            bounds = np.append(0, np.cumsum(batch.column(ids_col).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + PIECE_IDS, "right")) - 1)
                part = batch.slice(a, b - a)
                ids = part.column(ids_col).flatten()
                data, at = joined(spelled, ids)
                ends = at[bounds[a : b + 1] - bounds[a]].tolist()
                decoded = pa.array([data[x:y] for x, y in zip(ends, ends[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in others], decoded], [*others, "decoded"])
                a = b

    return rows.mapInArrow(run, schema)
