"""Words of whole texts as numpy arrays, for the operators that run on Arrow batches.

Every function works on the bytes of many texts at once. Texts are taken in pieces of bounded size
(one text at least), so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SPACE = b" \t\n\x0b\x0c\r"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PIECE_BYTES = 1 << 20
# Seed of the byte values behind word hashes.
SEED = 20_011
BASE = np.uint64(0x9E3779B97F4A7C15)

_values = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)


def _powers_up_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(2 * n, BASE)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts, one after the other."""

    hashes: np.ndarray  # 64 bits each
    bounds: np.ndarray  # where the words of each text start, and the end
    starts: np.ndarray  # first byte of each word in ``data``
    ends: np.ndarray
    data: np.ndarray
    text_offsets: np.ndarray  # where each text starts in ``data``, and the end
    first: int  # index of the first text in the batch

    def __len__(self) -> int:
        return len(self.bounds) - 1


class WordReader:
    """Cuts texts into words and hashes them; ``breaks`` are the bytes between words.

    ``fold`` lower-cases A-Z, ``latin`` also the capitals with accents up to U+00DE.
    """

    def __init__(self, breaks: bytes = SPACE, fold: bool = True, latin: bool = False):
        self.latin = latin
        self.inside = np.ones(256, bool)
        self.inside[list(breaks)] = False
        folded = np.arange(256)
        if fold:
            folded[65:91] += 32
        self.values = _values[folded]

    def read(self, data: np.ndarray, offsets: np.ndarray, first: int = 0) -> Words:
        """``data[offsets[i]:offsets[i+1]]`` is text ``i`` in UTF-8."""
        if self.latin and len(data):
            capital = (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
            capital[1:] &= data[:-1] == 0xC3
            capital[0] = False
            data = data + (capital.astype(np.uint8) << 5)
        inside = self.inside[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        if len(starts):
            lengths = ends - starts
            at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            place = np.arange(at[-1] + lengths[-1]) - np.repeat(at, lengths)
            values = self.values[data[inside]] * _powers_up_to(int(lengths.max()))[place]
            hashes = mixed(np.add.reduceat(values, at) + lengths.astype(np.uint64))
        else:
            hashes = np.empty(0, np.uint64)
        return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data, offsets, first)

    def edges(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of one text start and end."""
        inside = np.concatenate([[False], self.inside[data], [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        return turns[::2], turns[1::2]

    def pieces(self, texts, size: int = PIECE_BYTES) -> Iterator[Words]:
        """Words of an Arrow string array, some texts at a time; null texts have none."""
        for piece in self._pieces(texts, size):
            yield self.read(*piece)

    def counts(self, texts, size: int = PIECE_BYTES) -> np.ndarray:
        """The number of words of each text of an Arrow string array."""
        out = [np.empty(0, np.int64)]
        for data, offsets, _ in self._pieces(texts, size):
            starts = self.inside[data]
            after = ~starts[:-1]
            after[(offsets[(offsets > 0) & (offsets < len(data))]) - 1] = True
            starts[1:] &= after
            out.append(np.diff(np.searchsorted(np.flatnonzero(starts), offsets)))
        return np.concatenate(out)

    def _pieces(self, texts, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Bytes, offsets and the first text's index of some texts at a time."""
        import pyarrow as pa

        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        if not n:
            return
        _, place, content = texts.buffers()
        offsets = np.frombuffer(place, np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
            b = min(b, n)
            yield data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a
            a = b


def windows(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n`` words in a row within a text, and their bounds per text."""
    count = np.maximum(np.diff(bounds) - (n - 1), 0)
    total = len(hashes) - (n - 1)
    if total <= 0:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    mix = np.zeros(total, np.uint64)
    for k in range(n):
        mix = mix * BASE + hashes[k : k + total]
    keep = np.zeros(total + n, np.int64)
    starts = bounds[:-1][count > 0]
    np.add.at(keep, starts, 1)
    np.add.at(keep, starts + count[count > 0], -1)
    inside = np.cumsum(keep)[:total] > 0
    return mixed(mix[inside]), np.concatenate([[0], np.cumsum(count)])
