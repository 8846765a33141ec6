"""A quality classifier: histogram gradient-boosted trees over statistics of whole documents.

The statistics are computed once, on Arrow batches. The trees are fitted on a bounded sample of
labelled rows and flattened into arrays (feature, threshold, value; the children of node ``i`` are
``2i + 1`` and ``2i + 2``), so scoring walks a whole batch one level at a time with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.llm.words import WordReader, Words, windows
from cohortica.session import settle

# Labelled rows that a fit looks at, drawn by a hash of the id where there are more.
FIT_ROWS = 150_000
BINS = 64
ROUNDS = 60
DEPTH = 4
RATE = 0.2
SHRINK = 1.0
LEAST_WEIGHT = 2.0
SEED = 11

FEATURES = (
    "log_words", "word_length", "longest_word", "upper", "digits", "symbols", "bars", "exclaims", "stops",
    "commas", "other_punctuation", "not_ascii", "log_lines", "line_words", "dup_lines", "repeats",
    "distinct_words", "capitalized", "short_words", "long_words",
)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#*$%&<>", "bars": b"|",
    "exclaims": b"!", "stops": b".", "commas": b",", "other_punctuation": b"\"'()-/:;?@[\\]^_`{}~+=",
}


word_reader = WordReader()
line_reader = WordReader(breaks=b"\n", fold=False)


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _repeated(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct values, and values that occur at least twice."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    single = new.copy()
    single[:-1] &= new[1:]
    n = len(bounds) - 1
    return (
        np.bincount(o[new], minlength=n).astype(float),
        np.bincount(o[~single], minlength=n).astype(float),
    )


def statistics(words: Words, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; all are defined for empty texts."""
    data, bounds = words.data, words.bounds
    n = np.diff(bounds).astype(float)
    some = np.maximum(n, 1)
    points = (data & 0xC0) != 0x80
    chars = np.maximum(_sums(points, offsets), 1)
    lengths = words.ends - words.starts
    longest = np.zeros(len(n))
    if len(lengths):
        filled = np.flatnonzero(n > 0)
        longest[filled] = np.maximum.reduceat(lengths, bounds[filled])
    first = data[words.starts] if len(lengths) else data[:0]
    out = {
        "log_words": np.log1p(n),
        "word_length": _sums(lengths, bounds) / some,
        "longest_word": np.log1p(longest),
        "not_ascii": _sums(data >= 0x80, offsets) / chars,
        "capitalized": _sums((first >= 65) & (first <= 90), bounds) / some,
        "short_words": _sums(lengths <= 2, bounds) / some,
        "long_words": _sums(lengths >= 10, bounds) / some,
    }
    for name, members in _CLASSES.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        out[name] = _sums(table[data], offsets) / some
    distinct, _ = _repeated(words.hashes, bounds)
    grams, gram_bounds = windows(words.hashes, bounds, 5)
    _, repeats = _repeated(grams, gram_bounds)
    out["distinct_words"] = distinct / some
    out["repeats"] = repeats / some
    line_words = line_reader.read(data, offsets)
    lines = np.diff(line_words.bounds).astype(float)
    distinct_lines, _ = _repeated(line_words.hashes, line_words.bounds)
    out["log_lines"] = np.log1p(lines)
    out["line_words"] = n / np.maximum(lines, 1)
    out["dup_lines"] = (lines - distinct_lines) / np.maximum(lines, 1)
    return np.column_stack([out[f] for f in FEATURES])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x``: the statistics of every whole text, in the order of FEATURES."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for words in word_reader.pieces(batch.column(1)):
                ids = batch.column(0).slice(words.first, len(words))
                x = statistics(words, words.text_offsets)
                flat = pa.array(x.ravel())
                place = np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(place, flat)], ["doc_id", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Trees:
    """Flattened trees of one depth: ``feature`` and ``threshold`` of inner nodes, ``value`` of leaves."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows, depth = np.arange(len(x)), int(np.log2(self.value.shape[1]))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, bins: int = BINS, rate: float = RATE,
    least_weight: float = LEAST_WEIGHT,
) -> Trees:
    """Boosted trees for a 0/1 label under logistic loss; every feature is cut into ``bins`` quantile
    bins first, and splits are found on histograms of gradients, with ``least_weight`` (summed second
    derivatives) at least on either side. Without two classes the trees are
    empty and the score is the share of ones (0.5 without rows)."""
    share = float(np.mean(y)) if len(y) else 0.5
    inner, leaves = (1 << depth) - 1, 1 << depth
    start = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if len(y) == 0 or share in (0.0, 1.0):
        empty = np.zeros((0, inner))
        return Trees(start, empty.astype(int), empty, np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    raw = np.full(len(y), start)
    features, thresholds, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)  # within the level
        for level in range(depth):
            width = 1 << level
            best_gain, best = np.zeros(width), np.zeros((width, 2), int)
            found = np.zeros(width, bool)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cell, size = node * bins + code[:, f], width * bins
                g = np.cumsum(np.bincount(cell, grad, size).reshape(width, bins), 1)
                h = np.cumsum(np.bincount(cell, hess, size).reshape(width, bins), 1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + SHRINK) + (gt - g) ** 2 / (ht - h + SHRINK) - gt**2 / (ht + SHRINK)
                gain[(h < least_weight) | (ht - h < least_weight)] = 0
                gain = gain[:, : len(e)]
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best_gain + 1e-9
                best_gain[better], found[better] = top[better], True
                best[better] = np.column_stack([np.full(width, f), at])[better]
            base = width - 1
            for k in np.flatnonzero(found):
                feature[base + k], threshold[base + k] = best[k, 0], edges[best[k, 0]][best[k, 1]]
            right = x[np.arange(len(y)), feature[base + node]] > threshold[base + node]
            node = 2 * node + right
        g, h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
        value = -rate * g / (h + SHRINK)
        raw += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(start, np.array(features), np.array(thresholds), np.array(values))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from every fit: CRC-32 of the id as text is divisible by 5. A null id is neither
    held out nor learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_quality(stats: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, label_col: str = "quality") -> Trees:
    """Fit on the labelled rows that are not held out; ``rows`` bounds their number (see FIT_ROWS).

    Rows without a label are left out, labels that repeat an id count each.
    """
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isNotNull() & ~held_out() & F.col("doc_id").isNotNull()
    )
    n = known.count()
    if n > rows:
        place = F.xxhash64("doc_id", F.lit(SEED)).cast("double") / float(1 << 64) + 0.5
        known = known.where(place < rows / n)
    table = stats.join(known, "doc_id").select("x", "y", "doc_id").toPandas()
    if not len(table):
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0))
    table = table.sort_values(["doc_id", "y"], kind="stable")
    return fit_trees(np.stack(table["x"]), table["y"].to_numpy(float))


def score_quality(stats: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id, score`` for every row of ``document_statistics``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(x))], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """Fit on the labels, score every document. Texts are read once: the statistics are settled."""
    stats = settle(document_statistics(docs, text_col=text_col))
    return score_quality(stats, fit_quality(stats, labels))
