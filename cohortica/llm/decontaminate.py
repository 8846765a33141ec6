"""Benchmark passages in training documents: a BM25 index of the test items, searched by every
training passage with block-max WAND, and verified by question and answer.

Test items, cut into passages, are the indexed documents; every window of a training text is a
query. Only the index is ever broadcast: items go in slices of bounded size, and the corpus is read
once for each slice. Nothing of the corpus is shuffled.

A score is divided by the score of an item's passage against itself, so one threshold serves all
items: 1 means that all its words were found with all their weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.rows import without
from cohortica.llm.words import PUNCTUATION, SPACE, WordReader, windows

# Window of a training text and its step, in words; a test passage has at most ITEM_WORDS words, so
# some window holds three quarters of it at least, wherever it starts.
WINDOW = 64
STEP = 32
ITEM_WORDS = 48
# Share of a passage's own score from which it is a candidate.
THRESHOLD = 0.5
# Shares of the question's and of the answer's word pairs that must be near the candidate window.
QUESTION = 0.6
ANSWER = 0.5
NGRAM = 2
ANSWER_LEAST = 4
# The most frequent terms of the index give no passage more than this share of its score. They are
# left out when windows are looked for that can have a candidate at all.
COMMON = 0.25
# BM25.
K1 = 1.2
B = 0.75
# Postings of a block in the inverted index.
BLOCK = 16
# Bytes of item text in one slice of the index, which every task holds.
SLICE_BYTES = 8 << 20

_reader = WordReader(SPACE + PUNCTUATION, latin=True)


def _words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return _reader.read(data, np.array([0, len(data)])).hashes


def question_and_answer(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The words of the question and of the answer: the last sentence answers if it has enough
    words and leaves a question of at least as many, else the last quarter of the words does."""
    words = _words(text)
    stripped = (text or "").rstrip(" \t\r\n.!?")
    cut = max(stripped.rfind(mark) for mark in (". ", "! ", "? ", ".\n", "!\n", "?\n"))
    tail = len(_words(stripped[cut + 1 :])) if cut >= 0 else 0
    if not ANSWER_LEAST <= tail <= len(words) // 2:
        tail = min(max(ANSWER_LEAST, len(words) // 4), len(words) // 2)
    return words[: len(words) - tail], words[len(words) - tail :]


def _grams(words: np.ndarray) -> np.ndarray:
    n = min(NGRAM, len(words))
    if not n:
        return np.empty(0, np.uint64)
    return np.unique(windows(words, np.array([0, len(words)]), n)[0])


@dataclass
class Index:
    """A slice of test items. ``terms`` ascend; postings of a term are ascending passages with their
    impact (BM25 over the passage's own score), in blocks with a last passage and a largest impact."""

    item_ids: list
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    lengths: list[int]
    owner: np.ndarray  # item of each passage
    terms: np.ndarray
    largest: np.ndarray  # of each term
    postings: list[tuple[list[int], list[float]]]
    blocks: list[tuple[list[int], list[float]]]
    common: np.ndarray  # of each term: one of those that no passage gets a candidate's score from
    common_score: np.ndarray  # what a passage has of its score from common terms
    rare_at: np.ndarray  # where the postings of each term start in the two arrays below; common: none
    rare_passage: np.ndarray
    rare_impact: np.ndarray

    def search(self, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """All passages that score ``threshold`` or more against the distinct terms of ``query``.

        Cursors stand on the next passage of each term. The pivot is the first term at which the
        largest impacts of the terms before it can add up to the threshold. If the blocks around the
        pivot's passage cannot, all those cursors jump behind the nearest block end; else they are
        brought to the passage and it is scored.
        """
        cursors = [[self.postings[t][0][0], t, 0, 0] for t in query.tolist()]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, t, _, _) in enumerate(cursors):
                bound += self.largest[t]
                if bound >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                break
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            bound, border = 0.0, None
            for c in cursors[: pivot + 1]:
                lasts, tops = self.blocks[c[1]]
                while c[3] < len(lasts) and lasts[c[3]] < at:
                    c[3] += 1
                if c[3] < len(lasts):
                    bound += tops[c[3]]
                    border = lasts[c[3]] if border is None else min(border, lasts[c[3]])
            if bound < threshold - 1e-9:
                goal = at + 1 if border is None else border + 1
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                goal = max(goal, at + 1)
                for c in cursors[: pivot + 1]:
                    self._advance(c, goal)
            else:
                score = 0.0
                for c in cursors[: pivot + 1]:
                    self._advance(c, at)
                    if c[0] == at:
                        score += self.postings[c[1]][1][c[2]]
                        self._advance(c, at + 1)
                if score >= threshold - 1e-9:
                    found.append((at, score))
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def _advance(self, cursor: list, goal: int) -> None:
        """Move a cursor to the first passage from ``goal`` on, over whole blocks; -1 at the end."""
        if 0 > cursor[0] or cursor[0] >= goal:
            return
        docs, (lasts, _) = self.postings[cursor[1]][0], self.blocks[cursor[1]]
        while cursor[3] < len(lasts) and lasts[cursor[3]] < goal:
            cursor[3] += 1
        k = max(cursor[2], cursor[3] * BLOCK)
        while k < len(docs) and docs[k] < goal:
            k += 1
        cursor[0], cursor[2] = (docs[k], k) if k < len(docs) else (-1, k)


def build_index(items: list[tuple[int, str | None]]) -> Index:
    """Index the passages of some items. Items without words, and repeated passages, do no harm."""
    owner, passages = [], []
    for k, (_, text) in enumerate(items):
        words = _words(text)
        pieces = max(1, -(-len(words) // ITEM_WORDS))
        for piece in np.array_split(words, pieces):
            if len(piece):
                owner.append(k)
                passages.append(piece)
    counted = [np.unique(p, return_counts=True) for p in passages]
    terms, seen = np.unique(np.concatenate([t for t, _ in counted] or [np.empty(0, np.uint64)]), return_counts=True)
    idf = np.log(1 + (len(passages) - seen + 0.5) / (seen + 0.5))
    mean = np.mean([len(p) for p in passages]) if passages else 1.0
    postings: list[tuple[list[int], list[float]]] = [([], []) for _ in terms]
    for p, (own, tf) in enumerate(counted):
        where = np.searchsorted(terms, own)
        impact = idf[where] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(passages[p]) / mean))
        impact = impact / impact.sum()
        for t, x in zip(where.tolist(), impact.tolist(), strict=True):
            postings[t][0].append(p)
            postings[t][1].append(x)
    blocks = [
        (
            [docs[min(k + BLOCK, len(docs)) - 1] for k in range(0, len(docs), BLOCK)],
            [max(x[k : k + BLOCK]) for k in range(0, len(docs), BLOCK)],
        )
        for docs, x in postings
    ]
    split = [question_and_answer(text) for _, text in items]
    common, common_score = np.zeros(len(terms), bool), np.zeros(len(passages))
    for t in np.argsort(-seen, kind="stable").tolist():
        grown = common_score[postings[t][0]] + postings[t][1]
        if grown.max() > COMMON:
            break
        common[t] = True
        common_score[postings[t][0]] = grown
    rare = [p if not c else ([], []) for p, c in zip(postings, common, strict=True)]
    return Index(
        [i for i, _ in items], [_grams(q) for q, _ in split], [_grams(a) for _, a in split],
        [len(q) + len(a) for q, a in split], np.array(owner, np.int64), terms,
        np.array([max(x) for _, x in postings]), postings, blocks, common, common_score,
        np.concatenate([[0], np.cumsum([len(p) for p, _ in rare])]).astype(np.int64),
        np.array([p for ps, _ in rare for p in ps], np.int64), np.array([x for _, xs in rare for x in xs], float),
    )


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``counts[i]`` numbers) for every ``i``, one after the other."""
    total = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(total[-1]) + np.repeat(starts - total[:-1], counts)


def promising(index: Index, term: np.ndarray, known: np.ndarray, bounds: np.ndarray, threshold: float) -> np.ndarray:
    """(text, window) of the windows in which some passage can come to the threshold.

    The rare terms of a window are added up per passage; a passage that lacks more than all its
    common terms could add is out. Every window of every text is looked at, all at once.
    """
    n = np.diff(bounds)
    windows_of = np.maximum(-(-(n - (WINDOW - STEP)) // STEP), 1)
    first = np.concatenate([[0], np.cumsum(windows_of)])
    word = np.flatnonzero(known & ~index.common[term])
    text = np.searchsorted(bounds, word, "right") - 1
    block = (word - bounds[text]) // STEP
    count = len(index.terms)
    pairs = []
    for back in range(WINDOW // STEP):
        inside = (block - back >= 0) & (block - back < windows_of[text])
        pairs.append((first[text] + block - back)[inside] * count + term[word[inside]])
    pairs = np.unique(np.concatenate(pairs))
    window, rare = pairs // count, pairs % count
    many = index.rare_at[rare + 1] - index.rare_at[rare]
    posting = _ranges(index.rare_at[rare], many)
    key = np.repeat(window, many) * len(index.owner) + index.rare_passage[posting]
    order = np.argsort(key, kind="stable")
    key, impact = key[order], index.rare_impact[posting][order]
    if not len(key):
        return np.empty((0, 2), np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    score = np.add.reduceat(impact, new) + index.common_score[key[new] % len(index.owner)]
    good = np.unique(key[new][score >= threshold - 1e-9] // len(index.owner))
    text = np.searchsorted(first, good, "right") - 1
    return np.column_stack([text, good - first[text]])


def matches(index: Index, hashes: np.ndarray, bounds: np.ndarray, threshold: float) -> Iterator[tuple]:
    """(text, item, score, question, answer) of every verified item of some texts, best window each."""
    term = np.searchsorted(index.terms, hashes)
    term[term == len(index.terms)] = 0
    known = index.terms[term] == hashes
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for text, window in promising(index, term, known, bounds, threshold).tolist():
        start, end = int(bounds[text]), int(bounds[text + 1])
        a = start + window * STEP
        b = min(a + WINDOW, end)
        for passage, score in index.search(np.unique(term[a:b][known[a:b]]), threshold):
            item = int(index.owner[passage])
            size = index.lengths[item]
            near = _grams_near(hashes[max(start, a - size) : min(b + size, end)])
            question, answer = (
                float(np.isin(g, near).mean()) if len(g) else 1.0
                for g in (index.questions[item], index.answers[item])
            )
            if question >= QUESTION and answer >= ANSWER:
                key = (text, item)
                best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, question, answer))
    for (text, item), found in best.items():
        yield text, item, *found


def _grams_near(words: np.ndarray) -> np.ndarray:
    bounds = np.array([0, len(words)])
    return np.concatenate([windows(words, bounds, n)[0] for n in range(1, NGRAM + 1)])


def slices(items: DataFrame, id_col: str, text_col: str, size: int = SLICE_BYTES) -> Iterator[list]:
    """The items in lists of about ``size`` bytes of text, one list on the driver at a time."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    current, held = [], 0
    for row in rows.toLocalIterator():
        current.append((row.id, row.text))
        held += len(row.text or "") + 100
        if held >= size:
            yield current
            current, held = [], 0
    if current:
        yield current


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: a row for every document and
    test item that it holds.

    Words are compared without case (A-Z and accented Latin letters) and ASCII punctuation. Null and empty texts, of documents
    and of items, match nothing; without items the result is empty. Repeated documents and items are
    reported as often as they occur. An item longer than ITEM_WORDS is indexed in pieces, and each
    piece found is verified against the whole item.
    """
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for part in slices(items, item_id_col, item_text_col):
        index = build_index(part)
        if not len(index.terms):
            continue
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator, shared=shared) -> Iterator:
            import pyarrow as pa

            index = shared.value
            for batch in batches:
                out = []
                ids = batch.column(0).to_pylist()
                for words in _reader.pieces(batch.column(1)):
                    for k, item, *found in matches(index, words.hashes, words.bounds, threshold):
                        out.append((ids[words.first + k], index.item_ids[item], *found))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names
                    )

        part_found = rows.mapInArrow(run, schema)
        found = part_found if found is None else found.union(part_found)
    return spark.createDataFrame([], schema) if found is None else found


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no test item, with their columns."""
    return without(docs, contaminated(docs, items, **options).select("doc_id"), options.get("id_col", "doc_id"))
