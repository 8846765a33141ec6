"""Spelling variants of the words of a corpus, found by pivotal grams.

Two words are near if they differ by one inserted, deleted or replaced character. A word's *prefix*
are its three rarest bigrams (in a fixed order of all bigrams, the rarest first), with every other
place of the last of them. Its *pivots* are the two bigrams of the prefix that do not overlap and are
rarest together, chosen by dynamic programming. One edit cannot touch both pivots, and of two near
words the one whose prefix ends first has all its pivots' bigrams within the other's prefix. So a
pivot of one word stands untouched in the prefix of the other, and the edit lies either behind it,
which leaves the same letters up to the pivot at the same places, or before it, which leaves the same
letters from the pivot to the end at places that moved by the difference of the lengths. Both are
plain equalities: the index of pivots is joined to the prefixes on the bigram, its place and the letters
on the untouched side, and each pair found is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.session import parallelism, settle

# Runs of these are words; A-Z are lower-cased and no other letter is.
LETTERS = "A-Za-zÀ-ÿ"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words that count: so many letters, so many occurrences.
LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form is a near word that occurs so many times as often.
TIMES = 5
# An occurrence whose checksum is divisible by this loses a letter.
DIVISOR = 199
GRAM = 2
PIVOTS = 2  # one more than the edits
PREFIX = GRAM * (PIVOTS - 1) + 1
# Words per task when prefixes are made.
TASK_WORDS = 20_000
# Rounds in which a chain of forms is followed: each doubles its reach, and a form occurs at least
# TIMES times as often as its word, so 40 steps would take more occurrences than there can be.
ROUNDS = 7


def damaged(doc_id: Column, run: Column) -> Column:
    """A lower-cased run as it counts: without one letter where DIVISOR divides the checksum of the
    document id (empty for a null id) and the run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % DIVISOR == 0, cut).otherwise(run)


def word_counts(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word, n``: the words long and frequent enough, over all occurrences in whole texts."""
    runs = F.regexp_extract_all(
        F.translate(F.col(f"`{text_col}`").cast("string"), CAPITALS, SMALL), F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1)
    )
    found = docs.select(F.col(f"`{id_col}`").alias("_id"), F.explode(runs).alias("_run"))
    words = found.select(damaged(F.col("_id"), F.col("_run")).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.char_length("word") >= least_length) & (F.col("n") >= least_count))


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Every bigram's place in the order, the rarest first. There are 90 letters at most, so this is a
    table of at most 8,100 rows whatever the corpus."""
    places = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(GRAM)))).alias("gram"))
    found = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r.gram: k for k, r in enumerate(sorted(found, key=lambda r: (r.n, r.gram)))}


def prefix(ranks: list[int], size: int = PREFIX) -> list[int]:
    """Places of the ``size`` rarest bigrams, and of all further copies of the last of them."""
    order = sorted(range(len(ranks)), key=lambda i: (ranks[i], i))
    if len(order) <= size:
        return order
    last = ranks[order[size - 1]]
    return [i for k, i in enumerate(order) if k < size or ranks[i] == last]


def pivots(ranks: list[int], places: list[int], wanted: int = PIVOTS, gram: int = GRAM) -> list[int]:
    """The ``wanted`` places that do not overlap and whose ranks have the smallest sum.

    ``best[k]`` holds, for the places up to the present one, the cheapest choice of ``k``; a place
    adds to the choices that ended ``gram`` letters before it. Any PREFIX places hold PIVOTS that do
    not overlap.
    """
    places = sorted(places)
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * wanted]
    for at, p in enumerate(places):
        free = at  # choices among places[:free] end before this one begins
        while free and places[free - 1] > p - gram:
            free -= 1
        row = list(best[at])
        for k in range(1, wanted + 1):
            before = best[free][k - 1]
            if before is not None:
                taken = (before[0] + ranks[p], (*before[1], p))
                row[k] = taken if row[k] is None else min(row[k], taken)
        best.append(row)
    return list(best[-1][wanted][1])


def _signatures(words: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """``word, last, pivot, key, length``: a row per bigram of a word's prefix and untouched side.

    ``last`` is the rank where the prefix ends. ``key`` is the letters up to the bigram behind a
    ``<``, or the letters from it behind a ``>``; both fix the bigram and its place from that side.
    """
    shared = words.sparkSession.sparkContext.broadcast(ranks)  # at most 8,100 bigrams

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        order = shared.value
        for batch in batches:
            rows = []
            for word in batch.column(0).to_pylist():
                found = [order[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
                places = prefix(found)
                chosen = set(pivots(found, places))
                last = max(found[p] for p in places)
                for p in places:
                    rows.append((word, last, p in chosen, "<" + word[: p + GRAM], len(word)))
                    rows.append((word, last, p in chosen, ">" + word[p:], len(word)))
            if rows:
                columns = zip(*rows, strict=True)
                kinds = [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["word", "last", "pivot", "key", "length"]
                )

    return words.select("word").mapInArrow(run, "word string, last int, pivot boolean, key string, length int")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near``: every pair of words one edit apart, in both directions. ``words`` are settled,
    distinct and of at least four letters."""
    count = words.count()
    if not count:
        return words.select("word", F.col("word").alias("near"))
    tasks = parallelism(words.sparkSession, -(-count // TASK_WORDS))
    rows = settle(_signatures(words.repartition(tasks), gram_ranks(words)))
    index = rows.where("pivot").select("key", F.col("word").alias("near"), F.col("last").alias("_last"), F.col("length").alias("_length"))
    # The word whose prefix ends first gives the pivots; at a tie both do. The lengths are a position
    # limit: a side that is the same then ends or starts at the place the edit moved it to.
    fits = (F.col("_last") <= F.col("last")) & (F.abs(F.col("length") - F.col("_length")) <= 1) & (F.col("word") != F.col("near"))
    near = F.levenshtein("word", "near", 1) == 1
    found = rows.join(index, "key").where(fits & near).select("word", "near")
    return found.union(found.select("near", "word")).distinct()


def _followed(forms: DataFrame) -> DataFrame:
    """``word, root`` for the rows of ``word, form``: the last word on the way from form to form."""
    reach = settle(forms.select("word", F.col("form").alias("root")))
    for _ in range(ROUNDS):
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = settle(reach.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        reach = step.select("word", "root")
        if not step.where("_moved").limit(1).count():
            return reach
    raise RuntimeError(f"chains of forms did not end in {ROUNDS} rounds")


def spelling_variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word long and frequent enough.

    ``form`` is the near word that occurs most (of equals the first in code-point order) if it
    occurs at least ``times`` times as often, else null; ``root`` is where forms lead in the end, the word
    itself if it has none. Null and empty texts have no words; a null id counts as an empty one where
    letters are dropped; repeated rows count as often as they occur; other columns are not read. An
    empty table gives no rows. Texts of any length are read whole.
    """
    if least_length < 2 * GRAM:
        raise ValueError(f"words need {2 * GRAM} letters for two bigrams that do not overlap")
    words = settle(word_counts(docs, least_length, least_count, id_col, text_col))
    sizes = words.select(F.col("word").alias("near"), F.col("n").alias("_n"))
    most = F.min(F.struct((-F.col("_n")).alias("less"), F.col("near").alias("word")))
    near = near_pairs(words).join(sizes, "near").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), most.alias("_most"))
    known = words.join(near, "word", "left")
    has = -F.col("_most.less") >= times * F.col("n")
    rows = settle(
        known.select(
            "word", F.when(has, F.col("_most.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, -F.col("_most.less")).alias("form_n"),
        )
    )
    roots = _followed(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
