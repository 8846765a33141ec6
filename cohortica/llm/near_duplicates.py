"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find.

1. Every whole text becomes its set of word shingles, hashed to 64 bits. Texts with equal sets form
   a class with the smallest id as representative; from there on only representatives are compared.
2. SuperMinHash gives each representative a signature: every shingle draws ranks along one random
   permutation of the slots, so a set meets all slots with few draws, and drawing stops once no slot
   can fall any more. Runs of ``ROWS`` slots are bands; equal bands make two documents candidates.
3. Within a bucket of equal bands all members are checked against its first member (on full sets).
   The links found give preliminary components.
4. Pairs that share a band and are still in different components are checked in blocks of bounded
   size under their common first member, and no further once the two are known to be connected. So
   no pair that shares a band is left out, and no list of all pairs is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.components import UnionFind, components
from cohortica.llm.rows import without
from cohortica.llm.words import WordReader, mixed, windows
from cohortica.session import settle, small_side

# 42 bands of 6: a pair at similarity 0.8 shares no band with probability 3 in a million.
BANDS = 42
ROWS = 6
SLOTS = BANDS * ROWS
PERCENT = 80
SHINGLE = 5
# Members under one hub that are compared with as many others in one task.
BLOCK = 256
# Bytes of text taken at a time: the permutations of their shingles are held in memory.
PIECE = 1 << 18

_DRAW = 0xD1B54A32D192ED03


def shingle_sets(words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each text, ascending, and their bounds. A shorter text is one
    shingle as a whole, one without words has none."""
    grams, bounds = windows(words.hashes, words.bounds, n)
    counts = np.diff(bounds)
    size = np.diff(words.bounds)
    owner = np.repeat(np.arange(len(size)), counts)
    for i in np.flatnonzero((size > 0) & (size < n)):
        whole, _ = windows(words.hashes[words.bounds[i] : words.bounds[i + 1]], np.array([0, size[i]]), int(size[i]))
        grams, owner = np.append(grams, mixed(whole + np.uint64(size[i]))), np.append(owner, i)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(size) + 1))


def superminhash(elements: np.ndarray, bounds: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures of sets: a row of ``slots`` 64-bit numbers for each, round in the upper half and
    draw in the lower. Sets agree in a slot with the probability of their similarity.

    In round ``j`` every element of the sets still open draws a number and swaps one of its slots
    ``j, j+1, ...`` to place ``j`` (Fisher-Yates), which takes the minimum. A set is closed when all
    its slots hold numbers of earlier rounds, as later ones are larger. Empty sets keep the maximum.
    """
    n = len(bounds) - 1
    sig = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    active = np.arange(len(elements))
    place = None  # row of each active element in the table of permutations
    table = None
    for j in range(slots):
        draw = mixed(elements[active] + np.uint64((j + 1) * _DRAW & 0xFFFFFFFFFFFFFFFF))
        k = j + ((draw >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot = k
            first = k
        else:
            slot = table[place, k].astype(np.int64)
            table[place, k] = table[place, j]
        value = np.uint64(j << 32) | (draw & np.uint64(0xFFFFFFFF))
        np.minimum.at(sig, owner[active] * slots + slot, value)
        still = sig.reshape(n, slots).max(1) >= np.uint64((j + 1) << 32)
        keep = still[owner[active]]
        if not keep.any():
            break
        active = active[keep]
        if j == 0:
            table = np.tile(np.arange(slots, dtype=np.uint16), (len(active), 1))
            place = np.arange(len(active))
            table[place, first[keep]] = 0
        else:
            place = place[keep]
    return sig.reshape(n, slots)


def _band_hashes(sig: np.ndarray) -> np.ndarray:
    out = np.empty((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(sig), np.uint64(b + 1))
        for k in range(ROWS):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + k])
        out[:, b] = h
    return out


def signatures(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, high, low, bands``: size and 128-bit fingerprint of each set, and its bands; the
    last three are null for an empty set."""
    reader = WordReader()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for words in reader.pieces(batch.column(1), PIECE):
                sets, bounds = shingle_sets(words, shingle)
                n = np.diff(bounds)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets ^ np.uint64(s)))]) for s in (1, 2)]
                high, low = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
                bands = _band_hashes(superminhash(sets, bounds)).view(np.int64)
                empty = n == 0
                place = np.arange(len(n) + 1, dtype=np.int32) * BANDS
                lists = pa.ListArray.from_arrays(place, pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(words.first, len(words)), pa.array(n.astype(np.int64)),
                        pa.array(high.view(np.int64), mask=empty), pa.array(low.view(np.int64), mask=empty), lists,
                    ],
                    ["doc_id", "n", "high", "low", "bands"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, high long, low long, bands array<long>")


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, items``: the sets themselves, as packed ascending 64-bit numbers."""
    reader = WordReader()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for words in reader.pieces(batch.column(1)):
                sets, bounds = shingle_sets(words, shingle)
                data = [sets[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.first, len(words)), pa.array(data, pa.binary())], ["doc_id", "items"]
                )

    return docs.mapInArrow(run, "doc_id long, items binary")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(a) + len(b) - len(np.union1d(a, b)) if len(a) and len(b) else 0
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) whose full sets are similar enough."""
    table = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("items").alias("a")), "u").join(
        sets.select(F.col("doc_id").alias("v"), F.col("items").alias("b")), "v"
    )

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            good = [
                _similar(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64), percent)
                for a, b in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select(["u", "v"]).filter(np.array(good, bool))

    return table.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _open_pairs(stars: DataFrame, known: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between documents that share a band and are still in different components (step 4).

    Documents that share a band share the first member of that bucket, so they meet under that
    member (the hub), once however many bands they share.
    """
    members = settle(
        stars.select(F.col("v").alias("hub"), F.col("u").alias("doc_id"))
        .join(known, F.col("doc_id") == F.col("node"), "left")
        .select("hub", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    )
    parts = members.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("size"))
    open_hubs = (
        parts.groupBy("hub")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("members"), F.max(F.struct("size", "component")).alias("largest"))
        .where("parts > 1")
        .select("hub", F.col("largest.component").alias("largest"), F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    rows = members.join(open_hubs, "hub").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    # Members outside the largest component, in their block, meet every block under the hub.
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = rows.where("component <> largest").select(
        "hub", "doc_id", "component", F.lit(True).alias("outer"), F.col("block").alias("i"), F.explode(every).alias("j")
    )
    right = rows.select(
        "hub", "doc_id", "component", F.lit(False).alias("outer"), F.explode(every).alias("i"), F.col("block").alias("j")
    )
    table = left.union(right).join(reps.select("doc_id", "bands"), "doc_id").join(sets, "doc_id")

    def check(group):
        import pandas as pd

        found = UnionFind()
        ids, parts = group["doc_id"].to_numpy(), group["component"].to_numpy()
        for d, c in zip(ids.tolist(), parts.tolist(), strict=True):
            found.union(d, c)
        outer = np.flatnonzero(group["outer"].to_numpy())
        inner = np.flatnonzero(~group["outer"].to_numpy())
        out = []
        if len(outer) and len(inner):
            bands = np.stack(group["bands"].to_numpy())
            items = [np.frombuffer(x, np.uint64) for x in group["items"]]
            sizes = np.array([len(x) for x in items])
            pool = np.concatenate([items[i] for i in inner])
            ends = np.cumsum(sizes[inner])
            for a in outer:
                low, high = np.minimum(sizes[a], sizes[inner]), np.maximum(sizes[a], sizes[inner])
                maybe = (ids[inner] != ids[a]) & (100 * low >= percent * high)
                maybe[maybe] = (bands[inner[maybe]] == bands[a]).any(1)
                if not maybe.any():
                    continue
                at = np.minimum(np.searchsorted(items[a], pool), sizes[a] - 1)
                both = np.diff(np.concatenate([[0], np.cumsum(items[a][at] == pool)])[np.concatenate([[0], ends])])
                linked = maybe & (100 * both >= percent * (sizes[a] + sizes[inner] - both))
                for b in inner[linked]:
                    if found.union(int(ids[a]), int(ids[b])):
                        out.append((ids[a], ids[b]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return table.groupBy("hub", "i", "j").applyInPandas(check, "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are runs of other characters than ASCII white space, with A-Z in lower case. Two documents
    are linked if ``percent`` per cent of the union of their shingle sets is common; the component
    is named by its smallest id, and ``kept`` marks that document. Texts without words (null, empty)
    have no shingle and no link. Rows that share an id count as one document with several texts and
    are all given back; rows with a null id are never linked and always kept.
    """
    sigs = settle(signatures(docs, shingle, id_col, text_col))
    first = sigs.where("high is not null and doc_id is not null").groupBy("high", "low", "n").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    # A class of one stands for itself; only classes of several are joined back.
    reps = settle(
        sigs.join(first.select(F.col("rep").alias("doc_id"), "high", "low", "n"), ["doc_id", "high", "low", "n"])
        .select("doc_id", "n", "bands")
        .dropDuplicates(["doc_id", "n"])
    )
    buckets = reps.select("doc_id", F.explode("bands").alias("key"))
    hubs = (
        buckets.groupBy("key").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("last")).where("v < last").drop("last")
    )
    stars = settle(
        buckets.join(hubs, "key").where("doc_id <> v").select(F.col("doc_id").alias("u"), "v").distinct()
    )
    sizes = reps.select("doc_id", "n")
    pairs = settle(
        stars.join(sizes.select(F.col("doc_id").alias("u"), F.col("n").alias("nu")), "u")
        .join(sizes.select(F.col("doc_id").alias("v"), F.col("n").alias("nv")), "v")
        .where(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv"))
        .select("u", "v")
    )
    wanted = small_side(stars.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct())
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = settle(full_sets(texts.join(wanted, "doc_id"), shingle))
    links = settle(_verified(pairs, sets, percent))
    known = settle(components(links))
    more = settle(_open_pairs(stars, known, reps, sets, percent))
    named = components(links.union(more)) if more.count() else known
    classes = first.join(named, F.col("rep") == F.col("node"), "left").select(
        "high", "low", "n", F.coalesce("component", "rep").alias("component_id"), (F.col("copies") > 1).alias("_several"), "rep"
    )
    classes = small_side(classes.where("_several or component_id <> rep").drop("_several", "rep"))
    return sigs.join(classes, ["high", "low", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near copies, with their columns: those
    with the smallest id, rows with a null id, and texts without words."""
    return without(docs, near_duplicates(docs, id_col=id_col, **options).where("not kept").select("doc_id"), id_col)
