"""Mix documents to target domain weights through soft memberships.

A classifier fitted on the labelled table gives each document a probability for every domain. The
rates at which documents are taken are the numbers from 0 to a bound for which the expected tokens of
each domain come closest, in least squares, to the targets; a small pull towards 1 makes them unique.
They are found by projected gradient steps, each of which is one aggregate over a narrow table. A
projected gradient step takes a rate to ``1 + memberships . y``, cut to the bounds, where ``y`` has a number
per domain: so that is all there is to fit, and documents with the same memberships have the same rate.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.llm.quality_model import FEATURES, Trees, fit_trees, statistics, word_reader
from cohortica.llm.rows import wrapped
from cohortica.session import settle, small_side

# Domains of the labelled table, in order; the first that holds is a row's domain.
DOMAINS: dict[str, str] = {
    "toxic": "toxic = 1",
    "good": "quality = 1",
    "poor": "quality = 0",
}
# Target shares of the tokens.
TARGETS: dict[str, float] = {"toxic": 0.005, "good": 0.945, "poor": 0.05}
# The total is set by this domain: its target is this multiple of the tokens it is expected to have.
ANCHOR = "good"
EPOCHS = 1.02
# A mix is feasible if no domain misses its target by more than this share of the total.
MISS = 1e-3
# No domain is wanted more often than this; the total is lowered until that holds.
MOST_REPEATS = 4.0
# No document is taken more often than this.
MOST_RATE = 8.0
# What a squared miss (as a share of all tokens) costs against a squared distance of a rate from 1, and how
# far a miss may push the rate of a document that is all of one domain: -1 takes it to 0, and much more
# than that would only take away documents that are hardly of the domain.
PRESS = 1e6
MOST_PUSH = 2.0

# Hashed words whose evidence is kept, and how clear and frequent it must be.
BUCKETS = 1 << 18
LEAST_Z = 6.0
LEAST_DOCUMENTS = 5
# Labelled rows that the trees are fitted on, drawn by a hash of the id where there are more.
FIT_ROWS = 60_000
# What a split of the trees leaves on either side: little, as a domain may have a few labelled rows only.
LEAST_WEIGHT = 0.3
STEPS = 40
TOLERANCE = 1e-5
SEED = 7


def labelled_domains(labels: DataFrame, domains: Mapping[str, str] = DOMAINS) -> DataFrame:
    """``doc_id, domain`` (its place in ``domains``); rows without a domain or id are left out. An id
    with several labels has its first domain."""
    rule = F.lit(None).cast("int")
    for k, condition in reversed(list(enumerate(domains.values()))):
        rule = F.when(F.expr(condition), F.lit(k)).otherwise(rule)
    rows = labels.select("doc_id", rule.alias("domain")).where("domain is not null and doc_id is not null")
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("domain").alias("domain"))


def word_evidence(docs: DataFrame, labelled: DataFrame, n_domains: int) -> np.ndarray:
    """Log odds of each hashed word for each domain (BUCKETS x domains), zero where it is not clear.

    Counts, per domain, the labelled documents that hold a word, over all labelled documents. Each
    task sends one row per word bucket that it has seen, so what is gathered is bounded.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = np.zeros((BUCKETS + 1, n_domains), np.int64)  # the last row counts documents
        for batch in batches:
            domain = batch.column(1).to_numpy(zero_copy_only=False)
            for words in word_reader.pieces(batch.column(0)):
                bucket = (words.hashes % np.uint64(BUCKETS)).astype(np.int64)
                text = np.repeat(np.arange(len(words)), np.diff(words.bounds))
                pairs = np.unique(text * BUCKETS + bucket)
                own = domain[words.first + pairs // BUCKETS]
                np.add.at(seen, (pairs % BUCKETS, own), 1)
                np.add.at(seen, (BUCKETS, domain[words.first : words.first + len(words)]), 1)
        rows = np.flatnonzero(seen.any(1))
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), *[pa.array(seen[rows, k]) for k in range(n_domains)]],
                ["bucket", *[f"n{k}" for k in range(n_domains)]],
            )

    names = [f"n{k}" for k in range(n_domains)]
    known = docs.join(small_side(labelled), "doc_id").select("text", "domain")
    table = (
        known.mapInArrow(count, "bucket long, " + ", ".join(f"{n} long" for n in names))
        .groupBy("bucket")
        .agg(*[F.sum(n).alias(n) for n in names])
        .where(f"bucket = {BUCKETS} or {' + '.join(names)} >= {LEAST_DOCUMENTS}")
        .toPandas()
    )
    out = np.zeros((BUCKETS, n_domains), np.float32)
    totals = table.loc[table["bucket"] == BUCKETS, names].to_numpy(float)
    if not len(totals) or totals.sum() == 0:
        return out
    words = table[table["bucket"] != BUCKETS]
    n, total = words[names].to_numpy(float), totals[0]
    for k in range(n_domains):
        inside, outside = n[:, k], n.sum(1) - n[:, k]
        a, b = total[k], total.sum() - total[k]
        if not a or not b:
            continue
        share = (inside + outside) / (a + b)
        spread = np.sqrt(np.maximum(share * (1 - share) * (1 / a + 1 / b), 1e-12))
        z = (inside / a - outside / b) / spread
        odds = np.log((inside + 0.5) / (a + 1)) - np.log((outside + 0.5) / (b + 1))
        out[words["bucket"].to_numpy(), k] = np.where(z >= LEAST_Z, odds, 0)
    return out


def features(docs: DataFrame, evidence: np.ndarray) -> DataFrame:
    """``doc_id, tokens, x, mark``: word count, checksum of the text, and document statistics with, per domain, the number of
    distinct words that speak for it per word, and the strongest of them."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(evidence)
    width = len(FEATURES) + 2 * evidence.shape[1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights = shared.value
        for batch in batches:
            for words in word_reader.pieces(batch.column(1)):
                n = np.diff(words.bounds)
                text = np.repeat(np.arange(len(words)), n)
                weight = weights[(words.hashes % np.uint64(BUCKETS)).astype(np.int64)]
                columns = [statistics(words, words.text_offsets)]
                for k in range(weights.shape[1]):
                    strong = np.zeros(len(words))
                    np.maximum.at(strong, text, weight[:, k])
                    some = np.bincount(text, weight[:, k] > 0, len(words)) / np.maximum(n, 1)
                    columns += [strong[:, None], some[:, None]]
                x = np.column_stack(columns)
                place = np.arange(len(x) + 1, dtype=np.int32) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(words.first, len(words)), pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(place, pa.array(x.ravel())), batch.column(2).slice(words.first, len(words)),
                    ],
                    ["doc_id", "tokens", "x", "mark"],
                )

    rows = docs.select("doc_id", "text", F.md5("text").alias("mark"))
    return rows.mapInArrow(run, "doc_id long, tokens long, x array<double>, mark string")


@dataclass(frozen=True)
class DomainModel:
    """One set of trees per domain; their scores, scaled to sum 1, are the memberships."""

    trees: Sequence[Trees]

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        score = np.column_stack([t.score(x) for t in self.trees]) + 1e-9
        return score / score.sum(1, keepdims=True)


def fit_domains(table: DataFrame, labelled: DataFrame, n_domains: int, rows: int = FIT_ROWS) -> DomainModel:
    """Fit on labelled rows of ``features``; ``rows`` bounds their number (see FIT_ROWS). A domain
    without labelled rows gets no membership."""
    n = labelled.count()
    if n > rows:
        place = F.xxhash64("doc_id", F.lit(SEED)).cast("double") / float(1 << 64) + 0.5
        labelled = labelled.where(place < rows / n)
    known = table.join(labelled, "doc_id").select("doc_id", "x", "domain").toPandas()
    known = known.sort_values("doc_id", kind="stable")
    width = len(FEATURES) + 2 * n_domains
    x = np.stack(known["x"]) if len(known) else np.zeros((0, width))
    domain = known["domain"].to_numpy()
    return DomainModel([fit_trees(x, (domain == k).astype(float), rounds=40, least_weight=LEAST_WEIGHT) for k in range(n_domains)])


def memberships(table: DataFrame, model: DomainModel, names: Sequence[str]) -> DataFrame:
    """``doc_id, tokens, mark`` and a column ``p_<domain>`` for each domain."""
    columns = [f"p_{n}" for n in names]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            p = model.posteriors(flat.reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), *[pa.array(c) for c in p.T]], ["doc_id", "tokens", "mark", *columns]
            )

    return table.mapInArrow(run, "doc_id long, tokens long, mark string, " + ", ".join(f"{c} double" for c in columns))


@dataclass(frozen=True)
class Mix:
    """Fitted rates, as a number per domain, and how well they fit."""

    names: tuple[str, ...]
    slope: tuple[float, ...]
    most_rate: float
    expected: dict[str, float]  # tokens per domain at rate 1
    targets: dict[str, float]
    reached: dict[str, float]
    converged: bool
    feasible: bool  # no domain is too scarce for the anchor's total, and no target is missed

    def rate(self) -> Column:
        """The rate of a row of ``memberships``."""
        return _rate(self.names, self.slope, self.most_rate)


def _line(names: Sequence[str], slope: Sequence[float]) -> Column:
    return sum((F.col(f"p_{n}") * float(y) for n, y in zip(names, slope, strict=True)), F.lit(1.0))


def _rate(names: Sequence[str], slope: Sequence[float], most_rate: float) -> Column:
    return F.least(F.lit(float(most_rate)), F.greatest(F.lit(0.0), _line(names, slope)))


def fit_rates(
    table: DataFrame, targets: Mapping[str, float] = TARGETS, anchor: str = ANCHOR, epochs: float = EPOCHS,
    steps: int = STEPS, tolerance: float = TOLERANCE, most_repeats: float = MOST_REPEATS,
    most_rate: float = MOST_RATE, most_push: float = MOST_PUSH, limited: Sequence[str] = (),
) -> Mix:
    """Rates from 0 to ``most_rate`` whose expected tokens per domain match the targets.

    The anchor domain is wanted ``epochs`` times and the others in proportion to it. A domain in
    ``limited`` is not raised: it is wanted as much as the target says, or as there is. Where another
    domain would be wanted more than ``most_repeats`` times, the total is lowered and not the domain's
    share, and ``feasible`` is false. A domain of which not one token is expected cannot have a share: it is
    wanted 0 times, the others keep their proportions, and unless it is limited ``feasible`` is false too.

    Minimizes, over the documents weighted by their tokens, the mean squared distance of the rates from 1
    plus PRESS times the squared misses (as shares of all tokens; a miss that pushes harder than
    ``most_push`` downwards or ``most_rate`` upwards counts by that push alone). The gradient at a rate is its
    distance from 1 and its memberships times the misses, so at the minimum a rate is ``1 + memberships .
    y``, cut to the bounds, with ``y`` against the misses. Each step moves ``y`` along the gradient, scaled by the
    second moments of the documents that are not at a bound, is projected to the bounds of ``y``, and is
    shortened until the objective falls. The objective is strictly convex, so its minimum, also where
    targets cannot be met, does not depend on the way. A step is one aggregate over all documents, with
    ``y`` as literals in it. Stops when the misses or the projected gradient are within ``tolerance`` (of all
    tokens); ``converged`` says whether that came to pass. Rates that settle off the targets are not
    ``feasible``.
    """
    names = tuple(targets)
    n = len(names)
    p = [F.col(f"p_{x}") for x in names]
    weight = np.array([targets[x] for x in names], float)
    at = names.index(anchor)
    if weight[at] <= 0:
        raise ValueError("the anchor domain needs a target above 0")
    if most_rate <= epochs:
        raise ValueError("most_rate leaves no room for the anchor")

    def state(slope: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Tokens reached, second moments of the documents between the bounds, and the sum of
        ``c * line - c * c / 2`` with ``c`` the rate: what the rates add to the objective."""
        line, c = F.col("_line"), F.col("_c")
        free = F.when((line > 0) & (line < most_rate), F.col("tokens")).otherwise(0)
        rows = table.withColumn("_line", _line(names, slope)).withColumn("_c", _rate(names, slope, most_rate))
        sums = rows.agg(
            *[F.sum(F.col("tokens") * c * x) for x in p], *[F.sum(free * a * b) for a in p for b in p],
            F.sum(F.col("tokens") * (c * line - c * c / 2)),
        ).first()
        values = np.array([v or 0.0 for v in sums], float)
        return values[:n], values[n:-1].reshape(n, n), values[-1]

    slope = np.zeros(n)
    reached, second, part = state(slope)
    expected = reached
    wanted = weight / weight[at] * expected[at] * epochs
    held = np.array([x in limited for x in names])
    wanted = np.where(held, np.minimum(wanted, expected), wanted)
    absent = (expected < 1) & (wanted > 0)
    wanted = np.where(absent, 0.0, wanted)
    some = (wanted > 0) & ~held
    scale = min(1.0, (max(most_repeats, epochs) * expected[some] / wanted[some]).min(initial=1.0))
    wanted = wanted * scale
    all_ = max(expected.sum(), 1.0)
    total = max(wanted.sum(), 1.0)
    objective = lambda y, part: (y @ y) / (2 * PRESS) + (part - wanted @ y) / all_
    value, size, converged = objective(slope, part), 1.0, False
    low, high = -most_push, most_rate - 1
    for _ in range(steps):
        gradient = slope / PRESS + (reached - wanted) / all_
        free = ~((slope <= low) & (gradient > 0)) & ~((slope >= high) & (gradient < 0))
        converged = np.abs(reached - wanted).max() <= tolerance * total or np.abs(gradient[free]).max(initial=0) <= tolerance
        if converged:
            break
        move = np.zeros(n)
        moments = second / all_ + np.eye(n) / PRESS
        move[free] = -np.linalg.solve(moments[np.ix_(free, free)], gradient[free])
        tried = np.clip(slope + size * move, low, high)
        now, moments, part = state(tried)
        if objective(tried, part) <= value + 1e-4 * (gradient @ (tried - slope)):
            slope, reached, second, value = tried, now, moments, objective(tried, part)
            size = min(1.0, 4 * size)
        else:
            size /= 4
    feasible = bool(scale == 1.0 and not (absent & ~held).any() and np.abs(reached - wanted).max() <= MISS * total)
    name = lambda values: dict(zip(names, map(float, values), strict=True))
    return Mix(names, tuple(map(float, slope)), most_rate, name(expected), name(wanted), name(reached), bool(converged), feasible)


def _unmixed(table: DataFrame, names: tuple[str, ...]) -> Mix:
    """Every document once, where nothing tells domains apart."""
    sums = table.agg(*[F.sum(F.col("tokens") * F.col(f"p_{x}")) for x in names]).first()
    expected = {n: v or 0.0 for n, v in zip(names, sums, strict=True)}
    return Mix(names, (0.0,) * len(names), MOST_RATE, expected, expected, expected, True, False)


def mixed_rates(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, domains: Mapping[str, str] = DOMAINS,
    anchor: str = ANCHOR, limited: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, tokens, mark, p_<domain>..., rate, copies`` for every row of ``docs``, and of the whole mix
    ``target_<domain>...`` and ``reached_<domain>...`` (expected tokens) and ``feasible`` (see fit_rates).

    ``mark`` is the MD5 of the text. ``copies`` is the rate rounded up or down by a hash of the id, so that
    its mean is the rate and a second run gives the same; null ids all round alike. Null and empty texts
    have no tokens and a rate like any other text of their memberships; repeated rows and rows that share an
    id are rows like others. Where labels name fewer than two domains, nothing tells documents apart:
    every rate is 1 and ``feasible`` is false. Texts are read whole, a very long one by itself.
    """
    if set(targets) != set(domains):
        raise ValueError("targets and domains differ")
    names = tuple(domains)
    targets = {n: targets[n] for n in names}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labelled = settle(labelled_domains(labels, domains).join(rows.select("doc_id").distinct(), "doc_id", "left_semi"))
    known = labelled.select("domain").distinct().count()
    table = settle(features(rows, word_evidence(rows, labelled, len(names))))
    table = settle(memberships(table, fit_domains(table, labelled, len(names)), names))
    mix = fit_rates(table, targets, anchor, limited=limited) if known > 1 else _unmixed(table, names)
    if not mix.converged:
        raise RuntimeError(f"the rates have not settled in {STEPS} steps: {mix.reached} for {mix.targets}")
    place = F.xxhash64("doc_id", F.lit(SEED)).cast("double") / float(1 << 64) + 0.5
    whole = {f"target_{n}": F.lit(mix.targets[n]) for n in names} | {f"reached_{n}": F.lit(mix.reached[n]) for n in names}
    rates = table.withColumn("rate", mix.rate()).withColumn("copies", F.floor(F.col("rate") + place).cast("long"))
    return rates.withColumns(whole | {"feasible": F.lit(mix.feasible)})


def mixed_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", nearest: bool = False, **options
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    A mix that is not feasible is an error unless ``nearest`` asks for the nearest one. Rows are told
    apart by id and text, null ids and null texts included.
    """
    rates = mixed_rates(docs, labels, id_col=id_col, text_col=text_col, **options)
    first = rates.limit(1).collect()
    if first and not first[0]["feasible"] and not nearest:
        mix = {k: v for k, v in first[0].asDict().items() if k.startswith(("target_", "reached_"))}
        raise ValueError(f"the mix cannot be met: {mix}")
    odd = rates.where("copies <> 1").select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "copies").distinct()
    rows = wrapped(docs, id_col).withColumn("mark", F.md5(F.col("row").getField(text_col).cast("string")))
    copies = F.coalesce("copies", F.lit(1)).cast("int")
    return (
        rows.join(small_side(odd), F.col("key").eqNullSafe(F.col("_doc")) & F.col("mark").eqNullSafe(F.col("_mark")), "left")
        .select("row", F.explode(F.array_repeat(F.lit(1), copies)))
        .select("row.*")
    )
