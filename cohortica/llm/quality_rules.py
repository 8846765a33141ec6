"""A ledger of quality rules: every rule evaluated once, policies applied to its failure bits.

``ledger`` reads each text once and stores the measurements and one integer, ``failures``, in which
bit ``b`` is set if rule ``b`` fails. A policy is a named, versioned mask of rules; a document is
kept under a policy if no bit of the mask is set. Which rules matter (alone, together, or left out)
is then answered from the ledger without reading a text again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SHOUT = "!"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

# Rule name -> condition under which it fails. A rule keeps its bit: add rules at the end only.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 15 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "shouting": "2 * n_exclaims > n_words",
    "capitals": "n_words >= 10 and 10 * n_upper > 7 * word_chars",
    "word_length": "n_words >= 10 and (word_chars < 2 * n_words or word_chars > 12 * n_words)",
}
# Policy name -> rules that a kept document must pass.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("too_few_words", "repeated_windows"),
    "prose-1": tuple(RULES),
}
POLICY = "prose-1"


def mask(rules: tuple[str, ...]) -> int:
    """The bits of some rules."""
    return sum(1 << list(RULES).index(r) for r in rules)


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def measurements(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the numbers that the rules look at, all long; other columns stay as they are.

    Words are runs of other characters than ASCII white space, lines are split at line feeds, and
    only lines with a word count. ``n_repeat_words`` counts the words in five-word windows that
    occur at least twice in the text, first occurrence included. Windows are hashed to 64 bits and
    sorted inside the row with their positions; equal neighbours are repeats. A text never leaves
    its row, so nothing is shuffled and a long text costs n log n. Null texts have no words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    df = docs.withColumns(
        {
            "_hashes": F.transform(words, lambda w: F.xxhash64(w)),
            "_lines": lines,
            "word_chars": (
                F.char_length(text) - _count(text, SPACE_CHARS)
            ).cast("long"),
            "n_symbols": _count(text, SYMBOLS).cast("long"),
            "n_exclaims": _count(text, SHOUT).cast("long"),
            "n_upper": _count(text, ASCII_UPPER).cast("long"),
        }
    ).withColumns(
        {
            "n_words": F.size("_hashes").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.expr(
                f"""case when size(_hashes) > {WINDOW} then sort_array(transform(
                    sequence(0, size(_hashes) - {WINDOW}),
                    i -> struct(xxhash64({", ".join(f"_hashes[i + {k}]" for k in range(WINDOW))}) as h, i as i)
                )) end"""
            ),
        }
    )
    df = df.withColumn(
        "_repeats",
        F.expr(
            """sort_array(transform(
                filter(_windows, (x, k) -> (k > 0 and x.h = _windows[k - 1].h)
                    or (k + 1 < size(_windows) and x.h = _windows[k + 1].h)),
                x -> x.i))"""
        ),
    )
    covered = F.expr(
        f"""coalesce(aggregate(_repeats, struct(0L as n, -{WINDOW} as last),
            (a, i) -> struct(a.n + least({WINDOW}, i - a.last) as n, i as last), a -> a.n), 0L)"""
    )
    # The condition always holds, but it is not deterministic: so no filter on the measurements is
    # pushed below them, where the windows would be written into the lambda that compares
    # neighbours and be sorted anew for each of them.
    covered = F.when(F.monotonically_increasing_id() >= 0, covered)
    return df.withColumn("n_repeat_words", covered).drop("_hashes", "_lines", "_windows", "_repeats")


MEASURED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims", "n_upper",
)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, measurements and ``failures``. Input columns with the names of
    measurements are not read."""
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    bits = [
        F.when(F.expr(failing), F.lit(1 << b)).otherwise(F.lit(0)) for b, failing in enumerate(RULES.values())
    ]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return measurements(rows, "_text").select(id_col, *MEASURED, failures.cast("long").alias("failures"))


def passes(policy: str = POLICY) -> Column:
    """Whether a row of a ledger is kept under a policy."""
    return F.col("failures").bitwiseAND(mask(POLICIES[policy])) == 0


def ablations(rows: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """What each rule does in each policy, from a ledger: documents that fail the rule, that fail it
    alone (and would be kept without it), and documents kept by the whole policy and without the
    rule. First all rows become counts per bit pattern, one row for each pattern that occurs.
    """
    patterns = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    tried = [
        F.struct(
            F.lit(p).alias("policy"), F.lit(r).alias("rule"),
            F.lit(mask(rules)).cast("long").alias("all_bits"), F.lit(mask((r,))).cast("long").alias("bit"),
        )
        for p, rules in policies.items()
        for r in rules
    ]
    total = lambda condition: F.sum(F.when(F.expr(condition), F.col("n")).otherwise(0))
    return (
        patterns.select("failures", "n", F.inline(F.array(*tried)))
        .groupBy("policy", "rule")
        .agg(
            total("(failures & bit) != 0").alias("fail"),
            total("(failures & all_bits) = bit").alias("fail_alone"),
            total("(failures & all_bits) = 0").alias("kept"),
            total("(failures & all_bits & ~bit) = 0").alias("kept_without"),
        )
    )


def keep_good(docs: DataFrame, policy: str = POLICY, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with their columns."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text_col).alias("_text"))
    kept = [F.expr(f"not ({RULES[r]})") for r in POLICIES[policy]]
    good = kept[0]
    for k in kept[1:]:
        good = good & k
    return measurements(rows, "_text").where(good).select("_row.*")
