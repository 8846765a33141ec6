"""Scalar expressions: each takes columns (or names) and returns a Column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def approx_distinct(c: ColumnLike) -> Column:
    """Aggregate: about how many distinct non-null values, within a few percent.

    One small sketch per column, merged map-side; cheaper to plan for many columns at a time than
    ``approx_count_distinct``.
    """
    hashed = F.when(col(c).isNotNull(), F.xxhash64(col(c)))
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(hashed)), F.lit(0))


# Text, numbers and time


def month_key(ts: ColumnLike) -> Column:
    """Calendar month as ``yyyy-MM``."""
    return F.date_format(col(ts), "yyyy-MM")


def concat_key(*parts: ColumnLike) -> Column:
    """Parts as text, joined by ``_``; null if any part is null."""
    text = [col(p).cast("string") for p in parts]
    return F.concat(text[0], *[x for p in text[1:] for x in (F.lit("_"), p)])


def to_ts(text: ColumnLike, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.to_timestamp_ntz(col(text), F.lit(fmt))


def from_epoch(seconds: ColumnLike) -> Column:
    """UTC wall-clock time of epoch seconds."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(secs=col(seconds).cast("decimal(18,6)"))


def whole_days(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole 24-hour days between two times, not calendar-date changes."""
    return F.timestamp_diff("DAY", col(start), col(end))


def to_numeric(text: ColumnLike) -> Column:
    """Text as double; text that is not a number becomes null."""
    return F.trim(col(text)).try_cast("double")


def yes_flag(text: ColumnLike) -> Column:
    """1 for "yes" in any case and with any spaces around, else 0, also for null."""
    return F.when(F.lower(F.trim(col(text))) == "yes", 1).otherwise(0)


def years_between(ts: ColumnLike, ref: ColumnLike) -> Column:
    return F.year(col(ref)) - F.year(col(ts))


def months_apart(ts: ColumnLike, ref: ColumnLike) -> Column:
    """Calendar months between two times; days do not count."""
    return years_between(ts, ref) * 12 + F.month(col(ref)) - F.month(col(ts))


def day_name(ts: ColumnLike) -> Column:
    return F.date_format(col(ts), "EEEE")


def zero_to_null(c: ColumnLike) -> Column:
    return F.nullif(col(c), F.lit(0).cast("double"))


# Votes and ratings


def helpful_no(total: ColumnLike, helpful: ColumnLike) -> Column:
    return col(total) - col(helpful)


def pos_neg_diff(up: ColumnLike, down: ColumnLike) -> Column:
    return col(up) - col(down)


def average_rating_score(up: ColumnLike, down: ColumnLike) -> Column:
    """Share of up votes, 0 without votes."""
    n = col(up) + col(down)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.try_divide(col(up), n))


def wilson_lower_bound(up: ColumnLike, down: ColumnLike, confidence: float = 0.95) -> Column:
    """Lower end of the Wilson score interval of the up share, 0 without votes."""
    z = NormalDist().inv_cdf(1 - (1 - confidence) / 2)
    n = col(up) + col(down)
    share = F.try_divide(col(up), n)
    centre = share + F.try_divide(F.lit(z * z), 2 * n)
    spread = z * F.sqrt(F.try_divide(share * (1 - share) + F.try_divide(F.lit(z * z), 4 * n), n))
    bound = (centre - spread) / (1 + F.try_divide(F.lit(z * z), n))
    return F.when(n == 0, F.lit(0.0)).otherwise(bound)


# Derived features


def notnull_flag(c: ColumnLike) -> Column:
    return col(c).isNotNull().cast("int")


def char_count(c: ColumnLike) -> Column:
    return F.length(col(c))


def word_count(c: ColumnLike) -> Column:
    """Tokens between single spaces, empty ones included; null counts as one token."""
    return F.coalesce(F.size(F.split(col(c), " ", -1)), F.lit(1))


def prefix_count(c: ColumnLike, prefix: str) -> Column:
    """Tokens that start with ``prefix``; 0 for null."""
    tokens = F.split(F.coalesce(col(c), F.lit("")), r"\s+")
    return F.size(F.filter(tokens, lambda t: t.startswith(prefix)))


def regex_feature(c: ColumnLike, pattern: str, group: int = 1) -> Column:
    """First match of a capture group; null when nothing matches."""
    return F.when(col(c).rlike(pattern), F.regexp_extract(col(c), pattern, group))


def interact(a: ColumnLike, b: ColumnLike) -> Column:
    return col(a) * col(b)


def range_label(
    c: ColumnLike, edges: Sequence[float], labels: Sequence[str], closed: str = "right"
) -> Column:
    """Label of the range a value falls in; ``len(labels) == len(edges) + 1``.

    ``closed="right"`` puts an edge value into the lower range, ``"left"`` into the upper one.
    """
    if len(labels) != len(edges) + 1 or closed not in ("left", "right"):
        raise ValueError("one more label than edges, closed left or right")
    picked = F
    for edge, label in zip(edges, labels):
        test = col(c) <= F.lit(edge) if closed == "right" else col(c) < F.lit(edge)
        picked = picked.when(test, F.lit(label))
    return picked.when(col(c).isNotNull(), F.lit(labels[-1]))


def cross_label(*labels: ColumnLike, sep: str = "") -> Column:
    """Labels put together; null if one is null."""
    parts = [col(x).cast("string") for x in labels]
    return F.concat(parts[0], *[x for p in parts[1:] for x in (F.lit(sep), p)])


def range_flag(
    c: ColumnLike, low: float, high: float, inside: str = "Normal", outside: str = "Abnormal"
) -> Column:
    """Two-way label by ``low <= value <= high``; null is outside."""
    return F.when(col(c).between(F.lit(low), F.lit(high)), F.lit(inside)).otherwise(F.lit(outside))


def flag_in(c: ColumnLike, values: Sequence) -> Column:
    return F.coalesce(col(c).isin(list(values)), F.lit(False)).cast("int")


def flag_contains(c: ColumnLike, text: str) -> Column:
    return F.coalesce(col(c).contains(text), F.lit(False)).cast("int")


def is_value(c: ColumnLike, value) -> Column:
    """Equality that is false, not null, for a missing value."""
    return F.coalesce(col(c) == F.lit(value), F.lit(False))


def count_equal(cols: Sequence[ColumnLike], value) -> Column:
    """How many of the columns equal ``value``."""
    return reduce(add, [is_value(c, value).cast("int") for c in cols])


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, null when b is 0."""
    return F.try_divide(col(a), col(b))
