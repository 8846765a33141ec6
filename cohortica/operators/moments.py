"""Means and co-moments of all pairs of columns in one pass, for any number of columns.

Every partition turns its Arrow batches into matrices: for each pair of columns the rows where both are
present, both means, both sums of squares and the sum of products about the means. Two such sets of
matrices merge exactly (Chan, Golub and LeVeque 1979), so partitions are merged in two levels, and what
reaches the driver is one set, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Numbers of a batch that are squared at a time, and tasks of the first merge.
BATCH_CELLS = 4_000_000
MERGERS = 32
# A sum of squares below this share of the sum about any point is rounding: the column is constant.
ROUNDING = 1e-13


@dataclass
class Moments:
    """Matrices over pairs: entry (i, j) is about column i on the rows where i and j are present."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray  # about the mean
    product: np.ndarray  # of i and j about their means

    @staticmethod
    def empty(width: int) -> Moments:
        return Moments(*(np.zeros((width, width)) for _ in range(4)))

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of a matrix with NaN where a value is missing."""
        known = ~np.isnan(x)
        # Sums about the first value of each column: small numbers, and exact zeros for a constant.
        first = np.where(known.any(0), x[known.argmax(0), np.arange(x.shape[1])], 0.0)
        d, m = np.where(known, x - first, 0.0), known.astype(float)
        n, total, product = m.T @ m, d.T @ m, d.T @ d
        raw = (d * d).T @ m
        mean = np.divide(total, n, out=np.zeros_like(n), where=n > 0)
        square = np.maximum(raw - total * mean, 0.0)
        square[square <= ROUNDING * raw] = 0.0
        return Moments(n, mean + first[:, None] * (n > 0), square, product - mean * total.T)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        gap = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * share
        mean = np.where(self.n > 0, self.mean + gap * share, other.mean)
        return Moments(
            n, mean, self.square + other.square + gap * gap * weight, self.product + other.product + gap * gap.T * weight
        )

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.product]).tobytes()

    @staticmethod
    def unpacked(data: bytes, width: int) -> Moments:
        return Moments(*np.frombuffer(data).reshape(4, width, width))

    def correlation(self) -> np.ndarray:
        """NaN where it is undefined: fewer than two rows, or a constant column."""
        spread = np.sqrt(self.square * self.square.T)
        found = np.full_like(spread, np.nan)
        np.divide(self.product, spread, out=found, where=(self.n > 1) & (spread > 0))
        return np.clip(found, -1.0, 1.0)


def co_moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """Moments of all pairs of ``cols`` (numbers), in one job."""
    width = len(cols)
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    schema = "slot int, data binary"

    def row(slot: int, moments: Moments):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([moments.packed()], pa.binary())], ["slot", "data"])

    def partial(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        found = None
        step = max(1, BATCH_CELLS // max(width, 1))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns])
                own = Moments.of(x)
                found = own if found is None else found.merged(own)
        if found is not None:
            yield row(TaskContext.get().partitionId(), found)

    def merge(batches: Iterator) -> Iterator:
        found = None
        for batch in batches:
            for data in batch.column(1):
                own = Moments.unpacked(data.as_py(), width)
                found = own if found is None else found.merged(own)
        if found is not None:
            yield row(0, found)

    made = rows.mapInArrow(partial, schema).repartition(MERGERS, "slot").mapInArrow(merge, schema)
    last = made.repartition(1).mapInArrow(merge, schema).collect()  # one row
    return Moments.unpacked(last[0].data, width) if last else Moments.empty(width)
