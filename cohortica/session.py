"""Session set-up and the one way this library cuts lineage."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Most rows, and about the most bytes, of a derived table that is sent to every task.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20
# Whether the optimizer derives conditions on columns from those of the steps below.
CONSTRAINTS = "spark.sql.constraintPropagation.enabled"
# For large intermediate tables: shuffle files go when the table is written, not when the driver next
# collects garbage, and rows go to Python few at a time.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}
# The session's own folders; they go when the process ends.
_own: list[tempfile.TemporaryDirectory] = []


def local_session(cores: str = "*", app: str = "cohortica", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("COHORTICA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session that names none gets a temporary folder, because there driver and executors
    share one disk; it is removed when the process ends. On a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        _own.append(tempfile.TemporaryDirectory(prefix="cohortica-", ignore_cleanup_errors=True))
        path = _own[-1].name
    context.setCheckpointDir(path)
    return context.getCheckpointDir()


def settle(df: DataFrame, lean: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there from now on.

    Used where a result is read more than once and the readers must see the very same values:
    floating-point sums and range-partition bounds may differ between two runs of one plan.

    The plan is made first. A checkpoint would then also carry over what is known of the columns, and
    for a wide table with stacked projections that knowledge alone fills the driver's heap (not-null
    conditions of every column multiply from step to step); it is not asked for.

    ``lean`` takes the settings of LEAN for it; nothing reads the shuffle files of its making again.
    """
    spark = df.sparkSession
    shared_dir(spark)
    with _settings(spark, LEAN if lean else {}):
        if lean:
            df = df.select("*")  # a plan notes the settings when it is made
        df._jdf.queryExecution().executedPlan()
        with _settings(spark, {CONSTRAINTS: "false"}):
            return df.checkpoint(eager=True)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def leanly(spark: SparkSession):
    """The settings of LEAN, for plans that are both made and run inside the block."""
    return _settings(spark, LEAN)


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A derived table ready to be joined to a large one: settled, measured, and broadcast if small.

    Small means at most ``most`` rows and about BROADCAST_BYTES: a number counts for its width, text
    and arrays for their length, summed over all rows in the pass that counts them.

    Adaptive execution also broadcasts what turns out small, but by then the large side has been
    shuffled. Above the bound the join shuffles, and adaptive execution splits skewed partitions.
    """
    df = settle(df)
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return F.broadcast(df) if rows <= most and (size or 0) <= BROADCAST_BYTES else df


def _row_bytes(df: DataFrame):
    """About the bytes of a row: 16 a column, and what text, bytes and arrays hold."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind.startswith(("array", "map")):
            size = size + 16 * F.greatest(F.size(column), F.lit(0))
    return size


def parallelism(spark: SparkSession, tasks: int) -> int:
    """Partitions for so many tasks' worth of work: one each, up to a few per core.

    For work that is heavy on arithmetic and light on bytes. Adaptive execution sizes partitions by
    bytes, which would leave most cores idle there.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(tasks, max(3 * spark.sparkContext.defaultParallelism, shuffle)))
