"""Splitting, fitting and judging classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.session import parallelism

# A prime a little above a million: the number of distinct places a key can hash to.
PLACES = 1_000_003
# Forests grow until leaves are pure; this is the deepest that Spark can grow a tree.
DEEPEST = 30
# Rows that a task trains on. A level of a tree is a pass over all rows, so it is work and not bytes that counts.
ROWS_A_TASK = 20_000


def is_test_row(key: str, test: float = 0.3, seed: int = 17) -> Column:
    """Whether a row belongs to the test part, by integer arithmetic on its key alone.

    The same on any partitioning and in any engine, unlike a random draw.
    """
    place = F.pmod(F.pmod(F.col(key), F.lit(PLACES)) * 7919 + seed * 104729, F.lit(PLACES))
    return place < F.lit(int(test * PLACES))


def split(
    df: DataFrame, key: str, test: float = 0.3, seed: int = 17
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows."""
    chosen = is_test_row(key, test, seed)
    return df.where(~chosen), df.where(chosen)


def spread(train: DataFrame) -> DataFrame:
    """Rows dealt to as many tasks as they are worth; up to ROWS_A_TASK stay as they are."""
    tasks = parallelism(train.sparkSession, -(-train.count() // ROWS_A_TASK))
    return train.repartition(tasks) if tasks > 1 else train


def _fit(classifier, train: DataFrame, feats: Sequence[str]) -> PipelineModel:
    train = spread(train)
    assembler = VectorAssembler(inputCols=list(feats), outputCol="features")
    return Pipeline(stages=[assembler, classifier]).fit(train)


def fit_forest(
    train: DataFrame,
    feats: Sequence[str],
    label: str,
    trees: int = 100,
    depth: int = DEEPEST,
    seed: int = 42,
) -> PipelineModel:
    """Random forest; features and label must have no nulls. Trees are grown out unless ``depth`` stops
    them sooner; the node that a row has reached in each tree is kept, not walked to again at each level."""
    return _fit(
        RandomForestClassifier(
            featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True
        ),
        train,
        feats,
    )


def fit_gbt(
    train: DataFrame,
    feats: Sequence[str],
    label: str,
    rounds: int = 50,
    depth: int = 5,
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees for a 0/1 label."""
    return _fit(
        GBTClassifier(
            featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed
        ),
        train,
        feats,
    )


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with ``prediction`` and ``score``, the estimated probability of class 1."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability")


def confusion(pred: DataFrame, truth: str = "truth", guess: str = "prediction") -> DataFrame:
    y, g = F.col(truth) == 1, F.col(guess) == 1
    return pred.agg(
        F.count_if(y & g).alias("tp"),
        F.count_if(~y & g).alias("fp"),
        F.count_if(y & ~g).alias("fn"),
        F.count_if(~y & ~g).alias("tn"),
    )


def _metrics() -> dict[str, Column]:
    """Metrics from the four counts; a ratio with nothing below its line is 0, or null for AUC."""
    zero = F.lit(0.0)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        "accuracy": F.coalesce(F.try_divide(tp + tn, tp + fp + fn + tn), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
        "auc": (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2,
    }


def scorecard(
    pred: DataFrame,
    truth: str = "truth",
    guess: str = "prediction",
    names: Sequence[str] = ("accuracy", "recall", "precision", "f1", "auc"),
) -> DataFrame:
    """All metrics of hard labels from one pass."""
    metrics = _metrics()
    return confusion(pred, truth, guess).select(*[metrics[m].alias(m) for m in names])


def classification_metrics(
    pred: DataFrame, truth: str = "truth", guess: str = "prediction"
) -> DataFrame:
    """Accuracy, recall, precision and F1."""
    return scorecard(pred, truth, guess, ("accuracy", "recall", "precision", "f1"))


def roc_auc(pred: DataFrame, truth: str = "truth", guess: str = "prediction") -> DataFrame:
    """Area under the ROC curve of hard labels, the mean of both rates; null with one class."""
    return scorecard(pred, truth, guess, ("auc",))


def roc_auc_scores(pred: DataFrame, truth: str = "truth", score: str = "score") -> DataFrame:
    """Area under the ROC curve of scores: wins of positives over negatives, ties half.

    Rows are counted per score first. The running count of negatives uses range partitions, so a
    continuous score is never sorted in one task.
    """
    from cohortica.operators.ranking import running_total

    counts = (
        pred.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("s"))
        .agg(F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) != 1).alias("neg"))
    )
    below = running_total(counts, ["s"], "neg", "_upto")
    wins = F.sum(F.col("pos") * (F.col("_upto") - F.col("neg") / 2))
    return below.agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc")
    )


def importances(model: PipelineModel, feats: Sequence[str]) -> DataFrame:
    """Features by importance, largest first."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray()
    rows = sorted(
        ((f, float(v)) for f, v in zip(feats, values)), key=lambda fv: (-fv[1], fv[0])
    )
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double")
