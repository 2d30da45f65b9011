"""Vector assembly, model training, scoring and model selection."""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.curves import areas_under_curves
from sievework.operators.evaluation import METRICS, classification_metrics, confusion_matrix
from sievework.sources.small import small_table

SEED = 42
ROWS_A_TASK = 400_000  # some 650 bytes each as a fit of trees keeps them
CELL_SCHEMA = "label double, prediction double, count bigint"
# The columns of the comparison table.
RESULT_SCHEMA = (
    "model string, roc_auc double, pr_auc double, accuracy double, precision double, "
    "recall double, f1_score double, training_time_seconds double"
)


def four_models(seed: int = SEED) -> dict[str, Estimator]:
    """The four classifiers compared on a catalog table, with their settings."""
    return {
        "Decision Tree": DecisionTreeClassifier(
            maxDepth=6, minInstancesPerNode=20, impurity="gini", seed=seed
        ),
        "Random Forest": RandomForestClassifier(
            numTrees=15,
            maxDepth=6,
            minInstancesPerNode=20,
            subsamplingRate=0.8,
            featureSubsetStrategy="sqrt",
            impurity="gini",
            seed=seed,
        ),
        "Gradient Boosted Tree": GBTClassifier(
            maxIter=15,
            maxDepth=4,
            stepSize=0.08,
            minInstancesPerNode=20,
            subsamplingRate=0.8,
            seed=seed,
        ),
        "Logistic Regression": LogisticRegression(
            maxIter=8, regParam=0.05, elasticNetParam=0.1, standardization=False
        ),
    }


def two_models(seed: int = SEED) -> dict[str, Estimator]:
    """The larger forest and the standardising regression of the submitted job."""
    return {
        "Random Forest": RandomForestClassifier(numTrees=100, maxDepth=10, seed=seed),
        "Logistic Regression": LogisticRegression(
            maxIter=20, regParam=0.05, elasticNetParam=0.1
        ),
    }


def assemble(
    df: DataFrame, features: Sequence[str], label: str, invalid: str = "skip"
) -> DataFrame:
    """(features vector, label). ``invalid``: drop (``skip``) or refuse (``error``) rows
    with NULL or NaN features."""
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=invalid
    )
    return assembler.transform(df).select("features", F.col(label).alias("label"))


@contextmanager
def kept(*tables: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """The tables persisted in memory with spill to disk, and released afterwards."""
    held = tuple(t.persist(StorageLevel.MEMORY_AND_DISK) for t in tables)
    try:
        yield held
    finally:
        for t in held:
            t.unpersist()


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Repartition before training, or leave the partitioning of the scan as it is."""
    return df.repartition(partitions) if partitions else df


def fit_partitions(df: DataFrame, rows_a_task: int | None = None) -> int | None:
    """Partitions for a fit on ``df``: None, the partitioning of the scan, while its rows fit one task, else the
    least multiple of the session's parallelism with at most ``rows_a_task`` (``ROWS_A_TASK``) rows in each.

    A scan of a stored table packs files by their compressed size, so without this the rows that one task of a fit
    holds and reads would grow with the table. Pass a stored table: its rows are counted.
    """
    rows, rows_a_task = df.count(), rows_a_task or ROWS_A_TASK
    if rows <= rows_a_task:
        return None
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    return parallelism * math.ceil(rows / (parallelism * rows_a_task))


def fit_rows(df: DataFrame, features: Sequence[str], label: str, invalid: str = "skip") -> DataFrame:
    """Rows of a stored table assembled for a fit, over as many partitions as :func:`fit_partitions` names."""
    return spread(assemble(df, features, label, invalid), fit_partitions(df))


def partition_sizes(df: DataFrame) -> DataFrame:
    """(partition, rows) as the table is laid out now."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def input_sizes(train: DataFrame, test: DataFrame, features: int) -> DataFrame:
    """(split, rows, features, partitions) of assembled training and test rows."""
    sides = []
    for name, df in (("train", train), ("test", test)):
        sides.append(
            partition_sizes(df).agg(
                F.lit(name).alias("split"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                F.lit(features).alias("features"),
                F.count("partition").alias("partitions"),
            )
        )
    return sides[0].unionByName(sides[1])


@dataclass(frozen=True)
class Trained:
    """A fitted model with its test metrics."""

    name: str
    model: Model
    roc_auc: float
    pr_auc: float
    accuracy: float
    precision: float
    recall: float
    f1_score: float
    training_seconds: float
    cells: tuple[tuple, ...] = ()  # (label, prediction, count) of the test rows

    def rounded(self, digits: int = 4) -> tuple:
        scores = (self.roc_auc, self.pr_auc, *[getattr(self, m) for m in METRICS])
        return (self.name, *[round(x, digits) for x in scores], round(self.training_seconds, 2))


def scoring_handle(model: Model) -> Model:
    """The same fitted model without its training summary.

    Scoring ships the model to the tasks. A summary holds on to the training rows and through them to the
    session, which may have something in it that cannot be shipped (a session that used an ``Observation``
    does). The handle shares the parameters; the model passed in keeps its summary.
    """
    handle = model.copy()
    if getattr(handle, "hasSummary", False):
        none = SparkContext._active_spark_context._jvm.scala.Option.empty()
        handle._java_obj.setSummary(none)
    return handle


def score_rows(model: Model, test: DataFrame) -> DataFrame:
    """Test rows with label, prediction and rawPrediction."""
    return scoring_handle(model).transform(test).select("label", "prediction", "rawPrediction")


def positive_score(predictions: DataFrame) -> DataFrame:
    """label, prediction and the raw score of class 1 as a plain double column."""
    raw = vector_to_array("rawPrediction")
    return predictions.select("label", "prediction", raw[1].alias("score"))


def evaluate_model(predictions: DataFrame, exact: bool = False) -> dict:
    """All metrics of scored rows, and the cells of their confusion matrix.

    Ranking areas come from the binned evaluator, which sorts the distinct scores once for
    each area before it bins them, or ``exact`` from all distinct scores in one pass by ranges.
    """
    spark = predictions.sparkSession
    cells = tuple(
        (float(r[0]), float(r[1]), r[2]) for r in confusion_matrix(predictions).collect()
    )  # at most the number of classes squared
    matrix = small_table(spark, cells, CELL_SCHEMA)
    metrics = classification_metrics(matrix).head().asDict() | {"cells": cells}
    if exact:
        areas = areas_under_curves(positive_score(predictions)).head()
        return metrics | {"roc_auc": areas["roc_auc"], "pr_auc": areas["pr_auc"]}
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction")
    for name, area in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
        metrics[name] = evaluator.setMetricName(area).evaluate(predictions)
    return metrics


def matrix_of(spark: SparkSession, result: Trained) -> DataFrame:
    """The confusion matrix of a fitted model's test rows, as counted when it was evaluated."""
    return small_table(spark, result.cells, CELL_SCHEMA)


def train_models(
    estimators: Mapping[str, Estimator], train: DataFrame, test: DataFrame, exact: bool = False, at_once: int = 1
) -> list[Trained]:
    """Fit every estimator on ``train`` and evaluate it on ``test``; results in the order of the estimators.

    Pass persisted tables: every fit makes several passes over ``train``. ``at_once`` models are fitted side by side, each in a
    thread and a scheduler pool of its own: the many short jobs of one fill the gaps that the driver's steps leave in
    another. Where the session schedules fairly, pools share the cluster evenly. The models are the same as one after the other;
    a model's time is the wall clock around its fit, so it includes waiting for the others.
    """
    context = train.sparkSession.sparkContext

    def trained(name: str, estimator: Estimator) -> Trained:
        if at_once > 1:
            context.setLocalProperty("spark.scheduler.pool", f"fit {name}")
        start = time.perf_counter()
        model = estimator.fit(train)
        seconds = time.perf_counter() - start
        with kept(score_rows(model, test)) as (predictions,):
            metrics = evaluate_model(predictions, exact)
        return Trained(name=name, model=model, training_seconds=seconds, **metrics)

    if at_once <= 1:
        return [trained(name, estimator) for name, estimator in estimators.items()]
    with ThreadPoolExecutor(max_workers=at_once) as threads:
        # Each thread takes the caller's job properties with it.
        fits = [threads.submit(inheritable_thread_target(train.sparkSession)(trained), *pair) for pair in estimators.items()]
        return [fit.result() for fit in fits]


def comparison_table(spark: SparkSession, results: Sequence[Trained]) -> DataFrame:
    """One row per model with rounded metrics, best ROC area first."""
    rows = small_table(spark, [r.rounded() for r in results], RESULT_SCHEMA)
    return rows.orderBy(F.desc("roc_auc"), "model")


def best_model(results: Sequence[Trained]) -> Trained:
    """Highest unrounded ROC area; the earlier name wins a tie."""
    return min(results, key=lambda r: (-r.roc_auc, r.name))


def better_of_two(first: Trained, second: Trained) -> Trained:
    """The first of two models unless the second is strictly better."""
    return first if first.roc_auc >= second.roc_auc else second
