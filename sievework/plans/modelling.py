"""From training and test tables to a saved best model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.evaluation import (
    distribution_in_matrix,
    label_distribution,
    majority_baseline,
)
from sievework.operators.inspection import feature_importance, model_contents
from sievework.operators.quality import DEFAULT_OPTIONS
from sievework.operators.scaling import write_split
from sievework.operators.training import (
    Trained,
    assemble,
    best_model,
    better_of_two,
    comparison_table,
    fit_rows,
    four_models,
    input_sizes,
    kept,
    matrix_of,
    spread,
    train_models,
    two_models,
)
from sievework.plans.prepare import prepare
from sievework.sources import load_model, read_csv_inferred, save_model
from sievework.spec import QualityOptions, TableSpec


@dataclass(frozen=True)
class Selected:
    """Result of a model comparison."""

    comparison: DataFrame
    best: Trained
    models: Sequence[Trained]
    reports: dict[str, DataFrame]


def model_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Every column of a normalised table but key and label."""
    return [c for c in df.columns if c not in (spec.key, spec.label)]


def compare_models(
    train: DataFrame,
    test: DataFrame,
    spec: TableSpec,
    estimators: Mapping[str, Estimator] | None = None,
    partitions: int | None = None,
    model_path: str | None = None,
    importances: int | None = None,
    at_once: int = 1,
) -> Selected:
    """Train the estimators on a normalised table, compare them and save the best one.

    ``partitions`` redistributes the assembled rows before training, by default by their number; ``importances`` is the
    number of feature importances reported for each tree model, all by default; ``at_once`` models are
    fitted side by side. Reports come from what was counted during the evaluation, so nothing is scored twice.
    """
    spark = train.sparkSession
    columns = model_columns(train, spec)
    train_ml, test_ml = (
        spread(assemble(t, columns, spec.label), partitions) if partitions else fit_rows(t, columns, spec.label)
        for t in (train, test)
    )
    with kept(train_ml, test_ml):
        sizes = input_sizes(train_ml, test_ml, len(columns)).collect()
        baseline = majority_baseline(train_ml, test_ml).collect()
        results = train_models(estimators or four_models(), train_ml, test_ml, at_once=at_once)
        labels = label_distribution(train_ml).collect()
    reports = {
        "input_sizes": spark.createDataFrame(sizes),
        "majority_baseline": spark.createDataFrame(baseline),
        "training_labels": spark.createDataFrame(labels).orderBy("label"),
        "test_labels": distribution_in_matrix(matrix_of(spark, results[0]), "label").orderBy("label"),
    }
    for r in results:
        matrix = matrix_of(spark, r)
        reports[f"confusion_matrix/{r.name}"] = matrix.orderBy("label", "prediction")
        reports[f"prediction_distribution/{r.name}"] = distribution_in_matrix(matrix, "prediction")
        if hasattr(r.model, "featureImportances"):
            reports[f"feature_importance/{r.name}"] = feature_importance(
                spark, r.model, columns, importances
            )
    best = best_model(results)
    if model_path:
        save_model(best.model, model_path)
    return Selected(comparison_table(spark, results), best, results, reports)


def result_tables(spark: SparkSession, chosen: Selected) -> dict[str, DataFrame]:
    """The five result tables of a run, of its best model; importances only if it has them."""
    name = chosen.best.name
    matrix = matrix_of(spark, chosen.best)
    tables = {
        "best_model_metrics": chosen.comparison.where(F.col("model") == name),
        "confusion_matrix": matrix.orderBy("label", "prediction"),
        "actual_label_distribution": distribution_in_matrix(matrix, "label").orderBy("label"),
        "prediction_distribution": distribution_in_matrix(matrix, "prediction").orderBy("prediction"),
    }
    if (importance := chosen.reports.get(f"feature_importance/{name}")) is not None:
        tables["feature_importance"] = importance
    return tables


def train_two_from_csv(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    work_dir: str,
    model_path: str,
    options: QualityOptions = DEFAULT_OPTIONS,
) -> Selected:
    """CSV with inferred types to a saved forest or regression, whichever ranks better.

    Unlike :func:`compare_models`, rows with NULL or NaN features are an error, and
    repeated keys are neither checked nor removed.
    """
    raw = read_csv_inferred(spark, path)
    p = prepare(raw, spec, work_dir, options, on_duplicate="ignore", keep_key=False)
    train, test = write_split(p.features, spec, f"{work_dir}/split", keep_key=False)
    columns = model_columns(train, spec)
    train_ml, test_ml = (fit_rows(t, columns, spec.label, invalid="error") for t in (train, test))
    with kept(train_ml, test_ml):
        forest, regression = train_models(two_models(), train_ml, test_ml)
    best = better_of_two(forest, regression)
    save_model(best.model, model_path)
    importance = feature_importance(spark, forest.model, columns, None)
    reports = {f"feature_importance/{forest.name}": importance}
    return Selected(comparison_table(spark, [forest, regression]), best, [forest, regression], reports)


def describe_saved_model(
    spark: SparkSession, path: str, features: Sequence[str] | None = None
) -> DataFrame:
    """What a saved model contains, whatever its class."""
    return model_contents(spark, path, load_model(spark, path), features)
