"""Standardisation with statistics of the training rows only.

The statistics stay inside the plan: one aggregate row that the scaled columns refer to
as a scalar subquery. Nothing is collected and nothing is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.split import TRAIN_SHARE, hash_split, in_train
from sievework.spec import TableSpec

SPLIT, TRAIN, TEST = "split", "train", "test"


def scaling_statistics(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``<column>_mean`` and ``<column>_std`` (sample deviation), in one scan.

    Evaluating it raises when a column has no value to learn from, as in an empty table.
    """
    aggregates = [F.avg(c).alias(f"{c}_mean") for c in columns]
    aggregates += [F.stddev_samp(c).alias(f"{c}_std") for c in columns]
    stats = train.agg(*aggregates)
    checked = []
    for c in columns:
        error = F.raise_error(F.lit(f"no training value of {c} to compute scaling statistics from"))
        mean = F.col(f"{c}_mean")
        checked.append(
            F.when(mean.isNull(), error.cast("double")).otherwise(mean).alias(f"{c}_mean")
        )
        checked.append(F.col(f"{c}_std"))
    return stats.select(checked)


def scaling_table(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same statistics as (column, mean, std) rows."""
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}_mean").alias("mean"),
            F.col(f"{c}_std").alias("std"),
        )
        for c in columns
    ]
    return scaling_statistics(train, columns).select(F.inline(F.array(*entries)))


def standardize_columns(
    df: DataFrame,
    statistics: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = (),
    digits: int = 6,
) -> DataFrame:
    """``keep`` columns and ``<column>_scaled`` = round((x - mean) / std, digits).

    A constant column (deviation 0, or NULL when there is a single training row) scales to 0.0.
    """
    # One reference to the subquery, so that it is planned once however many columns there are.
    stated = df.withColumn("_stats", statistics.select(F.struct("*")).scalar())
    s = F.col("_stats")
    scaled = []
    for c in columns:
        std = s[f"{c}_std"]
        z = F.round(F.try_divide(F.col(c) - s[f"{c}_mean"], std), digits)
        constant = std.isNull() | (std == 0)
        scaled.append(F.when(constant, F.lit(0.0)).otherwise(z).alias(f"{c}_scaled"))
    return stated.select(*[F.col(c) for c in keep], *scaled)


def normalize(
    df: DataFrame,
    statistics: DataFrame,
    spec: TableSpec,
    keep_key: bool = True,
    digits: int = 6,
    also: Sequence[str] = (),
) -> DataFrame:
    """Feature table to model input: key, scaled features, 0/1 features, label and ``also`` other columns."""
    f = spec.feature_spec
    rest = [*f.binary, *spec.one_hot_names, *([spec.label] if spec.target else [])]
    head = [spec.key] if keep_key and spec.key else []
    scaled = standardize_columns(df, statistics, f.scaled, keep=[*head, *rest, *also], digits=digits)
    return scaled.select([*head, *[f"{c}_scaled" for c in f.scaled], *rest, *also])


def train_test_tables(
    features: DataFrame,
    spec: TableSpec,
    keep_key: bool = True,
    train_share: int = TRAIN_SHARE,
    method: str = "xxhash64",
    digits: int = 6,
) -> tuple[DataFrame, DataFrame]:
    """Split, learn the scaling on the training side, apply it to both sides."""
    train, test = hash_split(features, spec.key, train_share, method)
    statistics = scaling_statistics(train, spec.feature_spec.scaled)
    return (
        normalize(train, statistics, spec, keep_key, digits),
        normalize(test, statistics, spec, keep_key, digits),
    )


def split_rows(
    features: DataFrame,
    spec: TableSpec,
    keep_key: bool = True,
    train_share: int = TRAIN_SHARE,
    method: str = "xxhash64",
    digits: int = 6,
) -> DataFrame:
    """Both sides of the split in one table, standardised by the training side, with the side in ``SPLIT``.

    Writing it scans ``features`` twice: once for the statistics, once for all rows of either side.
    """
    side = F.when(in_train(spec.key, train_share, method), TRAIN).otherwise(TEST)
    sided = features.withColumn(SPLIT, side)
    statistics = scaling_statistics(sided.where(F.col(SPLIT) == TRAIN), spec.feature_spec.scaled)
    return normalize(sided, statistics, spec, keep_key, digits, also=[SPLIT])


def write_split(features: DataFrame, spec: TableSpec, path: str, **options) -> tuple[DataFrame, DataFrame]:
    """(train, test) read back from one write to ``path``, partitioned by side; each reads its own partition only."""
    rows = split_rows(features, spec, **options)
    rows.write.mode("overwrite").partitionBy(SPLIT).parquet(path)
    stored = features.sparkSession.read.schema(rows.schema).parquet(path)
    train, test = (stored.where(F.col(SPLIT) == side).drop(SPLIT) for side in (TRAIN, TEST))
    return train, test
