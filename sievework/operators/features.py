"""Engineered features and one-hot indicators of a clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework import functions as fx
from sievework.spec import TableSpec, indicator_name


def add_engineered_features(clean: DataFrame, spec: TableSpec) -> DataFrame:
    """The derived columns of the feature spec, stage by stage, and the 0/1 label."""
    out = clean
    for stage in spec.feature_spec.derived:
        out = out.withColumns({name: build() for name, build in stage.items()})
    if spec.target:
        out = out.withColumn(spec.label, fx.binary_label(spec.target, spec.positive_value))
    return out


def add_one_hot(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One 0/1 column per level of the declared domains, except the baseline.

    The domains are known, so nothing is fitted and no data is read for it. A value
    outside the domain looks like the baseline: all indicators 0.
    """
    indicators = {
        indicator_name(source, level): fx.indicator(source, level)
        for source in spec.feature_spec.one_hot
        for level in spec[source].levels
    }
    return df.withColumns(indicators)


def feature_table(clean: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, scalable features, binary features, indicators and label, in that order."""
    wide = add_one_hot(add_engineered_features(clean, spec), spec)
    columns = [spec.key] if spec.key else []
    columns += spec.feature_names
    if spec.target:
        columns.append(spec.label)
    return wide.select([F.col(c) for c in columns])
