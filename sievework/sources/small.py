"""Tables from results that are on the driver already."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def small_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A table from a short list of result rows, such as the cells of a matrix of columns."""
    return spark.createDataFrame(list(rows), schema)
