"""Schema contract and column audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.spec import TableSpec


def check_columns(found: list[str], expected: list[str], ordered: bool = False) -> None:
    """Raise ``ValueError`` naming missing and extra columns (or a wrong order)."""
    missing = sorted(set(expected) - set(found))
    extra = sorted(set(found) - set(expected))
    if missing or extra:
        raise ValueError(f"schema contract broken: missing columns {missing}, extra columns {extra}")
    if ordered and list(found) != list(expected):
        raise ValueError(f"schema contract broken: columns in order {list(found)}, expected {expected}")


def check_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The contract on the names of ``df``; reads no data and returns ``df`` for chaining."""
    check_columns(df.columns, spec.names)
    return df


def column_audit(df: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """One row per column: position, name, type, nullability, whether the spec expects it,
    and the number of rows and NULLs found. One scan, one partial aggregate."""
    expected = set(spec.names) if spec else set(df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(int(f.nullable)).alias("nullable"),
            F.lit(int(f.name in expected)).alias("expected"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n_{i}")).alias("nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*entries)))
