"""The profile and the quality report of a table, from few scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.profile import (
    duplicate_keys,
    duplicate_rows,
    frequency_tables,
    numeric_summary,
)
from sievework.operators.quality import (
    DEFAULT_OPTIONS,
    add_quality_flags,
    evaluated_once,
    is_rejected,
)
from sievework.sources.scratch import scratch_dir
from sievework.sources.small import small_table
from sievework.spec import QualityOptions, TableSpec


def full_profile(
    df: DataFrame,
    spec: TableSpec,
    options: QualityOptions = DEFAULT_OPTIONS,
    accuracy: int = 1_000,
    work_dir: str | None = None,
) -> dict[str, DataFrame]:
    """Profile and quality report of a typed table: shape, columns, nulls, numbers, violations,
    categories, target, unknown_labels, duplicate_rows and duplicate_keys.

    Six scans, whatever the number of reports: one aggregate for all that is counted per
    column or rule, one for the numbers, one for the values of all categories, two for
    whole rows and one for keys. The first comes to the driver, a few numbers per column; the values of the
    categories are stored in ``work_dir``, as there may be many; the others run when they are looked at. With the options of the
    clean-up, the violations are those that reject its rows.
    """
    spark = df.sparkSession
    flagged = evaluated_once(add_quality_flags(df, spec, options))
    rules = {f: F.col(f) for f in spec.flags} | {"any_rule": is_rejected(spec)}
    rules |= {n: condition() for n, condition in spec.observed.items()}
    counted = flagged.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
        *[F.count_if(condition).alias(f"r{i}") for i, condition in enumerate(rules.values())],
    )
    row = counted.head()
    rows = row["rows"]
    nulls = [rows - row[f"n{i}"] for i in range(len(df.columns))]
    expected = set(spec.names)
    audit = [
        (i + 1, f.name, f.dataType.simpleString(), int(f.nullable), int(f.name in expected), rows, n)
        for i, (f, n) in enumerate(zip(df.schema.fields, nulls))
    ]
    reports = {
        "shape": small_table(spark, [(rows, len(df.columns))], "rows bigint, columns int"),
        "columns": small_table(
            spark,
            audit,
            "position int, column string, type string, nullable int, expected int, rows bigint, nulls bigint",
        ),
        "nulls": small_table(spark, zip(df.columns, nulls), "column string, nulls bigint"),
        "violations": small_table(
            spark, [(n, row[f"r{i}"]) for i, n in enumerate(rules)], "rule string, violations bigint"
        ),
        "duplicate_rows": duplicate_rows(df.select(spec.names)),
    }
    if spec.numeric:
        reports["numbers"] = numeric_summary(df, spec.numeric, accuracy)
    if spec.key:
        reports["duplicate_keys"] = duplicate_keys(df, [spec.key])
    if spec.categorical:
        path = f"{work_dir.rstrip('/')}/categories" if work_dir else scratch_dir(spark)
        found = frequency_tables(df, spec.categorical)
        found.write.mode("overwrite").parquet(path)
        categories = spark.read.schema(found.schema).parquet(path)
        reports["categories"] = categories
        known = [F.struct(F.lit(c).alias("column"), F.lit(v).alias("value")) for c in spec.categorical for v in spec[c].domain]
        unknown = categories.where(
            F.col("value").isNotNull() & ~F.struct("column", "value").isin(known)
        )
        reports["unknown_labels"] = unknown.select("column", "value")
        if spec.target in spec.categorical:
            share = F.round(F.try_divide(F.col("count") * 100, F.lit(rows)), 2)
            target = categories.where(F.col("column") == spec.target)
            reports["target"] = target.select(
                F.col("value").alias(spec.target), "count", share.alias("percentage")
            ).orderBy(F.desc("count"), spec.target)
    return reports


PROFILE = ("shape", "columns", "nulls", "categories", "numbers", "target")
FINDINGS = ("duplicate_rows", "violations", "unknown_labels", "duplicate_keys")


def profile_table(df: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    """Shape, columns, NULLs, categories, numbers and target of a typed table."""
    found = full_profile(df, spec)
    return {n: found[n] for n in PROFILE if n in found}


def quality_findings(
    df: DataFrame, spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS
) -> dict[str, DataFrame]:
    """What is wrong with a typed table: duplicates, violations and unknown labels."""
    found = full_profile(df, spec, options)
    return {n: found[n] for n in FINDINGS if n in found}
