"""Text clean-up, typed coercion, quality flags and the accepted / rejected split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import functions as fx
from sievework.operators.contract import check_schema
from sievework.operators.profile import duplicate_keys
from sievework.spec import (
    BINARY_FLAG,
    CATEGORY_FLAG,
    DOUBLE,
    INTEGER,
    LONG,
    MISSING_FLAG,
    NEGATIVE_FLAG,
    TARGET_FLAG,
    QualityOptions,
    TableSpec,
)

DEFAULT_OPTIONS = QualityOptions()
ACCEPTED = "accepted"


def trim_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every spec column as text without surrounding spaces."""
    names = set(spec.names)
    return df.select([fx.trimmed(c).alias(c) if c in names else F.col(c) for c in df.columns])


def coerce_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Numeric spec columns from text to int / double; what does not parse becomes NULL."""
    casts = {INTEGER: fx.safe_int, LONG: fx.safe_long, DOUBLE: fx.safe_double}
    kinds = {c.name: casts[c.kind] for c in spec.columns if c.numeric}
    return df.select([kinds[c](F.col(c)).alias(c) if c in kinds else F.col(c) for c in df.columns])


def standardize(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Trim, then coerce."""
    return coerce_types(trim_columns(df, spec), spec)


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows behind a boundary that the optimizer moves no filter across.

    Without it every filter on the flags is rewritten in terms of the raw text, which
    repeats all casts and date parsing in each condition: slower rows and generated code
    that outgrows the compiler. A one-element generator is row-local, so nothing is
    shuffled or stored.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def rule_conditions(spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS) -> dict[str, Column]:
    """Flag name -> condition, over typed columns and the assembled date and sums.

    The sum rules are NULL when an addend is NULL; such a row is caught by the
    missing-value rule. All other conditions are never NULL.
    """
    missing = [F.col(c).isNull() for c in spec.names]
    if options.reject_nan:
        missing += [F.isnan(c.name) for c in spec.columns if c.kind == DOUBLE]
    if options.blank_is_null:
        missing += [F.col(c.name) == "" for c in spec.columns if not c.numeric]
    rules = {MISSING_FLAG: F.coalesce(fx.any_true(missing), F.lit(False))}
    if spec.date:
        rules[spec.date.flag] = F.col(spec.date.output).isNull()
    for rule in spec.sums:
        rules[rule.flag] = F.col(rule.output) <= 0
    negative = fx.any_true(F.col(c) < 0 for c in spec.numeric)
    rules[NEGATIVE_FLAG] = F.coalesce(negative, F.lit(False))
    if spec.binaries:
        rules[BINARY_FLAG] = fx.any_true(fx.not_in_domain(c, (0, 1)) for c in spec.binaries)
    if spec.categorical:
        rules[CATEGORY_FLAG] = fx.any_true(
            fx.not_in_domain(c, spec[c].domain) for c in spec.categorical
        )
    if spec.target:
        rules[TARGET_FLAG] = fx.not_in_domain(spec.target, spec[spec.target].domain)
    return rules


def add_check_columns(
    df: DataFrame, spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS
) -> DataFrame:
    """Typed rows plus the assembled date and the check sums."""
    derived = {}
    if spec.date:
        d = spec.date
        derived[d.output] = fx.date_from_parts(
            F.col(d.year), F.col(d.month), F.col(d.day), strict=options.strict_date_parts
        )
    for rule in spec.sums:
        # Whole numbers are summed as bigint, so that 32-bit addends cannot overflow.
        kinds = {spec[c].kind for c in rule.columns}
        derived[rule.output] = (
            fx.total(*rule.columns) if kinds <= {INTEGER, LONG} else sum(map(F.col, rule.columns))
        )
    return df.withColumns(derived)


def add_quality_flags(
    df: DataFrame, spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS
) -> DataFrame:
    """Typed rows plus the assembled date, the check sums and one boolean per rule."""
    return add_check_columns(df, spec, options).withColumns(rule_conditions(spec, options))


def is_rejected(spec: TableSpec) -> Column:
    """TRUE when any flag is; a NULL flag never hides another one that is TRUE."""
    return fx.any_true(F.col(flag) for flag in spec.flags)


def flag_rows(
    raw: DataFrame, spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS
) -> DataFrame:
    """Raw text rows to typed rows with all quality flags."""
    typed = standardize(check_schema(raw, spec), spec)
    return evaluated_once(add_quality_flags(typed, spec, options))


def rejection_report(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Key and flags (0, 1 or NULL) of every rejected row."""
    flags = [F.col(f).cast("int").alias(f) for f in spec.flags]
    return flagged.where(is_rejected(spec)).select(spec.key, *flags)


def accepted_rows(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed columns of every row that breaks no rule."""
    return flagged.where(~is_rejected(spec)).select(spec.clean_names)


def clean_and_rejected(
    raw: DataFrame, spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS
) -> tuple[DataFrame, DataFrame]:
    """The accepted table and the rejection report, both lazy over one flagged plan.

    The two together read the input twice; :func:`write_verdicts` reads it once.
    """
    flagged = flag_rows(raw, spec, options)
    return accepted_rows(flagged, spec), rejection_report(flagged, spec)


def write_verdicts(
    raw: DataFrame, spec: TableSpec, path: str, options: QualityOptions = DEFAULT_OPTIONS
) -> tuple[DataFrame, DataFrame]:
    """Clean in one pass: rows go to ``path`` as Parquet, partitioned by their verdict.

    Returns the accepted table and the rejection report read back from it, each
    reading only its own partition.
    """
    verdict = F.coalesce(~is_rejected(spec), F.lit(False)).cast("int")
    columns = [*spec.clean_names, *spec.flags]
    flagged = flag_rows(raw, spec, options).select(*columns, verdict.alias(ACCEPTED))
    flagged.write.mode("overwrite").partitionBy(ACCEPTED).parquet(path)

    # The schema is given, so an empty side still reads as an empty table.
    stored = raw.sparkSession.read.schema(flagged.schema).parquet(path)
    clean = stored.where(F.col(ACCEPTED) == 1).select(spec.clean_names)
    flags = [F.col(f).cast("int").alias(f) for f in spec.flags]
    return clean, stored.where(F.col(ACCEPTED) == 0).select(spec.key, *flags)


def clean_violations(
    clean: DataFrame, spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS
) -> DataFrame:
    """What is wrong with a table that should be clean, as (check, column, violations).

    NULL counts and rule violations are one scan with a partial aggregate; duplicate
    keys are a second one that only shuffles keys.
    """
    sums = {("missing_value", c): F.count_if(F.col(c).isNull()) for c in spec.names}
    inputs = [F.col(c) for c in spec.names]
    if spec.date:
        # The rules assemble the date again, so the stored one is kept under another name.
        inputs.append(F.col(spec.date.output).alias("_stored_date"))
        sums["missing_value", spec.date.output] = F.count_if(F.col("_stored_date").isNull())
    sums["rejected_row", "*"] = F.count_if(is_rejected(spec))
    checked = add_quality_flags(clean.select(inputs), spec, options)
    totals = checked.agg(*[s.alias(f"v{i}") for i, s in enumerate(sums.values())])
    entries = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, (check, column) in enumerate(sums)
    ]
    report = totals.select(F.inline(F.array(*entries)))
    if spec.key is None:
        return report
    keys = duplicate_keys(clean, [spec.key]).select(
        F.lit("duplicate_key").alias("check"),
        F.lit(spec.key).alias("column"),
        F.col("duplicates").alias("violations"),
    )
    return report.unionByName(keys)


def assert_clean(
    clean: DataFrame, spec: TableSpec, options: QualityOptions = DEFAULT_OPTIONS
) -> None:
    """Raise ``ValueError`` when :func:`clean_violations` finds anything.

    At most one short row per column and check comes to the driver.
    """
    broken = clean_violations(clean, spec, options).where("violations > 0").collect()
    if broken:
        found = ", ".join(f"{r['check']}({r['column']}): {r['violations']}" for r in broken)
        raise ValueError(f"table {spec.name!r} is not clean: {found}")
