"""Profiling: each report is one scan of the columns it needs.

Counts that describe the whole table are partial aggregates that shuffle one row per
partition. Reports per value group on the value with map-side combine, so one value
that holds a third of the rows costs no more than any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework import functions as fx
from sievework.sources.small import small_table
from sievework.spec import TableSpec

QUARTILES = (0.25, 0.5, 0.75)


def table_shape(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def _one_row_per_column(counts: DataFrame, columns: Sequence[str], prefix: str, value: str) -> DataFrame:
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"{prefix}{i}").alias(value))
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, one row per column."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    return _one_row_per_column(counts, columns, "c", "nulls")


def value_distribution(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Count and percentage of every value of a column.

    The total comes from the grouped counts, in a scalar subquery that reuses their
    shuffle, so the table is read once.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    rows = counts.agg(F.sum("count")).scalar()
    share = F.round(F.try_divide(F.col("count") * 100, rows), digits)
    return counts.select(column, "count", share.alias("percentage"))


def frequency_tables(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count) for several columns in one pass, instead of one query each."""
    text = df.select([F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def numeric_summary(df: DataFrame, columns: Sequence[str], accuracy: int = 1_000) -> DataFrame:
    """Count, mean, sample deviation, extremes and approximate quartiles per column.

    One lazy scan. Every task sums up its rows as counts, means, squared deviations, extremes and one quantile
    sketch per column. These are merged in two steps, first in ``MERGERS`` groups of tasks and then all, so
    no task merges the sketches of all others. The ranks of the quartiles are off by about 1/accuracy of the rows; where a column has
    no more than some thousand values they are exact. :func:`exact_percentiles` gives exact ones for any size.
    """
    parts, wholes = [], []
    k = sketch_size(accuracy)
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        parts += [
            F.count(value).alias(f"n{i}"), F.avg(value).alias(f"mean{i}"), (F.var_pop(value) * F.count(value)).alias(f"square{i}"),
            F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}"), F.kll_sketch_agg_double(value, k).alias(f"sketch{i}"),
        ]
        group = F.struct(F.col(f"n{i}").alias("n"), F.col(f"mean{i}").alias("mean"), F.col(f"square{i}").alias("square"))
        wholes += [
            F.collect_list(F.when(F.col(f"n{i}") > 0, group)).alias(f"groups{i}"), F.min(f"min{i}").alias(f"min{i}"),
            F.max(f"max{i}").alias(f"max{i}"), F.kll_merge_agg_double(F.when(F.col(f"n{i}") > 0, F.col(f"sketch{i}"))).alias(f"sketch{i}"),
        ]
    merged = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_group")).agg(*parts).agg(*wholes)
    return merged.select(F.inline(F.array(*[_summary(c, i) for i, c in enumerate(columns)])))


MERGERS = 64


def sketch_size(accuracy: int) -> int:
    """Size of a quantile sketch whose ranks are off by about 1/accuracy, from the published error of 2.296 / k ** 0.9021."""
    return min(65_535, max(8, math.ceil((2.296 * accuracy) ** (1 / 0.9021))))


def _summary(column: str, i: int) -> Column:
    """The struct of a column from the merged groups, of which there are ``MERGERS`` at most."""
    groups, zero = F.col(f"groups{i}"), F.lit(0.0)
    n = F.aggregate(groups, F.lit(0).cast("long"), lambda s, g: s + g["n"])
    mean = F.try_divide(F.aggregate(groups, zero, lambda s, g: s + g["n"] * g["mean"]), n)
    # The squares of a group are about its own mean; what that is off from the common one is added.
    square = F.aggregate(groups, zero, lambda s, g: s + g["square"] + g["n"] * (g["mean"] - mean) * (g["mean"] - mean))
    sketch = F.col(f"sketch{i}")
    filled = (n > 0) & (F.kll_sketch_get_n_double(sketch) > 0)
    quarters = {f"p{round(100 * q)}": F.when(filled, F.kll_sketch_get_quantile_double(sketch, F.lit(q))) for q in QUARTILES}
    return F.struct(
        F.lit(column).alias("column"), n.alias("count"), mean.alias("mean"),
        F.sqrt(F.try_divide(square, F.when(n > 1, n - 1))).alias("stddev"), F.col(f"min{i}").alias("min"),
        *[v.alias(name) for name, v in quarters.items()], F.col(f"max{i}").alias("max"),
    )


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
    cells: int = 1_000,
) -> DataFrame:
    """(column, probability, value): the smallest value with at least that share of the
    non-NULL, non-NaN values at or below it.

    Approximate percentiles a little to each side, from sketches merged in a tree of tasks,
    bracket every answer; they come to the driver, two numbers for each. One scan counts what
    lies below each bracket. Another counts the distinct values inside, about 6/accuracy of the
    rows. Each bracket is cut into ``cells`` of equal width: running sums go cell by cell in
    parallel, and a table of at most ``cells`` rows per bracket has what lies before each cell.
    """
    margin = 3.0 / accuracy
    names = {c: f"v{i}" for i, c in enumerate(columns)}
    wanted = [(c, p, f"{names[c]}_{j}") for c in columns for j, p in enumerate(probabilities)]
    values = df.select(
        [F.when(~F.isnan(c), F.col(c).cast("double")).alias(v) for c, v in names.items()]
    )
    shares = sorted({min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-margin, margin)})
    inner = [s for s in shares if 0 < s < 1]
    sketch = dict(zip(names.values(), values.approxQuantile(values.columns, inner, 1.0 / accuracy)))
    ends = values.agg(
        *[f(v).alias(f"{n}_{v}") for v in names.values() for n, f in (("min", F.min), ("max", F.max), ("n", F.count))]
    ).head()

    # At the ends the extremes close a bracket for certain.
    def edge(v: str, p: float) -> float:
        if p <= 0:
            return ends[f"min_{v}"]
        return ends[f"max_{v}"] if p >= 1 else sketch[v][inner.index(p)]

    filled = [(c, p, k) for c, p, k in wanted if ends[f"n_{names[c]}"]]
    low = {k: edge(names[c], p - margin) for c, p, k in filled}
    high = {k: edge(names[c], p + margin) for c, p, k in filled}
    found = {}
    if filled:
        below = values.agg(*[F.count_if(F.col(names[c]) < low[k]).alias(k) for c, _, k in filled]).head()
        rank = {
            k: max(math.ceil(Decimal(str(p)) * ends[f"n_{names[c]}"]), 1) - below[k] for c, p, k in filled
        }

        def cell(v: Column, k: str) -> Column:
            place = F.floor((v - low[k]) / (high[k] - low[k]) * cells) if high[k] > low[k] else F.lit(0)
            inside = F.least(place.cast("double"), F.lit(cells - 1.0))
            # Infinite ends give no width to divide by; order is kept with the ends in the outer cells.
            inside = F.when(F.isnan(inside), F.lit(0.0)).otherwise(inside)
            return F.when(v == low[k], 0).when(v == high[k], cells - 1).otherwise(inside.cast("int"))

        inside = [
            F.when(
                F.col(names[c]).between(low[k], high[k]),
                F.struct(F.lit(k).alias("k"), cell(F.col(names[c]), k).alias("cell"), F.col(names[c]).alias("value")),
            )
            for c, _, k in filled
        ]
        grouped = (
            values.select(F.inline(F.array_compact(F.array(*inside))))
            .groupBy("k", "cell", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        before = Window.partitionBy("k").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            grouped.groupBy("k", "cell")
            .agg(F.sum("n").alias("n"))
            .select("k", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        )
        within = Window.partitionBy("k", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        ranked = grouped.withColumn("upto", F.sum("n").over(within)).join(offsets, ["k", "cell"])
        upto = F.col("upto") + F.col("before")
        # The value whose running count first reaches the wanted rank.
        hits = [
            F.max(F.when((F.col("k") == k) & (upto >= r) & (upto - F.col("n") < r), F.col("value"))).alias(k)
            for k, r in rank.items()
        ]
        found = ranked.agg(*hits).head().asDict()
        missed = [k for k in rank if found[k] is None]
        if missed:
            raise RuntimeError(f"no exact percentile found in the brackets of {missed}")
    rows = [(c, float(p), found.get(k)) for c, p, k in wanted]
    return small_table(df.sparkSession, rows, "column string, probability double, value double")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and rows beyond the first of their key.

    Only the key is read and shuffled. A NULL key counts as one key.
    """
    return _excess(df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")))


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row. A row hash skips NULLs, so which columns are NULL is hashed as well."""
    keys = [F.col(f"`{c}`") for c in columns]
    keys = [F.array(*[k.isNull() for k in keys]), *keys]
    return [F.xxhash64(*keys).alias("_h1"), F.xxhash64(F.lit("second"), *keys[::-1]).alias("_h2")]


def duplicate_rows(df: DataFrame, fingerprint: bool = False) -> DataFrame:
    """Rows, distinct full rows and rows beyond the first of their kind.

    Rows are counted by two 64-bit hashes first, a small shuffle of fixed width however wide they are. A row
    whose hashes occur once is distinct for certain. Only the rows whose hashes repeat are compared
    in full, so that a collision cannot make two different rows one; where few rows repeat, few are shuffled.
    ``fingerprint`` takes the hashes for the rows and leaves the comparison out: one scan instead of two, for a count that is
    only right up to a 128-bit hash collision.
    """
    hashes = row_hashes(df.columns)
    counts = df.groupBy(*hashes).agg(F.count(F.lit(1)).alias("n"))
    if fingerprint:
        return _excess(counts)
    once = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") == 1).alias("distinct_rows")
    )
    repeated = counts.where("n > 1").select(F.col("_h1").alias("_r1"), F.col("_h2").alias("_r2"))
    hashed = df.select("*", *hashes)
    several = hashed.join(repeated, (F.col("_h1") == F.col("_r1")) & (F.col("_h2") == F.col("_r2")), "left_semi")
    compared = several.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    both = once.unionByName(compared.agg(F.lit(0).cast("long").alias("rows"), F.count("n").alias("distinct_rows")))
    totals = both.agg(F.sum("rows").alias("rows"), F.sum("distinct_rows").alias("distinct_rows"))
    return totals.withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def _excess(groups: DataFrame) -> DataFrame:
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("n").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def violation_totals(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """(rule, violations): one row per quality flag, the rows rejected by any of them, and
    the conditions that are observed only."""
    rules = {f: F.col(f) for f in spec.flags} | {
        "any_rule": fx.any_true(F.col(f) for f in spec.flags)
    }
    return rule_totals(flagged, rules | {n: condition() for n, condition in spec.observed.items()})


def rule_totals(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations): in how many rows each condition is TRUE."""
    totals = df.agg(*[F.count_if(condition).alias(f"r{i}") for i, condition in enumerate(rules.values())])
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*entries)))


def unknown_labels(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(column, value) for every non-NULL value outside its column's domain; one pass."""
    columns = spec.categorical
    entries = [
        F.when(
            ~F.col(c).isin(list(spec[c].domain)),
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value")),
        )
        for c in columns
    ]
    found = df.select(F.inline(F.array_compact(F.array(*entries))))
    return found.distinct()


def retention_summary(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows kept, rows removed and all rows."""
    rejected = fx.any_true(F.col(f) for f in spec.flags)
    return flagged.agg(
        F.count_if(~rejected).alias("kept"),
        F.count_if(rejected).alias("removed"),
        F.count(F.lit(1)).alias("total"),
    )
