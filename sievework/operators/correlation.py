"""Pearson correlations as tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.ranking import top_by_magnitude
from sievework.sources.scratch import scratch_dir
from sievework.sources.small import small_table

TARGET_TOP = 12
PAIR_TOP = 10
WIDE = 200  # more columns than this are correlated in blocks
BLOCK = 100
HELD = 1 << 24  # cells of the matrix in a task
MERGERS = 64


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, position_a, position_b, r) for all ordered pairs.

    The matrix is summed up on the executors in one pass; its size depends on the number
    of columns only. Up to ``WIDE`` columns it comes to the driver as a whole, more stay in
    blocks (:func:`blocked_correlations`). Constant columns give NULL.
    """
    if len(columns) > WIDE:
        return blocked_correlations(df, columns)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="v", handleInvalid="skip")
    vectors = assembler.transform(df.select(list(columns))).select("v")
    matrix = Correlation.corr(vectors, "v").head()[0].toArray()
    p = len(columns)
    cells = [(i, j, float(matrix[i, j])) for i in range(p) for j in range(p)]
    long = small_table(df.sparkSession, cells, "position_a int, position_b int, r double")
    names = F.array(*[F.lit(c) for c in columns])
    return long.select(
        names[F.col("position_a")].alias("feature_a"),
        names[F.col("position_b")].alias("feature_b"),
        "position_a",
        "position_b",
        F.nanvl("r", F.lit(None).cast("double")).alias("r"),
    )


MOMENTS = "i int, j int, part int, n long, mean_i array<double>, mean_j array<double>, c array<double>"


def _merged(one: tuple, other: tuple) -> tuple:
    """Co-moments of two sets of rows together, from (n, mean_i, mean_j, c) of each."""
    (n, mi, mj, c), (m, ni, nj, d) = one, other
    both = n + m
    if not both:
        return one
    di, dj = ni - mi, nj - mj
    return both, mi + di * (m / both), mj + dj * (m / both), c + d + np.outer(di, dj) * (n * m / both)


def _task_moments(batches: Iterator[pa.RecordBatch], p: int, block: int, pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """One row per pair of blocks with the co-moments of a task's complete rows."""
    held = {}
    for batch in batches:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, p)
        x = x[~np.isnan(x).any(axis=1)]
        if not len(x):
            continue
        mean = x.mean(axis=0)
        centered = x - mean
        for i, j in pairs:
            a, b = (slice(k * block, (k + 1) * block) for k in (i, j))
            new = (len(x), mean[a], mean[b], centered[:, a].T @ centered[:, b])
            held[i, j] = _merged(held[i, j], new) if (i, j) in held else new
    for (i, j), (n, mi, mj, c) in held.items():
        yield _moment_rows([(i, j, 0, n, mi, mj, c)])


def _moment_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*[(i, j, part, n, mi.tolist(), mj.tolist(), c.ravel().tolist()) for i, j, part, n, mi, mj, c in rows]))
    kinds = [pa.int32()] * 3 + [pa.int64()] + [pa.list_(pa.float64())] * 3
    names = ["i", "j", "part", "n", "mean_i", "mean_j", "c"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _sum_moments(rows: pa.Table) -> pa.Table:
    total = None
    for r in rows.to_pylist():
        mi, mj = np.array(r["mean_i"]), np.array(r["mean_j"])
        new = (r["n"], mi, mj, np.array(r["c"]).reshape(len(mi), len(mj)))
        total = _merged(total, new) if total else new
    return pa.Table.from_batches([_moment_rows([(r["i"], r["j"], r["part"], *total)])])


def blocked_correlations(
    df: DataFrame, columns: Sequence[str], block: int = BLOCK, held: int = HELD, work_dir: str | None = None
) -> DataFrame:
    """The same table as :func:`correlation_matrix`, for many columns: the matrix never is in one place.

    Every task sums up the co-moments of its rows for each pair of blocks of ``block`` columns, about its own means, which keeps
    them exact to rounding whatever the size of the values. Blocks are merged by pair, in two steps so that no task merges those of all
    others. A task holds at most about ``held`` cells; wider tables are scanned again for each further share of the
    blocks. The driver sees one deviation per column. Rows with a NULL or NaN are left out.
    """
    spark, p = df.sparkSession, len(columns)
    count = -(-p // block)
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    share = max(1, held // block**2)
    vectors = df.select(F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in columns]).alias("v"))
    parts = []
    for at in range(0, len(pairs), share):
        some = pairs[at : at + share]
        parts.append(vectors.mapInArrow(lambda it, some=some: _task_moments(it, p, block, some), MOMENTS))
    moments = parts[0]
    for more in parts[1:]:
        moments = moments.unionByName(more)
    moments = moments.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGERS)).cast("int"))
    for keys in (["i", "j", "part"], ["i", "j"]):
        moments = moments.groupBy(*keys).applyInArrow(_sum_moments, MOMENTS)
    path = work_dir or scratch_dir(spark)
    moments.write.mode("overwrite").parquet(path)
    moments = spark.read.schema(moments.schema).parquet(path)
    squares = np.full(p, np.nan)
    on_diagonal = F.transform("mean_i", lambda _, k: F.col("c")[k * (F.size("mean_i") + 1)])
    for r in moments.where("i = j").select("i", on_diagonal.alias("squares")).collect():  # one number per column
        squares[r["i"] * block : r["i"] * block + len(r["squares"])] = r["squares"]
    with np.errstate(invalid="ignore", divide="ignore"):
        scale = np.where(squares > 0, 1 / np.sqrt(squares), np.nan)
    names = list(columns)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                i, j, width = row["i"], row["j"], len(row["mean_j"])
                a, b = i * block + np.arange(len(row["mean_i"])), j * block + np.arange(width)
                r = np.array(row["c"]).reshape(len(a), width) * (scale[a][:, None] * scale[b][None, :])
                r = (r + r.T) / 2 if i == j else r
                sides = [(a, b, r)] if i == j else [(a, b, r), (b, a, r.T)]
                for rows, others, values in sides:
                    at, to, flat = np.repeat(rows, len(others)), np.tile(others, len(rows)), values.ravel().copy()
                    flat[at == to] = 1.0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[k] for k in at]), pa.array([names[k] for k in to]), pa.array(at.astype(np.int32)),
                         pa.array(to.astype(np.int32)), pa.array(flat, mask=np.isnan(flat))],
                        names=["feature_a", "feature_b", "position_a", "position_b", "r"],
                    )

    return moments.mapInArrow(cells, "feature_a string, feature_b string, position_a int, position_b int, r double")


def _with_target(matrix: DataFrame, p: int, k: int | None) -> DataFrame:
    """Correlations of the first ``p`` columns with the one after them."""
    cells = matrix.where((F.col("position_b") == p) & (F.col("position_a") < p))
    named = cells.select(F.col("feature_a").alias("feature"), "r")
    return top_by_magnitude(named, "r", k or p, ["feature"])


def _pairs(matrix: DataFrame, p: int, k: int | None) -> DataFrame:
    """Correlations among the first ``p`` columns, each pair once."""
    cells = matrix.where((F.col("position_a") < F.col("position_b")) & (F.col("position_b") < p))
    top = top_by_magnitude(cells, "r", k or p * p, ["position_a", "position_b"])
    return top.select("feature_a", "feature_b", "r")


def target_correlations(
    df: DataFrame, features: Sequence[str], label: str, k: int | None = TARGET_TOP
) -> DataFrame:
    """(feature, r) with the label, strongest first; ``k`` rows, all with ``None``."""
    return _with_target(correlation_matrix(df, [*features, label]), len(features), k)


def pair_correlations(
    df: DataFrame, features: Sequence[str], k: int | None = PAIR_TOP
) -> DataFrame:
    """(feature_a, feature_b, r) of the strongest pairs, each pair once; all with ``None``."""
    return _pairs(correlation_matrix(df, features), len(features), k)


def correlation_report(
    features: DataFrame,
    names: Sequence[str],
    label: str,
    k_target: int | None = TARGET_TOP,
    k_pairs: int | None = PAIR_TOP,
) -> tuple[DataFrame, DataFrame]:
    """The strongest correlations with the label and between features, from one matrix.

    The numbers of rows are the report's usual ones; ``None`` gives all.
    """
    matrix = correlation_matrix(features, [*names, label])
    return _with_target(matrix, len(names), k_target), _pairs(matrix, len(names), k_pairs)
