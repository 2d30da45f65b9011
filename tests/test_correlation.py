"""Correlations in blocks against the matrix in one place, and for more columns than that could hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import correlation


def cells(df):
    return {(r["feature_a"], r["feature_b"], r["position_a"], r["position_b"]): r["r"] for r in df.collect()}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 7))
    x[:, 1] = 1e5 + x[:, 0] * 1e-3 + x[:, 1] * 1e-4
    x[:, 2] = 5.0
    rows = [tuple(map(float, r)) for r in x]
    rows += [(None,) + rows[0][1:], (float("nan"),) + rows[1][1:]]
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(7))).repartition(4)


@pytest.mark.parametrize("block, held", [(3, 1 << 20), (2, 8), (7, 1), (50, 1)])
def test_blocks_give_the_same_matrix(table, block, held):
    names = table.columns
    whole, blocked = cells(correlation.correlation_matrix(table, names)), cells(correlation.blocked_correlations(table, names, block, held))
    assert whole.keys() == blocked.keys()
    for at, r in whole.items():
        assert blocked[at] is None if r is None else blocked[at] == pytest.approx(r, abs=1e-6), at


def test_large_values_lose_no_digits(table):
    found = cells(correlation.blocked_correlations(table, table.columns, 3))
    rows = np.array([r for r in table.collect() if r[0] is not None and not np.isnan(r[0])])
    shifted = rows - rows.mean(axis=0)
    expected = (shifted[:, 0] @ shifted[:, 1]) / np.sqrt((shifted[:, 0] ** 2).sum() * (shifted[:, 1] ** 2).sum())
    assert found["c0", "c1", 0, 1] == found["c1", "c0", 1, 0] == pytest.approx(expected, abs=1e-9)


def test_no_complete_row(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "a double, b double")
    assert correlation.blocked_correlations(df, ["a", "b"]).count() == 0
    assert correlation.blocked_correlations(df.limit(0), ["a", "b"]).count() == 0


def test_two_thousand_columns(spark, statements):
    """The matrix of 4,000,000 cells never comes to the driver; rankings of it are short."""
    names = [f"f{i}" for i in range(2000)]
    seed = spark.range(60).repartition(2)
    values = [(F.xxhash64("id", F.lit(i)) % 1000 / 100.0).alias(n) for i, n in enumerate(names)]
    df = seed.select(*values).withColumn("f1999", F.col("f3") * -2)
    matrix = correlation.correlation_matrix(df, names)
    assert matrix.count() == 2000 * 2000
    strongest = matrix.where("position_a < position_b").orderBy(F.desc(F.abs("r"))).head()
    assert (strongest["feature_a"], strongest["feature_b"]) == ("f3", "f1999") and strongest["r"] == pytest.approx(-1)
