"""Exact search against all inner products, and against SQL."""

import math
import random

import pytest
from pyspark.sql import functions as F
from sievework.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def plain(rows, k=5, step=50):
    """Sorted answers; rows are (id, vector or None)."""
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qid, q in usable:
        if qid is not None and qid % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), math.inf if i is None else i) for i, v in usable if i != qid)
            out += [(qid, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, **options).collect()
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=repr)


@pytest.mark.parametrize("options", [{}, {"query_block": 3, "vector_block": 40}, {"parts": 1}, {"parts": 64, "vector_block": 100}])
def test_random_vectors(spark, options):
    rng = random.Random(1)
    rows = [(i, [round(rng.gauss(0, 0.2) * 256) / 256 + rng.choice([0, 0.001]) for _ in range(12)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]
    rows = [(i, [float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    assert found(spark, rows, **options) == plain(rows)


def test_negative_scores_only(spark):
    rows = [(0, [1.0, 1.0])] + [(i, [-float(i), -1.0]) for i in range(1, 20)]
    assert found(spark, rows) == plain(rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [1.0, None]), (1, [1.0]), (2, []), (3, [0.25, 4.0, 9.0]),
            (4, [1.0, 0.5]), (4, [1.0, 0.5]), (250, [0.0, 0.0]), (None, [1.0, 0.5]), (300, [1.0, 0.5]), (300, [1.0, 0.5])]
    assert found(spark, rows) == plain(rows)
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == []
    assert found(spark, [(1, [1.0])]) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**20, 1.0])] + [(i, [2.0**20, float(i)]) for i in range(1, 9)]
    assert found(spark, rows) == plain(rows)
