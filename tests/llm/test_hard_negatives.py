"""Hard negatives against all scores; the curve, the zone maps and the bounds against their definitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sievework.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def plain(rows, step=10, positives=5, negatives=10):
    """Sorted result rows; rows are (id, vector, label)."""
    usable = [
        (i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
        if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q, c in usable:
        if i is None or i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), math.inf if j is None else j, d) for j, v, d in usable if j != i]
        near = sorted(x[:2] for x in scored if x[2] == c)[:positives]
        other = sorted(x[:2] for x in scored if x[2] != c)
        for p, j in near:
            some = [x for x in other if 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out += [(i, None if j == math.inf else j, r, None if n == math.inf else n, -p, -s) for r, (s, n) in enumerate(some, 1)]
    return sorted(out, key=repr)


def found(spark, rows, step=10, **options):
    df = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows], SCHEMA)
    got = hn.hard_negatives(df, F.col("vec_id") % step == 0, F.col("label"), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=repr)


def vectors(seed, n, size, labels=3):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(6)]
    rows = []
    for i in range(n):
        near = rng.choice(centers)
        rows.append((i, [float(np.float32(x + rng.gauss(0, 0.2))) for x in near], rng.randrange(labels)))
    return rows


@pytest.mark.parametrize("options", [{}, {"block_rows": 7, "ask_rows": 5, "zone_rows": 4}, {"block_rows": 40, "zone_rows": 3}])
def test_random_vectors(spark, options):
    rows = vectors(1, 300, 9)
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(40)]
    assert found(spark, rows, **options) == plain(rows)


def test_a_vector_in_most_rows_fills_few_answers(spark):
    """Ties at the k-th score are cut by id, block by block, and the answer stays whole."""
    rows = vectors(6, 60, 4) + [(1000 + i, [0.5, 0.25, 0.0, 0.125], i % 3) for i in range(240)]
    assert found(spark, rows, step=20, block_rows=10) == plain(rows, 20)


def test_few_rows_and_other_counts(spark):
    rows = vectors(4, 12, 3, labels=2)
    assert found(spark, rows, step=3, positives=2, negatives=3, block_rows=2) == plain(rows, 3, 2, 3)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (10, None, 1), (20, [nan, 1.0], 1), (30, [inf, 1.0], 1), (40, [1.0, None], 1), (50, [1.0, 1.0], None),
            (1, [1.0], 1), (2, [], 2), (3, [0.25, 4.0, 9.0], 2), (4, [0.5, 0.5], 2), (4, [0.5, 0.5], 2), (60, [0.0, 0.0], 1),
            (None, [0.75, 0.5], 2), (None, [0.75, 0.5], 1), (70, [1.0, 0.5], 1), (70, [1.0, 0.5], 1), (80, [-1.0, -2.0], 3), (5, [-1.0, -2.0], 2),
            (6, [1.0, 2.0], 3), (0, [0.5, 0.25], 2)]
    assert found(spark, rows, block_rows=3) == plain(rows)
    assert found(spark, []) == [] and found(spark, [(0, [1.0], 1)]) == [] and found(spark, [(0, [], 1), (1, [], 2)]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**20 - i, float(i)], i % 2) for i in range(25)]
    assert found(spark, rows, block_rows=4) == plain(rows)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (1, 5)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hn.hilbert_key(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walked = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(3)
    box = rng.integers(-50, 50, (40, 6))
    low, high = box.min(axis=0)[None, :], box.max(axis=0)[None, :]
    asks = rng.integers(-50, 50, (30, 6))
    least, most = hn.bounds(asks, low, high)
    scores = asks @ box.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()
    corner = np.where(asks >= 0, high, low)
    assert ((asks * corner).sum(axis=1) == most[:, 0]).all()


def test_zone_maps_cover_their_blocks_and_prune(spark):
    rows = vectors(8, 600, 4, labels=2)
    df = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows], SCHEMA)
    blocks = hn.block_table(hn.usable_rows(df, F.col("label")), 20)
    zones = hn.zone_maps(blocks)
    held = {}
    for r in blocks.collect():
        held.setdefault(r["block"], []).append(r)
    assert sum(map(len, held.values())) == 600 and all(len({r["label"] for r in b}) == 1 and len(b) <= 20 for b in held.values())
    for z in zones.collect():
        inside = np.array([r["e"] for r in held[z["block"]]])
        assert z["n"] == len(inside) and z["low"] == inside.min(axis=0).tolist() and z["high"] == inside.max(axis=0).tolist()
    asks = hn.usable_rows(df, F.col("label")).where("vec_id % 50 = 0").select(
        F.col("vec_id").alias("ask"), F.col("vec_id").alias("anchor_id"), "label", "e",
        F.array(F.lit(20_000).cast("long")).alias("low"), F.array(F.lit(hn.HIGHEST)).alias("high"),
        F.array(F.lit(int(hn.NO_ID))).alias("tie"),
    )
    read = hn.Search(blocks, zones, 5, True).chosen(asks, 1, probe=False).count()
    assert read < 0.7 * asks.count() * sum(1 for b in held if b["label"] == 0)
