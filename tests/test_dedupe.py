"""One row per key and duplicate rows: against plain versions, their plans and their shuffles."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import dedupe, profile

SCHEMA = "k int, t string, d double, i int, day date, b binary, a array<int>"


def rows_of(seed, n, keys):
    rng = random.Random(seed)
    texts = ["", "a", "a\0", "aaaaaaa", "aaaaaaab", "aaaaaaac", "aaaaaaa\0", "\u00e9t\u00e9", "zz", "z" * 40, None]
    return [
        (
            rng.choice([None, *range(keys)]), rng.choice(texts), rng.choice([0.0, -0.0, -1.5, 2.0, float("nan"), None]),
            rng.choice([None, -3, 0, 7]), rng.choice([None, datetime.date(2020, 1, 1), datetime.date(1960, 5, 5)]),
            rng.choice([None, b"", b"\xff" * 8, b"\xff" * 7, b"x"]), rng.choice([None, [], [1], [1, 2]]),
        )
        for _ in range(n)
    ]


def by_struct(df, key, order):
    """The smallest struct of every key."""
    rest = [c for c in df.columns if c not in key]
    ordered = [*order, *[c for c in rest if c not in order]]
    least = df.groupBy(*key).agg(F.min(F.struct(*ordered)).alias("_row"))
    return least.select([F.col(c) if c in key else F.col("_row")[c].alias(c) for c in df.columns])


def texts(df):
    """Rows as text, with one zero and one NaN."""
    return sorted(str(tuple(0.0 if isinstance(v, float) and v == 0 else v for v in r)) for r in df.collect())


@pytest.mark.parametrize("order", [[], ["t"], ["d"], ["i", "t"], ["day"], ["b"], ["a"], ["b", "t", "d"]], ids="-".join)
def test_keep_one_is_the_smallest_row(spark, order):
    df = spark.createDataFrame(rows_of(len(order), 400, 25), SCHEMA).repartition(3)
    assert texts(dedupe.keep_one(df, ["k"], order)) == texts(by_struct(df, ["k"], order))


@pytest.mark.parametrize("threshold", ["-1", "10m"], ids=["shuffled", "broadcast"])
def test_keep_one_with_ties_hot_keys_and_several_keys(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = [(1, "same prefix " + str(i % 50), 0.5, 1, None, None, None) for i in range(300)] + rows_of(3, 300, 3)
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        for key in (["k"], ["k", "i"], ["d", "day"]):
            assert texts(dedupe.keep_one(df, key, ["t"])) == texts(by_struct(df, key, ["t"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keep_one_of_nothing_and_odd_names(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 9)], "`a.b` int, `c d` int, rows int")
    assert [tuple(r) for r in dedupe.keep_one(df, ["a.b"]).collect()] == [(1, 1, 9)]
    assert dedupe.keep_one(df.where("false"), ["a.b"]).count() == 0
    assert dedupe.keep_one(df.select("`a.b`"), ["a.b"]).count() == 1


def test_prefixes_keep_the_order(spark):
    df = spark.createDataFrame(rows_of(7, 300, 3), SCHEMA)
    for name in ("t", "b"):
        prefix = dedupe.order_prefix(F.col(name), df.schema[name].dataType)
        found = [r[0] for r in df.where(F.col(name).isNotNull()).orderBy(name).select(prefix.alias("p")).collect()]
        assert found == sorted(found)


@pytest.mark.parametrize("seed", [1, 2])
def test_duplicate_rows_are_exact(spark, seed):
    df = spark.createDataFrame(rows_of(seed, 900, 2), "k int, t string, d double, i int, day date, b binary, a array<int>")
    n = df.groupBy(*df.columns).count().count()
    assert tuple(profile.duplicate_rows(df).head()) == (900, n, 900 - n)
    assert tuple(profile.duplicate_rows(df, fingerprint=True).head()) == (900, n, 900 - n)
    assert tuple(profile.duplicate_rows(df.limit(0)).head()) == (0, 0, 0)


def test_a_collision_makes_no_duplicate(spark, monkeypatch):
    """With a hash that says nothing, the comparison of whole rows still decides."""
    monkeypatch.setattr(profile, "row_hashes", lambda columns: [F.lit(1).cast("long").alias("_h1"), F.lit(2).cast("long").alias("_h2")])
    df = spark.createDataFrame(rows_of(5, 200, 2), SCHEMA)
    n = df.distinct().count()
    assert tuple(profile.duplicate_rows(df).head()) == (200, n, 200 - n)


def test_few_repeats_shuffle_few_bytes(spark, tmp_path, statements):
    wide = spark.range(4000).select("id", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"c{i}")), 512).alias(f"c{i}") for i in range(8)])
    wide.unionByName(wide.where("id < 5")).repartition(4).write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    seen = statements()
    assert tuple(profile.duplicate_rows(df).head()) == (4005, 4000, 5)
    narrow = seen.shuffled_bytes()
    seen = statements()
    df.groupBy(*df.columns).count().write.format("noop").mode("overwrite").save()
    whole = seen.shuffled_bytes()
    assert 0 < narrow < whole / 10
