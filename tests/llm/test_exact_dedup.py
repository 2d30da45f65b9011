"""Exact duplicates against grouping by normalised text; the perfect hash against its definition."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from sievework.llm import exact_dedup


def plain(rows):
    """Sorted result rows of (id, text) pairs."""
    groups = {}
    for n, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append((i is None, i or 0, n))
    out = []
    for t, members in groups.items():
        absent, keep, row = min(members)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(rows[n][0], None if absent else keep, len(members), n == row, sha) for _, _, n in members]
    return sorted(out, key=repr)


def found(docs, historical, **options):
    rows = exact_dedup.exact_duplicates(docs, historical, **options)
    assert rows.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 20_000])
def test_perfect_hash_is_minimal_and_perfect(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), dtype=np.uint8).reshape(-1, 32)
    hashed = exact_dedup.PerfectHash.of(digests)
    assert sorted(hashed.slots(digests).tolist()) == list(range(n))
    others = np.frombuffer(b"".join(hashlib.sha256(f"x{i}".encode()).digest() for i in range(500)), dtype=np.uint8).reshape(-1, 32)
    strange = hashed.slots(others)
    assert len(strange) == 500 and strange.max(initial=-1) < max(n, 1)


def test_perfect_hash_of_digests_that_differ_in_one_word():
    digests = np.zeros((300, 32), dtype=np.uint8)
    digests[:, 31] = np.arange(300) % 256
    digests[:, 30] = np.arange(300) // 256
    assert sorted(exact_dedup.PerfectHash.of(digests).slots(digests).tolist()) == list(range(300))
    with pytest.raises(ValueError, match="twice"):
        exact_dedup.PerfectHash.of(digests[[0, 1, 1]])


@pytest.mark.parametrize("historical", ["true", "false", "doc_id < 300", "doc_id % 3 = 1", "null"])
def test_random_groups(spark, docs_of, historical):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab \t\n") for _ in range(6)) for _ in range(150)]
    rows = [(i, rng.choice(texts[: rng.choice([3, 150])])) for i in range(600)]
    rng.shuffle(rows)
    docs = docs_of(*rows).repartition(5)
    got = found(docs, F.expr(historical).cast("boolean"), per_bucket=16)
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(r[0], r[1], r[2], r[4]) for r in plain(rows)]
    assert sorted(r[0] for r in got if r[3]) == sorted(r[0] for r in plain(rows) if r[3])


def test_edge_cases(docs_of, with_clashes):
    long = "word " * 200_000
    rows = [(9, None), (8, ""), (7, " "), (6, " \t\r\n\x0b\x0c "), (5, "a b"), (4, "a\t\tb"), (4, "a b"), (4, "a b"), (None, "a b"),
            (None, "only"), (None, "only"), (3, "a b"), (2, long), (1, long + " "), (11, " a b"), (12, "A b")]
    docs = with_clashes(docs_of(*rows))
    for historical in (F.col("doc_id") < 5, F.lit(True), exact_dedup.earlier_half(docs)):
        got = found(docs, historical)
        expected = plain(rows)
        assert [(r[0], r[1], r[2], r[4]) for r in got] == [(r[0], r[1], r[2], r[4]) for r in expected]
        assert sorted((r[0] is None, r[0] or 0) for r in got if r[3]) == sorted((r[0] is None, r[0] or 0) for r in expected if r[3])
        kept = exact_dedup.without_duplicates(docs, historical)
        assert kept.columns == docs.columns and kept.count() == sum(r[3] for r in expected)


def test_empty_table(docs_of):
    empty = docs_of((1, "a")).where("false")
    assert found(empty, exact_dedup.earlier_half(empty)) == []
    assert exact_dedup.without_duplicates(empty, F.lit(True)).count() == 0


def test_text_ids_and_odd_names(spark):
    docs = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "`my.id` string, `the text` string")
    got = found(docs, F.col("doc_id") < "b", doc_id="my.id", text="the text")
    assert [(r[0], r[1], r[3]) for r in got] == [("a", "a", True), ("b", "a", False), ("c", "c", True)]


def test_index_has_a_slot_per_historical_digest(spark, docs_of):
    docs = docs_of(*[(i, f"t{i % 70}") for i in range(200)])
    rows = exact_dedup.digest_table(docs)
    index = exact_dedup.history_index(exact_dedup.distinct_digests(rows, 3))
    slots = exact_dedup.opened(index)
    assert slots.count() == 70 == slots.select("bucket", "slot").distinct().count()
    sizes = {r["bucket"]: r["n"] for r in slots.groupBy("bucket").agg((F.max("slot") + 1).alias("n")).collect()}
    assert sum(sizes.values()) == 70
    again = exact_dedup.looked_up(exact_dedup.distinct_digests(rows, 3), index)
    assert again.where("slot >= 0").count() == 70
    strange = exact_dedup.digest_table(docs_of(*[(i, f"u{i}") for i in range(90)]))
    assert exact_dedup.looked_up(exact_dedup.distinct_digests(strange, 3), index).where("slot >= 0").count() == 0
