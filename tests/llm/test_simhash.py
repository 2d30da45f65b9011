"""Fingerprints, links and groups against plain versions."""

import random

import pytest
import xxhash
from sievework.llm import simhash
from sievework.llm.common import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """Smallest id reachable over fingerprints with at most two differing bits."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(known) if known else None
    return [least[find(i)] for i in range(len(rows))]


def test_whole_table(spark, small_docs):
    found = {r["doc_id"]: r for r in simhash.near_duplicates(small_docs).collect()}
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in small_docs.collect()]
    assert len(found) == len(rows)
    for (doc_id, fp), group in zip(rows, plain_groups(rows)):
        assert found[doc_id]["fingerprint"] == f"{fp:016x}"
        assert found[doc_id]["component_id"] == group


@pytest.mark.parametrize("crowd", [simhash.CROWD, 1], ids=["grid", "midpoints"])
def test_links_join_what_is_near(spark, crowd):
    random.seed(3)
    base = [random.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base:
        for _ in range(25):
            x = b
            for _ in range(random.randint(1, 5)):
                x ^= 1 << random.randrange(64)
            fps.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(df, crowd)).collect()}
    expected = plain_groups([(x, x & (1 << 64) - 1) for x in signed])
    assert [roots.get(x, x) for x in signed] == expected


def test_manhattan_distance_is_a_lower_bound(spark):
    random.seed(5)
    rows = [(random.getrandbits(63), random.getrandbits(63)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, b long")
    from pyspark.sql import functions as F

    got = df.select(
        simhash.differing(simhash.segment_counts(F.col("a")), simhash.segment_counts(F.col("b"))).alias("low"),
        simhash.differing(F.col("a"), F.col("b")).alias("d"),
    ).collect()
    for (a, b), r in zip(rows, got):
        manhattan = sum(abs((a >> s & 3).bit_count() - (b >> s & 3).bit_count()) for s in range(0, 64, 2))
        assert r["low"] == manhattan <= r["d"]


def test_edge_cases(docs_of, with_clashes):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "one"), (8, "ONE"), (7, "one two"), (7, "one two"), (None, "one two"), (1, "x " * 30000)]
    docs = with_clashes(docs_of(*rows))
    found = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=repr)
    zero = [r for r in found if r[1] == "0" * 16]
    assert sorted(r[0] for r in zero) == [3, 4, 5] and {r[2] for r in zero} == {3}
    assert {r[2] for r in found if r[0] in (8, 9)} == {8}
    assert [r[2] for r in found if r[0] in (7, None)] == [7, 7, 7]
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 7, 8]


def test_empty_table(docs_of):
    empty = docs_of((1, "a")).where("false")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.distinct_documents(empty).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    df = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {tuple(r) for r in components(df).collect()} == {(i, 0) for i in range(1, n)}
