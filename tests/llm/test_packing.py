"""Packed pieces: whole, within their bins, at the least cost tried."""

import random

import pytest
from pyspark.sql import functions as F
from sievework.llm import packing


def check(rows, lengths, sizes):
    """Every document whole, bins full to what they say, sizes permitted and the smallest that hold the contents."""
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["n_tokens"]))
        bins.setdefault(r["bin_id"], []).append(r)
    assert {d: sum(n for _, n in p) for d, p in pieces.items()} == lengths
    for p in pieces.values():
        assert sorted(k for k, _ in p) == list(range(len(p)))
        assert all(n == sizes[-1] for k, n in p if k < len(p) - 1)
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: (r["start"], r["n_tokens"])):
            assert r["start"] == at
            at += r["n_tokens"]
        assert {(r["bin_used"], r["bin_size"]) for r in b} == {(at, next(s for s in sizes if s >= at))}
    return bins


@pytest.mark.parametrize("chunk", [7, 20_000])
def test_pieces_and_bins(docs_of, chunk):
    rng = random.Random(chunk)
    rows = [(i, "w " * rng.choice([0, 1, 5, 31, 32, 33, 63, 64, 127, 128, 129, 700])) for i in range(200)] + [(1000, None)]
    lengths = {i: len((t or "").split()) + 1 for i, t in rows}
    sizes = (32, 64, 128)
    check(packing.pack_documents(docs_of(*rows), sizes=sizes, chunk=chunk).collect(), lengths, sizes)


def test_whole_table(small_docs):
    rows = packing.pack_documents(small_docs).collect()
    lengths = {r["doc_id"]: len((r["text"] or "").encode().split()) + 1 for r in small_docs.collect()}
    bins = check(rows, lengths, packing.SIZES)
    filled = sum(lengths.values()) / sum(b[0]["bin_size"] for b in bins.values())
    assert filled > 0.93


def test_best_fit_prefers_the_tightest_bin():
    placed, used = packing.best_fit(range(4), [60, 50, 40, 45], (100,), 1)
    assert placed == [0, 1, 0, 1] and used == [100, 95]


def test_plan_is_the_cheapest_tried():
    rng = random.Random(9)
    for _ in range(30):
        lengths = [rng.randint(1, 4096) for _ in range(60)]
        _, used, fitted = packing.pack(lengths, packing.SIZES)
        cost = sum(map(packing.bin_cost, fitted))
        order = sorted(range(60), key=lambda i: -lengths[i])
        for k in range(1, 5):
            other = packing.best_fit(order, lengths, packing.SIZES, k)[1]
            assert cost <= sum(packing.bin_cost(next(s for s in packing.SIZES if s >= u)) for u in other) + 1e-6
        assert sum(used) == sum(lengths)


def test_edge_cases(docs_of, with_clashes):
    docs = with_clashes(docs_of((1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (4, "w " * 100_000)))
    rows = packing.pack_documents(docs).collect()
    assert len(rows) == 5 + 25 and sum(r["n_tokens"] for r in rows) == 1 + 1 + 2 + 2 + 3 + 100_001
    assert packing.pack_documents(docs.where("false")).count() == 0
    zero = packing.pack_documents(docs.where("doc_id < 3"), length=F.lit(0)).collect()
    assert [r["n_tokens"] for r in zero] == [0, 0]
