"""Collocations against counting every phrase."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from sievework.llm import collocations


def plain(rows, least, top=2000):
    """Result rows, in order, of (text, lang) pairs."""
    counts, totals = {}, {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    out = []
    for lang in sorted(totals):
        found = []
        many = [w for (x, w), a in counts.items() if x == lang and len(w) > 1 and a >= least]
        for w in many:
            a = counts[lang, w]
            if any(len(v) > len(w) and counts[lang, v] >= a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1)) for v in many):
                continue
            cuts = [(counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
            score, _, l, r = min((1000 * a * totals[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            found.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def found(docs, **options):
    rows = collocations.collocations(docs, **options)
    assert rows.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in rows.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(map(tuple, rows.collect()))


def random_rows(seed, n):
    rng = random.Random(seed)
    phrases = ["New York City", "of the", "as well as the other", "a b c d e f g"]
    words = ["ab", "Cd", "é", "é.", "x,", "y\ty", "z!\n", "the", "of", "10:30", " "]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("options", [{}, {"shipped_words": 0}, {"shipped_groups": 0}, {"shipped_words": 3, "shipped_groups": 5}])
def test_random_texts(spark, docs_of, options):
    rows = random_rows(3, 120)
    docs = docs_of(*[(i, t, "s", lang) for i, (t, lang) in enumerate(rows)]).repartition(3)
    assert found(docs, least=5, **options) == plain(rows, 5)


@pytest.mark.parametrize("groups", [2**31, 2**33 + 1], ids=["one number", "two numbers"])
def test_pairs_of_many_groups(groups):
    top = groups - 1
    batch = collocations.relation_batch(
        pa.array([7, 8, 9], pa.int64()), [np.array([0, 1, 2, 4, 5]), np.array([], int), np.array([3, 4])],
        [np.array([top, 1, 0, top, 1]), np.array([], int), np.array([0, top])],
    )
    found = [r for b in collocations.counted_pairs(iter([batch.slice(0, 2), batch.slice(2)]), groups) for r in b.to_pylist()]
    assert sorted(map(tuple, map(dict.values, found))) == [(0, top, 1), (1, 0, 1), (top, 1, 2)]


def test_relations_are_taken_in_slices(monkeypatch):
    rng = np.random.default_rng(1)
    at = [np.flatnonzero(rng.random(n) < 0.7) for n in (0, 5, 90, 3, 0, 40)]
    batch = collocations.relation_batch(pa.array(range(6), pa.int64()), at, [x % 3 for x in at])
    whole = [r for b in collocations.counted_pairs(iter([batch]), 3) for r in b.to_pylist()]
    monkeypatch.setattr(collocations, "AT_ONCE", 10)
    parts = list(collocations.slices(iter([batch.slice(1)])))
    assert len(parts) > 2 and sum(p.num_rows for p in parts) == 5
    assert [r for b in collocations.counted_pairs(iter([batch]), 3) for r in b.to_pylist()] == whole


def test_repeats_in_a_piece_and_the_limit(spark, docs_of):
    rows = [("a a a a a a", "en")] * 5 + [("b c b c b c", "en")] * 4 + [("B c. b C", None)] * 6
    docs = docs_of(*[(1, t, "s", lang) for t, lang in rows])
    assert found(docs, least=3) == plain(rows, 3)
    assert found(docs, least=3, top=1) == plain(rows, 3, 1)


def test_edge_cases(docs_of, with_clashes):
    long = "very long text " * 60_000
    rows = [(None, "en"), ("", "en"), (" \t", None), ("...!?", "de"), (long, "en"), ("one", "de"), ("x" * 100_000, "de"), ("und so und so", "und"), ("und so", None)]
    docs = with_clashes(docs_of(*[(i, t, "s", lang) for i, (t, lang) in enumerate(rows)]))
    assert found(docs, least=3) == plain(rows, 3)
    assert found(docs.where("false")) == [] and found(docs.where("doc_id < 4")) == []


def test_scores_beyond_64_bits(spark):
    big = 2_000_000_000_000
    level = "id long, lang string, words array<string>, f long, first long, last long"
    words = spark.createDataFrame([(0, "en", ["a"], 3_000_000_000_001, None, None), (1, "en", ["b"], big + 7, None, None)], level)
    pairs = spark.createDataFrame([(0, "en", ["a", "b"], big, 0, 1)], level)
    totals = spark.createDataFrame([("en", 9_000_000_000_000_011)], "lang string, n long")
    got = collocations.scored_phrases(totals, [words, pairs, pairs.where("false")]).collect()
    assert [r["score"] for r in got] == [1000 * big * 9_000_000_000_000_011 // (3_000_000_000_001 * (big + 7))]
