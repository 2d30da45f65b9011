"""Source targets and cuts against plain versions and SQL."""

import pytest
from sievework.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Shares by weight, the excess of full sources shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not above:
            return target
        full |= above


def check(rows, found):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = plain_targets(sizes)
    taken = {}
    for r in found:
        source = r["row"]["source"]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(expected[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 0.5


def test_targets_and_cuts(docs_of):
    rows = [(i, "w " * (i % 7 + 1), "abcdé"[i % 5]) for i in range(200)]
    rows += [(1000 + i, "v " * 40, "hot") for i in range(300)] + [(2000, None, None), (2001, "only one here", None), (2002, "", "empty")]
    docs = docs_of(*rows)
    check(rows, mixing.mix(docs).collect())


def test_one_hot_bucket_size_does_not_matter(docs_of):
    rows = [(i, "w " * (i % 9 + 1), "ab"[i % 3 == 0]) for i in range(150)]
    results = [sorted((r["row"]["doc_id"], r["taken"]) for r in mixing.mix(docs_of(*rows), digits=d).collect()) for d in (1, 3)]
    assert results[0] == results[1]


def test_repeated_rows_and_clashing_names(docs_of, with_clashes):
    rows = [(1, "a b c", "s")] * 10 + [(2, "d e", "t")] * 10
    docs = with_clashes(docs_of(*rows))
    check(rows, mixing.mix(docs).collect())
    assert mixing.mixed(docs).columns == docs.columns


def test_mixed_documents_carry_the_words_taken(docs_of):
    rows = [(i, " \n".join(f"w{i}_{k}" for k in range(i % 11 + 3)), "abc"[i % 3]) for i in range(90)]
    docs = docs_of(*rows)
    taken = {r["row"]["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    out, texts = {}, {i: t for i, t, _ in rows}
    for r in mixing.mixed(docs).collect():
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + len(r["text"].split())
        assert texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    assert out == {i: n for i, n in taken.items() if n}


def test_without_words_or_rows(docs_of):
    found = mixing.mix(docs_of((1, "", "a"), (2, None, "b"))).collect()
    assert [(r["target"], r["taken"]) for r in found] == [(0.0, 0)] * 2
    assert mixing.mix(docs_of((1, "a")).where("false")).count() == 0
    assert mixing.mixed(docs_of((1, "a")).where("false")).count() == 0


def test_column_names_with_dots(docs_of):
    docs = docs_of((1, "a b", "x"), (2, "c", "y")).selectExpr("*", "doc_id AS `doc_id.x`", "text AS `text.y`")
    found = mixing.mixed(docs)
    assert found.columns == docs.columns and found.count() > 0
    assert all(r["doc_id.x"] == r["doc_id"] for r in found.collect())
