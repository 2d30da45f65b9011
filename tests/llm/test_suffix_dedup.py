"""Suffix arrays, and repeated strings against counting every window."""

import hashlib
import random
from collections import Counter

import pytest
from sievework.llm import suffix_dedup
from sievework.llm.suffix_groups import longest_matches, suffix_array


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_suffix_array(letters):
    rng = random.Random(letters)
    for _ in range(400):
        s = [rng.randrange(letters) for _ in range(rng.randrange(40))]
        array = sorted(range(len(s)), key=lambda i: s[i:])
        assert suffix_array(s) == array
        best = longest_matches(s, array)
        for i in range(len(s)):
            shared = 0
            for j in range(len(s)):
                h = 0
                while j != i and max(i, j) + h < len(s) and s[i + h] == s[j + h]:
                    h += 1
                shared = max(shared, h)
            assert best[i] == shared


def plain(texts, length):
    """(n_bytes, n_removed, n_spans, digest) of each text by counting all windows of all texts."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def report(docs, **options):
    rows = suffix_dedup.repeat_report(docs, **options).collect()
    return sorted((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in rows)


def copied_texts(rng, n):
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 260))) for _ in range(n)]
    passage = " ".join(rng.choice(words) for _ in range(150))
    for i in range(0, n, 3):
        other, cut = prose[rng.randrange(n)], rng.randrange(len(prose[i]))
        prose[i] = prose[i][:cut] + other[rng.randrange(len(other)) :] + prose[i][cut:]
    for i in range(1, n, 4):
        prose[i] += rng.choice(["", " ", "x"]) + passage[rng.randrange(40) : len(passage) - rng.randrange(40)]
    return prose + prose[:3] + ["a" * 900, "a" * 450, "ab" * 500, "", "short"]


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 2], ids=["suffix_arrays", "counted"])
@pytest.mark.parametrize("length, gram, block", [(400, 64, 16), (120, 32, 8)])
def test_against_all_windows(docs_of, crowd, length, gram, block):
    texts = copied_texts(random.Random(length + crowd), 60)
    found = report(docs_of(*enumerate(texts)), length=length, gram=gram, block=block, crowd=crowd)
    assert found == list(enumerate(plain(texts, length)))


def test_whole_table(small_docs):
    given = sorted((r["doc_id"], r["text"]) for r in small_docs.collect())
    assert [r for _, r in report(small_docs)] == plain([t for _, t in given], 400)


def test_long_texts_come_in_slices(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    monkeypatch.setattr(suffix_dedup, "SLICE", 1500)
    texts = copied_texts(random.Random(8), 20)
    long = [" ".join(texts[:10]), " ".join(texts[5:15])]
    import pyarrow as pa

    assert max(map(len, long)) > 3000
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([0, 1]), pa.array(long)], names=["t1", "t2", "text"])
    starts = {}
    for out in suffix_dedup.anchor_rows(iter([batch]), 400, 64):
        for r in out.to_pylist():
            for p in range(r["s"], r["e"] + 1):
                starts[r["t1"], p] = starts.get((r["t1"], p), 0) + 1
    sizes = [len(t.encode()) for t in long]
    assert starts == {(i, p): 1 for i, n in enumerate(sizes) for p in range(n - 399)}


def test_edge_cases(docs_of, with_clashes):
    text = "".join(random.Random(1).choice("abcdefgh ") for _ in range(700))
    docs = with_clashes(docs_of((1, None), (2, ""), (3, text), (3, text), (4, "é" * 150 + text[:390]), (5, text[:100] + "é" + text[:500])))
    found = dict(report(docs))
    assert found[1][:3] == found[2][:3] == (0, 0, 0)
    assert found[3] == (700, 700, 1, hashlib.sha256(b"").hexdigest())
    assert found[4][1] == 0 and found[5][1] == 500
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()}
    assert texts[3] == ("", 0) and texts[5] == (text[:100] + "é", 101) and texts[1] == (None, None)
    assert suffix_dedup.repeat_report(docs.where("false")).count() == 0
    assert suffix_dedup.without_repeats(docs.where("false")).count() == 0
