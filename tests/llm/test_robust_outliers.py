"""Base statistics against a plain version; estimates and verdicts on planted outliers."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from sievework.llm import robust_outliers as ro

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_statistics_of_whole_table(small_docs):
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    found = ro.judged(small_docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[n] for n in NAMES) == plain(texts[r["row"]["doc_id"]])


def test_base_statistics_of_odd_texts(docs_of, with_clashes):
    texts = [None, "", " \n\t", "a b", "a b c a b c", "a a a a a", "x\ny\nx\n\n \nx", "é ß|🙂 # b", "l1 a\x0bb\x0cc\rd", "a\r\nb\r\na\r\n", "w " * 60000]
    docs = with_clashes(docs_of(*enumerate(texts), *enumerate(texts)))
    for r in ro.judged(docs).collect():
        assert tuple(r[n] for n in NAMES) == plain(texts[r["row"]["doc_id"]])
        assert r["base_failed"] and not r["kept"]
    assert ro.judged(docs.where("false")).count() == 0


def test_distance_and_factor_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(500, ro.D)) @ rng.normal(size=(ro.D, ro.D)) * 2000 + 50_000).astype(int)
    df = spark.createDataFrame([(*map(int, v), "k") for v in x], [*ro.VECTOR, "k"])
    est = ro.moments(df, ["k"], 1.0)
    cov = np.cov(x.T, bias=True) + np.diag([(f * ro.UNIT) ** 2 for f in ro.FLOORS])
    row = est.first()
    assert row["det"] == pytest.approx(np.linalg.slogdet(cov)[1])
    got = {tuple(r[v] for v in ro.VECTOR): r["d2"] for r in ro.distance(df.join(est, "k"), "d2").collect()}
    for v in x:
        z = v - x.mean(axis=0)
        assert got[tuple(v)] == pytest.approx(z @ np.linalg.solve(cov, z))


def test_outliers_of_a_group_go_and_do_not_mask_themselves(docs_of):
    rng = random.Random(6)

    def prose(n, size):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(*size))) for _ in range(n))

    rows = [(i, prose(rng.randint(60, 300), (2, 8)), "plain", "en") for i in range(400)]
    rows += [(1000 + i, prose(120, (9, 15)), "plain", "en") for i in range(80)]
    rows += [(2000 + i, prose(120, (9, 15)), "long words", "de") for i in range(300)]
    kept = {r["row"]["doc_id"]: r["kept"] for r in ro.judged(docs_of(*rows)).collect()}
    assert all(kept[i] for i in range(400)) and not any(kept[1000 + i] for i in range(80))
    assert all(kept[2000 + i] for i in range(300))


def test_clean_documents_of_the_table_stay(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = [(quality[r["row"]["doc_id"]], r["kept"]) for r in ro.judged(docs).collect() if r["row"]["doc_id"] in quality and not r["base_failed"]]
    assert all(k for q, k in judged if q == 1) and not any(k for q, k in judged if q == 0)


def test_chi_squared():
    assert ro.chi2_quantile(0.95, 4) == pytest.approx(9.4877, abs=1e-3)
    assert ro.chi2_even(12.592, 6) == pytest.approx(0.95, abs=1e-4)


def test_native_plan(small_docs):
    plan = ro.judged(small_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_a_small_source_has_its_own_estimate_beside_a_hot_one(docs_of):
    rng = random.Random(7)

    def prose(n, size):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(*size))) for _ in range(n))

    rows = [(i, prose(rng.randint(60, 200), (2, 8)), "hot", "en") for i in range(400)]
    rows += [(1000 + i, prose(120, (9, 15)), "small", "en") for i in range(60)]
    rows += [(2000 + i, prose(120, (2, 8)), "small", "en") for i in range(5)]
    kept = {r["row"]["doc_id"]: r["kept"] for r in ro.judged(docs_of(*rows)).collect()}
    assert all(kept[1000 + i] for i in range(60)) and not any(kept[2000 + i] for i in range(5))
    assert all(kept[i] for i in range(400))
