"""Quality rules and toxicity: held-out accuracy, rules against plain evaluation, edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from sievework.llm import rule_quality, toxicity
from sievework.llm.common import fold

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")


def held_out_rates(scored, labels, label):
    rows = scored.where("held_out").join(labels, "doc_id").groupBy(label, "predicted").count().collect()
    n = {(r[label], r["predicted"]): r["count"] for r in rows}
    return [n.get((c, 1), 0) / max(1, n.get((c, 1), 0) + n.get((c, 0), 0)) for c in (0, 1)]


def test_quality_on_held_out_rows(big):
    docs, labels = big
    scored = rule_quality.quality(docs, labels, keep=["doc_id"]).select("row.doc_id", "held_out", "score", "predicted")
    bad, good = held_out_rates(scored, labels, "quality")
    assert bad <= 0.01 and good >= 0.995
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_on_held_out_rows(big):
    docs, labels = big
    scored = toxicity.toxicity(docs, labels)
    clean, toxic = held_out_rates(scored, labels, "toxic")
    assert clean <= 0.01 and toxic >= 0.85
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_folds(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "i long")
    got = {r["i"]: r["f"] for r in df.select("i", fold(F.col("i"), 5).alias("f")).collect()}
    assert got == {None: 0, **{i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}}


def test_held_out_labels_teach_nothing(big):
    docs, labels = big
    turned = labels.withColumn("quality", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [rule_quality.learn(docs, x, label="quality", text="text", most=500, folds=5) for x in (labels, turned)]
    assert models[0] == models[1]


def test_statistics(spark):
    text = "Ab cd, ab!\nx1 #|\nx1 #|\n"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "i int, text string")
    rows = {r["i"]: r for r in rule_quality.with_statistics(df, F.col("text"), F.col("i")).collect()}
    r = rows[1]
    assert r["log_words"] == pytest.approx(np.log1p(7)) and r["word_length"] == pytest.approx(16 / 7)
    assert r["symbols"] == pytest.approx(4 / 7) and r["stops"] == pytest.approx(2 / 7) and r["exclaims"] == pytest.approx(1 / 7)
    assert r["capitals"] == pytest.approx(1 / 23) and r["digits"] == pytest.approx(2 / 23)
    assert r["distinct_words"] == pytest.approx(5 / 7) and r["distinct_lines"] == pytest.approx(3 / 4)
    assert rows[2][1:] == rows[3][1:]


def test_compiled_rules_equal_plain_evaluation(spark):
    rng = random.Random(1)
    names = rule_quality.STATISTICS
    rules = tuple(
        rule_quality.Rule(tuple((rng.choice(names), rng.random() < 0.5, rng.random()) for _ in range(rng.randint(1, 3))), rng.gauss(0, 1))
        for _ in range(20)
    )
    model = rule_quality.RuleEnsemble(0.3, rules)
    rows = [tuple(rng.random() for _ in names) for _ in range(100)]
    got = spark.createDataFrame(rows, list(names)).select(model.score().alias("s")).collect()
    for row, s in zip(rows, got):
        value = dict(zip(names, row))
        odds = 0.3 + sum(r.weight for r in rules if all((value[n] > t) == above for n, above, t in r.tests))
        assert s["s"] == pytest.approx(1 / (1 + np.exp(-odds)))


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_edge_cases(spark, docs_of, with_clashes, label):
    docs = with_clashes(docs_of((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (5, "w " * 100_000)))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in (1, 2, 3)] + [(None, 1, 1), (5, None, None)], none.schema)
    for labels in (none, some):
        if label == "quality":
            run = lambda d: rule_quality.quality(d, labels).select("row.doc_id", "held_out", "score", "predicted")
        else:
            run = lambda d: toxicity.toxicity(d, labels)
        rows = run(docs).collect()
        assert sorted((r["doc_id"] for r in rows), key=repr) == [1, 2, 3, 3, 5, None]
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["predicted"] == (r["score"] >= (0.3 if label == "quality" else 0.5)) for r in rows)
        assert run(docs.where("false")).count() == 0


def test_gradients():
    """A single step moves the loss down for every kind of parameter."""
    rng = np.random.default_rng(0)
    texts = [[b"w%d" % rng.integers(30) for _ in range(rng.integers(1, 12))] + ([b"bad"] if i % 2 else []) for i in range(80)]
    labels = np.arange(80) % 2
    model = toxicity.train(texts, labels, buckets=1 << 10, epochs=30)
    z, languages = toxicity.logits(model, texts, {})
    assert ((z >= model.thresholds[languages]) == labels).mean() > 0.95


def test_projected_lookup_equals_convolution():
    rng = np.random.default_rng(2)
    model = toxicity.TextCnn(
        rng.normal(size=(64, 4)), [rng.normal(size=(w, 4, 3)) for w in toxicity.WIDTHS], np.zeros(9), np.ones(9), 0.0, np.zeros(5)
    )
    words = [b"a", b"bb", b"ccc", b"dddd", b"a"]
    v = np.vstack([model.vectors(model.hashed(words)), np.zeros((toxicity.GAP, 4))])
    plain = [
        max(sum(v[t + k] @ f[k][:, n] for k in range(len(f)) if t + k < len(v)) for t in range(len(v)))
        for f in model.filters for n in range(3)
    ]
    assert toxicity.logits(model, [words], {})[0][0] == pytest.approx(np.maximum(plain, 0).sum(), rel=1e-5)
