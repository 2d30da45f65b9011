"""Counts and base scores against a plain version; the model is a probability and beats its base."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from sievework.llm import attention_lm as lm

VOCABULARY = "byte_bpe_50k.tiktoken"


def check(docs, rows):
    given = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b""]) for r in docs.collect()]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in given}
    counts = Counter(w for i, ws in given if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (repr(i), held[i], len(ws), sum(counts[w] > 0 for w in ws), total,
         round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws), 6))
        for i, ws in given
    )
    got = sorted(
        (repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows
    )
    assert got == expected


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 10], ids=["all shipped", "most joined"])
def test_base_of_whole_table(small_docs, tokenizer_path, frequent):
    rows = lm.score_texts(small_docs, tokenizer_path(VOCABULARY), frequent=frequent, steps=60).collect()
    check(small_docs, rows)
    # Words never seen are spelled, each of them; the base has one event for them all. So the two are compared where all words are known.
    if frequent == lm.FREQUENT:
        known = [r for r in rows if r["n_known"] == r["n_tokens"] > 1]
        assert known and sum(r["score"] for r in known) > sum(r["base_score"] for r in known)
    without = lm.score_texts(small_docs, tokenizer_path(VOCABULARY), frequent=frequent, steps=0, rounds=0).collect()
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["score"] for r in without if r["held_out"])


def test_edge_cases(docs_of, with_clashes, tokenizer_path):
    docs = with_clashes(docs_of((1, None), (2, ""), (3, "A b  a"), (3, "A b  a"), (None, "é \x0b b"), (4, "w " * 50_000), (9, "unseen word")))
    rows = lm.score_texts(docs, tokenizer_path(VOCABULARY), steps=5).collect()
    check(docs, rows)
    assert all(r["score"] < 0 for r in rows)
    assert lm.score_texts(docs.where("false"), tokenizer_path(VOCABULARY), steps=1).count() == 0
    held = docs_of(*[(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2])
    check(held, lm.score_texts(held, tokenizer_path(VOCABULARY), steps=1).collect())


def test_every_target_is_scored_once_with_enough_context():
    for n in (1, 5, 32, 33, 63, 64, 65, 96, 97, 500):
        sequence = np.arange(1, n + 1) % lm.CLASSES
        inputs, targets, scored, owner = lm.windows([sequence, sequence[:3]])
        of = owner == 0
        assert targets[of][scored[of]].tolist() == sequence.tolist()
        assert inputs[of][0][0] == lm.CLASSES
        for w in np.flatnonzero(of)[1:]:
            assert np.flatnonzero(scored[w]).min() >= lm.STRIDE


def test_batched_scores_equal_single_ones_and_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    sequences = [np.append(rng.integers(1, lm.CLASSES, n), 0).astype(np.int32) for n in (0, 3, 70, 200)]
    model = lm.train(sequences, np.full(lm.CLASSES, 1 / lm.CLASSES), steps=20)
    together = lm.sequence_scores(model, sequences)
    assert together == pytest.approx([lm.sequence_scores(model, [s])[0] for s in sequences], rel=1e-4)
    some = np.array([lm.sequence_scores(model, [np.array([c], dtype=np.int32)])[0] for c in range(lm.CLASSES)])
    assert (10**some).sum() == pytest.approx(1, rel=1e-4)


def test_a_place_never_sees_what_follows():
    rng = np.random.default_rng(4)
    model = lm.train([np.append(rng.integers(1, 9, 100), 0)], np.full(lm.CLASSES, 1 / lm.CLASSES), steps=5)
    a = rng.integers(0, lm.CLASSES, (1, lm.WINDOW))
    b = a.copy()
    b[0, 40:] = 7
    assert np.allclose(model.hidden(a)[0][0, :40], model.hidden(b)[0][0, :40], atol=1e-5)


def test_gradients_lower_the_loss():
    pattern = np.append(np.tile([1, 2, 3, 4], 40), 0)
    before, after = (lm.sequence_scores(lm.train([pattern], np.full(lm.CLASSES, 1 / lm.CLASSES), steps=s), [pattern])[0] for s in (1, 150))
    assert after > before / 10


def test_scores_are_those_of_the_whole_forward_pass():
    """Cheaper scoring gives what the hidden states give, whether or not rows have to be shifted."""
    rng = np.random.default_rng(4)
    sequences = [np.append(rng.integers(1, lm.CLASSES, n), 0).astype(np.int32) for n in (0, 1, 31, 63, 64, 65, 200, 700)]
    model = lm.train(sequences, np.full(lm.CLASSES, 1 / lm.CLASSES), steps=20)
    for factor in (1, 60):
        model.out *= factor
        model.inner *= factor
        model.query *= factor
        inputs, targets, scored, owner = lm.windows(sequences)
        hidden = model.hidden(inputs)[0].astype(np.float64)
        logits = hidden @ model.out + model.bias
        logits -= logits.max(axis=2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
        inside = np.einsum("btd,gdm->btgm", hidden, model.inner) + model.inner_bias
        inside -= inside.max(axis=3, keepdims=True)
        inside -= np.log(np.exp(inside).sum(axis=3, keepdims=True))
        head = (logits[..., : lm.GROUPS, None] + inside).reshape(*logits.shape[:2], lm.HEAD)
        logits = np.concatenate([head, logits[..., lm.GROUPS :]], axis=2)
        each = np.take_along_axis(logits, targets[..., None], 2)[..., 0] * scored
        expected = np.bincount(owner, each.sum(axis=1)) / np.log(10)
        assert np.allclose(lm.sequence_scores(model, sequences), expected, rtol=1e-3, atol=1e-3)


@pytest.mark.parametrize("most", [0, 1, 50, 99, 100, 130, 1000])
def test_the_cut_of_frequent_words_falls_inside_a_cell(spark, most):
    rows = [(f"w{i}".encode(), 1 if i < 100 else i) for i in range(150)]
    counts = spark.createDataFrame(rows, "word binary, c long")
    kept = [r["c"] for r in counts.where(lm.most_frequent(counts, most)).collect()]
    assert len(kept) <= most and len(kept) >= min(most, 150) - 3
    dropped = sorted(c for _, c in rows)[: 150 - len(kept)]
    assert not kept or max(dropped, default=0) <= min(kept) * 2 ** (1 / 16)


def test_symbols_cover_the_whole_vocabulary():
    """Both sides of the head by count, tail groups behind, shares of a tail group that sum to one, ids never seen included."""
    begins = np.arange(50_256) % 2 == 0
    counts = {i: 5_000 - i for i in range(3_000)}
    symbols, shares, tokens = lm.symbol_table(begins, counts, 7)
    half = lm.HEAD // 2
    assert symbols[begins][: half - 1].tolist() == list(range(1, half)) and symbols[~begins][:half].tolist() == list(range(half, lm.HEAD))
    assert tokens[0] == 7 and tokens.sum() == sum(counts.values()) + 7
    assert set(symbols.tolist()) >= set(range(1, lm.HEAD + 9)) and symbols.max() < lm.CLASSES and (shares[symbols < lm.HEAD] == 0).all()
    assert lm.BEGINS[lm.outer_of(symbols)].tolist() == begins.tolist()
    assert np.bincount(symbols, 10**shares)[lm.HEAD : lm.HEAD + 9] == pytest.approx(np.ones(9))
    few = lm.symbol_table(begins[:300], {}, 0)[0]
    assert sorted(few.tolist()) == [*range(1, 151), *range(half, half + 150)]


def test_words_are_split_whole(tokenizer_path):
    """All subwords of a word, in order, also of words that are forgotten in between."""
    import tiktoken

    ranks = lm.read_ranks(tokenizer_path(VOCABULARY))
    plain = tiktoken.Encoding("plain", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    symbols, shares, _ = lm.symbol_table(lm.word_begins(ranks), {}, 0)
    scorer = lm.Scorer(None, {b"the": 3, lm.END: 2}, ranks, symbols, shares)
    words = "the ñllbo ciónmenterrar the zzzyqx".split()
    ids = [i for w in words for i in plain.encode_ordinary(" " + w)]
    for _ in range(2):
        assert scorer.sequence([w.encode() for w in words]).tolist() == [*symbols[ids].tolist(), 0]
        scorer.known.used += 17 * lm.CACHED
        scorer.known.trimmed()
    assert list(scorer.known) == [b"the"] and scorer.sequence([]).tolist() == [0]


def test_one_task_changes_the_model_like_plain_steps_and_tasks_are_averaged(spark, tokenizer_path):
    ranks = lm.read_ranks(tokenizer_path(VOCABULARY))
    symbols, shares, tokens = lm.symbol_table(lm.word_begins(ranks), {}, 0)
    scorer = lm.Scorer(None, {}, ranks, symbols, shares)
    texts = [("a b c " * 60,), ("d e f " * 200,), ("",)]
    shipped = spark.sparkContext.broadcast(scorer)
    unigram = np.full(lm.CLASSES, 1 / lm.CLASSES)
    for parts in ([texts], [texts[:1], texts[1:]]):
        docs = spark.createDataFrame([(n, *t) for n, part in enumerate(parts) for t in part], "n int, text string")
        docs = docs.repartitionByRange(len(parts), "n").sortWithinPartitions("n").select("text")
        changes = []
        for part in docs.rdd.glom().collect():
            found = lm.local_change(lm.untrained(unigram), (scorer.sequence(lm.words_of(r["text"])) for r in part))
            changes.append(found)
        n = sum(w for _, w in changes)
        expected = lm.untrained(unigram).parameters() + sum(c.astype(float) * w for c, w in changes) / n
        model = lm.untrained(unigram)
        assert lm.averaged(docs, shipped, model) == n
        assert np.allclose(model.parameters(), expected, atol=1e-6)
    assert lm.averaged(docs.where("false"), shipped, model) == 0


def test_a_word_is_known_or_spelled(tokenizer_path):
    """Scores of texts from single places: both ways to every word, by hand."""
    ranks = lm.read_ranks(tokenizer_path(VOCABULARY))
    split = lm.Subwords(ranks)
    seen = {b"the": 50, b"zzyqx": 6, b"zzyqv": 2}
    first = split(b"zzyqx")[0]
    assert split(b"zzyqv")[0] == first and len(split(b"the")) == 1
    symbols, shares, _ = lm.symbol_table(lm.word_begins(ranks), {}, 0)
    scorer = lm.Scorer(None, seen, ranks, symbols, shares, lm.Lexicon(len(ranks), [(split(b"the")[0], 50, 1), (first, 8, 2)]))
    scorer.known = known = lm.Known(scorer)
    model = lm.untrained(np.full(lm.CLASSES, 1 / lm.CLASSES))
    texts = [b"the zzyqx zzyqw the".split(), [], [b"zzyqv"] * 40]
    expected = []
    for words in texts:
        ids = [split(w) for w in words]
        places, begins = 10 ** lm.place_scores(model, [np.array([*(symbols[i] for one in ids for i in one), 0], dtype=np.int32)])
        total, at = 0.0, 0
        for word, one in zip(words, ids):
            p = places[at : at + len(one)] * 10 ** shares[one]
            n, v = (50, 1) if word == b"the" else (8, 2)
            ways = p[0] / begins[at] * (seen.get(word, 0) + (v + 1) * p[1:].prod() * begins[at + len(one)]) / (n + v + 1)
            total, at = total + math.log10(ways), at + len(one)
        expected.append(total + math.log10(places[at] / begins[at]))
    got = known.scores(model, [known.rows(ws) for ws in texts])
    assert got == pytest.approx(expected, rel=1e-4)


@pytest.mark.parametrize("size", [1.0, 40.0], ids=["usual", "beyond the range of exponentials"])
def test_prepared_scores_are_those_of_the_layer(size):
    rng = np.random.default_rng(4)
    model = lm.untrained(np.full(lm.CLASSES, 1 / lm.CLASSES))
    for name in lm.PARAMETERS:
        part = getattr(model, name)
        setattr(model, name, (part + rng.normal(0, 0.2, part.shape)).astype(np.float64) * (size if name in ("out", "inner", "query") else 1))
    sequences = [rng.integers(0, lm.CLASSES, n) for n in (1, 40, 64, 65, 200)]
    inputs, targets, scored, _ = lm.windows(sequences)
    hidden = model.hidden(inputs)[0]

    def logs(logits):
        top = logits.max(axis=-1, keepdims=True)
        return logits - top - np.log(np.exp(logits - top).sum(axis=-1, keepdims=True))

    outer = logs(hidden @ model.out + model.bias)
    for w, t in zip(*np.nonzero(scored)):
        goal = targets[w, t]
        expected = outer[w, t, lm.outer_of(goal)]
        if goal < lm.HEAD:
            group = goal // lm.GROUP
            expected += logs(hidden[w, t] @ model.inner[group] + model.inner_bias[group])[goal % lm.GROUP]
        one = np.zeros_like(scored[:1])
        one[0, t] = True
        found, begins = lm.Reader(model).scores(inputs[w : w + 1], targets[w : w + 1], one, 0)[:, 0] if t % 13 == 0 else (expected, None)
        assert found == pytest.approx(expected, abs=1e-4 * size)
        if begins is not None:
            assert begins == pytest.approx(np.log(np.exp(outer[w, t])[lm.BEGINS].sum()), abs=1e-4 * size)


def test_known_bounds_settle_that_no_exponent_is_too_large(monkeypatch):
    """The lengths of rows bound every exponent, so the exponents themselves are looked through only where that bound is too large."""
    rng = np.random.default_rng(6)
    sequences = [rng.integers(0, lm.CLASSES, n).astype(np.int32) for n in (1, 64, 300)]
    model = lm.untrained(np.full(lm.CLASSES, 1 / lm.CLASSES))
    reader, hidden = lm.Reader(model), model.hidden(lm.windows(sequences)[0])[0].reshape(-1, lm.DIMS)
    reached = lm.largest(np.c_[hidden, np.ones(len(hidden))])
    assert np.abs(hidden @ model.out + model.bias).max() <= reached * reader.out_reach * 1.001
    inside = np.einsum("td,gdm->tgm", hidden, model.inner) + model.inner_bias[None]
    assert np.abs(inside).max() <= reached * reader.inner_reach * 1.001
    asked, plain = [], lm.extreme
    monkeypatch.setattr(lm, "extreme", lambda values, bound=np.inf: asked.append(bound) or plain(values, bound))
    scores = lm.sequence_scores(model, sequences)
    assert asked and max(asked) <= lm.SAFE
    monkeypatch.setattr(lm, "extreme", lambda values, bound=np.inf: np.inf)
    assert scores == pytest.approx(lm.sequence_scores(model, sequences), rel=1e-6)


def test_every_training_text_is_learned_from(docs_of, tokenizer_path, monkeypatch):
    """Each row that is not held out is in one round, repeated rows as often as they come."""
    rows = [(i % 3_200, f"w{i % 11} w{i % 3_200}") for i in range(3_500)]
    learned, plain = Counter(), lm.averaged

    def averaged(taught, *args):
        learned.update(r["text"] for r in taught.collect())
        return plain(taught, *args)

    monkeypatch.setattr(lm, "averaged", averaged)
    lm.score_texts(docs_of(*rows), tokenizer_path(VOCABULARY), start=50, steps=1)
    assert learned == Counter(t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2)


def test_words_that_are_not_shipped_are_known_all_the_same(small_docs, docs_of, tokenizer_path):
    """Scores do not depend on which counts go to the tasks and which are joined; a word of very many subwords does not overflow."""
    long = docs_of(*[(i, "common " * 9 + "zq" * 900 + " " + "zq" * 900) for i in range(12)])
    docs = small_docs.select("doc_id", "text").unionByName(long.selectExpr("doc_id - 100 AS doc_id", "text"))
    all_shipped, joined = (
        {r["doc_id"]: r["score"] for r in lm.score_texts(docs, tokenizer_path(VOCABULARY), frequent=n, steps=5, rounds=0).collect()}
        for n in (lm.FREQUENT, 10)
    )
    assert len(joined) == docs.count() and joined == pytest.approx(all_shipped, rel=1e-5)


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(8)
    sequences = [rng.integers(0, lm.CLASSES, n).astype(np.int32) for n in (1, 40, 64, 65, 200)]
    model = lm.untrained(np.full(lm.CLASSES, 1 / lm.CLASSES))
    for name in lm.PARAMETERS:
        setattr(model, name, getattr(model, name).astype(np.float64))
    given, goals, where, _ = lm.windows(sequences)

    def loss():
        return -np.log(10) * lm.sequence_scores(model, sequences).sum() / where.sum()

    for name, slope in lm.slopes(model, given, goals, where).items():
        part, found = getattr(model, name), slope.ravel()
        for i in np.argsort(-np.abs(found))[:3].tolist():
            before = part.flat[i]
            part.flat[i] = before + 1e-4
            above = loss()
            part.flat[i] = before - 1e-4
            below = loss()
            part.flat[i] = before
            assert (above - below) / 2e-4 == pytest.approx(found[i], rel=1e-3), name
