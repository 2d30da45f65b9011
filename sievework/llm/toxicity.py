"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import fold, words_of

# Frequent function words, by which a text's language is told for its threshold.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was with as be this by are at from",
    "fr": "le la les et des du une est pour dans qui au sur par pas avec un",
    "de": "der die und den von zu das sich mit im auf ist eine dem nicht ein als",
    "es": "el los y se del las por con no una para su al lo que",
}
LANGUAGES = (*FUNCTION_WORDS, "other")
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5)
CACHED = 250_000
AT_ONCE = 200_000


@dataclass
class TextCnn:
    """Embeddings of hashed words and prefixes, filters per width, an output layer, a threshold per language."""

    embedding: np.ndarray  # buckets x dims; the row of bucket 0 is unused
    filters: list[np.ndarray]  # per width: width x dims x n
    bias: np.ndarray  # widths * n
    out: np.ndarray  # widths * n
    out_bias: float
    thresholds: np.ndarray  # per language of LANGUAGES

    def hashed(self, words: list[bytes]) -> np.ndarray:
        """Buckets of each word: of the whole and of its first letters."""
        crc, n = zlib.crc32, len(self.embedding)
        return np.array(
            [[crc(w), *[crc(w[:k], k) for k in PREFIXES]] for w in words], dtype=np.int64
        ).reshape(-1, 1 + len(PREFIXES)) % n

    def vectors(self, buckets: np.ndarray) -> np.ndarray:
        return self.embedding[buckets].mean(axis=1)

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        """What a word adds to every filter at every offset, side by side: convolution is then a sum of looked-up rows."""
        return np.concatenate([vectors @ f[k] for f in self.filters for k in range(len(f))], axis=1)

    def convolved(self, rows: np.ndarray) -> np.ndarray:
        """Filter responses at every position from the words' projected rows; rows past the end add nothing."""
        n, at, parts = self.filters[0].shape[2], 0, []
        for f in self.filters:
            total = rows[:, at : at + n].copy()
            for k in range(1, len(f)):
                total[:-k] += rows[k:, at + k * n : at + (k + 1) * n]
            parts.append(total)
            at += len(f) * n
        return np.concatenate(parts, axis=1)


LANGUAGE_OF = {w.encode(): i for i, ws in enumerate(FUNCTION_WORDS.values()) for w in ws.split()}
GAP = max(WIDTHS) - 1


class Vocabulary(dict):
    """Row numbers of the words seen lately; row 0 is the empty place between documents."""

    def __init__(self):
        self[b""] = 0
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.fresh.append(word)
        self[word] = n = len(self)
        return n


def blocks(texts: list[list[bytes]], size: int) -> Iterator[list[list[bytes]]]:
    held, n = [], 0
    for words in texts:
        held.append(words)
        n += len(words)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def laid_out(block: list[list[bytes]], known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all words with empty places after each document, and where each begins."""
    rows, starts = [], []
    for words in block:
        starts.append(len(rows))
        rows += map(known.__getitem__, words)
        rows += [0] * max(GAP, 1)
    return np.array(rows), np.array(starts)


def language_counts(rows: np.ndarray, starts: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """The language whose function words a document has most of; the last one if it has none."""
    hits = np.stack([np.add.reduceat((tags[rows] == i).astype(np.int32), starts) for i in range(len(FUNCTION_WORDS))], 1)
    return np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), len(FUNCTION_WORDS))


def logits(model: TextCnn, texts: list[list[bytes]], state: dict) -> tuple[np.ndarray, np.ndarray]:
    """(logit, language) of each document. state keeps the vocabulary and its rows between calls."""
    found, tongues = [], []
    for block in blocks(texts, AT_ONCE):
        if not state or len(state["known"]) > CACHED:
            width = sum(len(f) * f.shape[2] for f in model.filters)
            state |= {"known": Vocabulary(), "rows": np.zeros((1, width), dtype=np.float32), "n": 1, "tags": np.full(1, -1)}
        known = state["known"]
        rows, starts = laid_out(block, known)
        if known.fresh:
            fresh = model.projected(model.vectors(model.hashed(known.fresh)))
            need = state["n"] + len(fresh)
            if need > len(state["rows"]):
                grown = np.zeros((2 * need, fresh.shape[1]), dtype=np.float32)
                grown[: state["n"]] = state["rows"][: state["n"]]
                tags = np.full(2 * need, -1)
                tags[: state["n"]] = state["tags"][: state["n"]]
                state |= {"rows": grown, "tags": tags}
            state["rows"][state["n"] : need] = fresh
            state["tags"][state["n"] : need] = [LANGUAGE_OF.get(w, -1) for w in known.fresh]
            state["n"], known.fresh = need, []
        pooled = np.maximum.reduceat(model.convolved(state["rows"][rows]), starts, axis=0)
        found.append(np.maximum(pooled + model.bias, 0) @ model.out + model.out_bias)
        tongues.append(language_counts(rows, starts, state["tags"]))
    return (np.concatenate(found), np.concatenate(tongues)) if found else (np.zeros(0), np.zeros(0, dtype=int))


def train(
    texts: list[list[bytes]], labels: np.ndarray, *, buckets=1 << 16, dims=16, n_filters=8, epochs=12, rate=0.003,
    batch=48, decay=1e-4, dropped=0.5, seed=7,
) -> TextCnn:
    """Fits the classifier by Adam on the log loss, the classes weighing alike, then its thresholds.

    A fifth of the documents is not fitted on; each language's threshold is set on all documents, but
    lies midway between the classes there. Only the position that a filter answers to most gets a gradient.
    """
    rng = np.random.default_rng(seed)
    model = TextCnn(
        rng.normal(0, 0.02, (buckets, dims)).astype(np.float32),
        [rng.normal(0, (w * dims) ** -0.5, (w, dims, n_filters)).astype(np.float32) for w in WIDTHS],
        np.full(len(WIDTHS) * n_filters, 0.1, dtype=np.float32),
        rng.normal(0, 0.3, len(WIDTHS) * n_filters).astype(np.float32),
        0.0,
        np.zeros(len(LANGUAGES)),
    )
    known = Vocabulary()
    laid = [laid_out([words], known)[0] for words in texts]
    codes = np.concatenate([np.zeros((1, 1 + len(PREFIXES)), dtype=np.int64), model.hashed(known.fresh)])
    weights = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    fitted_on = np.flatnonzero(rng.random(len(texts)) >= 0.2)
    moments: dict = {}
    step = 0

    def adam(name, value, gradient, rows=None):
        m, v = moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * gradient
        v[at] = 0.99 * v[at] + 0.01 * gradient**2
        value[at] -= rate * (m[at] / (1 - 0.9**step) / (np.sqrt(v[at] / (1 - 0.99**step)) + 1e-7) + decay * value[at])

    for _ in range(epochs if len(fitted_on) else 0):
        for some in np.array_split(rng.permutation(fitted_on), max(1, len(fitted_on) // batch)):
            step += 1
            rows = np.concatenate([laid[i] for i in some])
            rows = np.where(rng.random(len(rows)) < dropped, 0, rows)  # so that no word hides the others
            starts = np.r_[0, np.cumsum([len(laid[i]) for i in some])[:-1]]
            words, inverse = np.unique(rows, return_inverse=True)
            vectors = model.vectors(codes[words])
            vectors[words == 0] = 0
            responses = model.convolved(model.projected(vectors)[inverse])
            ends = np.r_[starts[1:], len(rows)]
            best = np.stack([s + responses[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
            pooled = np.take_along_axis(responses, best, axis=0) + model.bias
            active = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ model.out + model.out_bias, -30, 30)))
            error = ((p - labels[some]) * weights[some] / len(some)).astype(np.float32)
            toward = error[:, None] * model.out * (pooled > 0)
            slope = np.zeros_like(vectors)
            for w, f in enumerate(model.filters):
                part = slice(w * n_filters, (w + 1) * n_filters)
                change = np.zeros_like(f)
                for k in range(len(f)):
                    at = np.minimum(best[:, part] + k, len(rows) - 1)
                    word = inverse[at]
                    inside = (toward[:, part] * (best[:, part] + k < len(rows)))[:, :, None]
                    change[k] = (vectors[word] * inside).sum(axis=0).T
                    np.add.at(slope, word.ravel(), (inside * f[k].T[None]).reshape(-1, dims))
                adam(f"filter{w}", f, change)
            adam("bias", model.bias, toward.sum(axis=0))
            out_change = (error[:, None] * active).sum(axis=0)
            adam("out", model.out, out_change)
            model.out_bias -= rate * float(error.sum())
            slope[words == 0] = 0
            touched = np.flatnonzero(np.abs(slope).sum(axis=1))
            cells, back = np.unique(codes[words[touched]], return_inverse=True)
            gradient = np.zeros((len(cells), dims), dtype=np.float32)
            np.add.at(gradient, back.ravel(), np.repeat(slope[touched] / codes.shape[1], codes.shape[1], axis=0))
            adam("embedding", model.embedding, gradient, cells)
    found, tongues = logits(model, texts, {})
    overall = threshold(found, labels)
    model.thresholds[:] = [
        threshold(found[tongues == i], labels[tongues == i], overall) for i in range(len(LANGUAGES))
    ]
    return model


def threshold(found: np.ndarray, labels: np.ndarray, otherwise: float = 0.0) -> float:
    """The logit with the fewest errors, in the middle of its gap; ``otherwise`` where a class is missing."""
    if (labels == 1).sum() < 5 or (labels == 0).sum() < 5:
        return otherwise
    order = np.argsort(found, kind="stable")
    z, y = found[order], labels[order]
    errors = np.r_[(y == 0).sum(), (y == 0).sum() + np.cumsum(y == 1) - np.cumsum(y == 0)]
    cut = int(errors.argmin())
    low, high = z[max(cut - 1, 0)], z[min(cut, len(z) - 1)]
    return float((low + high) / 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, text: str, most: int, folds: int) -> pd.DataFrame:
    """Texts and labels of at most about ``most`` rows outside fold 0, chosen by a hash of the id, both classes alike.

    The bound is documented: the sample is collected, whatever the table's size. Rows with a null label or id teach nothing.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    usable = usable.select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col("label") == value, F.lit(min(1.0, most / 2 / count))).otherwise(share)
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    # At most about `most` narrow rows: the bound that lets them be broadcast.
    return (
        docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toPandas()
    )


def toxicity(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", text: str = "text", most: int = 4_000, folds: int = 5
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) of every whole text.

    The classifier learns from a sample of at most about ``most`` labelled documents outside fold 0; scoring
    is row-local and looks at nothing but the text. The language that picks the threshold is the one
    whose function words the text has most of. Defined cases: a null or empty text has no word and gets
    the score of an empty place; without labels of both classes every score is 0.5 - so predicted is 1 - only if the
    model says so: an untrained model is replaced by the constant 0; texts of any length are scored whole; repeated rows are
    scored each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label, text, most, folds)
    shipped = None
    if sample["label"].nunique() > 1:
        model = train([words_of(t) for t in sample["text"]], sample["label"].to_numpy())
        shipped = spark.sparkContext.broadcast(model)  # size fixed by its parameters

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        state: dict = {}
        for texts in batches:
            if shipped is None:
                yield pd.Series(np.zeros(len(texts)))
                continue
            model = shipped.value
            parts = [np.zeros(0)]
            for at in range(0, len(texts), 500):
                z, tongues = logits(model, [words_of(t) for t in texts.iloc[at : at + 500]], state)
                parts.append(1 / (1 + np.exp(-np.clip(z - model.thresholds[tongues], -500, 500))))
            yield pd.Series(np.concatenate(parts))

    return docs.select(
        F.col("doc_id"),
        (fold(F.col("doc_id"), folds) == 0).alias("held_out"),
        score(F.col(text)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
