"""Language-model scores: a causal self-attention model over subword ids, trained and run in numpy."""

from __future__ import annotations

import base64
import copy
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import fold, words_of, written

END = b""  # the token after a text's last word; no word is empty
# The most frequent subwords have weights of their own, in groups; the others are in tail groups, each twice as large as the one before.
# Half of the head and of the tail groups are for subwords that begin a word (and the end), half for those that go on with one.
HEAD, GROUP, TAIL, FIRST_TAIL = 1024, 32, 20, 64
GROUPS = HEAD // GROUP
OUTER = GROUPS + TAIL
BEGINS = np.array([g < GROUPS // 2 if g < GROUPS else g - GROUPS < TAIL // 2 for g in range(OUTER)])
CLASSES = HEAD + TAIL  # what the layer sees and predicts: 0 for the end, subwords of the head, tail groups
WINDOW, STRIDE, DIMS = 64, 32, 16
FREQUENT = 1 << 18
CACHED = 1 << 18
COUNTED = 200_000
ADDED = 16_384  # words that are split at a time
AT_ONCE = 64  # windows whose weights fit a processor's cache
HELD = 2_048  # windows that a training task mixes
BLOCK = 4_096  # parameters that are averaged as one row
SAFE = 60  # exponents that neither overflow nor vanish
ODDS = pa.list_(pa.float32())


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    """Subwords of a public rank file with their ids."""
    with open(vocabulary, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def word_begins(ranks: dict[bytes, int]) -> np.ndarray:
    """Whether each id begins a word: its subword begins with a space."""
    out = np.zeros(max(ranks.values()) + 1, dtype=bool)
    out[[i for piece, i in ranks.items() if piece[:1] == b" "]] = True
    return out


class Subwords:
    """Splits whole words into the subword ids of a public vocabulary, by its own byte-pair merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def __call__(self, word: bytes) -> list[int]:
        return self.encoding._encode_single_piece(b" " + word)


def outer_of(symbols: np.ndarray) -> np.ndarray:
    """Group of each symbol: the first level of the output."""
    return OUTER_OF.take(symbols)


OUTER_OF = np.r_[np.repeat(np.arange(GROUPS), GROUP), np.arange(GROUPS, OUTER)]
INNER_OF = np.r_[np.tile(np.arange(GROUP), GROUPS), np.zeros(TAIL, dtype=np.int64)]
SORTED_BY = OUTER_OF.clip(max=GROUPS).astype(np.int8)


def symbol_table(begins: np.ndarray, counts: dict[int, int], ends: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol of each id, log10 of each id's share of its symbol, tokens of each symbol) of the ids, which begin a word or not.

    Ids of the whole vocabulary are placed by their counts in the training texts. Those of the head are a symbol each. A tail group is
    one symbol, in which an id has its smoothed share of the counts, so every id has a probability and all of them sum to 1.
    """
    seen = np.zeros(len(begins), dtype=np.int64)
    for i, c in counts.items():
        seen[i] = c
    symbols = np.empty(len(begins), dtype=np.int32)
    half, groups = HEAD // 2, TAIL // 2
    for side, at, reserved in ((True, 0, 1), (False, 1, 0)):  # place 0 is the end
        ids = np.flatnonzero(begins == side)
        ids = ids[np.argsort(-seen[ids], kind="stable")]
        place = np.arange(reserved, len(ids) + reserved)
        group = np.minimum(np.log2(np.maximum(place - half, 0) / FIRST_TAIL + 1).astype(np.int64), groups - 1)
        symbols[ids] = np.where(place < half, place + at * half, HEAD + at * groups + group)
    tokens = np.bincount(symbols, seen, CLASSES)
    whole = np.bincount(symbols, seen + 1, CLASSES)
    shares = np.where(symbols < HEAD, 0.0, np.log10((seen + 1) / whole[symbols]))
    tokens[0] = ends
    return symbols, shares, tokens


def causal_mask(n: int) -> np.ndarray:
    return np.triu(np.full((n, n), -1e9, dtype=np.float32), 1)


@dataclass
class Attention:
    """One causal attention layer with a residual over embedded symbols and places; a softmax over groups and one within the group give the next."""

    ids: np.ndarray  # classes + 1 for the beginning, x dims
    places: np.ndarray  # window x dims
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    mix: np.ndarray
    out: np.ndarray  # dims x groups
    bias: np.ndarray
    inner: np.ndarray  # groups of the head x dims x members
    inner_bias: np.ndarray
    mask: np.ndarray = field(default_factory=lambda: causal_mask(WINDOW))

    def hidden(self, inputs: np.ndarray) -> tuple[np.ndarray, ...]:
        x = self.ids[inputs] + self.places
        q, k, v = x @ self.query, x @ self.key, x @ self.value
        weights = q @ k.transpose(0, 2, 1) * np.float32(x.shape[2] ** -0.5) + self.mask
        weights -= weights.max(axis=2, keepdims=True)
        np.exp(weights, out=weights)
        weights /= weights.sum(axis=2, keepdims=True)
        seen = weights @ v
        return x + seen @ self.mix, x, q, k, v, weights, seen

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in PARAMETERS])

    def moved(self, by: np.ndarray) -> None:
        """Adds a change to all parameters, in the order of ``parameters``."""
        at = 0
        for n in PARAMETERS:
            part = getattr(self, n)
            part += by[at : at + part.size].reshape(part.shape).astype(part.dtype)
            at += part.size


PARAMETERS = ("ids", "places", "query", "key", "value", "mix", "out", "bias", "inner", "inner_bias")


class Reader:
    """Scores places by a model whose linear parts are worked out once for each symbol and each place of a window.

    What a place asks, holds and gives is the sum of a row of its symbol and a row of its place, so nothing of the layer is multiplied out
    again for each place; the layer's output matrix is in the values already. Columns of ones bring along biases and sums. The numbers are those of ``Attention.hidden``
    but for rounding.
    """

    def __init__(self, model: Attention):
        dims = model.ids.shape[1]
        scale = np.float32(dims**-0.5)

        def ones(rows: np.ndarray, value: float) -> np.ndarray:
            return np.concatenate([rows, np.full((len(rows), 1), value, rows.dtype)], axis=1)

        def sides(rows: np.ndarray, one: float) -> tuple[np.ndarray, np.ndarray]:
            held = ones(rows @ model.value @ model.mix, one)  # the last column adds up the weights
            return np.concatenate([rows @ model.key, held], axis=1), np.concatenate([rows @ (model.query * scale), rows], axis=1)

        (self.held, self.asked), (self.held_at, self.asked_at) = sides(model.ids, 1.0), sides(model.places, 0.0)
        self.dims, self.mask = dims, model.mask
        self.out = np.concatenate([model.out, model.bias[None]])
        self.inner = np.concatenate([model.inner, model.inner_bias[:, None]], axis=1)
        self.sums = np.stack([np.ones(OUTER), BEGINS], axis=1).astype(model.out.dtype)
        self.members = np.ones(GROUP, model.out.dtype)

        def reach(symbols: np.ndarray, places: np.ndarray) -> float:
            return largest(symbols[:, :dims]) + largest(places[:, :dims])

        self.bound = reach(self.held, self.held_at) * reach(self.asked, self.asked_at)
        self.out_reach, self.inner_reach = largest(self.out.T), largest(self.inner.transpose(0, 2, 1).reshape(-1, dims + 1))

    def scores(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray, skip: int) -> np.ndarray:
        """Natural logs, in order, of the probability of every scored target and of the probability that a word begins there; none of the first ``skip`` places of a window is scored."""
        n, width = inputs.shape
        dims = self.dims
        held = self.held.take(inputs, axis=0)
        held += self.held_at[:width]
        asked = self.asked.take(inputs[:, skip:], axis=0)
        asked += self.asked_at[skip:width]
        weights = asked[:, :, :dims] @ held[:, :, :dims].transpose(0, 2, 1)
        weights[:, :, skip:] += self.mask[skip:width, skip:width]  # all held before the first scored place are seen
        exponentials(weights, self.bound)
        seen = (weights @ held[:, :, dims:]).reshape(-1, dims + 1)
        own, goal = asked.reshape(-1, asked.shape[2]), targets[:, skip:].ravel()
        where = np.flatnonzero(scored[:, skip:])
        if len(where) < len(goal):
            seen, own, goal = seen.take(where, axis=0), own.take(where, axis=0), goal.take(where)
        hidden = np.ones((len(goal), dims + 1), held.dtype)
        np.divide(seen[:, :dims], seen[:, dims:], out=hidden[:, :dims])
        hidden[:, :dims] += own[:, dims:]
        reached = largest(hidden)
        logits = hidden @ self.out
        total = picked(logits, outer_of(goal))
        total -= exponentials(logits, extreme(logits, reached * self.out_reach))
        whole, begins = np.log(logits @ self.sums).T
        total -= whole
        order, cuts = by_group(goal)
        logits = within(self.inner, hidden.take(order, axis=0), cuts)
        chosen = picked(logits, INNER_OF.take(goal.take(order)))
        chosen -= exponentials(logits, extreme(logits, reached * self.inner_reach))
        total[order] += chosen - np.log(logits @ self.members)
        return np.stack([total, begins - whole])


def within(inner: np.ndarray, hidden: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Second level: the members' weights of each row's group, rows in the order of their groups."""
    out = np.empty((len(hidden), GROUP), dtype=hidden.dtype)
    for g, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if b > a:
            np.matmul(hidden[a:b], inner[g], out=out[a:b])
    return out


def by_group(goal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of targets in the head, sorted by their group; where each group begins)."""
    group = SORTED_BY.take(goal)
    order = np.argsort(group, kind="stable")
    cuts = np.r_[0, np.cumsum(np.bincount(group, minlength=GROUPS + 1)[:GROUPS])]
    return order[: cuts[-1]], cuts


def picked(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """One value of each row."""
    return rows.ravel().take(np.arange(0, rows.size, rows.shape[1]) + columns)


def largest(rows: np.ndarray) -> float:
    """The greatest length of a row: no inner product of rows of two tables exceeds the product of these."""
    return float(np.sqrt(np.einsum("ij,ij->i", rows, rows).max(initial=0)))


def extreme(values: np.ndarray, bound: float = np.inf) -> float:
    """The greatest absolute value; where a known ``bound`` of it settles that none is too large, the bound."""
    return bound if bound <= SAFE else max(float(values.max(initial=0)), -float(values.min(initial=0)))


def exponentials(values: np.ndarray, bound: float) -> np.ndarray | float:
    """Exponentials in place; returns what was taken off each row before, nothing where ``bound`` says that none can overflow or all vanish."""
    shift = 0.0
    if bound > SAFE:
        shift = values.max(axis=-1)
        values -= shift[..., None]
    np.exp(values, out=values)
    return shift


def windows(sequences: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, scored, sequence) of overlapping windows over target sequences that end with class 0.

    A window holds WINDOW places and the next begins STRIDE later; it scores the places that the one before does
    not hold, so every target is scored once, with STRIDE or more places before it unless the text begins there.
    """
    lengths = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
    counts = np.maximum(1, -(-(lengths - WINDOW + STRIDE) // STRIDE))
    # Every text takes whole strides, so that a window is WINDOW // STRIDE rows of them, one after the other.
    strides = WINDOW // STRIDE
    rows = counts + strides - 1
    begins = np.cumsum(rows) - rows
    at = np.repeat(begins * STRIDE - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    padded = np.zeros((2, rows.sum(), STRIDE), dtype=np.int32)
    inside = np.zeros(padded.shape[1:], dtype=bool)
    flat, whole = padded.reshape(2, -1), np.concatenate(sequences)
    flat[1, at] = whole
    flat[0, at[1:]] = whole[:-1]
    flat[0, begins * STRIDE] = CLASSES
    inside.reshape(-1)[at] = True
    owner = np.repeat(np.arange(len(sequences)), counts)
    first = np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    inputs, targets, scored = (np.concatenate([t[first + k] for k in range(strides)], axis=1) for t in (*padded, inside))
    scored[np.r_[False, owner[1:] == owner[:-1]], : WINDOW - STRIDE] = False
    return inputs, targets, scored, owner


def place_scores(model: Attention, sequences: Sequence[np.ndarray]) -> np.ndarray:
    """log10 probabilities, of every symbol of the sequences, one after the other, and that a word or the end begins there."""
    inputs, targets, scored, owner = windows(sequences)
    lengths = np.array([len(s) for s in sequences])
    begins = np.r_[True, owner[1:] != owner[:-1]]
    base = (np.cumsum(lengths) - lengths)[owner] + (np.arange(len(owner)) - np.flatnonzero(begins)[owner]) * STRIDE
    out = np.empty((2, lengths.sum()))
    reader = Reader(model)
    # The first window of a text scores from its first place on, the others only what the one before does not hold.
    for rows, skip in ((np.flatnonzero(begins), 0), (np.flatnonzero(~begins), WINDOW - STRIDE)):
        for at in range(0, len(rows), AT_ONCE):
            some = rows[at : at + AT_ONCE]
            where = np.flatnonzero(scored[some, skip:])
            place = (base[some, None] + np.arange(skip, WINDOW)).ravel().take(where)
            found = reader.scores(inputs[some], targets[some], scored[some], skip)
            out[0, place], out[1, place] = found
    return out / np.log(10)


def sequence_scores(model: Attention, sequences: Sequence[np.ndarray]) -> np.ndarray:
    """log10 probability of each sequence of symbols."""
    lengths = np.array([len(s) for s in sequences])
    return np.add.reduceat(place_scores(model, sequences)[0], np.cumsum(lengths) - lengths)


def untrained(unigram: np.ndarray, seed: int = 5) -> Attention:
    """A model that starts as the unigram model of the symbols."""
    rng = np.random.default_rng(seed)

    def start(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    inner = DIMS**-0.5
    groups = np.bincount(outer_of(np.arange(CLASSES)), unigram, OUTER)
    members = unigram[:HEAD].reshape(GROUPS, GROUP) / groups[:GROUPS, None]
    return Attention(
        start(CLASSES + 1, DIMS, scale=0.5), start(WINDOW, DIMS, scale=0.05),
        *(start(DIMS, DIMS, scale=inner) for _ in range(4)),
        start(DIMS, OUTER, scale=0.02), np.log(groups).astype(np.float32),
        start(GROUPS, DIMS, GROUP, scale=0.02), np.log(members).astype(np.float32),
    )


def slopes(model: Attention, given: np.ndarray, goals: np.ndarray, where: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean loss of a batch of windows.

    Places that a window only sees ask for nothing: in windows that score none of their first WINDOW - STRIDE, only the others are followed up.
    """
    slope = {name: np.zeros_like(getattr(model, name)) for name in PARAMETERS}
    n = max(1, np.count_nonzero(where))
    whole = where[:, : WINDOW - STRIDE].any(axis=1)
    for rows, skip in ((np.flatnonzero(whole), 0), (np.flatnonzero(~whole), WINDOW - STRIDE)):
        if len(rows):
            add_slopes(slope, model, given[rows], goals[rows, skip:], where[rows, skip:], skip, n)
    return slope


def add_slopes(
    slope: dict[str, np.ndarray], model: Attention, given: np.ndarray, goals: np.ndarray, where: np.ndarray, skip: int, n: int
) -> None:
    """Adds the gradient of the summed loss over ``n`` of windows none of whose first ``skip`` places is scored; ``goals`` and ``where`` are without these."""
    b, width = given.shape
    asking, scale = width - skip, np.float32(DIMS**-0.5)
    ways = np.concatenate([model.key, model.value], axis=1)
    ask = model.query * scale
    x = model.ids.take(given, axis=0)
    x += model.places[:width]
    own = x[:, skip:].reshape(-1, DIMS)
    held = (x.reshape(-1, DIMS) @ ways).reshape(b, width, 2 * DIMS)
    k, v, q = held[:, :, :DIMS], held[:, :, DIMS:], (own @ ask).reshape(b, asking, DIMS)
    weights = q @ k.transpose(0, 2, 1)
    bound = extreme(weights)
    weights[:, :, skip:] += model.mask[skip:width, skip:width]
    exponentials(weights, bound)
    weights /= weights.sum(axis=2, keepdims=True)
    seen = weights @ v

    at = np.flatnonzero(where)
    goal = goals.ravel().take(at)
    flat = (seen.reshape(-1, DIMS) @ model.mix + own).take(at, axis=0)

    def missed(logits: np.ndarray, goal: np.ndarray) -> np.ndarray:
        exponentials(logits, extreme(logits))
        logits /= n * (logits @ np.ones((logits.shape[1], 1), logits.dtype))
        logits.ravel()[np.arange(0, logits.size, logits.shape[1]) + goal] -= 1 / n
        return logits

    p = missed(flat @ model.out + model.bias, outer_of(goal))
    slope["out"] += flat.T @ p
    slope["bias"] += p.sum(axis=0)
    back = p @ model.out.T
    order, cuts = by_group(goal)
    rows = flat.take(order, axis=0)
    goal = goal.take(order)
    p = missed(within(model.inner, rows, cuts) + model.inner_bias.take(OUTER_OF.take(goal), axis=0), INNER_OF.take(goal))
    inside = np.empty_like(rows)
    for g, (first, end) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if end > first:
            some = p[first:end]
            slope["inner"][g] += rows[first:end].T @ some
            slope["inner_bias"][g] += some.sum(axis=0)
            np.matmul(some, model.inner[g].T, out=inside[first:end])
    back[order] += inside

    toward = np.zeros_like(own)
    toward[at] = back
    slope["mix"] += seen.reshape(-1, DIMS).T @ toward
    to_seen = (toward @ model.mix.T).reshape(b, asking, DIMS)
    to_logits = to_seen @ v.transpose(0, 2, 1)
    to_logits -= (to_seen * seen).sum(axis=2, keepdims=True)
    to_logits *= weights
    to_query = (to_logits @ k).reshape(-1, DIMS)
    to_held = np.concatenate([to_logits.transpose(0, 2, 1) @ q, weights.transpose(0, 2, 1) @ to_seen], axis=2).reshape(-1, 2 * DIMS)
    slope["query"] += own.T @ to_query * scale
    both = x.reshape(-1, DIMS).T @ to_held
    slope["key"] += both[:, :DIMS]
    slope["value"] += both[:, DIMS:]
    to_x = (to_held @ ways.T).reshape(b, width, DIMS)
    to_x[:, skip:] += (toward + to_query @ ask.T).reshape(b, asking, DIMS)
    slope["places"][:width] += to_x.sum(axis=0)
    inputs = given.ravel()
    order = np.argsort(inputs.astype(np.int16), kind="stable")
    inputs = inputs.take(order)
    begins = np.flatnonzero(np.r_[True, inputs[1:] != inputs[:-1]])
    slope["ids"][inputs[begins]] += np.add.reduceat(to_x.reshape(-1, DIMS).take(order, axis=0), begins, axis=0)


class Steps:
    """Adam on the parameters of one model."""

    def __init__(self, model: Attention):
        self.model, self.step = model, 0
        self.moments = {n: (np.zeros_like(getattr(model, n)), np.zeros_like(getattr(model, n))) for n in PARAMETERS}

    def take(self, batch: tuple[np.ndarray, np.ndarray, np.ndarray], pace: float) -> None:
        self.step += 1
        slope = slopes(self.model, *batch)
        for name in PARAMETERS:
            m, s = self.moments[name]
            m += 0.1 * (slope[name] - m)
            s += 0.01 * (slope[name] ** 2 - s)
            getattr(self.model, name)[...] -= pace * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.99**self.step)) + 1e-8)


def train(
    sequences: Sequence[np.ndarray], unigram: np.ndarray, *, steps: int = 500, batch: int = 48, rate: float = 0.006, seed: int = 5
) -> Attention:
    """Fits a model by Adam on windows of the sequences drawn with replacement."""
    model = untrained(unigram, seed)
    if not len(sequences):
        return model
    rng = np.random.default_rng(seed)
    inputs, targets, scored, _ = windows(sequences)
    adam = Steps(model)
    for step in range(1, steps + 1):
        some = rng.integers(0, len(inputs), batch)
        adam.take((inputs[some], targets[some], scored[some]), rate * min(1.0, step / 20) * (1 - 0.8 * step / steps))
    return model


def local_change(
    model: Attention, sequences: Iterator[np.ndarray], *, batch: int = 48, rate: float = 0.002, seed: int = 5
) -> tuple[np.ndarray, int]:
    """(change of all parameters, windows) after one pass of a task over its sequences, mixed within HELD windows or more."""
    before = model.parameters()
    rng = np.random.default_rng(seed)
    adam, held, size, total = Steps(model), [], 0, 0

    def passed() -> int:
        inputs, targets, scored, _ = windows(held)
        order = rng.permutation(len(inputs))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            adam.take((inputs[some], targets[some], scored[some]), rate * min(1.0, (adam.step + 1) / 20) * len(some) / batch)
        return len(order)

    for sequence in sequences:
        held.append(sequence)
        size += 1 + len(sequence) // STRIDE
        if size >= HELD:
            total += passed()
            held, size = [], 0
    if held:
        total += passed()
    return model.parameters() - before, total


def averaged(taught: DataFrame, scorer: Broadcast, model: Attention) -> int:
    """One round of training over all rows of ``taught`` (one column of texts); returns the number of windows.

    Every task begins with the same parameters and passes over its own texts; their changes are averaged, each weighted by the number
    of its windows. A change has a fixed size, and is added up in two steps, so neither a task nor the driver holds all of them.
    """
    state = taught.sparkSession.sparkContext.broadcast(model)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = scorer.value
        texts = (t for batch in batches for t in batch.column(0).to_pylist())
        start = copy.deepcopy(state.value)
        moved, n = local_change(start, (tools.sequence(words_of(t)) for t in texts))
        if n:
            blocks = range(0, len(moved), BLOCK)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(blocks)), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int32()),
                pa.array([n] * len(blocks), pa.int64()),
                pa.array([(moved[at : at + BLOCK].astype(np.float64) * n).tobytes() for at in blocks], pa.binary()),
            ], names=["block", "task", "n", "change"])

    def added(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        total = sum(np.frombuffer(c, dtype=np.float64) for c in rows["change"].to_pylist())
        return pa.table({
            "block": rows["block"][:1], "task": rows["task"][:1], "n": pa.array([sum(rows["n"].to_pylist())], pa.int64()),
            "change": pa.array([total.tobytes()], pa.binary()),
        })

    schema = "block int, task int, n long, change binary"
    parts = taught.mapInArrow(change, schema)
    some = parts.groupBy("block", F.floor(F.col("task") / 64).alias("some")).applyInArrow(added, schema)
    rows = sorted(some.groupBy("block").applyInArrow(added, schema).collect())  # the size of the model
    state.unpersist()
    if not rows:
        return 0
    model.moved(np.concatenate([np.frombuffer(r["change"], dtype=np.float64) for r in rows]) / rows[0]["n"])
    return rows[0]["n"]


class Lexicon:
    """How a word goes on after its first subword: one of the known words that begin so, or a new one, spelled by the model.

    For each first id: the training tokens of words that begin so, and how many different words those are. A new word is
    about as likely as words were new in training (Witten and Bell's estimate).
    """

    def __init__(self, size: int, rows: Sequence[tuple[int, int, int]]):
        tokens, different = np.zeros(size), np.zeros(size)
        for i, c, v in rows:
            tokens[i], different[i] = c, v
        self.new = np.log10((different + 1) / (tokens + different + 1))
        self.one = -np.log10(tokens + different + 1)

    def of(self, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probability, after their first subwords, of known words with these training counts."""
        return self.one[first] + np.log10(counts)


@dataclass
class Scorer:
    """All that a task needs: its size is bounded by FREQUENT, the vocabulary file and the model's parameters."""

    model: Attention | None
    frequent: dict[bytes, int]  # counts of the most frequent training words
    ranks: dict[bytes, int]
    symbols: np.ndarray  # of each id
    shares: np.ndarray  # log10 of each id's share of its symbol
    lexicon: Lexicon | None = None
    split: Subwords | None = None
    known: Known | None = None

    def pieces(self, words: Sequence[bytes]) -> list[list[int]]:
        if self.split is None:  # made once in a worker process
            self.split = Subwords(self.ranks)
        return [*map(self.split, words)]

    def sequence(self, words: list[bytes]) -> np.ndarray:
        """Symbols of a text: those of all subwords of all words, and the end."""
        if self.known is None:
            self.known = Known(self)
        rows = self.known.rows(words)
        found = self.known.sequence(rows)
        self.known.trimmed()
        return found

    def __getstate__(self):
        return self.__dict__ | {"split": None, "known": None}


class Known(dict):
    """Row numbers of words, with their symbols, what both ways to a word add to their subwords' log10 probabilities, log10 (count + 1) and whether the count must be looked up elsewhere.

    For a word whose count is elsewhere, ``known`` is what the known way adds at a count of one.
    """

    def __init__(self, scorer: Scorer):
        self.scorer = scorer
        size = len(scorer.frequent) + CACHED
        self.starts, self.lengths = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.logs, self.rare = np.zeros(size), np.zeros(size, bool)
        self.spelled, self.known = np.zeros(size), np.full(size, -np.inf)
        self.flat, self.used = np.zeros(4 * size, np.int32), 0
        common = [pair for pair in scorer.frequent.items() if pair[0] != END]
        for at in range(0, len(common), ADDED):
            words, counts = zip(*common[at : at + ADDED])
            self.add(words, np.array(counts, dtype=np.float64))
        self.base, self.base_used = len(self), self.used

    def add(self, words: Sequence[bytes], counts: np.ndarray | None) -> None:
        """Rows for different words that have none yet, with their training counts or, for rare words, without."""
        n, m = len(self), len(words)
        while n + m > len(self.logs):
            for name in ("starts", "lengths", "logs", "spelled", "known", "rare"):
                column = getattr(self, name)
                setattr(self, name, np.concatenate([column, np.zeros_like(column)]))
        pieces = self.scorer.pieces(words)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=m)
        ids = np.fromiter(chain.from_iterable(pieces), dtype=np.int64, count=int(lengths.sum()))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        starts = np.cumsum(lengths) - lengths
        self.update(zip(words, range(n, n + m)))
        new = slice(n, n + m)
        self.starts[new], self.lengths[new] = self.used + starts, lengths
        self.flat[self.used : self.used + len(ids)] = self.scorer.symbols[ids]
        self.used += len(ids)
        shares, lexicon, first = self.scorer.shares[ids], self.scorer.lexicon, ids[starts]
        self.spelled[new] = np.add.reduceat(shares, starts) + (lexicon.new[first] if lexicon else 0)
        self.known[new] = shares[starts] + lexicon.of(first, 1 if counts is None else counts) if lexicon else -np.inf
        self.logs[new] = 0.0 if counts is None else np.log10(counts + 1)
        self.rare[new] = counts is None

    def rows(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            unknown = list(dict.fromkeys(words[i] for i in missing))
            for at in range(0, len(unknown), ADDED):
                self.add(unknown[at : at + ADDED], None)
            found[missing] = [self[words[i]] for i in missing]
        return found

    def sequence(self, rows: np.ndarray) -> np.ndarray:
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        size = int(ends[-1]) if len(ends) else 0
        out = np.zeros(size + 1, dtype=np.int32)
        out[:size] = self.flat[np.repeat(self.starts[rows] - ends + lengths, lengths) + np.arange(size)]
        return out

    def scores(self, model: Attention, texts: Sequence[np.ndarray]) -> np.ndarray:
        """log10 probability of each text, given as the rows of its words: after its first subword a word is known, or spelled and then ended."""
        return self.ways(model, texts)[0]

    def ways(self, model: Attention, texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The scores, in which rare words are only spelled, and for each of those in order log10 of how many times as likely the known way would be, seen once."""
        places, begins = place_scores(model, [self.sequence(rows) for rows in texts])
        # Every word and every end is one unit; an end has one place and nothing to add.
        sizes = np.array([len(rows) + 1 for rows in texts])
        ends = np.cumsum(sizes) - 1
        rows = np.concatenate(texts)
        is_word = np.ones(sizes.sum(), dtype=bool)
        is_word[ends] = False
        lengths, spelled, known = np.ones(len(is_word), dtype=np.int64), np.zeros(len(is_word)), np.full(len(is_word), -np.inf)
        lengths[is_word], spelled[is_word], known[is_word] = self.lengths[rows], self.spelled[rows], self.known[rows]
        rare = np.flatnonzero(is_word)[self.rare[rows]]
        starts = np.cumsum(lengths) - lengths
        # That a word begins here is said by the word before: it was known whole, or its spelling ended.
        begins = begins[starts]
        ended = np.append(begins[1:], 0.0)
        ended[ends] = 0.0
        spelled += np.add.reduceat(places, starts) + ended
        known += places[starts]
        odds = known[rare] - spelled[rare]
        known[rare] = -np.inf
        units = np.logaddexp(spelled * np.log(10), known * np.log(10)) / np.log(10) - begins
        return np.add.reduceat(units, ends - sizes + 1), odds

    def trimmed(self) -> None:
        """Forgets the rare words when there are too many: the bound holds between batches of documents."""
        if len(self) > self.base + CACHED or self.used > self.base_used + 16 * CACHED:
            for word in list(self)[self.base :]:
                del self[word]
            self.used = self.base_used


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of texts with their counts so far, handed on whenever too many are held."""

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"]
        )

    held: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            held.update(words_of(text.as_py()))
            held[END] += 1
            if len(held) > COUNTED:
                yield out()
                held.clear()
    yield out()


def scored_rows(batches: Iterator[pa.RecordBatch], scorer: Scorer, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds from (doc_id, held_out, text): 0, a document's sums; 1, a rare word of a document with the odds of ``Known.ways`` at all its places."""
    known = scorer.known = scorer.known or Known(scorer)  # made once in a worker process
    uid = TaskContext.get().partitionId() << 40
    end = np.log10(scorer.frequent.get(END, 0) + 1)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts, sums, knowns, totals = [], [], [], []
            owners, rare_ids, rare_words = [], [], []
            for d, text in enumerate(part.column(2).to_pylist()):
                words = words_of(text)
                rows = known.rows(words)
                sums.append(known.logs[rows].sum() + end)
                texts.append(rows)
                totals.append(len(words) + 1)
                rare = np.flatnonzero(known.rare[rows])
                knowns.append(len(words) - len(rare) + (END in scorer.frequent))
                owners.append(np.full(len(rare), d))
                rare_ids.append(rows[rare])
                rare_words += [words[i] for i in rare.tolist()]
            scores, odds = known.ways(scorer.model, texts)
            known.trimmed()
            n, m = part.num_rows, len(rare_words)
            none = pa.nulls
            documents = [
                pa.array(np.zeros(n, dtype=np.int32)), pa.array(uid + np.arange(n)), part.column(0), part.column(1),
                pa.array(totals, pa.int64()), pa.array(knowns, pa.int64()), pa.array(np.array(sums)), pa.array(scores),
                none(n, pa.binary()), none(n, ODDS),
            ]
            yield pa.RecordBatch.from_arrays(documents, names=names)
            if m:
                owner, ids = np.concatenate(owners), np.concatenate(rare_ids)
                order = np.lexsort((ids, owner))
                owner, ids = owner.take(order), ids.take(order)
                begins = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (owner[1:] != owner[:-1])])
                places = pa.ListArray.from_arrays(pa.array(np.r_[begins, m], pa.int32()), pa.array(odds.take(order), pa.float32()))
                k = len(begins)
                empty = [none(k, c.type) for c in documents[2:8]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(k, dtype=np.int32)), pa.array(uid + owner.take(begins), pa.int64()), *empty,
                     pa.array([rare_words[i] for i in order.take(begins).tolist()], pa.binary()), places],
                    names=names,
                )
            uid += n


def most_frequent(counts: DataFrame, most: int) -> Column:
    """A condition that holds for the ``most`` most frequent words of (word, c), or all but a few of them.

    Nothing is sorted: words are counted by sixteenths of an octave, and within the sixteenth that would be too many by
    buckets of a hash, so that the cut falls inside it, at the same words in every run.
    """
    octave = F.floor(F.log2("c") * 16).cast("int")
    bucket = F.pmod(F.xxhash64("word"), F.lit(4_096)).cast("int")
    chosen, left = F.lit(False), most
    for r in sorted(counts.groupBy(octave.alias("octave")).count().collect(), key=lambda r: -r["octave"]):
        if r["count"] <= left:
            chosen, left = octave >= r["octave"], left - r["count"]
            continue
        inside = counts.where(octave == r["octave"]).groupBy(bucket.alias("bucket")).count()
        end = 0
        for b in sorted(inside.collect(), key=lambda b: b["bucket"]):
            left -= b["count"]
            if left < 0:
                break
            end = b["bucket"] + 1
        return chosen | ((octave == r["octave"]) & (bucket < end))
    return chosen


def score_texts(
    docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", folds: int = 7, out_fold: int = 2,
    start: int = 1_500, steps: int = 500, rounds: int = 4, frequent: int = FREQUENT,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    Every word is split into all its subwords in a public vocabulary, and attention gives the probability of the next subword: a
    softmax over groups of subwords, then one within the group. HEAD - 1 subwords and the end are predicted from context at both levels; the
    others are in groups predicted from context, with their smoothed share of the training counts inside. After its first subword a word is
    either one of the training words that begin so, by their counts (``Lexicon``), or a new one that the model spells and ends; the score is the
    log10 of the sum of both ways, over all words of the text and its end. Each subword is scored once. The probabilities of all texts sum to at
    most 1: a word that was never seen has to be spelled, where the base gives all of them together as much as it should give each.

    All training texts are counted: per-task counts, then one aggregate by word. The model starts from ``steps`` steps on about
    ``start`` training documents and then learns from all training documents, each of them in one of ``rounds`` rounds: tasks learn
    from their own texts and their changes are averaged. The ``frequent`` most frequent words go to every task; the counts of others are
    joined by word, for the base and for the score alike, so no table grows with the corpus on any machine.

    Defined cases: a null text counts as empty, and an empty text is its end token; a null id is in the fold of the empty
    text; without training texts every count is 0; repeated rows are counted and scored each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType
    held_out = fold(F.col(doc_id), folds) == out_fold
    taught = docs.where(~held_out).select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(doc_id).alias("doc_id"))
    counts = taught.select("text").mapInArrow(count_words, "word binary, c long")
    counts = written(counts.groupBy("word").agg(F.sum("c").alias("c")), "word_counts")
    ends = F.sum(F.when(F.octet_length("word") == 0, F.col("c")))
    total, distinct, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), ends).first()
    top = counts.where(most_frequent(counts, frequent)).toArrow()  # at most ``frequent`` words
    common = dict(zip(top["word"].to_pylist(), top["c"].to_pylist()))
    if ends:
        common[END] = ends
    ranks = read_ranks(vocabulary)
    shipped = spark.sparkContext.broadcast(ranks)  # the vocabulary file, whatever the corpus

    def by_subword(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, found = Subwords(shipped.value), Counter()
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i in split(word) if word != END else ():
                    found[i] += c
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["id", "c"])

    by_id = counts.mapInArrow(by_subword, "id int, c long").groupBy("id").agg(F.sum("c").alias("c"))
    # At most a row per subword of the vocabulary file.
    symbols, shares, tokens = symbol_table(word_begins(ranks), {r["id"]: r["c"] for r in by_id.collect()}, ends or 0)

    def by_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Subwords(shipped.value)
        found: dict[int, list[int]] = {}
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word != END:
                    both = found.setdefault(split(word)[0], [0, 0])
                    both[0] += c
                    both[1] += 1
        both = np.array(list(found.values()), dtype=np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), *map(pa.array, both)], names=["id", "c", "v"])

    firsts = counts.mapInArrow(by_first, "id int, c long, v long").groupBy("id").agg(F.sum("c").alias("c"), F.sum("v").alias("v"))
    # Again a row per subword at most.
    scorer = Scorer(None, common, ranks, symbols, shares, Lexicon(len(symbols), firsts.collect()))
    size = max(1, taught.count())

    def first(documents: float) -> Column:
        return F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) < int(min(1.0, documents / size) * 1_000_003) + 1

    # A row that is repeated, however often, is one of those the model starts from.
    chosen = taught.where(first(start)).dropDuplicates(["doc_id", "text"]).orderBy("doc_id", "text")
    teach = [scorer.sequence(words_of(r["text"])) for r in chosen.select("text").toLocalIterator()] if total else []
    scorer.model = train(teach, (tokens + 1) / (tokens + 1).sum(), steps=steps)
    if total and rounds:
        lesson = F.pmod(F.xxhash64("text", "doc_id", F.lit("lesson")), F.lit(rounds)).cast("int")
        untaught = spark.sparkContext.broadcast(Scorer(None, {}, ranks, symbols, shares))
        for r in range(rounds):
            averaged(taught.where(lesson == r).select("text"), untaught, scorer.model)
    tools = spark.sparkContext.broadcast(scorer)
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("uid", T.LongType()), T.StructField("doc_id", kind),
        T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("logs", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("word", T.BinaryType()), T.StructField("odds", T.ArrayType(T.FloatType())),
    ])
    names = schema.names
    given = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    both = written(given.mapInArrow(lambda it: scored_rows(it, tools.value, names), schema), "scored", "kind")
    # A rare word is as likely as by both ways: each of its places gains log10 (1 + c * 10^odds), written so that nothing overflows.
    count = F.log10("c")
    more = F.transform("odds", lambda o: o + count)
    gain = F.aggregate(more, F.lit(0.0), lambda total, o: total + F.greatest(o, F.lit(0.0)) + F.log1p(F.exp(-F.abs(o) * np.log(10).item())) / np.log(10).item())
    found = both.where("kind = 1").join(counts, "word").select("uid", "c", F.size("odds").alias("n"), gain.alias("gain"))
    rare = found.groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"), F.sum("n").alias("more_known"), F.sum("gain").alias("more_score")
    )
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return both.where("kind = 0").join(rare, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1)))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
