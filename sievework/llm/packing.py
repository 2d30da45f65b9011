"""Packing documents into training sequences: best fit over bins of several permitted sizes."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import word_count

SIZES = (512, 1024, 2048, 4096)
CHUNK = 20_000


def bin_cost(size: int) -> float:
    """What a sequence of this length costs: its tokens, attention that grows with the square, a fixed share."""
    return size * (1 + size / 8192) + 64


def best_fit(
    order: Sequence[int], lengths: Sequence[int], sizes: Sequence[int], allowed: int
) -> tuple[list[int], list[int]]:
    """(bin of each item, contents of each bin) for items taken in the given order.

    An item goes to the open bin that it leaves least room in. If none has room, a bin opens whose size
    costs least for each token that it can still be filled with: one of the first ``allowed`` sizes, or
    the least larger one for an item that needs it.
    """
    placed, used = [0] * len(lengths), []
    rooms: list[int] = []  # distinct remaining capacities, ascending
    at: dict[int, list[int]] = {}
    left = sum(lengths)
    for i in order:
        need = lengths[i]
        k = bisect_left(rooms, need)
        if k < len(rooms):
            room = rooms[k]
            b = at[room].pop()
            if not at[room]:
                del at[room], rooms[k]
        else:
            fits = [s for s in sizes[:allowed] if s >= need] or [next(s for s in sizes if s >= need)]
            room = min(fits, key=lambda s: (bin_cost(s) / max(1, min(s, left)), s))
            b = len(used)
            used.append(0)
        placed[i] = b
        used[b] += need
        left -= need
        if room > need:
            if room - need not in at:
                at[room - need] = []
                insort(rooms, room - need)
            at[room - need].append(b)
    return placed, used


def pack(lengths: Sequence[int], sizes: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, contents of each bin, size of each bin) at the least cost among the joint plans tried.

    Plan k may open the k smallest sizes, and larger ones only for items that need them. Items come
    longest first. In each plan every bin is at last downsized to the smallest size that holds its
    contents; the plan whose bins then cost least is taken, the one with fewer sizes in a tie.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    plans = []
    for k in range(1, len(sizes) + 1):
        placed, used = best_fit(order, lengths, sizes, k)
        fitted = [next(s for s in sizes if s >= u) for u in used]
        plans.append((sum(map(bin_cost, fitted)), k, placed, used, fitted))
    return min(plans)[2:]


def pack_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    length: Column | None = None,
    sizes: Sequence[int] = SIZES,
    chunk: int = CHUNK,
) -> DataFrame:
    """Every document in sequences of permitted lengths: one row per piece.

    doc_id, piece (from 0), n_tokens, bin_id, bin_size (a permitted length), bin_used (tokens in the
    bin) and start (where the piece begins in it). A document's length is its words and one end mark,
    unless ``length`` gives another. A document longer than the largest size is cut into full pieces, each a bin of its own, and
    a remainder; nothing is dropped. Remainders are packed ``chunk`` documents at a time within the input's partitions, so
    there is no shuffle, a task holds ``chunk`` lengths however large the table, and a lost task makes
    the same bins again. Each chunk can leave a few bins part full: under one in a thousand at the default.

    Defined cases: a null or empty text is its end mark; lengths of 0 or less take part as 0 and may share a bin
    with anything; repeated rows are packed each; a null id is kept; an empty table gives no rows.
    """
    sizes = sorted(sizes)
    length = word_count(F.col(text)) + 1 if length is None else length
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long").alias("n"))

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        made = 0
        for part in chunks(batches, chunk):
            for out, count in packed(part, sizes, first + made):
                made += count
                yield out

    schema = T.StructType(
        [T.StructField("doc_id", kind)]
        + [T.StructField(c, T.LongType()) for c in ("piece", "n_tokens", "bin_id", "bin_size", "bin_used", "start")]
    )
    return rows.mapInArrow(bins, schema)


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a partition, ``size`` at a time."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def packed(part: pa.Table, sizes: Sequence[int], first_bin: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Rows of one chunk, with the number of bins that they open: full pieces, then packed remainders."""
    largest = sizes[-1]
    n = part["n"].to_numpy()
    full = n // largest
    ids = part["doc_id"].combine_chunks()

    def batch(docs, piece, tokens, bin_id, size, used, start):
        columns = [ids.take(pa.array(docs)), *map(pa.array, (piece, tokens, bin_id, size, used, start))]
        names = ["doc_id", "piece", "n_tokens", "bin_id", "bin_size", "bin_used", "start"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def same(value, like):
        return np.full(len(like), value, dtype=np.int64)

    opened = first_bin
    for d in np.flatnonzero(full):
        for at in range(0, int(full[d]), 100_000):
            piece = np.arange(at, min(at + 100_000, full[d]), dtype=np.int64)
            most = same(largest, piece)
            yield batch(same(d, piece), piece, most, opened + piece - at, most, most, same(0, piece)), len(piece)
            opened += len(piece)
    docs = np.flatnonzero((n % largest > 0) | (n == 0))
    if not len(docs):
        return
    tokens = n[docs] % largest
    placed, used, fitted = (np.array(x, dtype=np.int64) for x in pack(tokens.tolist(), sizes))
    order = np.argsort(placed, kind="stable")
    by_bin, length = placed[order], tokens[order]
    ends = np.cumsum(length)
    heads = np.flatnonzero(np.r_[True, by_bin[1:] != by_bin[:-1]])
    base = np.repeat((ends - length)[heads], np.diff(np.r_[heads, len(by_bin)]))
    docs = docs[order]
    yield batch(docs, full[docs], length, opened + by_bin, fitted[by_bin], used[by_bin], ends - length - base), len(used)
