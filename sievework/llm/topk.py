"""Exact top-k inner-product search by a three-phase uniform threshold over dimension blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.common import written

PARTS = 4
QUERY_BLOCK = 512
VECTOR_BLOCK = 4096
NO_ID = np.iinfo(np.int64).max


def whole_vector(embedding: Column) -> Column:
    """floor(256 * x) of every component; null where the vector or a component is null or not finite."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(embedding, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def exact_kind(a: np.ndarray, b: np.ndarray) -> type:
    """float64 multiplies faster and is exact while no sum can reach 2**53; integers are exact up to a long's range."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float64 if most < 2**53 else np.int64


def local_scores(queries: np.ndarray, vectors: np.ndarray, parts: int) -> Iterator[np.ndarray]:
    """Scores of all queries and vectors from each block of dimensions: the lists of the method's nodes."""
    kind = exact_kind(queries, vectors)
    q, v = queries.astype(kind), vectors.astype(kind)
    for at in np.array_split(np.arange(q.shape[1]), parts):
        yield q[:, at] @ v[:, at].T


def best_rows(scores: np.ndarray, ids: np.ndarray, keep: np.ndarray, k: int) -> list[np.ndarray]:
    """Columns of the k best kept entries of each row: highest score first, then smallest id."""
    found = []
    for row, mask in zip(scores, keep):
        at = np.flatnonzero(mask)
        if len(at) > k:
            edge = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= edge]
        found.append(at[np.lexsort((ids[at], -row[at]))][:k])
    return found


def ids_of(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().fill_null(NO_ID).to_numpy()


def gather(queries: pa.Table, vectors: pa.Table, k: int, parts: int) -> pa.Table:
    """Phase 1: of one block of vectors, the k best of each local list, with their full scores."""
    q = matrix(queries["e"])
    v = matrix(vectors["e"], q.shape[1])
    q = matrix(queries["e"], v.shape[1])
    vid, qid = ids_of(vectors["vec_id"]), ids_of(queries["query_id"])
    other = vid[None, :] != qid[:, None]
    full, lists = 0, np.zeros(other.shape, dtype=bool)
    for local in local_scores(q, v, parts):
        full = full + local
        if local.shape[1] > k:
            at = np.argpartition(np.where(other, local, local.min() - 1), local.shape[1] - k, axis=1)[:, -k:]
            np.put_along_axis(lists, at, True, axis=1)
        else:
            lists[:] = True
    best = best_rows(full, vid, lists & other, k)
    rows = np.repeat(np.arange(len(best)), [len(b) for b in best])
    columns = np.concatenate(best) if best else np.zeros(0, dtype=int)
    return pa.table({
        "query_no": queries["query_no"].combine_chunks().take(pa.array(rows)),
        "score": pa.array(np.asarray(full)[rows, columns].astype(np.int64)) if len(rows) else pa.array([], pa.int64()),
    })


def resolve(queries: pa.Table, vectors: pa.Table, k: int, parts: int) -> pa.Table:
    """Phases 2 and 3: entries whose score in some block of dimensions reaches its uniform share of the cutoff.

    A score that reaches the cutoff t has a local score of t / parts or more, so nothing is missed; the
    entries found are then resolved to their full scores, and those below the cutoff go.
    """
    q = matrix(queries["e"])
    v = matrix(vectors["e"], q.shape[1])
    q = matrix(queries["e"], v.shape[1])
    vid, qid = ids_of(vectors["vec_id"]), ids_of(queries["query_id"])
    no_cut = np.iinfo(np.int64).min
    cut = queries["cutoff"].combine_chunks().fill_null(no_cut).to_numpy()
    share = np.where(cut == no_cut, -np.inf, np.floor(cut / parts))[:, None]
    full, enough = 0, np.zeros((len(q), len(v)), dtype=bool)
    for local in local_scores(q, v, parts):
        full = full + local
        enough |= local >= share
    keep = enough & (full >= cut[:, None]) & (vid[None, :] != qid[:, None])
    best = best_rows(full, vid, keep, k)
    rows = np.repeat(np.arange(len(best)), [len(b) for b in best])
    columns = np.concatenate(best) if best else np.zeros(0, dtype=int)
    found = vid[columns]
    return pa.table({
        "query_no": queries["query_no"].combine_chunks().take(pa.array(rows)),
        "query_id": pa.array(qid[rows]),
        "vec_id": pa.array(found, pa.int64(), mask=found == NO_ID),
        "score": pa.array(np.asarray(full)[rows, columns].astype(np.int64)) if len(rows) else pa.array([], pa.int64()),
    })


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    parts: int = PARTS,
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors with the highest integer inner product for each query row.

    Queries meet vectors block by block: both are dealt into even blocks and every pair of blocks is
    one group, a matrix product of bounded size, wherever it runs. Phase 1 gathers the best of each
    local score list with their full scores; the k-th best of a query over all blocks is a safe cutoff.
    Phase 2 sends it out with the queries and collects every entry that has its uniform share of it in some block of dimensions,
    phase 3 resolves these exactly, k per query and block at most, of which the k best are the answer. Ties go to the smaller id.

    Defined cases: vectors that are null or hold null or non-finite components take no part; vectors of
    unlike length are compared as if filled up with zeros; all rows with a query's id are left out of its
    answers; a null id is no query and comes last among ties; a repeated query row is answered each time, and repeated
    vectors are answers of their own; fewer than k candidates give fewer rows; an empty table gives none.
    Scores are exact while they fit in a long.
    """
    usable = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), whole_vector(F.col(embedding)).alias("e"), is_query.alias("asks")
    ).where(F.col("e").isNotNull())
    usable = written(usable.withColumn("row_no", F.monotonically_increasing_id()), "vectors")
    total, asking = usable.agg(F.count("*"), F.count_if("asks")).first()
    v_blocks, q_blocks = max(1, -(-total // vector_block)), max(1, -(-asking // query_block))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("row_no"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = usable.where("asks").select(
        F.col("row_no").alias("query_no"), F.col("vec_id").alias("query_id"), "e", dealt(q_blocks).alias("q_block")
    )
    sides = usable.select("vec_id", "e", dealt(v_blocks).alias("v_block"), every(q_blocks).alias("q_block"))

    def met(queries: DataFrame, step, schema: str) -> DataFrame:
        left = queries.withColumn("v_block", every(v_blocks)).groupBy("q_block", "v_block")

        def one(q: pa.Table, v: pa.Table) -> pa.Table:
            if q.num_rows and v.num_rows:
                return step(q, v, k, parts)
            return pa.table({n: pa.array([], t) for n, t in fields})

        kinds = {"long": pa.int64()}
        fields = [(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]
        return left.cogroup(sides.groupBy("q_block", "v_block")).applyInArrow(one, schema)

    first = met(asked, gather, "query_no long, score long")
    ordered = Window.partitionBy("query_no").orderBy(F.desc("score"))
    cutoff = (
        first.withColumn("place", F.row_number().over(ordered))
        .where(F.col("place") == k)
        .select("query_no", F.col("score").alias("cutoff"))
    )
    ready = written(asked.join(cutoff, "query_no", "left"), "cutoffs")
    entries = met(ready, resolve, "query_no long, query_id long, vec_id long, score long")
    final = Window.partitionBy("query_no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (
        entries.withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
