"""Hard negatives: Hilbert-ordered blocks of candidates, zone maps, and bounds that choose the blocks to read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sievework.llm.common import written
from sievework.llm.topk import NO_ID, best_rows, exact_kind, ids_of, matrix, whole_vector

BLOCK_ROWS = 1_024  # candidates of a block
ASK_ROWS = 4_096  # anchors that meet a block, or a group of zone maps, at once
ZONE_ROWS = 1_024  # zone maps of a group
CURVE_DIMS, CURVE_BITS = 8, 6
LOWEST, HIGHEST = -(1 << 62), 1 << 62  # no score of exact integers in doubles comes near


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of rows of cell numbers with ``bits`` bits each; all bits together are at most 63.

    From the highest bit down, the lower bits of the first dimension are inverted, or exchanged with those of
    the dimension at hand, so that each cube is walked in the direction in which the one before it ended. A Gray code then
    gives the order.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = np.int64(1 << bit), np.int64((1 << bit) - 1)
        for i in range(n):
            up = (x[i] & high) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] & np.int64(1 << bit)) != 0, np.int64((1 << bit) - 1), 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> np.int64(bit)) & 1)
    return key


def curve_place(e: Column, dims: list[int], low: list[float], high: list[float], bits: int) -> Column:
    """Hilbert key of integer vectors over some dimensions, cut into even cells between low and high."""
    floor, width = np.array(low), np.maximum(np.array(high) - np.array(low), 1e-9)

    @F.pandas_udf("long")
    def place(vectors: pd.Series) -> pd.Series:
        if not len(dims):
            return pd.Series(np.zeros(len(vectors), dtype=np.int64))
        some = np.array([[v[d] if d < len(v) else 0 for d in dims] for v in vectors], dtype=np.float64).reshape(-1, len(dims))
        cells = np.clip((some - floor) / width * (1 << bits), 0, (1 << bits) - 1)
        return pd.Series(hilbert_key(cells.astype(np.int64), bits))

    return place(e)


def block_table(rows: DataFrame, block_rows: int = BLOCK_ROWS, dims: int = CURVE_DIMS, bits: int = CURVE_BITS) -> DataFrame:
    """The candidates (vec_id, label, e) as stored Parquet blocks: sorted by label and place on the Hilbert curve.

    The curve runs over the dimensions that vary most. A block, numbered by ``block``, is about ``block_rows`` neighbours on the curve with one
    label. Every task writes a run of the order as its own file, so blocks are files or runs of row groups. Equal keys are
    dealt by a hash of the row, so that a vector in a third of all rows fills many blocks and not one.
    """
    size = rows.agg(F.max(F.size("e"))).first()[0] or 0
    spread = rows.select([F.coalesce(F.get("e", F.lit(d)), F.lit(0)).cast("double").alias(f"d{d}") for d in range(size)])
    stats = spread.agg(F.count(F.lit(1)), *[f(f"d{d}") for d in range(size) for f in (F.avg, F.var_pop)]).first()
    mean = {d: stats[1 + 2 * d] or 0.0 for d in range(size)}
    variance = {d: stats[2 + 2 * d] or 0.0 for d in range(size)}
    chosen = sorted(variance, key=lambda d: (-variance[d], d))[:dims]
    reach = [2 * variance[d] ** 0.5 + 1 for d in chosen]
    low = [mean[d] - r for d, r in zip(chosen, reach)]
    high = [mean[d] + r for d, r in zip(chosen, reach)]
    placed = rows.withColumn("place", curve_place(F.col("e"), chosen, low, high, bits)).withColumn("salt", F.xxhash64("vec_id"))
    ordered = placed.repartitionByRange("label", "place", "salt").sortWithinPartitions("label", "place", "salt")
    row_no = F.monotonically_increasing_id()  # numbers the rows of each task in their order
    ordered = ordered.select("vec_id", "label", "e", F.shiftright(row_no, 33).alias("run"), row_no.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    number = F.floor(F.col("at") / block_rows).cast("long")
    # Where a block would hold several labels, each of them is a block of its own.
    return written(ordered.select(F.struct("run", number.alias("number"), "label").alias("block"), "vec_id", "label", "e"), "blocks")


def zone_maps(blocks: DataFrame) -> DataFrame:
    """(block, label, n, low, high, first_id) of every block: the least and greatest value of each dimension, padded with zeros, and the least id."""
    size = blocks.agg(F.max(F.size("e"))).first()[0] or 0
    part = [F.coalesce(F.get("e", F.lit(d)), F.lit(0)) for d in range(size)]
    ends = [f(x).alias(f"{n}{d}") for d, x in enumerate(part) for n, f in (("l", F.min), ("h", F.max))]
    first_id = F.min(F.coalesce("vec_id", F.lit(int(NO_ID)))).alias("first_id")
    zones = blocks.groupBy("block", "label").agg(F.count("*").alias("n"), first_id, *ends)
    arrays = [F.array(*[F.col(f"{n}{d}") for d in range(size)]).cast("array<long>").alias(name) for n, name in (("l", "low"), ("h", "high"))]
    return written(zones.select("block", "label", "n", "first_id", *arrays), "zones")


def bounds(asks: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each ask with any vector inside each box, by interval arithmetic.

    In doubles. Where their sums need not be exact, the bounds are widened by more than the rounding can be.
    """
    exact = exact_kind(asks, np.concatenate([low, high])) is np.float64
    asks, low, high = (m.astype(np.float64) for m in (asks, low, high))
    up, down = np.maximum(asks, 0), np.minimum(asks, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    slack = 0 if exact else 1e-9 * (np.abs(asks) @ np.maximum(np.abs(low), np.abs(high)).T) + 1
    return least - slack, most + slack


def padded(tables: list[pa.ChunkedArray]) -> list[np.ndarray]:
    """Lists of integers as matrices of one width."""
    width = max(matrix(t).shape[1] for t in tables)
    return [matrix(t, width) for t in tables]


def window_ends(column: pa.ChunkedArray, missing: int) -> np.ndarray:
    """Rows x windows; rows with fewer windows get ends that nothing reaches."""
    lists = column.to_pylist()
    out = np.full((len(lists), max(map(len, lists), default=0)), missing, dtype=np.int64)
    for row, values in zip(out, lists):
        row[: len(values)] = values
    return out


class Search:
    """Best candidates of windows of scores, block by block.

    ``asks`` has (ask, anchor_id, label, e, low, high, tie): an anchor with one or more windows, arrays of score bounds that include their
    ends; at the low end only ids up to ``tie`` count. ``same`` looks for candidates with the anchor's label, otherwise for those with another one. The k best of every
    window are found in two rounds. The first reads one promising block per anchor and group of zone maps, which gives each
    window a k-th best entry so far. The second reads every other block whose bounds allow a score between
    that, or the window's low end, and its high end, with an id that would come before it if the scores are equal; a block that is not read can
    hold nothing that belongs to the answer.
    """

    def __init__(self, blocks: DataFrame, zones: DataFrame, k: int, same: bool, ask_rows: int = ASK_ROWS, zone_rows: int = ZONE_ROWS):
        self.blocks, self.zones, self.k, self.same, self.ask_rows = blocks, zones, k, same, ask_rows
        self.groups = max(1, -(-zones.count() // zone_rows))

    def chunked(self, asks: DataFrame, chunks: int) -> DataFrame:
        return asks.withColumn("chunk", F.pmod(F.xxhash64("ask"), F.lit(chunks)).cast("int"))

    def chosen(self, asks: DataFrame, chunks: int, probe: bool) -> DataFrame:
        """(ask, block, mid): blocks to read. A probe gives one per ask and group of zone maps, of any number of those one is used."""
        zones = self.zones.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(self.groups)).cast("int"))
        zones = zones.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        every = self.chunked(asks, chunks).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1))))
        same = self.same

        def met(a: pa.Table, z: pa.Table) -> pa.Table:
            rows, columns, worth = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            if a.num_rows and z.num_rows:
                least, most = bounds(*padded([a["e"], z["low"], z["high"]]))
                own, theirs = (t["label"].combine_chunks().to_numpy() for t in (a, z))
                may = (own[:, None] == theirs[None, :]) == same
                low, high = window_ends(a["low"], HIGHEST), window_ends(a["high"], LOWEST)
                if probe:
                    top = high.max(axis=1, initial=LOWEST)[:, None].astype(np.float64)
                    # Most promising: reaches far up, but its middle no further than the highest window.
                    value = np.where(top >= HIGHEST, most, -np.abs((least + most) / 2 - top))
                    value = np.where(may, value, -np.inf)
                    rows = np.flatnonzero(may.any(axis=1))
                    columns = value.argmax(axis=1)[rows]
                    worth = value[rows, columns]
                else:
                    wanted = np.zeros(may.shape, dtype=bool)
                    tie, first_id = window_ends(a["tie"], LOWEST), z["first_id"].combine_chunks().to_numpy()
                    for w in range(low.shape[1]):
                        lo, hi = low[:, w, None], high[:, w, None]
                        wanted |= (lo <= hi) & (least <= hi) & ((most > lo) | ((most == lo) & (first_id[None, :] <= tie[:, w, None])))
                    rows, columns = np.nonzero(wanted & may)
                    worth = np.zeros(len(rows))
            return pa.table({
                "ask": a["ask"].combine_chunks().take(pa.array(rows, pa.int64())),
                "block": z["block"].combine_chunks().take(pa.array(columns, pa.int64())),
                "worth": pa.array(worth, pa.float64()),
            })

        schema = T.StructType([T.StructField("ask", T.LongType()), self.zones.schema["block"], T.StructField("worth", T.DoubleType())])
        return every.groupBy("chunk", "group").cogroup(zones.groupBy("chunk", "group")).applyInArrow(met, schema)

    def read(self, asks: DataFrame, pairs: DataFrame, chunks: int) -> DataFrame:
        """(ask, window, vec_id, score): the k best of each window in every block that its anchor is to read."""
        given = self.chunked(pairs.join(asks, "ask"), chunks)
        candidates = self.blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        k = self.k

        def scored(a: pa.Table, c: pa.Table) -> pa.Table:
            parts: list[tuple[np.ndarray, ...]] = []
            if a.num_rows and c.num_rows:
                asks_, vectors = padded([a["e"], c["e"]])
                kind = exact_kind(asks_, vectors)
                vectors = vectors.T.astype(kind)
                ids, own = ids_of(c["vec_id"]), ids_of(a["anchor_id"])
                ask = a["ask"].combine_chunks().to_numpy()
                low, high, tie = window_ends(a["low"], HIGHEST), window_ends(a["high"], LOWEST), window_ends(a["tie"], LOWEST)
                for at in range(0, len(asks_), 512):
                    some = slice(at, at + 512)
                    scores = asks_[some].astype(kind) @ vectors
                    other = ids[None, :] != own[some, None]
                    for w in range(low.shape[1]):
                        lo, hi = low[some, w, None], high[some, w, None]
                        inside = other & (scores <= hi) & ((scores > lo) | ((scores == lo) & (ids[None, :] <= tie[some, w, None])))
                        best = best_rows(scores, ids, inside, k)
                        rows = np.repeat(np.arange(len(best)), [len(b) for b in best])
                        columns = np.concatenate(best)
                        parts.append((ask[some][rows], np.full(len(rows), w), ids[columns], scores[rows, columns].astype(np.int64)))
            whole = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
            names = pa.array(whole[2], pa.int64(), mask=whole[2] == NO_ID)
            return pa.table({"ask": whole[0], "window": pa.array(whole[1], pa.int32()), "vec_id": names, "score": whole[3]})

        return given.groupBy("block", "chunk").cogroup(candidates.groupBy("block", "chunk")).applyInArrow(
            scored, "ask long, window int, vec_id long, score long"
        )

    def best(self, found: DataFrame) -> DataFrame:
        """(ask, window, vec_id, score, rank): the k best over all blocks."""
        order = Window.partitionBy("ask", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.k)

    def run(self, asks: DataFrame) -> DataFrame:
        chunks = max(1, -(-asks.count() // self.ask_rows))
        probes = self.chosen(asks, chunks, probe=True).groupBy("ask").agg(F.max(F.struct("worth", "block")).alias("top"))
        probes = written(probes.select("ask", "top.block"), "probes")
        first = written(self.best(self.read(asks, probes, chunks)), "first")
        entry = F.struct("score", F.coalesce("vec_id", F.lit(int(NO_ID))).alias("vec_id"))
        kth = first.where(F.col("rank") == self.k).groupBy("ask").agg(
            F.map_from_entries(F.collect_list(F.struct("window", entry))).alias("kth")
        )
        # The k-th best lies inside its window, so its score is the low end or above.
        tie = F.transform("tie", lambda tie, w: F.coalesce(F.col("kth")[w]["vec_id"], tie))
        low = F.transform("low", lambda low, w: F.coalesce(F.col("kth")[w]["score"], low))
        asks = asks.join(kth, "ask", "left").withColumns({"low": low, "tie": tie}).drop("kth")
        asks = written(asks, "raised")
        pairs = self.chosen(asks, chunks, probe=False).select("ask", "block")
        pairs = written(pairs.join(probes, ["ask", "block"], "left_anti"), "pairs")
        return self.best(first.drop("rank").unionByName(self.read(asks, pairs, chunks)))


def usable_rows(vectors: DataFrame, label: Column, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, label, e) of the rows that take part, stored."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole_vector(F.col(f"`{embedding}`")).alias("e"))
    return written(rows.where("label IS NOT NULL AND e IS NOT NULL"), "usable")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, *, vec_id: str = "vec_id", embedding: str = "embedding",
    positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    block_rows: int = BLOCK_ROWS, ask_rows: int = ASK_ROWS, zone_rows: int = ZONE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition over the column ``vec_id``. A row's score is its integer inner product with the anchor. Its positives are the best
    ``positives`` rows of its label, its negatives for each of them the best ``negatives`` rows of other labels with a score between
    ``least`` and ``most`` percent of the positive's; ties go to the smaller id.

    Candidates lie in Hilbert-ordered blocks with zone maps (``block_table``, ``zone_maps``); ``Search`` reads those
    whose bounds reach into an anchor's windows. Blocks, anchors and zone maps meet in groups of bounded size.

    Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; vectors of unlike length count
    as filled up with zeros; rows with the anchor's id are no candidates for it; a null id is no anchor and comes last among ties;
    a repeated anchor row is answered each time, and repeated rows are candidates of their own; a window whose upper end is below its lower end is
    empty, as for a negative positive; an empty table gives no rows. Scores are exact while they fit in a long.
    """
    rows = usable_rows(vectors, label, vec_id, embedding)
    blocks = block_table(rows, block_rows)
    zones = zone_maps(blocks)
    anchors = rows.where(is_anchor).select(
        F.monotonically_increasing_id().alias("ask"), F.col("vec_id").alias("anchor_id"), "label", "e"
    )
    anchors = written(anchors, "anchors")

    def window(low: Column, high: Column) -> list[Column]:
        return [F.array(x.cast("long")).alias(n) for x, n in ((low, "low"), (high, "high"), (F.lit(int(NO_ID)), "tie"))]

    near = Search(blocks, zones, positives, True, ask_rows, zone_rows).run(anchors.select("*", *window(F.lit(LOWEST), F.lit(HIGHEST))))
    near = written(near.select("ask", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Whole numbers all the way: the first score of 100 * score >= least * p, and the last of 100 * score <= most * p.
    low = F.expr(f"(positive_score * {least} + pmod(-(positive_score * {least}), 100)) div 100").alias("low")
    high = F.expr(f"(positive_score * {most} - pmod(positive_score * {most}, 100)) div 100").alias("high")
    # The windows of an anchor in the order of its positives: at most that many.
    windows = near.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("place", low, high))).alias("w"))
    asks = anchors.join(windows, "ask").select("ask", "anchor_id", "label", "e", F.col("w.low").alias("low"), F.col("w.high").alias("high"), F.transform("w", lambda _: F.lit(int(NO_ID))).alias("tie"))
    far = Search(blocks, zones, negatives, False, ask_rows, zone_rows).run(written(asks, "asks"))
    named = near.join(anchors.select("ask", "anchor_id"), "ask")
    return far.withColumn("place", F.col("window") + 1).join(named, ["ask", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
