"""SimHash near-duplicates: fingerprints, a grid over segment bit counts, exact verification, groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import components, words_of, written

SEED = 42
BANDS = 4
RADIUS = 2
CROWD = 2_000
EVEN_BITS = 0x5555555555555555
AT_ONCE = 65_536


def simhash(words: list[bytes], width: int) -> int:
    """Signed 64-bit fingerprint of a word sequence: a bit is set if it is in over half of the shingles' hashes."""
    import xxhash

    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    spans = zip(starts, ends[width - 1 :]) if len(words) > width else [(0, ends[-1])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s : e - 1], SEED) for s, e in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at : at + AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """SimHash of a whole text over shingles of ``width`` words; 0 if it has no word."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(words_of(t), width) for t in texts], dtype="int64")

    return of(text)


def segment_counts(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments, each written in unary in its segment.

    In that form the Manhattan distance of two count vectors is the number of differing bits. It never
    exceeds the number of bits in which the fingerprints differ.
    """
    even = F.lit(EVEN_BITS)
    high = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(high).bitwiseAND(even)
    both = fp.bitwiseAND(high).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): links among distinct fingerprints ``fp`` that join those within RADIUS bits, directly or by a chain of such.

    The segment counts are the coordinates of a grid. A Manhattan ball of the radius leaves all but
    RADIUS of the bands of coordinates as they are, so two fingerprints within reach share the
    coordinates of a set of BANDS - RADIUS bands: a cell. Each fingerprint goes to one cell per such set; inside
    a cell the Manhattan distance over all segments is the lower bound, the fingerprints decide.

    A cell of more than ``crowd`` fingerprints would cost the square of that, so its members are linked
    through midpoints instead: two fingerprints differ in at most two bits if and only if some value is within one bit
    of both, and no value has more than 65 neighbours. That is exact and linear.
    """
    bits = 64 // BANDS
    counts = segment_counts(F.col("fp"))
    band = [F.shiftrightunsigned(F.col("counts"), bits * i).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(BANDS)]
    layers = list(combinations(range(BANDS), BANDS - RADIUS))

    def cell(layer: int, bands: tuple[int, ...]) -> Column:
        value = F.lit(0).cast("long")
        for i in bands:
            value = F.shiftleft(value, bits).bitwiseOR(band[i])
        return F.struct(F.lit(layer).alias("layer"), value.alias("cell"))

    placed = (
        fps.select("fp", counts.alias("counts"))
        .select("fp", "counts", F.explode(F.array(*[cell(n, b) for n, b in enumerate(layers)])).alias("at"))
        .select("fp", "counts", "at.layer", "at.cell")
    )
    # Counted with map-side combine and stored, so that the join can split a cell that very many share.
    sizes = written(placed.groupBy("layer", "cell").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = written(placed.join(sizes, ["layer", "cell"]), "cells")
    quiet = shared.where(F.col("n") <= crowd)
    x, y = quiet.alias("x"), quiet.alias("y")
    near = x.join(
        y,
        (F.col("x.layer") == F.col("y.layer"))
        & (F.col("x.cell") == F.col("y.cell"))
        & (F.col("x.fp") < F.col("y.fp"))
        & (differing(F.col("x.counts"), F.col("y.counts")) <= RADIUS)
        & (differing(F.col("x.fp"), F.col("y.fp")) <= RADIUS),
    ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    middle = F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))
    busy = shared.where(F.col("n") > crowd).select("fp").distinct()
    met = busy.select("fp", F.explode(middle).alias("middle")).groupBy("middle").agg(F.collect_list("fp").alias("all"))
    starred = met.where(F.size("all") > 1).select(
        F.array_min("all").alias("a"), F.explode("all").alias("b")
    ).where("a <> b")
    return near.unionByName(starred)


def grouped(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(fp, root, component_id) for every distinct ``fp`` of (doc_id, fp): its group and the group's smallest doc_id."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(distinct.select("fp"), crowd)).withColumnRenamed("node", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = roots.select("root").distinct()
    groups = named.join(linked, "root", "left_semi").groupBy("root").agg(F.min("first_id").alias("least_id"))
    return named.join(groups, "root", "left").select("fp", "root", F.coalesce("least_id", "first_id").alias("component_id"))


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3, crowd: int = CROWD
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Equal fingerprints are one node, so copies cost one row each and no links. Defined cases: a null or
    empty text has fingerprint 0; a text of fewer words than ``width`` is one shingle; repeated rows are
    kept; null ids never name a group unless it has no other; an empty table gives no rows. Other columns are ignored.
    """
    prints = written(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), width).alias("fp")), "prints"
    )
    groups = grouped(prints, crowd)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(groups, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def distinct_documents(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3, crowd: int = CROWD
) -> DataFrame:
    """The documents without near copies: of each group only the one with the smallest id stays, whole.

    Of several rows with that id the one whose text has the smallest hash stays, of equal rows the first.
    The choice is made on narrow rows; the documents themselves are shuffled once, to drop the others. The columns
    are those of the input.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    printed = docs.select(
        row, fingerprint(F.col(text), width).alias("fp"), F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    printed = written(printed, "printed")  # the numbers of the rows hold from here on
    narrow = written(printed.select("row_no", F.col(f"row.`{doc_id}`").alias("doc_id"), "fp", "tie"), "narrow")
    groups = grouped(narrow.select("doc_id", "fp"), crowd)
    kept = (
        narrow.join(groups, "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("tie", "row_no")).alias("first"))
    )
    return printed.join(kept.select("first.row_no"), "row_no", "left_semi").select("row.*")
