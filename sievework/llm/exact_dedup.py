"""Exact duplicates: a minimal perfect hash over historical digests, looked up by those that come later."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import written

DIGEST = 32  # bytes of a SHA-256
PER_BUCKET = 4_096
ROOM = 1.5
#: White space other than a single blank; a single blank is what it would become.
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with every run of white space as one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN, " ")


def words_of_digests(digests: np.ndarray) -> np.ndarray:
    """n x 4 words of 64 bits from n x 32 bytes."""
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, DIGEST // 8)


def places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where digests fall in a level: each level looks at another word, mixed with the number of the level."""
    x = words[:, level % words.shape[1]] + np.uint64((level * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """A minimal perfect hash of n distinct digests onto 0 .. n - 1.

    Digests fall into the bits of a first level. Those alone on their bit set it and are done, the others go on to the next,
    smaller level. The slot of a digest is the number of set bits before its own, over all levels. Two digests
    differ in a word, and every word is looked at again and again, so all find a place; ``ROOM`` bits
    a digest are given to each level.
    """

    sizes: np.ndarray  # bits of each level
    bits: np.ndarray  # all levels, one after the other

    @classmethod
    def of(cls, digests: np.ndarray, levels: int = 512) -> PerfectHash:
        words, sizes, bits = words_of_digests(digests), [], []
        while len(words):
            if len(sizes) == levels:
                raise ValueError("a digest is given twice")
            size = max(8, int(len(words) * ROOM))
            at = places(words, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words = words[~alone[at]]
            sizes.append(size)
            bits.append(alone)
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(bits) if bits else np.zeros(0, dtype=bool))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of every member; of a nonmember the slot of some member, or -1."""
        words = words_of_digests(digests)
        rank = np.cumsum(self.bits) - 1
        found, left, start = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + places(words[left], level, size)
            hit = self.bits[at]
            found[left[hit]] = rank[at[hit]]
            left, start = left[~hit], start + size
            if not len(left):
                break
        return found


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """n x 32 bytes from a column of binary digests."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, DIGEST)


def as_column(digests: np.ndarray) -> pa.Array:
    return pa.array([d.tobytes() for d in digests], pa.binary())


def digest_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_no, doc_id, digest) of every document, stored: the numbers of the rows hold from there on."""
    digest = F.unhex(F.sha2(normalised(F.col(f"`{text}`")), 256)).alias("digest")
    return written(docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(f"`{doc_id}`").alias("doc_id"), digest), "digests")


def distinct_digests(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, digest, winner, rows): each distinct digest with the locator of its winner.

    The winner has the smallest id, a null id only if there is no other, and of equal ids the first row. Reduced in the map tasks, so copies
    that make up a third of all rows cost one row each.
    """
    winner = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row_no")).alias("winner")
    bucket = F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(buckets)).alias("bucket")
    return rows.groupBy("digest").agg(winner, F.count("*").alias("n_rows")).select(
        bucket, "digest", "winner.doc_id", "winner.row_no", "n_rows"
    )


def history_index(distinct: DataFrame) -> DataFrame:
    """One row per bucket of historical digests: the hash, and by slot the full digests and the winners' locators.

    A bucket has about PER_BUCKET digests, whatever the corpus: its row is bounded, and each is made and looked up on its own.
    """
    kind = distinct.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()),
        T.StructField("digests", T.BinaryType()), T.StructField("doc_ids", T.ArrayType(kind)),
        T.StructField("row_nos", T.ArrayType(T.LongType())), T.StructField("n_rows", T.ArrayType(T.LongType())),
    ])

    def built(rows: pa.Table) -> pa.Table:
        digests = as_matrix(rows["digest"])
        hashed = PerfectHash.of(digests)
        by_slot = pa.array(np.argsort(hashed.slots(digests)))
        rows = rows.take(by_slot)
        return pa.table({
            "bucket": rows["bucket"].slice(0, 1),
            "sizes": pa.array([hashed.sizes.tolist()], pa.list_(pa.int64())),
            "bits": pa.array([np.packbits(hashed.bits).tobytes()], pa.binary()),
            "digests": pa.array([as_matrix(rows["digest"]).tobytes()], pa.binary()),
            **{name: pa.array([rows[c].to_pylist()], pa.list_(rows[c].type)) for name, c in (("doc_ids", "doc_id"), ("row_nos", "row_no"), ("n_rows", "n_rows"))},
        })

    return distinct.groupBy("bucket").applyInArrow(built, schema)


def looked_up(distinct: DataFrame, index: DataFrame) -> DataFrame:
    """(digest, slot) of later digests: their slot in the index where its full digest is the same, -1 for nonmembers."""

    def found(later: pa.Table, stored: pa.Table) -> pa.Table:
        digests = as_matrix(later["digest"])
        slots = np.full(len(digests), -1, dtype=np.int64)
        for row in stored.to_pylist():  # one at most
            sizes = np.array(row["sizes"], dtype=np.int64)
            bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), count=int(sizes.sum())).astype(bool)
            slots = PerfectHash(sizes, bits).slots(digests)
            held = np.frombuffer(row["digests"], dtype=np.uint8).reshape(-1, DIGEST)
            hit = slots >= 0
            hit[hit] = (held[slots[hit]] == digests[hit]).all(axis=1)  # byte for byte
            slots[~hit] = -1
        return later.select(["bucket", "digest", "doc_id", "row_no", "n_rows"]).append_column("slot", pa.array(slots))

    schema = T.StructType([*[distinct.schema[c] for c in ("bucket", "digest", "doc_id", "row_no", "n_rows")], T.StructField("slot", T.LongType())])
    return distinct.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(found, schema)


def opened(index: DataFrame) -> DataFrame:
    """(bucket, slot, digest, doc_id, row_no, n_rows): the slots of an index as rows."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                digests = np.frombuffer(row["digests"], dtype=np.uint8).reshape(-1, DIGEST)
                n = len(digests)
                columns = [pa.array(np.full(n, row["bucket"])), pa.array(np.arange(n)), as_column(digests)]
                given = [pa.array(row[c], batch.schema.field(c).type.value_type) for c in ("doc_ids", "row_nos", "n_rows")]
                yield pa.RecordBatch.from_arrays([*columns, *given], names=schema.names)

    schema = T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("slot", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("doc_id", index.schema["doc_ids"].dataType.elementType), T.StructField("row_no", T.LongType()), T.StructField("n_rows", T.LongType()),
    ])
    return index.mapInArrow(slots, schema)


def duplicate_groups(rows: DataFrame, historical: Column, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(digest, keep_id, keep_row, group_size) of every distinct digest of a table of ``digest_table``.

    The historical rows make the index. The others are looked up in it: members join the group of their slot, and may win it; the
    digests that the index does not hold make groups of their own.
    """
    buckets = max(1, -(-rows.count() // per_bucket))
    is_old = F.coalesce(historical, F.lit(False))
    index = written(history_index(distinct_digests(rows.where(is_old), buckets)), "index")
    later = written(looked_up(distinct_digests(rows.where(~is_old), buckets), index), "looked_up")
    best = F.least(
        F.struct(F.col("o.doc_id").isNull().alias("absent"), "o.doc_id", "o.row_no"),
        F.when(F.col("l.n_rows").isNotNull(), F.struct(F.col("l.doc_id").isNull().alias("absent"), "l.doc_id", "l.row_no")),
    )
    members = later.where("slot >= 0")
    on = (F.col("o.bucket") == F.col("l.bucket")) & (F.col("o.slot") == F.col("l.slot"))
    old = opened(index).alias("o").join(members.alias("l"), on, "left").select(
        "o.digest", best.alias("best"), (F.col("o.n_rows") + F.coalesce("l.n_rows", F.lit(0))).alias("group_size")
    )
    old = old.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"), "group_size")
    new = later.where("slot < 0").select("digest", F.col("doc_id").alias("keep_id"), F.col("row_no").alias("keep_row"), F.col("n_rows").alias("group_size"))
    return written(old.unionByName(new), "groups")


def exact_duplicates(
    docs: DataFrame, historical: Column, *, doc_id: str = "doc_id", text: str = "text", per_bucket: int = PER_BUCKET
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document.

    Texts are equal when they are the same after each run of white space became one blank; their
    SHA-256 stands for them. ``historical`` says, over the column ``doc_id``, which documents the index is built from; the result does not
    depend on it. Of equal texts the row with the smallest id stays.

    Defined cases: a null text is an empty one; rows with equal id and text are one group of which one row stays; a row
    without an id stays only if no other row of its group has one, and counts as not historical where the condition is null;
    an empty table gives no rows; other columns are ignored.
    """
    rows = digest_table(docs, doc_id, text)
    groups = duplicate_groups(rows, historical, per_bucket)
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_no") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def earlier_half(docs: DataFrame, doc_id: str = "doc_id") -> Column:
    """Ids up to the middle of their range: what came in before, where ids are given in order."""
    low, high = docs.agg(F.min(doc_id), F.max(doc_id)).first()
    return F.col("doc_id") <= F.lit(None if low is None else low + (high - low) // 2)


def without_duplicates(docs: DataFrame, historical: Column, *, doc_id: str = "doc_id", text: str = "text", per_bucket: int = PER_BUCKET) -> DataFrame:
    """The documents without repeats: the winning row of every group, whole, in the input's columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    digest = F.unhex(F.sha2(normalised(F.col(f"`{text}`")), 256)).alias("digest")
    numbered = written(docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(f"`{doc_id}`").alias("doc_id"), digest, row), "numbered")
    groups = duplicate_groups(numbered.select("row_no", "doc_id", "digest"), historical, per_bucket)
    return numbered.join(groups.select(F.col("keep_row").alias("row_no")), "row_no", "left_semi").select("row.*")
