"""Removal of byte strings that occur more than once, by suffix arrays over groups of aligned contexts."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import written
from sievework.llm.suffix_groups import longest_matches, suffix_array

LENGTH = 400
GRAM = 64
BLOCK = 16
CROWD = 5_000
PIECE = 1 << 20
SLICE = 1 << 22
PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of every gram of bytes, by differences of one running sum."""
    n = len(data)
    powers, inverse = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * powers[:n], out=total[1:])
    found = (total[gram:] - total[:-gram]) * inverse[: n - gram + 1]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0x9E3779B97F4A7C15)
    found ^= found >> np.uint64(29)
    return found


_BYTES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95
_KNOWN: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, made once for the largest n so far."""
    if not _KNOWN or len(_KNOWN[0]) < n:
        ones = [np.full(n, pow(b, 1, 1 << 64), dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
        for p in ones:
            p[0] = 1
        _KNOWN[:] = [np.cumprod(p) for p in ones]
    return _KNOWN


def anchored(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first start, last start, anchor, hash of the anchor's gram) of runs of windows with one anchor.

    data holds texts one after the other, ends where each ends. Every window of ``length`` bytes inside a text
    has as anchor the gram in it whose hash is least, the leftmost one in a tie. Equal windows thus have equal grams at
    equal distances as anchors, and each window start is in one run.
    """
    n = len(data)
    if n < length:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),)
    hashes = gram_hashes(data, gram)
    width, m = length - gram + 1, n - length + 1
    keyed = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    rows = -(-len(keyed) // width) + 1
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keyed)] = keyed
    cells = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(cells, axis=1).ravel()
    behind = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[:m], ahead[width - 1 : width - 1 + m]) & PLACE).astype(np.int64)
    begins = np.r_[0, ends[:-1]]
    inside = np.zeros(n + 1, dtype=np.int8)
    long = ends - begins >= length
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    valid = np.cumsum(inside[:m]) > 0
    change = np.empty(m, dtype=bool)
    change[0] = True
    change[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    first = np.flatnonzero(valid & change)
    stop = np.empty(m, dtype=bool)
    stop[-1] = True
    stop[:-1] = (anchor[1:] != anchor[:-1]) | ~valid[1:]
    last = np.flatnonzero(valid & stop)
    return first, last, anchor[first], hashes[anchor[first]]


def text_pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, ends, texts) of runs of whole texts of about PIECE bytes; a longer text comes in slices that overlap by a window less one."""
    i, n = 0, len(offsets) - 1
    while i < n:
        lo = int(offsets[i])
        j = max(i + 1, int(np.searchsorted(offsets, lo + PIECE, side="right")) - 1)
        hi = int(offsets[j])
        if hi - lo <= SLICE:
            yield lo, hi, offsets[i + 1 : j + 1] - lo, np.arange(i, j)
        else:
            for at in range(lo, max(lo + 1, hi - length + 1), SLICE):
                to = min(hi, at + SLICE + length - 1)
                yield at, to, np.array([to - at]), np.arange(i, i + 1)
        i = j


def anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Runs of windows of all texts of (t1, t2, text): text key, byte range of the starts, anchor place, gram and context hashes."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        text = batch.column(2)
        if not len(text):
            continue
        kind = "<i8" if pa.types.is_large_string(text.type) else "<i4"
        _, spots, bytes_ = text.buffers()
        offsets = np.frombuffer(spots, kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.zeros(0, np.uint8)
        view = memoryview(data)
        t1, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for lo, hi, ends, texts in text_pieces(offsets, length):
            first, last, anchor, grams = anchored(data[lo:hi], ends, length, gram)
            if not len(first):
                continue
            of = texts[np.searchsorted(ends, first, side="right")]
            base = offsets[of] - lo
            contexts = [digest(view[a:b]) for a, b in zip((first + lo).tolist(), (last + lo + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (
                    t1[of], t2[of], first - base, last - base, anchor - base,
                    grams.view(np.int64), np.array(contexts, dtype=np.uint64).view(np.int64),
                )],
                names=["t1", "t2", "s", "e", "a", "g", "h"],
            )


def repeated_starts(contexts: list[bytes], anchors: list[int], length: int, block: int) -> list[np.ndarray]:
    """For each context, which of its window starts begin a string that also begins elsewhere in the contexts.

    The contexts share one gram, and are cut into blocks that are aligned to it. A suffix array over the blocks of all of them
    tells how far each block's suffix goes on alike somewhere else. That settles the windows inside such a match, and
    those whose whole blocks do not match. Only windows that end within a block of a match's end are compared byte by byte.
    """
    shift = [a % block for a in anchors]
    counts = [(len(c) - r) // block for c, r in zip(contexts, shift)]
    cut = b"".join(c[r : r + n * block] for c, r, n in zip(contexts, shift, counts))
    _, names = np.unique(np.frombuffer(cut, dtype=f"V{block}"), return_inverse=True)
    symbols, begins = [], []
    at = 0
    for i, n in enumerate(counts):
        begins.append(len(symbols))
        symbols += (names[at : at + n] + len(contexts)).tolist()
        symbols.append(i)  # a mark of its own ends every context
        at += n
    best = np.array(longest_matches(symbols, suffix_array(symbols)), dtype=np.int64)
    found, open_starts = [], {}
    for i, (c, a, r, n) in enumerate(zip(contexts, anchors, shift, counts)):
        starts = np.arange(len(c) - length + 1)
        run = best[begins[i] : begins[i] + n]
        to = r + block * (np.arange(n) + run) - length  # last start inside each match
        sure = np.zeros(len(starts) + 1, dtype=np.int64)
        whole = np.flatnonzero(to >= r + block * np.arange(n))
        np.add.at(sure, r + block * whole, 1)
        np.add.at(sure, to[whole] + 1, -1)
        sure = np.cumsum(sure[:-1]) > 0
        head = -((r - starts) // block)  # first whole block of each window
        needed = (starts + length - r) // block - head
        maybe = (run[np.minimum(head, n - 1)] >= needed) & ~sure if n else ~sure
        found.append(sure)
        for p in np.flatnonzero(maybe).tolist():
            open_starts.setdefault(p - a, []).append(i)
    for offset in open_starts:
        inside = [(i, offset + a) for i, a in enumerate(anchors) if 0 <= offset + a <= len(contexts[i]) - length]
        seen = Counter(contexts[i][p : p + length] for i, p in inside)
        for i in open_starts[offset]:
            p = offset + anchors[i]
            found[i][p] = seen[contexts[i][p : p + length]] > 1
    return found


def runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last index of every run of true flags."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    yield from zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())


def settle_groups(batches: Iterator[pa.RecordBatch], length: int, block: int) -> Iterator[pa.RecordBatch]:
    """Spans of the contexts of each gram; the rows of a gram come one after the other."""
    names = ["t1", "t2", "s", "e"]

    def settled(rows: list[dict]) -> list[tuple[int, int, int, int]]:
        rows = list({r["h"]: r for r in rows}.values())  # a context can come from several copies of a text
        if len(rows) < 2:
            return []
        flags = repeated_starts([r["bytes"] for r in rows], [r["a"] - r["s"] for r in rows], length, block)
        return [
            (r["t1"], r["t2"], r["s"] + x, r["s"] + y + length)
            for r, f in zip(rows, flags) if not r["known"] for x, y in runs(f)
        ]

    held, gram, out = [], None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["g"] != gram:
                out += settled(held)
                held, gram = [], row["g"]
            held.append(row)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)
            out = []
    out += settled(held)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)


def window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A row per window of each context, with 128 bits of hash, for grams that too many contexts share."""
    import xxhash

    for batch in batches:
        for row in batch.to_pylist():
            view, n = memoryview(row["bytes"]), len(row["bytes"]) - length + 1
            hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[p : p + length]) for p in range(n)), dtype="<i8").reshape(n, 2)
            full = [np.full(n, row[c], dtype=np.int64) for c in ("t1", "t2")]
            columns = [*full, row["s"] + np.arange(n), hashes[:, 0].copy(), hashes[:, 1].copy(), np.full(n, row["known"])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["t1", "t2", "p", "w1", "w2", "known"])


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text: two hashes with different seeds."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def repeats(
    docs: DataFrame, text: str = "text", *, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, crowd: int = CROWD
) -> DataFrame:
    """(t1, t2, whole, spans): what is to go from each text that has a repeated string of ``length`` bytes.

    ``whole`` is true for a text that occurs more than once and has that length; spans is then null. Else
    spans are byte ranges, each covered by repeated strings; they can touch and overlap.

    1. Every window of a text belongs to an anchor, a gram of bytes chosen by content alone, so equal
       windows have equal anchors. A run of windows with one anchor is a context of some 560 bytes; one narrow row
       stands for it. 2. Grams that occur once are dropped. Contexts that occur twice or more
       are repeated throughout: aggregates settle the inside of copied passages, most of it by gram alone. 3. What is left are grams with different contexts,
       at the edges of copied passages. The bytes of each different context go to the gram's task once,
       which builds a suffix array over them. Grams shared by more than ``crowd`` contexts are not gathered;
       their windows are counted by hash instead, spread over all tasks.
    """
    longs = " long, ".join
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select(*text_key(F.col("text")), "text")
    anchors = texts.where(F.octet_length("text") >= length).mapInArrow(
        lambda it: anchor_rows(it, length, gram), longs(["t1", "t2", "s", "e", "a", "g", "h"]) + " long"
    )
    anchors = written(anchors, "anchors")
    # A written table on one side and a plain shuffle on the other: a join that splits a very common gram.
    grams = anchors.groupBy("g").agg(F.count("*").alias("n"), (F.min("h") == F.max("h")).alias("alike"))
    grams = written(grams.where("n > 1").select("g", "alike"), "grams")
    common = written(anchors.join(grams, "g"), "common")
    # Inside a copied passage a gram has one context only, and that settles it; the others are looked at one by one.
    mixed = common.where("NOT alike")
    first = F.min(F.struct("t1", "t2", "s", "e", "a")).alias("at")
    contexts = mixed.groupBy("g", "h").agg(F.count("*").alias("n"), first)
    contexts = written(contexts, "contexts")
    known = contexts.where("n > 1").select("g", "h")
    span = ("t1", "t2", "s", (F.col("e") + length).alias("e"))
    settled = common.where("alike").select(*span).unionByName(mixed.join(known, ["g", "h"]).select(*span))
    # Written, like all narrow sides below, so that the joins can split a gram or text that is very common.
    variety = written(contexts.groupBy("g").agg(F.count("*").alias("contexts")).where("contexts > 1"), "variety")
    edges = contexts.join(variety, "g").select(
        "at.*", "g", "h", (F.col("n") > 1).alias("known"), (F.col("contexts") > crowd).alias("hot")
    )
    wanted = edges.groupBy("t1", "t2").agg(F.collect_list(F.struct("s", "e", "a", "g", "h", "known", "hot")).alias("wanted"))
    held = texts.join(written(wanted, "wanted"), ["t1", "t2"]).select("t1", "t2", F.encode("text", "UTF-8").alias("data"), F.explode("wanted").alias("w"))
    cut = F.substring(F.col("data"), (F.col("w.s") + 1).cast("int"), (F.col("w.e") - F.col("w.s") + length).cast("int"))
    held = written(held.select("t1", "t2", "w.*", cut.alias("bytes")), "edges")
    quiet = held.where("NOT hot").drop("hot").repartition("g").sortWithinPartitions("g")
    resolved = quiet.mapInArrow(lambda it: settle_groups(it, length, block), longs(["t1", "t2", "s", "e"]) + " long")
    windows = held.where("hot").mapInArrow(
        lambda it: window_rows(it, length), "t1 long, t2 long, p long, w1 long, w2 long, known boolean"
    )
    # A context of several copies of a text comes once for each of them: equal places count once.
    windows = written(windows.distinct(), "windows")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.max("known").alias("known")).where("n > 1 OR known")
    counted = windows.where("NOT known").join(twice.select("w1", "w2"), ["w1", "w2"]).select("t1", "t2", F.col("p").alias("s"), (F.col("p") + length).alias("e"))
    copies = texts.where(F.octet_length("text") >= length).groupBy("t1", "t2").agg(F.count("*").alias("n")).where("n > 1")
    spans = settled.unionByName(resolved).unionByName(counted).distinct()
    spans = spans.join(copies.select("t1", "t2"), ["t1", "t2"], "left_anti")
    spans = spans.groupBy("t1", "t2").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    whole = copies.select("t1", "t2", F.lit(True).alias("whole"), F.lit(None).cast("array<struct<s:bigint,e:bigint>>").alias("spans"))
    return written(whole.unionByName(spans.select("t1", "t2", F.lit(False).alias("whole"), "spans")), "spans")


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the union of the spans, in order."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for s, e in spans:
        kept.append(data[at:s])
        at = e
    return b"".join([*kept, data[at:]])


CUT = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])


@F.pandas_udf(CUT)
def cut_report(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for text, some in zip(texts, spans):
        gone = merged(some)
        left = without(text.encode("utf-8"), gone)
        rows.append((sum(e - s for s, e in gone), len(gone), hashlib.sha256(left).hexdigest()))
    return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])


@F.pandas_udf(T.StringType())
def cut_text(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([without(t.encode("utf-8"), merged(s)).decode("utf-8", "ignore") for t, s in zip(texts, spans)], dtype=object)


def repeat_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    Texts without a removal, or with nothing left, are not shuffled: their digest is a built-in
    expression. Defined cases: a null text counts as empty; texts under ``length`` bytes lose nothing, nor can any match cross
    documents; repeated rows of that length lose everything; other columns are ignored; an empty table gives no rows.
    """
    gone = repeats(docs, text, **options)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.select("doc_id", *text_key(F.col("text")), "text")
    size = F.octet_length("text").cast("long").alias("n_bytes")
    heads = texts.select("doc_id", "t1", "t2", size, F.sha2("text", 256).alias("sha"))
    heads = heads.join(gone.select("t1", "t2", "whole"), ["t1", "t2"], "left").where("whole IS NULL OR whole")
    lost = F.col("whole").isNotNull()
    rest = heads.select(
        "doc_id",
        "n_bytes",
        F.when(lost, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(lost, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(lost, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    partly = texts.join(gone.where("NOT whole").select("t1", "t2", "spans"), ["t1", "t2"])
    partly = partly.select("doc_id", size, cut_report("text", "spans").alias("r")).select("doc_id", "n_bytes", "r.*")
    return rest.unionByName(partly)


def without_repeats(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents with every repeated string cut out, in the input's columns.

    A cut inside a character drops what is left of that character. n_chars, where the table has it, is that
    of the text that stays; a document that loses all of it stays with an empty text.
    """
    gone = repeats(docs, text, **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, *text_key(F.coalesce(F.col(text), F.lit(""))))
    left = keyed.join(gone, ["t1", "t2"], "left")
    old = F.col(f"row.`{text}`")
    new = F.when(F.col("whole"), F.lit("")).when(F.col("spans").isNotNull(), cut_text(F.coalesce(old, F.lit("")), F.coalesce("spans", F.array().cast("array<struct<s:bigint,e:bigint>>")))).otherwise(old)
    left = left.select("row", new.alias("new"), F.col("whole").isNotNull().alias("cut"))
    changed = {text: F.col("new")}
    if "n_chars" in docs.columns:
        length = F.when(F.col("cut"), F.char_length("new").cast("long")).otherwise(F.col("row.n_chars"))
        changed["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return left.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
