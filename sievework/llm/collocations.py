"""Collocations: stored occurrence relations, extended by a merge join on adjacent places and a semi join on frequent groups."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.common import removed, written

LEAST = 100
LONGEST = 5
TOP = 2_000
COUNTED = 200_000  # distinct words that a task holds before it hands on their counts
AT_ONCE = 1 << 18  # occurrences that a task looks at at once; a longer document is looked at whole
PAIRED = 1 << 20  # adjacent pairs that a task counts at once
SHIPPED_WORDS = 1 << 19  # frequent words that are sent to the tasks; more are joined
SHIPPED_GROUPS = 1 << 20  # frequent groups that are sent to the tasks; more are joined
# The separators of pieces other than the full stop.
ENDS = b",;:!?\x0a\x0b\x0c\x0d"
STOP = b"."
TO_STOP = bytes.maketrans(ENDS, STOP * len(ENDS))
RELATION = "doc_no long, at array<int>, g array<long>"


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, and a full stop, which no word holds, at every end of a piece."""
    return text.lower().translate(TO_STOP).replace(STOP, b" . ").split() if text else []


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of (doc_no, lang, text), words handed on whenever too many are held."""
    held: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            words.pop(STOP, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())],
                names=["lang", "word", "n"],
            )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(1).to_pylist(), batch.column(2)):
            held.setdefault(lang, Counter()).update(tokens(text.as_py()))
            if sum(map(len, held.values())) > COUNTED:
                yield from out()
    yield from out()


class Known(dict):
    """Numbers of words; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def relation_batch(doc_no: pa.Array, at: list[np.ndarray], g: list[np.ndarray]) -> pa.RecordBatch:
    ends = pa.array(np.r_[0, np.cumsum([len(x) for x in at])].astype(np.int32))
    flat = [np.concatenate(x) if x else np.zeros(0) for x in (at, g)]
    lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(t))) for x, t in zip(flat, (np.int32, np.int64))]
    return pa.RecordBatch.from_arrays([doc_no, *lists], names=["doc_no", "at", "g"])


def word_places(batches: Iterator[pa.RecordBatch], known: dict[str, Known]) -> Iterator[pa.RecordBatch]:
    """The occurrences of known words, a row per document: places in ascending order, and the word at each."""
    none = Known()
    for batch in batches:
        for some in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            at, g = [], []
            for lang, text in zip(some.column(1).to_pylist(), some.column(2)):
                words = tokens(text.as_py())
                codes = np.fromiter(map(known.get(lang, none).__getitem__, words), dtype=np.int64, count=len(words))
                at.append(np.flatnonzero(codes >= 0))
                g.append(codes[at[-1]])
            yield relation_batch(some.column(0), at, g)


def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_no, at, lang, word) of every word."""
    for batch in batches:
        for doc_no, lang, text in zip(*[c.to_pylist() for c in batch.columns]):
            words = tokens(text)
            at = [i for i, w in enumerate(words) if w != STOP]
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_no] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array([lang] * len(at), pa.string()), pa.array([words[i] for i in at], pa.binary())],
                names=["doc_no", "at", "lang", "word"],
            )


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a relation in runs of about AT_ONCE occurrences."""
    for batch in batches:
        ends = batch.column(1).offsets.to_numpy()[1:].astype(np.int64)
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else batch.column(1).offsets[0].as_py()
            to = max(at + 1, int(np.searchsorted(ends, before + AT_ONCE, side="right")))
            yield batch.slice(at, to - at)
            at = to


def merge_joined(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(row, place, group, next group) of the merge join of a relation with itself on document and adjacent place.

    The relation is sorted by document and place, so an occurrence meets the one that follows it, if that is at the next place.
    Ends of pieces take a place that no occurrence has.
    """
    at, g = batch.column(1), batch.column(2)
    offsets = at.offsets.to_numpy()
    lo, hi = int(offsets[0]), int(offsets[-1])
    places, groups = at.values.to_numpy()[lo:hi], g.values.to_numpy()[int(g.offsets[0].as_py()) :][: hi - lo]
    row = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(offsets))
    meets = np.flatnonzero((places[1:] == places[:-1] + 1) & (row[1:] == row[:-1]))
    return row[meets], places[meets], groups[meets], groups[meets + 1]


def paired(first: np.ndarray, last: np.ndarray, groups: int) -> np.ndarray:
    """One sortable value per pair of group numbers below ``groups``."""
    if groups * groups < 2**63:
        return first * np.int64(groups) + last
    return np.rec.fromarrays([first, last], names="first,last")


def counted_pairs(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """(first, last, n) of adjacent groups."""
    held: list[np.ndarray] = []
    size = 0

    def out() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        if found.dtype.names:
            first, last = found["first"], found["last"]
        else:
            first, last = np.divmod(found, np.int64(groups))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (first, last, n.astype(np.int64))], names=["first", "last", "n"])

    for batch in slices(batches):
        _, _, first, last = merge_joined(batch)
        held.append(paired(first, last, groups))
        size += len(first)
        if size > PAIRED:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def extended_places(batches: Iterator[pa.RecordBatch], keys: np.ndarray, numbers: np.ndarray, groups: int) -> Iterator[pa.RecordBatch]:
    """The occurrences of longer groups: those pairs of adjacent ones that are among the sorted ``keys``."""
    for batch in slices(batches):
        row, at, first, last = merge_joined(batch)
        if len(keys):
            pair = paired(first, last, groups)
            spot = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            stays = np.flatnonzero(keys[spot] == pair)
            row, at, g = row[stays], at[stays], numbers[spot[stays]]
        else:
            row, at, g = row[:0], at[:0], first[:0]
        cuts = np.searchsorted(row, np.arange(1, batch.num_rows))
        made = relation_batch(batch.column(0), np.split(at, cuts), np.split(g, cuts))
        yield made.filter(pa.array(np.bincount(row, minlength=batch.num_rows) > 0))


def numbered(groups: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The groups with numbers ``id`` from 0 on without gaps, stored, and how many there are.

    Each task numbers its rows; the offsets of the tasks come from their counts, one small row per task.
    """
    raw = written(groups.withColumn("mark", F.monotonically_increasing_id()), f"{name}_marked")
    sizes = {r["task"]: r["n"] for r in raw.groupBy(F.shiftright("mark", 33).cast("int").alias("task")).agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for task in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(task, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts or [0]]), F.shiftright("mark", 33).cast("int") + 1)
    return written(raw.select((start + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))).alias("id"), *groups.columns), name), before


def gathered(rows: DataFrame) -> DataFrame:
    """(doc_no, at, g) rows to the sorted relation, a row per document."""
    whole = rows.groupBy("doc_no").agg(F.sort_array(F.collect_list(F.struct("at", "g"))).alias("all"))
    return whole.select("doc_no", F.col("all.at").alias("at"), F.col("all.g").alias("g"))


def first_relation(texts: DataFrame, words: DataFrame, count: int, shipped: int) -> DataFrame:
    """R1: the places of the frequent words, which are sent to the tasks while they are few, and joined otherwise."""
    if count > shipped:
        rows = texts.mapInArrow(word_rows, "doc_no long, at int, lang string, word binary")
        return gathered(rows.join(words, ["lang", "word"]).select("doc_no", "at", F.col("id").alias("g")))
    known: dict[str, Known] = {}
    table = words.select("lang", "word", "id").toArrow()
    for lang, word, number in zip(*[c.to_pylist() for c in table.columns]):
        known.setdefault(lang, Known())[word] = number
    sent = texts.sparkSession.sparkContext.broadcast(known)  # at most ``shipped`` words
    return texts.mapInArrow(lambda it: word_places(it, sent.value), RELATION)


def next_relation(relation: DataFrame, groups: int, frequent: DataFrame, count: int, shipped: int) -> DataFrame:
    """R(k + 1) from R(k): adjacent places whose pair of groups is frequent. The semi join ships the frequent ones while they are few."""
    if count > shipped:
        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                row, at, first, last = merge_joined(batch)
                columns = [batch.column(0).take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array(first), pa.array(last)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_no", "at", "first", "last"])

        rows = relation.mapInArrow(pairs, "doc_no long, at int, first long, last long")
        return gathered(rows.join(frequent, ["first", "last"]).select("doc_no", "at", F.col("id").alias("g")))
    table = frequent.select("first", "last", "id").toArrow()
    first, last, numbers = (c.combine_chunks().to_numpy() for c in table.columns)
    keys = paired(first, last, groups)
    order = np.argsort(keys)
    sent = relation.sparkSession.sparkContext.broadcast((keys[order], numbers[order]))  # at most ``shipped`` groups
    return relation.mapInArrow(lambda it: extended_places(it, *sent.value, groups), RELATION)


def frequent_phrases(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
    shipped_words: int = SHIPPED_WORDS, shipped_groups: int = SHIPPED_GROUPS,
) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) with all word occurrences, and for each length from 1 on the table (id, lang, words, f, first, last).

    A phrase is frequent with ``least`` occurrences inside pieces of its language. ``first`` and ``last`` are the numbers of the phrases that
    it begins and ends with, one word shorter.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("doc_no"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    counts = texts.mapInArrow(counted_words, "lang string, word binary, n long")
    counts = written(counts.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = written(counts.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words, count = numbered(counts.where(F.col("f") >= least), "frequent1")
    found = [words.select(
        "id", "lang", F.array(F.decode("word", "UTF-8")).alias("words"), "f",
        F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"),
    )]
    relation = written(first_relation(texts, words, count, shipped_words), "r1")
    for k in range(2, longest + 1):
        pairs = relation.mapInArrow(lambda it, m=max(count, 1): counted_pairs(it, m), "first long, last long, n long")
        pairs = pairs.groupBy("first", "last").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        frequent, more = numbered(pairs, f"frequent{k}")
        shorter = found[-1]
        phrases = frequent.join(shorter.select(F.col("id").alias("first"), "lang", F.col("words").alias("begin")), "first")
        phrases = phrases.join(shorter.select(F.col("id").alias("last"), F.element_at("words", -1).alias("end")), "last")
        found.append(written(phrases.select("id", "lang", F.concat("begin", F.array("end")).alias("words"), "f", "first", "last"), f"phrases{k}"))
        if k < longest:
            longer = written(next_relation(relation, max(count, 1), frequent, more, shipped_groups), f"r{k}")
            removed(relation)
            relation, count = longer, more
    removed(relation)
    return totals, found


def phrase_of(words: Column) -> Column:
    return F.array_join(words, " ")


def scored_phrases(totals: DataFrame, found: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one makes needless.

    A longer phrase with as many occurrences has one more word or holds one that has: only phrases one word longer are looked at.
    Products are decimals of 38 digits; the score is a whole quotient.
    """
    sizes = found[0].select("lang", phrase_of(F.col("words")).alias("part"), "f")
    for level in found[1:-1]:
        sizes = sizes.unionByName(level.select("lang", phrase_of(F.col("words")).alias("part"), "f"))
    sizes = written(sizes, "sizes")
    stay = []
    for level, longer in zip(found[1:], [*found[2:], None]):
        if longer is not None:
            inside = longer.select(F.explode(F.array("first", "last")).alias("id"), F.col("f").alias("most"))
            inside = inside.groupBy("id").agg(F.max("most").alias("most"))
            level = level.join(inside, "id", "left").where("most IS NULL OR most < f").drop("most")
        stay.append(level.select("lang", "words", F.col("f").alias("a")))
    candidates = stay[0]
    for level in stay[1:]:
        candidates = candidates.unionByName(level)
    words = F.col("words")
    cuts = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: F.struct(
        k.alias("cut"), phrase_of(F.slice(words, F.lit(1), k)).alias("left"), phrase_of(F.slice(words, k + 1, F.size(words) - k)).alias("right")
    ))
    each = candidates.select("lang", phrase_of(words).alias("phrase"), "a", F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    each = each.join(sizes.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    each = each.join(sizes.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    each = each.join(totals, "lang")
    wide = "decimal(19,0)"
    each = each.withColumn("score", F.expr(
        f"(CAST(a AS {wide}) * CAST(n AS {wide}) * 1000) DIV (CAST(l AS {wide}) * CAST(r AS {wide}))"
    ))
    lowest = each.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
    return lowest.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")


def collocations(docs: DataFrame, *, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the best phrases of two to five words of each language.

    By set-oriented mining: R1 holds the places of all frequent words, sorted by document and place, and is stored. R(k) is merge-joined with itself on
    document and adjacent place; the pairs are counted in the tasks and by an aggregate; the frequent ones, by a semi join, leave R(k + 1).
    A document is a row of a relation, so a merge join never leaves its task.

    Defined cases: a null text is empty, a null language is ``und``; repeated rows count each; words are compared byte for byte
    after A-Z is lower-cased; without frequent phrases, and for an empty table, there are no rows; other columns are ignored.
    """
    scored = scored_phrases(*frequent_phrases(docs, **options))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
