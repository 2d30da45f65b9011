"""Token counts of a word-level byte-pair vocabulary, by heap-and-linked-list merging."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the vocabulary's format: the pieces that a text is cut into before merging.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
CACHED = 400_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_merges(path: str) -> tuple[dict[tuple[str, str], int], str, list[str]]:
    """Rank of every mergeable pair, the word-end mark and the strings that are one token as they stand."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
    special = [t["content"] for t in spec["added_tokens"]]
    return {pair: rank for rank, pair in enumerate(pairs)}, spec["model"]["end_of_word_suffix"] or "", special


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols stay when the lowest-ranked adjacent pair is merged, leftmost first, until none is left.

    The symbols form a doubly linked list and the mergeable pairs a heap of (rank, position); a popped
    pair whose symbols have changed since is skipped. Every merge takes one symbol away, so the count is
    the initial number less the merges: n log n in the length of the piece, no identifier is made.
    """
    left, right = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    heap = [(ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if j < 0 or symbols[i] != a or symbols[j] != b:
            continue
        merges += 1
        symbols[i], symbols[j] = a + b, ""
        right[i] = k = right[j]
        if k >= 0:
            left[k] = i
            if (rank := ranks.get((a + b, symbols[k]))) is not None:
                heapq.heappush(heap, (rank, i, a + b, symbols[k]))
        if (h := left[i]) >= 0 and (rank := ranks.get((symbols[h], a + b))) is not None:
            heapq.heappush(heap, (rank, h, symbols[h], a + b))
    return len(symbols) - merges


class PieceCounts(dict):
    """Tokens of each piece seen lately; it starts anew when full, so memory is bounded."""

    def __init__(self, ranks: dict[tuple[str, str], int], end: str):
        self.ranks, self.end, self.letters = ranks, end, byte_letters()

    def __missing__(self, piece: str) -> int:
        symbols = [self.letters[b] for b in piece.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        count = merged_length(symbols, self.ranks)
        if len(self) >= CACHED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = count
        return count


def token_counter(spark: SparkSession, vocabulary: str):
    """A column function: text to its number of tokens, with no begin, end or truncation.

    The vocabulary is read on the driver from the given path and sent out once: its size is that of
    the file, whatever the input. Strings that the file lists as added tokens count as one token.
    """
    shipped = spark.sparkContext.broadcast(read_merges(vocabulary))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import regex

        ranks, end, special = shipped.value
        cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        pieces, known = regex.compile(PIECE), PieceCounts(ranks, end)

        def plain(text: str) -> int:
            # Sigma has a lower-case form of its own at a word's end; letters are lowered one by one here.
            lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            return sum(map(known.__getitem__, pieces.findall(lowered)))

        def whole(text: str | None) -> int:
            if not text:
                return 0
            if cut is None or "<" not in text:
                return plain(text)
            return sum(map(plain, cut.split(text))) + len(cut.findall(text))

        for texts in batches:
            yield pd.Series([whole(t) for t in texts], dtype="int64")

    return count


def count_tokens(
    docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text; row-local, no shuffle.

    Defined cases: a null text counts as empty; empty texts and texts of white space have no tokens;
    pieces of any length are merged whole; repeated rows are counted each; other columns are ignored.
    """
    count = token_counter(docs.sparkSession, vocabulary)
    whole: Column = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        count(whole).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
