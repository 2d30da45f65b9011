"""Token counts against the library whose vocabulary it is."""

import random

from sievework.llm import token_counts
from tokenizers import Tokenizer

NAME = "word_bpe_49k.json"
TEXTS = [
    "", " \n\t ", "Hello, world!! I'm here; we'll don't can't they've", "ΑΣ ΣΑΣ Σ", "İstanbul ǅ ﬁne", "éà é", "日本語テキスト 中文",
    "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> c<|endoftext|><|endoftext|>", "x" * 5000, "ab" * 3000 + " " + "1234567890", "🙂🙃 ½ ² ٣",
    "\x1c\x1d a b c​d\u0085e", "it's IT'S 's's", "#*$%&|<> <| |>", "naïve coöperation", "\x00 null \x7f",
]


def test_matches_the_library(spark, small_docs, docs_of, tokenizer_path):
    random.seed(2)
    alphabet = "abcdeéèßöñ'.,!|<>#1 \n"
    texts = TEXTS + ["".join(random.choice(alphabet) for _ in range(random.randint(1, 200))) for _ in range(300)]
    docs = docs_of(*enumerate(texts)).unionByName(small_docs.withColumn("doc_id", small_docs.doc_id + 10_000))
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = Tokenizer.from_file(tokenizer_path(NAME))
    expected = dict(zip(given, (len(e.ids) for e in library.encode_batch(list(given.values()), add_special_tokens=False))))
    for r in token_counts.count_tokens(docs, tokenizer_path(NAME)).collect():
        assert r["n_tokens"] == expected[r["doc_id"]], given[r["doc_id"]][:80]
        assert r["n_bytes"] == len(given[r["doc_id"]].encode())
        assert r["over_limit"] == (r["n_tokens"] > 2048)


def test_edge_cases(docs_of, with_clashes, tokenizer_path):
    docs = with_clashes(docs_of((1, None), (2, "same"), (2, "same"), (None, "word")))
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, tokenizer_path(NAME)).collect()), key=repr)
    assert found == [(1, 0, 0), (2, 4, 1), (2, 4, 1), (None, 4, 1)]
    assert token_counts.count_tokens(docs.where("false"), tokenizer_path(NAME)).count() == 0


def test_merges_lowest_rank_first():
    ranks = {("b", "c"): 0, ("a", "b"): 1, ("a", "bc"): 2, ("abc", "abc"): 3}
    assert token_counts.merged_length(list("abcabc"), ranks) == 1
    assert token_counts.merged_length(list("ab"), ranks) == 1
    assert token_counts.merged_length(list("aaa"), {("a", "a"): 0}) == 2
    assert token_counts.merged_length(["x"], ranks) == 1
