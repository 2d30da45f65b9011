"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into column expressions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import GAP, fold, written

# The characters counted as marks of each kind.
SYMBOLS = "#*$%&|<>"
STOPS = ".,;:!?"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
STATISTICS = (
    "log_words", "word_length", "symbols", "stops", "exclaims", "capitals", "digits", "distinct_words", "distinct_lines",
)


def statistics(text: Column) -> Column:
    """A struct of the statistics of a whole text, all built-in expressions; a null text counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, GAP), lambda w: w != "")
    lines = F.split(whole, "\n")
    return F.struct(
        F.char_length(whole).alias("chars"),
        words.alias("words"),
        lines.alias("lines"),
        *[
            (F.char_length(whole) - F.char_length(F.translate(whole, marks, ""))).alias(name)
            for name, marks in (
                ("symbols", SYMBOLS), ("stops", STOPS), ("exclaims", "!"), ("capitals", CAPITALS),
                ("digits", DIGITS), ("blanks", " \t\n\x0b\x0c\r"),
            )
        ],
    )


def with_statistics(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """The kept columns with one double per statistic; counts are taken relative to words, characters or lines."""

    def share(part: Column, whole: Column) -> Column:
        return part.cast("double") / F.greatest(whole, F.lit(1))

    raw = docs.select(*keep, statistics(text).alias("s"))
    sized = raw.select(
        "*", F.size("s.words").alias("n_words"), F.size(F.array_distinct("s.words")).alias("n_distinct"),
        F.size("s.lines").alias("n_lines"), F.size(F.array_distinct("s.lines")).alias("n_distinct_lines"),
    )
    n, chars = F.col("n_words"), F.col("s.chars")
    values = {
        "log_words": F.log1p(n),
        "word_length": share(chars - F.col("s.blanks"), n),
        "symbols": share(F.col("s.symbols"), n),
        "stops": share(F.col("s.stops"), n),
        "exclaims": share(F.col("s.exclaims"), n),
        "capitals": share(F.col("s.capitals"), chars),
        "digits": share(F.col("s.digits"), chars),
        "distinct_words": F.when(n > 0, share(F.col("n_distinct"), n)).otherwise(F.lit(1.0)),
        "distinct_lines": share(F.col("n_distinct_lines"), F.col("n_lines")),
    }
    kept = [c for c in raw.columns if c != "s"]
    return sized.select(*kept, *[values[s].alias(s) for s in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, threshold) tests and its weight in the log odds."""

    tests: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def holds(self) -> Column:
        return reduce(and_, [F.col(s) > t if above else F.col(s) <= t for s, above, t in self.tests])

    def __str__(self) -> str:
        tests = " and ".join(f"{s} {'>' if above else '<='} {t:.6g}" for s, above, t in self.tests)
        return f"{self.weight:+.4f} if {tests}"


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """The probability of label 1 as one expression over the statistics."""
        odds = sum((F.when(r.holds(), r.weight).otherwise(0.0) for r in self.rules), F.lit(self.intercept))
        return 1 / (1 + F.exp(-odds))


def tree_rules(node, path: tuple = ()) -> Iterator[Rule]:
    """A rule for every path from the root of a fitted tree to an inner node or a leaf; repeated tests are merged."""
    if path:
        tightest: dict[tuple[str, bool], float] = {}
        for name, above, t in path:
            other = tightest.get((name, above), t)
            tightest[name, above] = max(other, t) if above else min(other, t)
        yield Rule(tuple(sorted((n, a, t) for (n, a), t in tightest.items())))
    if node.subtreeDepth() > 0:
        name, t = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        yield from tree_rules(node.leftChild(), (*path, (name, False, t)))
        yield from tree_rules(node.rightChild(), (*path, (name, True, t)))


def fit_rules(
    labelled: DataFrame, *, trees: int = 8, depth: int = 3, penalty: float = 0.001, rounds: int = 40, seed: int = 11
) -> RuleEnsemble:
    """Rules from a forest of shallow trees, weighed by a lasso logistic regression; rules of weight 0 go.

    labelled: the statistics and a double ``label`` of both classes. Both fits are MLlib jobs over the table.
    """
    labelled = written(VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(labelled), "labelled")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, subsamplingRate=0.7, seed=seed).fit(labelled)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in tree_rules(tree._call_java("rootNode"))))
    if not rules:
        share = labelled.agg(F.avg("label")).first()[0]
        from math import log

        return RuleEnsemble(log(max(share, 1e-6) / max(1 - share, 1e-6)), ())
    held = [F.when(r.holds(), 1.0).otherwise(0.0).alias(f"rule{i}") for i, r in enumerate(rules)]
    matrix = VectorAssembler(inputCols=[f"rule{i}" for i in range(len(rules))], outputCol="rules")
    matrix = written(matrix.transform(labelled.select("label", *held)).select("label", "rules"), "rules")
    fitted = LogisticRegression(
        featuresCol="rules", elasticNetParam=1.0, regParam=penalty, maxIter=rounds, standardization=False
    ).fit(matrix)
    weights = fitted.coefficients.toArray()
    return RuleEnsemble(
        float(fitted.intercept), tuple(Rule(r.tests, float(w)) for r, w in zip(rules, weights) if w != 0)
    )


def learn(
    docs: DataFrame, labels: DataFrame, *, label: str, text: str, most: int, folds: int
) -> RuleEnsemble | None:
    """The ensemble fitted on labelled documents outside fold 0; None if they are not of both classes.

    About ``most`` labelled rows are used, taken by a hash of the id: a documented bound, so their narrow
    table may be broadcast to the documents.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    usable = usable.select("doc_id", F.col(label).cast("double").alias("label")).distinct()
    count, low, high = usable.agg(F.count("*"), F.min("label"), F.max("label")).first()
    if not count or low == high:
        return None
    share = min(1.0, most / count)
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    joined = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = written(with_statistics(joined, F.col("text"), F.col("label")), "sample")
    if sample.select("label").distinct().count() < 2:
        return None
    return fit_rules(sample)


def quality(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", text: str = "text", most: int = 20_000,
    folds: int = 5, cut: float = 0.3, keep: list[str] | None = None,
) -> DataFrame:
    """row (a struct of the ``keep`` columns, all by default), held_out, score and predicted of every whole text.

    The score is one compiled expression over built-in statistics of the text alone: no Python, no
    shuffle. Defined cases: a null or empty text has zero counts and is scored by the rules they meet; without
    labels of both classes every score is 1, so nothing is rejected; null ids are in the fold of the empty text;
    repeated rows are scored each; an empty table gives no rows; input columns stay inside ``row``.
    """
    model = learn(docs, labels, label=label, text=text, most=most, folds=folds)
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    held = (fold(F.col("doc_id"), folds) == 0).alias("held_out")
    scored = with_statistics(docs, F.col(text), row, held).withColumn("score", model.score() if model else F.lit(1.0))
    return scored.select("row", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
