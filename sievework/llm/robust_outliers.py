"""Quality rules: base statistics, and robust multivariate outliers per language and source."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.common import GAP, written

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
WINDOW = 3

# The transformed statistics of a text, and below which spread of each no difference counts.
VECTOR = ("word_length", "symbols", "dup_lines", "repeats")
FLOORS = (0.25, 0.05, 0.08, 0.08)
UNIT = 10_000
D = len(VECTOR)
# Rows from which a group has an estimate, five for each dimension and some; rows that the estimate above counts as in it.
LEAST, PRIOR = 25, 50


def base_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """row (a struct of the ``keep`` columns) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    All of it stays in the row: a text's windows are hashed to 64 bits over the three words one after the
    other; where some hash repeats, (hash, position) pairs are sorted and equal neighbours give the positions covered.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, GAP), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    cut = docs.select(
        row,
        words.alias("words"),
        (F.char_length(whole) - F.char_length(F.translate(whole, " \t\n\x0b\x0c\r", ""))).alias("blanks"),
        F.char_length(whole).alias("chars"),
        (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).alias("n_symbols"),
        lines.alias("lines"),
    )
    n = F.size("words")
    hashes = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    hashed = cut.select(
        "row", n.alias("n_words"), "blanks", "chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), hashes.alias("h"),
    )
    paired = hashed.withColumn(
        "h",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<x:bigint,i:int>>")),
    )

    def alike(i: Column, j: Column) -> Column:
        return F.coalesce(F.get(F.col("h"), i)["x"] == F.get(F.col("h"), j)["x"], F.lit(False))

    hits = F.filter(
        F.transform("h", lambda p, i: F.when(alike(i, i - 1) | alike(i, i + 1), p["i"])), lambda p: p.isNotNull()
    )
    marked = paired.withColumn("h", hits)
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("h", lambda p: F.array(*[p + k for k in range(WINDOW)]))))
    )
    return marked.select(
        "row",
        F.col("n_words").cast("long").alias("n_words"),
        (F.col("chars") - F.col("blanks")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def vector() -> list[Column]:
    """The transformed statistics in whole units of 1 / UNIT, so that all sums over rows are exact and order-free."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    values = (
        F.col("word_chars") / n,
        F.log1p(F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
    )
    return [F.round(v * UNIT).cast("long").alias(name) for v, name in zip(values, VECTOR)]


def chi2_even(x: float, d: int) -> float:
    """Distribution function of chi-squared with an even number of degrees of freedom."""
    term = total = 1.0
    for k in range(1, d // 2):
        term *= x / 2 / k
        total += term
    return 1 - exp(-x / 2) * total


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_even(middle, d) < p else (low, middle)
    return low


def factored(out: DataFrame) -> DataFrame:
    """Adds the lower Cholesky factor l00.. of the matrix c00.. as columns."""
    for j in range(D):
        inner = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - inner, F.lit((FLOORS[j] * UNIT) ** 2 / 4))))
        for i in range(j + 1, D):
            dot = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - dot) / F.col(f"l{j}{j}"))
    return out


def shrunk(found: DataFrame, prior: int) -> DataFrame:
    """The estimates with the covariance of each group drawn towards that of the level above, as if it brought ``prior`` rows.

    A group of m rows keeps m / (m + prior) of its own covariance, so nothing switches at a number of rows. Centres
    stay: they need few rows, and a small source may have its own. Languages draw on all, sources on their language.
    """
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    cov = [sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j + 1)), F.lit(0.0)) for i, j in pairs]
    found = found.select("level", "lang", "source", "m", *[f"mu{i}" for i in range(D)], F.array(*cov).alias("own"))
    weight = F.col("m") / (F.col("m") + prior)

    def drawn(own: Column, above: Column) -> Column:
        one = [(F.get(own, F.lit(n)), F.get(above, F.lit(n))) for n in range(len(pairs))]
        return F.array(*[x * weight + F.coalesce(y, x) * (1 - weight) for x, y in one])

    over = found.where("level = 2")
    langs = found.where("level = 1").withColumn("above", over.select("own").scalar())
    langs = langs.withColumn("own", drawn(F.col("own"), F.col("above"))).drop("above")
    above = langs.select("lang", F.col("own").alias("above"))
    sources = found.where("level = 0").join(above, "lang", "left").withColumn("own", drawn(F.col("own"), F.col("above")))
    out = over.unionByName(langs).unionByName(sources.drop("above"))
    out = factored(out.select("*", *[F.get("own", F.lit(n)).alias(f"c{i}{j}") for n, (i, j) in enumerate(pairs)]))
    return out.select("level", "lang", "source", "m", *[f"mu{i}" for i in range(D)], *[f"l{i}{j}" for i, j in pairs])


def moments(rows: DataFrame, keys: Sequence[str], scale: float) -> DataFrame:
    """Per key: count m, means mu0.., and the lower Cholesky factor l00.. of the covariance times ``scale`` plus the floors.

    A statistic with no spread in the group keeps its floor, so the factor always exists. ``det`` is the
    logarithm of the determinant.
    """
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    wide = "decimal(38,0)"
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("m"),
        *[F.sum(F.col(v).cast(wide)).alias(f"s{i}") for i, v in enumerate(VECTOR)],
        *[F.sum(F.col(VECTOR[i]).cast("decimal(19,0)") * F.col(VECTOR[j]).cast("decimal(19,0)")).alias(f"p{i}{j}") for i, j in pairs],
    )
    mean = [F.col(f"s{i}").cast("double") / F.col("m") for i in range(D)]
    out = sums.select(
        *keys, "m", *[mean[i].alias(f"mu{i}") for i in range(D)],
        *[
            ((F.col(f"p{i}{j}").cast("double") / F.col("m") - mean[i] * mean[j]) * scale
             + (F.lit((FLOORS[i] * UNIT) ** 2) if i == j else F.lit(0.0))).alias(f"c{i}{j}")
            for i, j in pairs
        ],
    )
    out = factored(out)
    det = sum((F.log(f"l{i}{i}") * 2 for i in range(D)), F.lit(0.0))
    return out.withColumn("det", det).select(
        *keys, "m", "det", *[f"mu{i}" for i in range(D)], *[f"l{i}{j}" for i, j in pairs]
    )


def distance(rows: DataFrame, name: str) -> DataFrame:
    """Adds the squared Mahalanobis distance from the group's centre, by forward substitution."""
    for i in range(D):
        known = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"z{i}", (F.col(VECTOR[i]) - F.col(f"mu{i}") - known) / F.col(f"l{i}{i}"))
    return rows.withColumn(name, sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0)))


def nearest_share(rows: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """The rows of each key up to the distance that holds ``share`` of them, to a sixty-fourth of an octave.

    Distances are counted in logarithmic cells, a few hundred per key, so no key's rows meet in one task.
    """
    cell = F.floor(F.log2(F.col("d2") + 1e-6) * 64).cast("int")
    rows = rows.withColumn("cell", cell)
    counts = rows.groupBy(*keys, "cell").agg(F.count("*").alias("n"))
    group = Window.partitionBy(*keys)
    counts = counts.withColumn("until", F.sum("n").over(group.orderBy("cell"))).withColumn("all", F.sum("n").over(group))
    edge = counts.where(F.col("until") >= F.ceil(F.col("all") * share)).groupBy(*keys).agg(F.min("cell").alias("edge"))
    # One narrow row per key, written so that its size is known where the join is planned.
    return rows.join(written(edge, "edges"), list(keys)).where("cell <= edge")


def determinants(
    rows: DataFrame, *, share: float = 0.75, steps: int = 3, least: int = LEAST, trim: float = 0.99, prior: int = PRIOR
) -> DataFrame:
    """Minimum-covariance-determinant estimates: one row per level, language and source.

    ``rows`` have lang, source and the vector, as stored. Two starts are made per group: all its rows, and its
    rows whose vector is near the coordinate-wise medians. Each goes through ``steps`` concentration steps (keep the
    share of rows nearest to the present estimate, estimate anew), and the start whose determinant ends
    smaller is taken. A last step re-estimates from the rows within the ``trim`` quantile. Groups are
    languages with sources, languages, and all documents, each from the ``least`` rows on that a covariance needs; the
    covariance of a small group is drawn towards that of the group above by its number of rows (``shrunk``).
    """
    keys = ["level", "lang", "source"]
    nothing = F.lit(None).cast("string")
    levels = F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang"), nothing.alias("source")),
        F.struct(F.lit(2).alias("level"), nothing.alias("lang"), nothing.alias("source")),
    )
    keyed = rows.select(*VECTOR, F.explode(levels).alias("g")).select(
        *VECTOR, "g.level", F.coalesce("g.lang", F.lit("\0")).alias("lang"), F.coalesce("g.source", F.lit("\0")).alias("source")
    )
    sized = keyed.groupBy(*keys).agg(F.count("*").alias("rows"))
    sized = written(sized.where(f"rows >= {least} OR level = 2"), "groups")
    keyed = keyed.join(sized, keys).drop("rows")
    # The median of a coordinate is a count over its cells: at most a few hundred per group.
    cells = keyed.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(v) / 100).alias("cell")) for i, v in enumerate(VECTOR)])).alias("c"))
    counts = cells.select(*keys, "c.i", "c.cell").groupBy(*keys, "i", "cell").agg(F.count("*").alias("n"))
    group = Window.partitionBy(*keys, "i")
    counts = counts.withColumn("until", F.sum("n").over(group.orderBy("cell"))).withColumn("all", F.sum("n").over(group))
    middle = counts.where(F.col("until") * 2 >= F.col("all")).groupBy(*keys, "i").agg((F.min("cell") * 100 + 50).alias("median"))
    medians = middle.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("median"))).cast("double").alias(f"mu{i}") for i in range(D)])
    zero = [F.lit(FLOORS[i] * UNIT if i == j else 0.0).alias(f"l{i}{j}") for i in range(D) for j in range(i + 1)]
    from_median = medians.select(*keys, *[f"mu{i}" for i in range(D)], *zero).withColumn("start", F.lit(1))
    from_all = moments(keyed, keys, 1.0).drop("m", "det").withColumn("start", F.lit(0))
    state = written(from_all.unionByName(from_median), "start")
    h = chi2_quantile(share, D)
    consistent = share / chi2_even(h, D + 2)
    for step in range(steps):
        near = nearest_share(distance(keyed.join(state, keys), "d2"), [*keys, "start"], share)
        state = written(moments(near, [*keys, "start"], consistent), f"step{step}")
        if step < steps - 1:
            state = state.drop("m", "det")
    best = Window.partitionBy(*keys).orderBy("det", "start")
    raw = state.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place", "start", "det")
    raw = written(shrunk(written(raw, "own"), prior), "raw").drop("m")
    inside = distance(keyed.join(raw, keys), "d2").where(F.col("d2") <= chi2_quantile(trim, D))
    final = written(moments(inside, keys, 1.0).where(f"level = 2 OR m >= {least // 2}"), "final")
    return written(shrunk(final, prior), "estimates")


def judged(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
    keep: Sequence[str] | None = None, tail: float = 1e-9, least: int = LEAST, share: float = 0.75,
) -> DataFrame:
    """row, the base statistics, base_failed, distance (squared, robust) and kept for every document.

    A document that passes the base rules is kept if its distance from the centre of its language and
    source is within the chi-squared quantile that leaves ``tail``. Estimates are made from documents
    that pass the base rules; a group of under ``least`` of them is judged by its language's, or by all documents'.

    Built-in expressions only. Defined cases: a null or empty text has no words and fails the base rules; null
    languages and sources are groups like others; repeated rows are judged each; groups without spread use the
    documented floors; an empty table, or one without passing documents, gives rows but no verdict of the
    method, so they fall by the base rules alone.
    """
    inner = docs.withColumns({})
    names = list(keep or docs.columns)
    stats = base_statistics(
        inner.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("kept_row"), F.col(text).alias("text"),
                     F.coalesce(F.col(lang).cast("string"), F.lit("\1")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("\1")).alias("source")),
        "text", ["kept_row", "lang", "source"],
    )
    stats = stats.select(F.col("row.kept_row").alias("row"), "row.lang", "row.source", "n_words", "word_chars", "n_symbols",
                         "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"))
    stats = written(stats.select("*", *vector()), "statistics")
    found = determinants(stats.where("NOT base_failed"), least=least, share=share)
    factors = [c for c in found.columns if c[0] in "ml" and c[1:2].isdigit() or c[:2] == "mu"]
    levels = [
        found.where(f"level = {n}").select(*by, F.struct(*factors).alias(f"g{n}"))
        for n, by in enumerate((["lang", "source"], ["lang"], []))
    ]
    judged = (
        stats.join(levels[0], ["lang", "source"], "left")
        .join(levels[1], ["lang"], "left")
        .withColumn("g", F.coalesce("g0", "g1", levels[2].select("g2").scalar()))
    )
    judged = distance(judged.select(*stats.columns, "g.*"), "distance")
    fine = ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= chi2_quantile(1 - tail, D)))
    return judged.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        fine.alias("kept"),
    )
