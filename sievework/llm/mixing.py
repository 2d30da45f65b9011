"""Mixing sources to target weights: hash-random order, distributed prefix sums, a cut per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.common import WORD, word_count, written

WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """Target of every source from (absent, source, source_size), one row per source.

    Sources in code point order, the null source last, take the weights in turn and share
    ``share`` times all sizes. No target exceeds ``cap`` times its source; what is above is shared
    again by weight. Ordered by the level at which a source is full, the full ones come first, so
    the common level of the others follows from two running sums instead of repeated sharing.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy("absent", "source")
    by_level = everything.orderBy("full_at", "absent", "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    levels = (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("all_size", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("spent", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("all_size") - F.col("spent")) / F.sum("weight").over(after))
    )
    open_ones = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("full_at"))
    level = F.first("level").over(everything.orderBy("full_at", "absent", "source"))
    levels = levels.withColumn("open_at", F.min(open_ones).over(everything))
    rest = levels.where("full_at >= open_at").withColumn("common", level)
    full = levels.where("open_at IS NULL OR full_at < open_at").withColumn("common", F.lit(None).cast("double"))
    target = F.coalesce(F.col("common") * F.col("weight"), F.col("most"))
    return rest.unionByName(full).select("absent", "source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
    digits: int = 3,
) -> DataFrame:
    """Which documents a mix takes, and how often, so that every source meets its target.

    Returns ``row`` (a struct of the ``keep`` columns, all by default), size, source_size, target,
    copies (int, whole copies), cut (words of one more copy that is not whole, else 0) and taken
    (copies * size + cut). Every document of a source is taken as many whole times as its target holds
    the source; the rest of the target, rounded to words, goes to a prefix of the source's hash-random
    order, whose last document is cut where the budget ends. A source's sum is its target but for rounding.

    The order is by the MD5 of seed, id and text. The first ``digits`` hex digits range-partition every
    source into 16**digits even buckets; running sums inside a bucket plus the sums of the buckets
    before it are the prefix sums, so a source that holds most rows is spread like any other. Reruns
    agree. Defined cases: a null text has size 0; a null source is a source of its own, last in order;
    a null id counts as empty; repeated rows are taken as separate documents; without words all targets
    are 0; an empty table gives no rows. Input columns stay inside ``row`` and cannot clash.
    """
    size = word_count(F.col(text)) if size is None else size
    key = F.md5(
        F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    )
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
        size.cast("long").alias("size"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(source).isNull().alias("absent"),
        key.alias("key"),
    ).withColumn("bucket", F.conv(F.substring("key", 1, digits), 16, 10).cast("int"))
    place = ["absent", "source", "bucket"]
    sums = written(base.groupBy(*place).agg(F.sum("size").alias("bucket_size")), "bucket_sizes")
    totals = sums.groupBy("absent", "source").agg(F.sum("bucket_size").alias("source_size"))
    targets = source_targets(totals, weights, share, cap)
    within = Window.partitionBy("absent", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(within), F.lit(0)))
    cuts = offsets.drop("bucket_size").join(targets, ["absent", "source"])
    running = Window.partitionBy(*place).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (
        base.withColumn("until", F.sum("size").over(running))
        .join(cuts, place)
        .withColumn("until", F.col("until") + F.col("offset"))
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("rest", F.floor(F.col("rest") + 0.5))
        .withColumn("extra", (F.col("rest") > 0) & (F.col("until") <= F.col("rest")))
        .withColumn("copies", (F.col("whole") + F.col("extra").cast("long")).cast("int"))
        .withColumn("before", F.col("until") - F.col("size"))
        .withColumn("cut", F.when(F.col("extra") | (F.col("before") >= F.col("rest")), F.lit(0)).otherwise(F.col("rest") - F.col("before")))
        .withColumn("taken", F.col("copies") * F.col("size") + F.col("cut"))
        .select("row", "size", "source_size", "target", "copies", "cut", "taken")
    )


def mixed(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents of the mix themselves: each as often as ``mix`` takes it, in the input's columns.

    The copy at a source's cut keeps its first words and the white space between them; n_chars, where the
    table has it, is that of the copy.
    """
    chosen = mix(docs, text=text, **options)
    copies = F.concat(F.array_repeat(F.lit(0), F.col("copies")), F.when(F.col("cut") > 0, F.array("cut")).otherwise(F.array()))
    each = chosen.select("row", F.explode(F.transform(copies, lambda c: c.cast("long"))).alias("cut"))
    parts = F.regexp_extract_all(F.col(f"row.{text}"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    begun = F.array_join(F.slice(parts, F.lit(1), F.col("cut").cast("int")), "")
    short = F.when(F.col("cut") > 0, begun).otherwise(F.col(f"row.{text}"))
    changed = {text: short}
    if "n_chars" in docs.columns:
        length = F.when(F.col("cut") > 0, F.char_length(begun).cast("long")).otherwise(F.col("row.n_chars"))
        changed["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return each.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
