"""Helpers shared by the operators of this subpackage: words, written tables, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than these six separators.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased: the separators of ``bytes.split`` are those six."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id falls in the fold of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one in ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``. A local
    session without either gets a temporary folder; any other session must name one.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The same rows, stored in the shared folder: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Deletes a table of ``written`` that nothing needs any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by alternating star contraction.

    Each round hangs the larger neighbours of every node on its smallest neighbour, then does the same
    for the smaller ones; the number of rounds grows with the logarithm of the largest component. A
    round is two aggregates with map-side combine and two joins that adaptive execution can split, so a
    node with very many links is no special case. Nodes without links do not appear.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    edges, before = written(edges, "links"), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = written(small.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct(), "small")
        now = small.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        removed(edges), removed(large)
        edges = small
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
