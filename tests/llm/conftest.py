import os

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text[, source[, lang]]) rows."""

    def make(*rows):
        full = [
            (r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None)
            for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path


#: Names that operators use inside; documents may have columns of the same names.
CLASHING = ["fp", "row", "size", "g", "h", "spans", "t1", "n", "words", "cell", "root", "key", "bucket", "score", "source_size"]


@pytest.fixture
def with_clashes():
    from pyspark.sql import functions as F

    return lambda df: df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
