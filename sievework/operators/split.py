"""Deterministic train / test split on a hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import functions as fx

TRAIN_SHARE = 80
BUCKETS = 100


def in_train(key: str, train_share: int = TRAIN_SHARE, method: str = "xxhash64") -> Column:
    """TRUE for keys of the training side. Row-local: equal keys always agree, and neither
    the order nor the number of partitions matters."""
    return fx.hash_bucket(key, BUCKETS, method) < train_share


def hash_split(
    df: DataFrame, key: str, train_share: int = TRAIN_SHARE, method: str = "xxhash64"
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, together complete, without a shuffle."""
    train = in_train(key, train_share, method)
    return df.where(train), df.where(~train)


def split_sizes(
    df: DataFrame, key: str, train_share: int = TRAIN_SHARE, method: str = "xxhash64"
) -> DataFrame:
    """(split, rows) of both sides in one scan."""
    side = F.when(in_train(key, train_share, method), "train").otherwise("test")
    return df.groupBy(side.alias("split")).agg(F.count(F.lit(1)).alias("rows"))
