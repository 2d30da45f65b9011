"""Feature expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(*columns: str) -> Column:
    """Sum of integer columns, widened so that it cannot overflow; NULL if any is NULL."""
    return reduce(add, [F.col(c).cast("bigint") for c in columns])


def is_positive(column: str) -> Column:
    return (F.col(column) > 0).cast("int")


def weekend_flag(day_of_week: str) -> Column:
    """1 for Sunday and Saturday in the 1 = Sunday numbering."""
    return F.col(day_of_week).isin(1, 7).cast("int")


def rounded_product(left: str, right: str, digits: int = 2) -> Column:
    return F.round(F.col(left) * F.col(right), digits)


def rounded_ratio(numerator: str, denominator: str, digits: int = 2) -> Column:
    """Rounded quotient; NULL on a zero denominator."""
    return F.round(F.try_divide(F.col(numerator), F.col(denominator)), digits)


def rate_or_zero(part: str, whole: str) -> Column:
    """part / whole, and 0.0 unless whole is positive."""
    quotient = F.try_divide(F.col(part), F.col(whole))
    return F.when(F.col(whole) > 0, quotient).otherwise(F.lit(0.0))


def binary_label(column: str, positive: str) -> Column:
    """1 for the positive value, 0 for everything else."""
    return F.when(F.col(column) == positive, 1).otherwise(0)


def indicator(column: str, level: str) -> Column:
    """One-hot indicator of a single level."""
    return (F.col(column) == level).cast("int")


def hash_bucket(column: str, buckets: int = 100, method: str = "xxhash64") -> Column:
    """Bucket number in [0, buckets) that depends on the value only; never NULL.

    ``xxhash64`` is the fast default; ``md5`` can be recomputed by other engines.
    """
    if method == "xxhash64":
        return F.pmod(F.xxhash64(F.col(column)), F.lit(buckets))
    if method == "md5":
        prefix = F.substring(F.md5(F.col(column).cast("string")), 1, 8)
        return F.coalesce(F.conv(prefix, 16, 10).cast("bigint") % buckets, F.lit(0))
    raise ValueError(f"unknown hash method: {method!r}")
