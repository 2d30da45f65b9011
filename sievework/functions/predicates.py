"""Boolean building blocks of the quality rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_true(conditions: Iterable[Column]) -> Column:
    """OR of the conditions, in three-valued logic; FALSE when there are none."""
    return reduce(or_, conditions, F.lit(False))


def not_in_domain(column: str, values: Iterable) -> Column:
    """TRUE for NULL and for anything outside ``values``; never NULL."""
    c = F.col(column)
    return c.isNull() | ~c.isin(list(values))


def null_or_nan(column: str) -> Column:
    """TRUE when a numeric column holds no usable number."""
    return F.col(column).isNull() | F.isnan(column)
