"""Column expressions: no jobs, no UDFs, the same result with ANSI mode on or off."""

from sievework.functions.coercion import safe_double, safe_int, safe_long, trimmed
from sievework.functions.dates import date_from_parts
from sievework.functions.features import (
    binary_label,
    hash_bucket,
    indicator,
    is_positive,
    rate_or_zero,
    rounded_product,
    rounded_ratio,
    total,
    weekend_flag,
)
from sievework.functions.predicates import any_true, not_in_domain, null_or_nan

__all__ = [
    "any_true",
    "binary_label",
    "date_from_parts",
    "hash_bucket",
    "indicator",
    "is_positive",
    "not_in_domain",
    "null_or_nan",
    "rate_or_zero",
    "rounded_product",
    "rounded_ratio",
    "safe_double",
    "safe_int",
    "safe_long",
    "total",
    "trimmed",
    "weekend_flag",
]
