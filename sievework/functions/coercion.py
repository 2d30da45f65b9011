"""Casts that turn bad input into NULL whatever the session's ANSI setting is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sign, whole digits, a dot and more digits: the only text besides plain integers that
# still counts as an integer. The replacement is the sign, a zero and the whole digits.
_DECIMAL_TEXT = r"^\s*([+-]?)(\d*)\.\d*\s*$"
_WHOLE_PART = "$10$2"


def trimmed(column: str) -> Column:
    """The column as text without leading and trailing spaces."""
    return F.trim(F.col(column).cast("string"))


def safe_int(text: Column) -> Column:
    """Text to 32-bit integer: ``"2.7"`` gives 2, ``"1e3"``, overflow and words give NULL."""
    # The regular expression only runs on the rare values the plain cast refuses.
    return F.coalesce(
        text.try_cast("int"),
        F.regexp_replace(text, _DECIMAL_TEXT, _WHOLE_PART).try_cast("int"),
    )


def safe_long(text: Column) -> Column:
    """Text to 64-bit integer, by the rules of :func:`safe_int`."""
    return F.coalesce(
        text.try_cast("bigint"),
        F.regexp_replace(text, _DECIMAL_TEXT, _WHOLE_PART).try_cast("bigint"),
    )


def safe_double(text: Column) -> Column:
    """Text to double; words give NULL."""
    return text.try_cast("double")
