"""Dates assembled from numeric parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_parts(year: Column, month: Column, day: Column, strict: bool = False) -> Column:
    """``yyyy-MM-dd`` date, NULL when the parts form no real date.

    Month and day are brought to two characters, which cuts longer numbers
    (month 112 reads as 11). ``strict`` makes such parts NULL instead.
    """
    text = F.concat_ws(
        "-",
        year.cast("string"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(day.cast("string"), 2, "0"),
    )
    parsed = F.try_to_date(text, "yyyy-MM-dd")
    if strict:
        return F.when(month.between(1, 12) & day.between(1, 31), parsed)
    return parsed
