"""Edge rows of the quality rules, with ANSI mode on and off."""

import pytest
from pyspark.sql import functions as F

from sievework.operators import contract, dedupe, quality
from sievework.spec import QualityOptions
from sievework.specs import BOOKING

RULES = BOOKING.flags


def verdict(raw, options=QualityOptions()):
    """The set of TRUE flags per row, in row order; the empty set for a kept row."""
    flagged = quality.flag_rows(raw, BOOKING, options).orderBy("booking_id").collect()
    return [{f for f in RULES if row[f]} for row in flagged]


CASES = {
    "valid": ({}, set()),
    "impossible date": ({"arrival_month": "2", "arrival_date": "29"}, {"invalid_arrival_date"}),
    "month 13": ({"arrival_month": "13", "arrival_date": "1"}, {"invalid_arrival_date"}),
    "long month": ({"arrival_month": "112", "arrival_date": "5"}, set()),
    "long day": ({"arrival_month": "5", "arrival_date": "310"}, set()),
    "two-digit year": ({"arrival_year": "18"}, {"invalid_arrival_date"}),
    "negative month": (
        {"arrival_month": "-1", "arrival_date": "5"},
        {"invalid_arrival_date", "negative_numeric_value"},
    ),
    "missing nights": ({"no_of_week_nights": ""}, {"missing_required_value"}),
    "null nights": ({"no_of_week_nights": None}, {"missing_required_value"}),
    "null category": (
        {"room_type_reserved": None},
        {"missing_required_value", "invalid_category_value"},
    ),
    "null target": (
        {"booking_status": None},
        {"missing_required_value", "invalid_category_value", "invalid_target_value"},
    ),
    "null binary": (
        {"repeated_guest": None},
        {"missing_required_value", "invalid_binary_value"},
    ),
    "null date part": (
        {"arrival_month": None},
        {"missing_required_value", "invalid_arrival_date"},
    ),
    "decimal text": ({"no_of_adults": "2.0"}, set()),
    "exponent text": ({"no_of_adults": "1e3"}, {"missing_required_value"}),
    "overflow text": ({"lead_time": "99999999999"}, {"missing_required_value"}),
    "padded text": ({"no_of_adults": " 5 "}, set()),
    "padded category": ({"booking_status": " Canceled "}, set()),
    "no nights": (
        {"no_of_week_nights": "0", "no_of_weekend_nights": "0"},
        {"zero_or_negative_night_stay"},
    ),
    "no guests": (
        {"no_of_adults": "0", "no_of_children": "0"},
        {"zero_or_negative_guest_count"},
    ),
    "negative lead time": ({"lead_time": "-1"}, {"negative_numeric_value"}),
    "NaN price": ({"avg_price_per_room": "NaN"}, set()),
    "zero price": ({"avg_price_per_room": "0"}, set()),
    "negative price": ({"avg_price_per_room": "-0.01"}, {"negative_numeric_value"}),
    "bad case": (
        {"booking_status": "canceled"},
        {"invalid_category_value", "invalid_target_value"},
    ),
    "bad binary": ({"repeated_guest": "2"}, {"invalid_binary_value"}),
    "huge sum": (
        {"no_of_adults": "2147483647", "no_of_children": "2147483647"},
        set(),
    ),
}


def test_edge_rows(make_rows, ansi):
    changes = [{**c, "booking_id": f"{i:03}"} for i, (c, _) in enumerate(CASES.values())]
    found = verdict(make_rows(*changes))
    expected = [flags for _, flags in CASES.values()]
    assert dict(zip(CASES, found, strict=True)) == dict(zip(CASES, expected, strict=True))


INTEGERS = {
    "2.0": 2, "2.7": 2, "-2.9": -2, "2.": 2, ".5": 0, "2.99999999999999": 2, "1e3": None,
    "2.0x": None, "-": None, "": None, "2147483648.5": None, "+7": 7, " 5 ": 5, None: None,
}


def test_integer_text(make_rows, ansi):
    raw = make_rows(*[{"no_of_adults": text, "booking_id": str(text)} for text in INTEGERS])
    rows = quality.standardize(raw, BOOKING).select("booking_id", "no_of_adults").collect()
    expected = {str(text).strip(): number for text, number in INTEGERS.items()}
    assert {r["booking_id"]: r["no_of_adults"] for r in rows} == expected


def test_long_parts_keep_their_value(make_rows, ansi):
    raw = make_rows({"arrival_month": "112", "arrival_date": "5"})
    row = quality.clean_and_rejected(raw, BOOKING)[0].head()
    assert str(row["arrival_date_full"]) == "2018-11-05"
    assert row["arrival_month"] == 112


def test_options(make_rows, ansi):
    rows = make_rows(
        {"avg_price_per_room": "NaN", "booking_id": "1"},
        {"booking_id": "   "},
        {"arrival_month": "112", "arrival_date": "5", "booking_id": "2"},
        {"booking_id": "3"},
    )
    strict = QualityOptions(strict_date_parts=True, reject_nan=True, blank_is_null=True)
    assert verdict(rows) == [set()] * 4
    assert verdict(rows, strict) == [
        {"missing_required_value"},
        {"missing_required_value"},
        {"invalid_arrival_date"},
        set(),
    ]


def test_null_flag_stays_null(make_rows, ansi):
    _, rejected = quality.clean_and_rejected(make_rows({"no_of_week_nights": ""}), BOOKING)
    row = rejected.head()
    assert row["missing_required_value"] == 1
    assert row["zero_or_negative_night_stay"] is None
    assert rejected.columns == ["booking_id", *RULES]


def test_kept_plus_rejected_is_everything(spark, sf_dir, tmp_path):
    from sievework.plans.bookings_view import bookings

    raw = bookings(spark, sf_dir)
    clean, rejected = quality.clean_and_rejected(raw, BOOKING)
    kept, removed = clean.count(), rejected.count()
    assert kept + removed == raw.count()
    any_flag = F.greatest(*[F.coalesce(F.col(f), F.lit(0)) for f in RULES])
    assert rejected.where(any_flag == 0).count() == 0
    quality.assert_clean(clean, BOOKING)

    stored_clean, stored_rejected = quality.write_verdicts(raw, BOOKING, str(tmp_path / "v"))
    assert stored_clean.exceptAll(clean).count() == 0 and stored_clean.count() == kept
    assert stored_rejected.exceptAll(rejected).count() == 0
    assert stored_rejected.count() == removed


def test_one_sided_verdicts(make_rows, tmp_path):
    clean, rejected = quality.write_verdicts(make_rows({}), BOOKING, str(tmp_path / "v"))
    assert (clean.count(), rejected.count()) == (1, 0)


def test_assert_clean_names_the_problem(make_rows):
    raw = make_rows({"booking_id": "a"}, {"booking_id": "a"}, {"booking_id": "b"})
    clean, _ = quality.clean_and_rejected(raw, BOOKING)
    with pytest.raises(ValueError, match=r"duplicate_key\(booking_id\): 1"):
        quality.assert_clean(clean, BOOKING)
    broken = clean.dropDuplicates(["booking_id"]).withColumn("lead_time", F.lit(-1))
    with pytest.raises(ValueError, match="rejected_row"):
        quality.assert_clean(broken, BOOKING)
    undated = clean.withColumn("arrival_date_full", F.lit(None).cast("date"))
    with pytest.raises(ValueError, match=r"missing_value\(arrival_date_full\)"):
        quality.assert_clean(undated, BOOKING)


def test_duplicate_policies(make_rows, ansi):
    raw = make_rows(
        {"booking_id": "a", "lead_time": "9"},
        {"booking_id": "a", "lead_time": "4"},
        {"booking_id": "b"},
    )
    clean, _ = quality.clean_and_rejected(raw, BOOKING)
    with pytest.raises(ValueError, match="1 rows repeat"):
        dedupe.resolve_duplicates(clean, ["booking_id"], "error")
    kept = dedupe.resolve_duplicates(clean, ["booking_id"], "keep_one", ["lead_time"])
    assert kept.columns == clean.columns
    assert {(r["booking_id"], r["lead_time"]) for r in kept.collect()} == {("a", 4), ("b", 10)}
    assert dedupe.resolve_duplicates(clean, ["booking_id"], "ignore").count() == 3


def test_schema_contract(make_rows):
    raw = make_rows({})
    assert contract.check_schema(raw, BOOKING) is raw
    with pytest.raises(ValueError, match=r"missing columns \['lead_time'\], extra columns \['x'\]"):
        contract.check_schema(raw.withColumnRenamed("lead_time", "x"), BOOKING)
