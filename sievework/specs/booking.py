"""Specification of the booking-record table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework import functions as fx
from sievework.spec import DOUBLE, INTEGER, ColumnSpec, DateRule, FeatureSpec, SumRule, TableSpec

# The legal levels of the categorical columns.
MEAL_PLANS = ("Meal Plan 1", "Meal Plan 2", "Meal Plan 3", "Not Selected")
ROOM_TYPES = (
    "Room_Type 1",
    "Room_Type 2",
    "Room_Type 3",
    "Room_Type 4",
    "Room_Type 5",
    "Room_Type 6",
    "Room_Type 7",
)
SEGMENTS = ("Aviation", "Complementary", "Corporate", "Offline", "Online")
STATUSES = ("Canceled", "Not_Canceled")

# The features that get standardised, in output order, and the 0/1 features.
SCALED_FEATURES = (
    "no_of_adults",
    "no_of_children",
    "no_of_weekend_nights",
    "no_of_week_nights",
    "lead_time",
    "arrival_year",
    "arrival_month",
    "arrival_date",
    "no_of_previous_cancellations",
    "no_of_previous_bookings_not_canceled",
    "avg_price_per_room",
    "no_of_special_requests",
    "total_nights",
    "total_guests",
    "arrival_day_of_week",
    "arrival_quarter",
    "estimated_booking_value",
    "avg_price_per_guest",
    "previous_total_bookings",
    "previous_cancellation_rate",
)
BINARY_FEATURES = (
    "required_car_parking_space",
    "repeated_guest",
    "has_children",
    "arrival_is_weekend",
)

FEATURES = FeatureSpec(
    scaled=SCALED_FEATURES,
    binary=BINARY_FEATURES,
    one_hot=("type_of_meal_plan", "room_type_reserved", "market_segment_type"),
    derived=(
        {
            # Names of the derived features.
            "total_nights": lambda: fx.total("no_of_weekend_nights", "no_of_week_nights"),
            "total_guests": lambda: fx.total("no_of_adults", "no_of_children"),
            "has_children": lambda: fx.is_positive("no_of_children"),
            "arrival_day_of_week": lambda: F.dayofweek("arrival_date_full"),
            "arrival_quarter": lambda: F.quarter("arrival_date_full"),
            "previous_total_bookings": lambda: fx.total(
                "no_of_previous_cancellations", "no_of_previous_bookings_not_canceled"
            ),
        },
        {
            "arrival_is_weekend": lambda: fx.weekend_flag("arrival_day_of_week"),
            "estimated_booking_value": lambda: fx.rounded_product(
                "avg_price_per_room", "total_nights"
            ),
            "avg_price_per_guest": lambda: fx.rounded_ratio("avg_price_per_room", "total_guests"),
            "previous_cancellation_rate": lambda: fx.rate_or_zero(
                "no_of_previous_cancellations", "previous_total_bookings"
            ),
        },
    ),
)


def booking_spec(key: str = "booking_id") -> TableSpec:
    """The booking table; files spell the key column ``Booking_ID``, catalogs ``booking_id``."""
    return TableSpec(
        name="bookings",
        key=key,
        # Column names and order of the raw table.
        columns=(
            ColumnSpec(key),
            ColumnSpec("no_of_adults", INTEGER),
            ColumnSpec("no_of_children", INTEGER),
            ColumnSpec("no_of_weekend_nights", INTEGER),
            ColumnSpec("no_of_week_nights", INTEGER),
            ColumnSpec("type_of_meal_plan", domain=MEAL_PLANS, baseline="Meal Plan 1"),
            ColumnSpec("required_car_parking_space", INTEGER, binary=True),
            ColumnSpec("room_type_reserved", domain=ROOM_TYPES, baseline="Room_Type 1"),
            ColumnSpec("lead_time", INTEGER),
            ColumnSpec("arrival_year", INTEGER),
            ColumnSpec("arrival_month", INTEGER),
            ColumnSpec("arrival_date", INTEGER),
            ColumnSpec("market_segment_type", domain=SEGMENTS, baseline="Online"),
            ColumnSpec("repeated_guest", INTEGER, binary=True),
            ColumnSpec("no_of_previous_cancellations", INTEGER),
            ColumnSpec("no_of_previous_bookings_not_canceled", INTEGER),
            ColumnSpec("avg_price_per_room", DOUBLE),
            ColumnSpec("no_of_special_requests", INTEGER),
            ColumnSpec("booking_status", domain=STATUSES),
        ),
        # Names of the flags and of the columns that the rules derive.
        date=DateRule(
            flag="invalid_arrival_date",
            year="arrival_year",
            month="arrival_month",
            day="arrival_date",
            output="arrival_date_full",
        ),
        sums=(
            SumRule(
                "zero_or_negative_night_stay",
                ("no_of_weekend_nights", "no_of_week_nights"),
                "total_nights_check",
            ),
            SumRule(
                "zero_or_negative_guest_count",
                ("no_of_adults", "no_of_children"),
                "total_guests_check",
            ),
        ),
        target="booking_status",
        positive_value="Canceled",
        label="booking_status_label",
        features=FEATURES,
        observed={"non_positive_room_price": lambda: F.col("avg_price_per_room") <= 0},
    )


BOOKING = booking_spec()
