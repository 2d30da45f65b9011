import pytest
from pyspark.sql import functions as F

from sievework.operators import correlation, features, quality, scaling, split
from sievework.plans.queries import clean_bookings
from sievework.spec import indicator_name
from sievework.specs import BOOKING


def clean(raw):
    return quality.clean_and_rejected(raw, BOOKING)[0]


def test_engineered_row(make_rows, ansi):
    row = features.feature_table(clean(make_rows({})), BOOKING).head()
    assert row["total_nights"] == 3 and row["total_guests"] == 3
    assert row["has_children"] == 1
    assert row["arrival_day_of_week"] == 7 and row["arrival_is_weekend"] == 1
    assert row["arrival_quarter"] == 1
    assert row["estimated_booking_value"] == 301.5
    assert row["avg_price_per_guest"] == 33.5
    assert row["previous_total_bookings"] == 4
    assert row["previous_cancellation_rate"] == 0.25
    assert row["booking_status_label"] == 1
    assert row["type_of_meal_plan_Meal_Plan_2"] == 1
    assert row["market_segment_type_Offline"] == 1


def test_rate_without_history(make_rows, ansi):
    raw = make_rows(
        {"no_of_previous_cancellations": "0", "no_of_previous_bookings_not_canceled": "0"}
    )
    row = features.feature_table(clean(raw), BOOKING).head()
    assert row["previous_cancellation_rate"] == 0.0


def test_feature_layout(make_rows):
    table = features.feature_table(clean(make_rows({})), BOOKING)
    assert len(BOOKING.feature_names) == 37 and len(BOOKING.one_hot_names) == 13
    assert table.columns == ["booking_id", *BOOKING.feature_names, "booking_status_label"]


def test_indicator_names():
    assert indicator_name("c", "Meal Plan 2") == "c_Meal_Plan_2"
    assert indicator_name("c", " a--b ") == "c_a_b"


def test_one_indicator_per_source(spark, sf_dir):
    table = features.feature_table(clean_bookings(spark, sf_dir), BOOKING)
    for source in BOOKING.feature_spec.one_hot:
        names = [indicator_name(source, v) for v in BOOKING[source].levels]
        total = sum(F.col(n) for n in names)
        assert table.where(total > 1).count() == 0


def test_split_is_a_partition(spark, sf_dir):
    rows = clean_bookings(spark, sf_dir)
    for method in ("xxhash64", "md5"):
        train, test = split.hash_split(rows, "booking_id", method=method)
        assert train.count() + test.count() == rows.count()
        assert train.join(test, "booking_id", "left_semi").count() == 0
    nulls = spark.createDataFrame([(None,), ("a",)], "booking_id string")
    for method in ("xxhash64", "md5"):
        train, test = split.hash_split(nulls, "booking_id", method=method)
        assert train.count() + test.count() == 2


def test_known_split_sizes(spark):
    """Counts measured on the larger table, for both hash methods."""
    rows = clean_bookings(spark, "/root/testdata/sf0.01")
    for method, expected in (("xxhash64", 10142), ("md5", 10190)):
        sizes = {r[0]: r[1] for r in split.split_sizes(rows, "booking_id", method=method).collect()}
        assert sizes == {"train": expected, "test": 12706 - expected}


def test_scaled_training_columns_are_standard(spark, sf_dir, ansi):
    table = features.feature_table(clean_bookings(spark, sf_dir), BOOKING)
    train, test = scaling.train_test_tables(table, BOOKING)
    scaled = [f"{c}_scaled" for c in BOOKING.feature_spec.scaled]
    assert train.columns[0] == "booking_id" and len(train.columns) == 39
    assert test.columns == train.columns
    stats = train.agg(
        *[F.avg(c).alias(c) for c in scaled], *[F.stddev_samp(c).alias(f"{c}_s") for c in scaled]
    ).head()
    for c in scaled:
        assert stats[c] == pytest.approx(0, abs=1e-5)
        assert stats[f"{c}_s"] == pytest.approx(1, abs=1e-4)


def test_constant_and_single_row_scale_to_zero(spark, ansi):
    def scale(rows):
        df = spark.createDataFrame(rows, "a double")
        stats = scaling.scaling_statistics(df, ["a"])
        return [r[0] for r in scaling.standardize_columns(df, stats, ["a"]).collect()]

    assert scale([(5.0,), (5.0,)]) == [0.0, 0.0]
    assert scale([(5.0,)]) == [0.0]
    nans = scale([(float("nan"),), (5.0,)])
    assert all(v != v for v in nans)


def test_empty_training_side_is_an_error(spark, ansi):
    df = spark.createDataFrame([(1.0,)], "a double")
    stats = scaling.scaling_statistics(df.limit(0), ["a"])
    with pytest.raises(Exception, match="no training value of a"):
        scaling.standardize_columns(df, stats, ["a"]).collect()


def test_correlations(spark, ansi):
    rows = [(float(i), -2.0 * i, 3.0, i % 2) for i in range(20)]
    rows += [(None, 1.0, 3.0, 1), (float("nan"), 1.0, 3.0, 1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    pairs = [tuple(r) for r in correlation.pair_correlations(df, ["a", "b", "c"]).collect()]
    assert [p[:2] for p in pairs] == [("a", "b")]
    assert pairs[0][2] == pytest.approx(-1)
    target = correlation.target_correlations(df, ["a", "b", "c"], "y").collect()
    assert [r["feature"] for r in target] == ["a", "b"]
    by_matrix, _ = correlation.correlation_report(df, ["a", "b", "c"], "y")
    for ours, theirs in zip(target, by_matrix.collect(), strict=True):
        assert ours["r"] == pytest.approx(theirs["r"])
