import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import profile, quality, ranking, reports
from sievework.specs import BOOKING


def test_exact_percentiles_against_sorting(spark, ansi):
    rng = random.Random(5)
    # A third of the rows share one value; the rest are spread over a wide range.
    values = [7.0] * 3000 + [rng.expovariate(1e-3) for _ in range(6000)]
    rows = [(v, None if i % 7 == 0 else i % 11) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "a double, b int").repartition(5)
    shares = (0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0)
    found = {
        (r["column"], r["probability"]): r["value"]
        for r in profile.exact_percentiles(df, ["a", "b"], shares, accuracy=100).collect()
    }
    for column, at in (("a", 0), ("b", 1)):
        present = sorted(r[at] for r in rows if r[at] is not None)
        for p in shares:
            rank = max(1, -(-len(present) * p // 1))
            assert found[column, p] == present[int(rank) - 1], (column, p)


def test_exact_percentiles_without_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    assert [r["value"] for r in profile.exact_percentiles(df, ["a"]).collect()] == [None] * 3
    assert profile.exact_percentiles(df.limit(0), ["a"]).count() == 3


def test_numeric_summary_matches_builtin(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = ["l_quantity", "l_discount"]
    builtin = df.select(columns).summary("mean", "stddev", "min", "25%", "50%", "75%", "max")
    wide = {r["summary"]: r for r in builtin.collect()}
    for row in profile.numeric_summary(df, columns).collect():
        names = ("mean", "stddev", "min", "25%", "50%", "75%", "max")
        ours = (row[c] for c in ("mean", "stddev", "min", "p25", "p50", "p75", "max"))
        for name, value in zip(names, ours, strict=True):
            assert float(wide[name][row["column"]]) == pytest.approx(value)


def test_summary_of_odd_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1e9 + i, None, nan, float(i)) for i in range(10)] + [(None, None, nan, inf)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    found = {r["column"]: r for r in profile.numeric_summary(df, ["a", "b", "c", "d"]).collect()}
    assert found["a"]["count"] == 10 and found["a"]["mean"] == pytest.approx(1e9 + 4.5, rel=1e-15)
    assert found["a"]["stddev"] == pytest.approx(3.0276503540974917) and found["a"]["p50"] == 1e9 + 4
    assert found["b"]["count"] == 0 and [found["b"][c] for c in ("mean", "stddev", "min", "p25", "p75", "max")] == [None] * 6
    assert found["c"]["count"] == 11 and found["c"]["p50"] is None
    assert found["d"]["max"] == inf and found["d"]["p25"] == 2.0
    one = profile.numeric_summary(df.where("d = 3"), ["a"]).head()
    assert one["stddev"] is None and one["p25"] == one["p75"] == 1e9 + 3
    assert [r["count"] for r in profile.numeric_summary(df.limit(0), ["a", "d"]).collect()] == [0, 0]


def test_summary_quartiles_are_near(spark):
    values = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("x")).repartition(9)
    row = profile.numeric_summary(values, ["x"]).head()
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        below = values.where(F.col("x") <= row[name]).count() / 100_000
        assert abs(below - share) < 0.004


def test_duplicates(spark):
    rows = [(1, "x", 0.0), (1, "x", -0.0), (1, None, 0.0), (None, None, 1.0), (None, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, t string, d double")
    for fingerprint in (False, True):
        assert tuple(profile.duplicate_rows(df, fingerprint).head()) == (5, 3, 2)
    assert tuple(profile.duplicate_keys(df, ["k"]).head()) == (5, 2, 3)
    assert tuple(profile.duplicate_keys(df.limit(0), ["k"]).head()) == (0, 0, 0)


def test_distribution_and_top(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), ("c",)], "v string")
    found = {tuple(r) for r in profile.value_distribution(df, "v").collect()}
    assert found == {("a", 2, 33.33), ("b", 2, 33.33), ("c", 1, 16.67), (None, 1, 16.67)}
    assert tuple(ranking.most_frequent(df, "v").head()) == ("a", 2)
    scores = spark.createDataFrame(
        [("a", -3.0), ("b", 3.0), ("c", 1.0), ("d", float("nan")), ("e", None)], "n string, s double"
    )
    top = ranking.top_by_magnitude(scores, "s", 2, ["n"]).collect()
    assert [r["n"] for r in top] == ["a", "b"]


def test_unknown_labels_and_violations(make_rows):
    raw = make_rows(
        {"booking_status": "canceled"}, {"booking_status": "canceled"}, {"room_type_reserved": "X"}, {}
    )
    typed = quality.standardize(raw, BOOKING)
    findings = reports.quality_findings(typed, BOOKING)
    assert {tuple(r) for r in findings["unknown_labels"].collect()} == {
        ("booking_status", "canceled"),
        ("room_type_reserved", "X"),
    }
    totals = {r["rule"]: r["violations"] for r in findings["violations"].collect()}
    assert totals["invalid_category_value"] == 3 and totals["invalid_target_value"] == 2
    assert totals["any_rule"] == 3
    assert findings["duplicate_keys"].head()["duplicates"] == 0


def test_profile_reports(make_rows):
    typed = quality.standardize(make_rows({}, {"lead_time": "x"}), BOOKING)
    found = reports.profile_table(typed, BOOKING)
    assert tuple(found["shape"].head()) == (2, 19)
    nulls = {r["column"]: r["nulls"] for r in found["nulls"].collect()}
    assert nulls["lead_time"] == 1 and sum(nulls.values()) == 1
    assert found["target"].head()["count"] == 2
    assert found["columns"].where(F.col("expected") == 1).count() == 19
    assert found["numbers"].count() == 14
    assert found["categories"].where("column = 'booking_status'").head()["count"] == 2
