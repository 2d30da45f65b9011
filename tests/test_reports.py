"""Whole reports, shared scratch folders, wide keys and NULL-safe fingerprints."""

import argparse
from types import SimpleNamespace

import pytest

from sievework import __main__ as cli
from sievework.operators import profile, quality, reports, training
from sievework.plans.bookings_view import table
from sievework.plans.queries import QUERIES
from sievework.sources import save_model, scratch_dir, write_csv
from sievework.spec import QualityOptions
from sievework.specs import BOOKING, ORDERS


def session(master, folder=None, setting=None):
    conf = SimpleNamespace(get=lambda key: setting)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=context)


def test_scratch_folder():
    assert scratch_dir(session("yarn", "hdfs:/set", "hdfs:/conf")).startswith("hdfs:/set/")
    assert scratch_dir(session("yarn", None, "hdfs:/conf/")).startswith("hdfs:/conf/sievework-")
    assert scratch_dir(session("yarn"), "s3://own").startswith("s3://own/")
    assert scratch_dir(session("local[2]")) != scratch_dir(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"))


def test_reports_are_written_whole(spark, tmp_path, capsys):
    df = spark.range(137).withColumnRenamed("id", "n")
    cli.report(argparse.Namespace(show=3), str(tmp_path), {"a/b c": df})
    assert spark.read.csv(str(tmp_path / "a" / "b_c"), header=True).count() == 137
    assert "137 rows" in capsys.readouterr().out


def test_describe_writes_all_nodes(spark, tmp_path):
    rows = [(float((i * 7) % 5 > 2), float(i), float(i % 9)) for i in range(400)]
    df = training.assemble(spark.createDataFrame(rows, "y double, a double, b double"), ["a", "b"], "y")
    model = training.four_models()["Random Forest"].fit(df)
    save_model(model, str(tmp_path / "model"))
    cli.describe(spark, argparse.Namespace(model=str(tmp_path / "model"), out=str(tmp_path / "out"), show=0))
    nodes = spark.read.csv(str(tmp_path / "out" / "contents"), header=True)
    assert nodes.count() == sum(t.numNodes for t in model.trees) > 50
    assert {float(r["tree_weight"]) for r in nodes.select("tree_weight").distinct().collect()} == set(model.treeWeights)


def test_csv_counts_what_it_writes(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", None), ("", "c")], "x string, y string")
    assert write_csv(df, str(tmp_path / "a")) == 2
    assert write_csv(df.where("false"), str(tmp_path / "b"), single_file=True) == 0


def test_fingerprint_tells_null_columns_apart(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("a", "b"), ("a", "b")], "p string, q string")
    plain, hashed = (profile.duplicate_rows(df, f).first() for f in (False, True))
    assert plain == hashed and hashed["distinct_rows"] == 3


@pytest.mark.parametrize(
    "change, options",
    [
        ({"arrival_month": "112"}, QualityOptions(strict_date_parts=True)),
        ({"avg_price_per_room": "NaN"}, QualityOptions(reject_nan=True)),
        ({"booking_id": "  "}, QualityOptions(blank_is_null=True)),
    ],
)
def test_findings_follow_the_options(make_rows, change, options):
    typed = quality.standardize(make_rows({}, change), BOOKING)
    for o, expected in ((QualityOptions(), 0), (options, 1)):
        found = {r["rule"]: r["violations"] for r in reports.quality_findings(typed, BOOKING, o)["violations"].collect()}
        assert found["any_rule"] == expected
        assert "non_positive_room_price" in found


def test_wide_keys(spark, ansi):
    raw = spark.createDataFrame([("6000000000", "1", "F", "1.5", "d", "2-HIGH")], ORDERS.raw_schema)
    row = quality.flag_rows(raw, ORDERS).first()
    assert row["o_orderkey"] == 6_000_000_000 and not row["missing_required_value"]


def test_percentiles_by_cells(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    wanted = {(r[0], r[1]): r[2] for r in profile.exact_percentiles(lines, ["l_extendedprice"]).collect()}
    for cells, accuracy in ((1, 10_000), (7, 20), (1000, 20)):
        got = profile.exact_percentiles(lines, ["l_extendedprice"], accuracy=accuracy, cells=cells).collect()
        assert {(r[0], r[1]): r[2] for r in got} == wanted
    inf = float("inf")
    odd = spark.createDataFrame([(x,) for x in [-inf, -inf, 1.0, 2.0, 3.0, inf, float("nan"), None]], "x double")
    assert [r["value"] for r in profile.exact_percentiles(odd, ["x"], (0.0, 0.4, 0.5, 0.9, 1.0)).collect()] == [-inf, 1.0, 1.0, inf, inf]
    assert profile.exact_percentiles(odd.where("false"), ["x"], (0.5,)).first()["value"] is None


def test_date_alone_reads_no_other_columns(spark, sf_dir):
    plan = QUERIES["assemble_date"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "o_orderstatus" not in plan


def test_correlations_need_no_row_per_feature(spark, sf_dir):
    plan = QUERIES["target_correlation"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
