"""Plans that hold at scale: no cross joins, no Python rows, pruned scans, map-side combine."""

import pytest

from sievework.operators import dedupe, profile
from sievework.plans.bookings_view import bookings, table
from sievework.plans.queries import QUERIES

LAZY = (
    "clean_rows", "rejected_rows", "violation_summary", "unknown_labels",
    "frequency_tables", "target_distribution", "numeric_summary", "exact_percentiles",
    "duplicate_rows", "dedupe_keep_one", "feature_table", "hash_split_md5", "scaling_stats",
    "standardized", "target_correlation", "majority_baseline", "classification_metrics", "roc_auc",
)
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not [u for u in UNWANTED if u in plan]


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = plan_of(profile.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    plan = plan_of(profile.value_distribution(table(spark, sf_dir, "orders"), "o_orderstatus"))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan


def test_one_row_per_key_sorts_no_whole_table(spark, sf_dir):
    """Keys are counted by a hash aggregate of fixed width; only repeated keys are looked at further."""
    df = dedupe.keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    df.write.format("noop").mode("overwrite").save()
    plan = plan_of(df)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "partial_min" in plan and "WindowGroupLimit" in plan
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final


def test_global_sort_only_where_asked(spark, sf_dir):
    assert "rangepartitioning" not in plan_of(QUERIES["feature_table"](spark, sf_dir))
    assert "rangepartitioning" in plan_of(QUERIES["clean_rows"](spark, sf_dir))


def test_split_needs_no_shuffle(spark, sf_dir):
    assert "Exchange" not in plan_of(QUERIES["hash_split_md5"](spark, sf_dir))


def test_lines_are_not_broadcast(spark, sf_dir):
    df = bookings(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    assert "SortMergeJoin" in plan_of(df)


def test_building_a_summary_runs_nothing(spark, sf_dir, statements):
    lines = table(spark, sf_dir, "lineitem")
    seen = statements()
    summary = profile.numeric_summary(lines, ["l_quantity", "l_extendedprice"])
    assert seen.jobs() == 0 and not seen.new()
    assert summary.count() == 2
    assert len([n for _, n in seen.nodes() if n.name().startswith("Scan parquet")]) == 1


def test_a_summary_is_merged_in_two_steps(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").repartition(200)
    plan = plan_of(profile.numeric_summary(lines, ["l_quantity"]))
    assert "hashpartitioning(_groupingexpression" in plan.replace("_group#", "_groupingexpression#") and "SinglePartition" in plan
