"""Specifications of the star-schema tables."""

from __future__ import annotations

from sievework.spec import DOUBLE, INTEGER, LONG, ColumnSpec, FeatureSpec, SumRule, TableSpec

ORDERS = TableSpec(
    name="orders",
    key="o_orderkey",
    columns=(
        ColumnSpec("o_orderkey", LONG),
        ColumnSpec("o_custkey", LONG),
        ColumnSpec("o_orderstatus", domain=("F", "O", "P"), baseline="O"),
        ColumnSpec("o_totalprice", DOUBLE),
        ColumnSpec("o_orderdate"),
        ColumnSpec(
            "o_orderpriority",
            domain=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
            baseline="5-LOW",
        ),
    ),
    target="o_orderstatus",
    positive_value="F",
    label="label",
    features=FeatureSpec(
        scaled=("o_totalprice",), one_hot=("o_orderstatus", "o_orderpriority")
    ),
)

LINEITEM = TableSpec(
    name="lineitem",
    columns=(
        ColumnSpec("l_orderkey", LONG),
        ColumnSpec("l_partkey", LONG),
        ColumnSpec("l_suppkey", LONG),
        ColumnSpec("l_linenumber", INTEGER),
        ColumnSpec("l_quantity", DOUBLE),
        ColumnSpec("l_extendedprice", DOUBLE),
        ColumnSpec("l_discount", DOUBLE),
        ColumnSpec("l_tax", DOUBLE),
        ColumnSpec("l_returnflag", domain=("A", "N", "R"), baseline="N"),
        ColumnSpec("l_linestatus", domain=("F", "O"), baseline="O"),
        ColumnSpec("l_shipdate"),
    ),
    # A line with neither a discount nor tax is flagged.
    sums=(SumRule("no_discount_or_tax", ("l_discount", "l_tax"), "adjustment"),),
    features=FeatureSpec(
        scaled=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        one_hot=("l_returnflag", "l_linestatus"),
    ),
)

CUSTOMER = TableSpec(
    name="customer",
    key="c_custkey",
    columns=(
        ColumnSpec("c_custkey", LONG),
        ColumnSpec("c_name"),
        ColumnSpec("c_nationkey", INTEGER),
        ColumnSpec("c_acctbal", DOUBLE),
        ColumnSpec(
            "c_mktsegment",
            domain=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
            baseline="MACHINERY",
        ),
    ),
)
