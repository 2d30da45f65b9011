"""Booking records derived from the star-schema tables, with bad rows for every rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "lineitem", "orders")

# Plain SQL, so that the same text runs on another engine to check results against.
# * The lines are reduced to one row per order before the join, with map-side combine; the
#   hint keeps that side, which grows with the data, from being broadcast, and leaves the
#   rows spread over the shuffle partitions for the text work that follows.
# * Keys of more than eight digits are not cut, so that every order keeps an id of its own.
# * A thousandth of the price is rounded half up in whole cents, because engines differ in
#   how they round a binary tie such as 69.195.
BOOKINGS_SQL = """
SELECT /*+ MERGE(n) */
  concat('INN', CASE WHEN o.o_orderkey < 100000000 THEN lpad(cast(o.o_orderkey AS varchar(20)), 8, '0')
                     ELSE cast(o.o_orderkey AS varchar(20)) END) AS booking_id,
  cast(o.o_orderkey % 4 AS varchar(20)) AS no_of_adults,
  cast(o.o_custkey % 3 AS varchar(20)) AS no_of_children,
  cast(coalesce(n.f_lines, 0) AS varchar(20)) AS no_of_weekend_nights,
  CASE WHEN o.o_orderkey % 113 = 0 THEN 'n/a'
       ELSE cast(coalesce(n.o_lines, 0) AS varchar(20)) END AS no_of_week_nights,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Meal Plan 1' WHEN '2-HIGH' THEN ' Meal Plan 2 '
       WHEN '3-MEDIUM' THEN 'Meal Plan 3' WHEN '5-LOW' THEN 'Meal Plan 1'
       ELSE 'Not Selected' END AS type_of_meal_plan,
  CASE WHEN o.o_orderkey % 101 = 0 THEN '2'
       ELSE cast(o.o_orderkey % 2 AS varchar(20)) END AS required_car_parking_space,
  CASE WHEN o.o_orderkey % 89 = 0 THEN 'Room_Type 9'
       ELSE concat('Room_Type ', cast(1 + o.o_custkey % 7 AS varchar(20))) END AS room_type_reserved,
  cast(CASE WHEN o.o_orderkey % 83 = 0 THEN -1 ELSE o.o_orderkey % 400 END AS varchar(20)) AS lead_time,
  cast(year(o.o_orderdate) AS varchar(20)) AS arrival_year,
  CASE WHEN o.o_orderkey % 97 = 0 THEN '2'
       ELSE cast(month(o.o_orderdate) AS varchar(20)) END AS arrival_month,
  CASE WHEN o.o_orderkey % 97 = 0 THEN '30'
       ELSE cast(day(o.o_orderdate) AS varchar(20)) END AS arrival_date,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Aviation' WHEN 'BUILDING' THEN 'Complementary'
       WHEN 'FURNITURE' THEN 'Corporate' WHEN 'HOUSEHOLD' THEN 'Offline'
       ELSE 'Online' END AS market_segment_type,
  cast(CASE WHEN o.o_custkey % 10 = 0 THEN 1 ELSE 0 END AS varchar(20)) AS repeated_guest,
  cast(o.o_custkey % 2 AS varchar(20)) AS no_of_previous_cancellations,
  cast(o.o_custkey % 5 AS varchar(20)) AS no_of_previous_bookings_not_canceled,
  cast(cast(floor((round(o.o_totalprice * 100) + 500) / 1000) / 100 AS decimal(12,2)) AS varchar(20))
    AS avg_price_per_room,
  cast(o.o_orderkey % 6 AS varchar(20)) AS no_of_special_requests,
  CASE WHEN o.o_orderkey % 127 = 0 THEN 'Unknown' WHEN o.o_orderstatus = 'F' THEN 'Canceled'
       ELSE 'Not_Canceled' END AS booking_status
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN (SELECT l_orderkey,
                  sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f_lines,
                  sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS o_lines
           FROM lineitem GROUP BY l_orderkey) n ON n.l_orderkey = o.o_orderkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 19 booking columns as text, one row per order."""
    views = {name: table(spark, sf_dir, name) for name in TABLES}
    text = BOOKINGS_SQL
    for name in TABLES:
        for keyword in ("FROM", "JOIN"):
            text = text.replace(f"{keyword} {name} ", f"{keyword} {{{name}}} ")
    return spark.sql(text, **views)
