"""Listing-shaped views over the TPC-H-like test tables.

Each text is plain SQL that Spark and DuckDB read alike; ``{table}`` names are
bound to DataFrames in Spark and to registered tables in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, tuple[str, str]] = {}
VIEWS["listings"] = ("part", """
SELECT p_partkey AS id,
  CAST(51.3 AS DOUBLE) + CAST((p_partkey * 37) % 401 AS DOUBLE) / 1000 AS latitude,
  CAST(-0.5 AS DOUBLE) + CAST((p_partkey * 91) % 797 AS DOUBLE) / 1000 AS longitude,
  CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 51 = 0 THEN '' WHEN p_partkey % 53 = 0 THEN 'n/a'
       WHEN (p_partkey * 7919) % 1200 >= 1000 THEN concat('$1,', lpad(CAST((p_partkey * 7919) % 1200 - 1000 AS STRING), 3, '0'), '.00')
       ELSE concat('$', CAST((p_partkey * 7919) % 1200 AS STRING), '.50') END AS price,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_size % 8 + 1 END AS accommodates,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_size % 4 END AS bedrooms,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_size % 6 END AS beds,
  CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE CAST(p_size % 5 AS DOUBLE) / 2 END AS bathrooms,
  p_type AS room_type, p_brand AS property_type,
  concat(' NATION_', CAST(p_partkey % 26 AS STRING), ' ') AS neighbourhood_cleansed,
  p_name AS name,
  CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN concat(p_name, ' PENTHOUSE with View')
       ELSE concat('Plain ', p_name) END AS description,
  CASE p_partkey % 6 WHEN 0 THEN 'Wifi, Balcony' WHEN 1 THEN 'Hot tub' WHEN 2 THEN 'Garden, Jacuzzi, Kitchen'
       WHEN 3 THEN '' WHEN 4 THEN NULL ELSE 'Sea view' END AS amenities,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST((p_partkey * 31) % 501 AS DOUBLE) / 100 END AS review_scores_rating,
  CAST((p_partkey * 17) % 300 AS INT) AS number_of_reviews,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST((p_partkey * 7) % 97 AS DOUBLE) / 10 END AS reviews_per_month,
  CAST((p_partkey * 41) % 366 AS INT) AS availability_365,
  CAST((p_partkey * 43) % 31 AS INT) AS availability_30,
  CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 't' ELSE 'f' END AS host_is_superhost,
  CASE WHEN p_partkey % 37 = 0 THEN 'N/A' ELSE concat(CAST((p_partkey * 13) % 101 AS STRING), '%') END AS host_response_rate,
  CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE concat(CAST((p_partkey * 19) % 101 AS STRING), '%') END AS host_acceptance_rate
FROM part
""")
VIEWS["hosts"] = ("customer", """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 47 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN 'unknown' WHEN c_custkey % 31 = 0 THEN '2021-02-30'
       WHEN c_custkey % 29 = 0 THEN '' ELSE concat(CAST(2008 + c_custkey % 16 AS STRING), '-', lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0'), '-',
       lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0')) END AS host_since
FROM customer
""")
VIEWS["calendar"] = ("lineitem", """
SELECT l_partkey AS listing_id, CAST(l_shipdate AS DATE) AS date,
  CASE WHEN l_linestatus = 'F' THEN 'f' ELSE 't' END AS available,
  concat('$', CAST(CAST(floor(l_quantity) AS INT) AS STRING), '.00') AS price
FROM lineitem
""")
VIEWS["crime"] = ("orders", """
SELECT o_orderkey AS crime_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
       ELSE concat('Nation_', CAST(o_custkey % 24 AS STRING), ' 0', CAST(o_orderkey % 90 + 10 AS STRING), 'B') END AS lsoa_name
FROM orders
""")
VIEWS["stations"] = ("supplier", """
SELECT s_suppkey AS station_id,
  CAST(51.3 AS DOUBLE) + CAST((s_suppkey * 53) % 401 AS DOUBLE) / 1000 AS latitude,
  CAST(-0.5 AS DOUBLE) + CAST((s_suppkey * 17) % 797 AS DOUBLE) / 1000 AS longitude
FROM supplier
""")
VIEWS["tourist_spots"] = ("nation", """
SELECT n_nationkey AS spot_id,
  CAST(51.3 AS DOUBLE) + CAST((n_nationkey * 71) % 401 AS DOUBLE) / 1000 AS latitude,
  CAST(-0.5 AS DOUBLE) + CAST((n_nationkey * 29) % 797 AS DOUBLE) / 1000 AS longitude
FROM nation
""")
VIEWS["income_house"] = ("customer", """
SELECT CASE WHEN c_nationkey < 23 THEN concat('NATION_', CAST(c_nationkey AS STRING))
       ELSE concat('OUTSIDE_', CAST(c_nationkey AS STRING)) END AS borough,
  c_acctbal * 100 AS median_house_price, c_acctbal * 10 AS mean_household_income
FROM customer
""")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, text = VIEWS[name]
    df = table(spark, sf_dir, source)
    return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=df)


def with_views(*names: str) -> str:
    """A WITH clause defining the views for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in names)
