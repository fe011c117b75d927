"""The driver's tables in the roles of the domain: cells, zones, hourly and daily series, annual series, places.

Each role has the SQL that makes the same rows, as a WITH clause for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.functions.cells import Grid
from cellgrid.session import read_table

#: Customers in rows of 50 stand for grid cells.
WIDTH = 50
GRID = Grid(north=4.77, west=-75.95, step=0.00025, rows=520, cols=428)

CELLS = """cells AS (SELECT c_custkey AS cell_id, CAST(c_custkey // 50 AS INTEGER) AS row, CAST(c_custkey % 50 AS INTEGER) AS col,
    c_nationkey AS zone, c_acctbal AS value, CAST(c_custkey % 7 AS DOUBLE) AS weight, c_mktsegment AS class,
    CAST((c_custkey * 37) % 1000 AS DOUBLE) AS dist FROM customer)"""
HOURLY = "hourly AS (SELECT event_type AS var, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)"
DAILY = HOURLY + """, daily AS (SELECT var, CAST(ts AS DATE) AS day, count(value) AS n,
    CASE WHEN count(value) >= 18 THEN avg(value) END AS mean, CASE WHEN count(value) >= 18 THEN max(value) END AS max FROM hourly GROUP BY 1, 2)"""
MONTHLY = """monthly AS (SELECT o_orderpriority AS var, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
    avg(o_totalprice) AS value FROM orders GROUP BY 1, 2)"""
YEARLY = "yearly AS (SELECT o_orderpriority AS var, year(o_orderdate) AS year, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2)"
PLACES = """places AS (SELECT s_suppkey AS place, CAST((s_suppkey * 7919) % 1000 AS DOUBLE) AS x,
    CAST((s_suppkey * 104729) % 1000 AS DOUBLE) AS y, s_nationkey AS zone, s_acctbal AS size FROM supplier)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        key.alias("cell_id"), F.floor(key / WIDTH).cast("int").alias("row"), (key % WIDTH).cast("int").alias("col"),
        F.col("c_nationkey").alias("zone"), F.col("c_acctbal").alias("value"), (key % 7).cast("double").alias("weight"),
        F.col("c_mktsegment").alias("class"), ((key * 37) % 1000).cast("double").alias("dist"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's zone: a square of side 40 in a grid of 5 x 5, cut short by one corner."""
    k = F.col("n_nationkey")
    x, y = (k % 5) * 200.0, F.floor(k / 5) * 200.0
    corner = lambda a, b: F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y"))
    ring = F.array(corner(10, 10), corner(190, 10), corner(190, 100), corner(100, 190), corner(10, 190))
    return read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("zone_id"), k.alias("zone_idx"), ring.alias("ring"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return events.groupBy(F.col("event_type").alias("var"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.avg("value").alias("value"))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_orderpriority").alias("var"), F.trunc("o_orderdate", "month").alias("month")).agg(F.avg("o_totalprice").alias("value"))


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_orderpriority").alias("var"), F.year("o_orderdate").alias("year")).agg(F.avg("o_totalprice").alias("value"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        key.alias("place"), ((key * 7919) % 1000).cast("double").alias("x"), ((key * 104729) % 1000).cast("double").alias("y"),
        F.col("s_nationkey").alias("zone"), F.col("s_acctbal").alias("size"),
    )
