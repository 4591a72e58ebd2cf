"""The test tables in the roles of panel inputs, and the same in SQL.

Customers are cells, nations are countries, orders are dated events, daily
maxima per user of ``events`` are daily series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.panel import entity_quarters
from riskweave.session import table

FIRST, LAST = (1995, 1), (2001, 3)


def entities(spark: SparkSession, d: str) -> DataFrame:
    """(pgid, iso3): every customer as a cell, in its nation."""
    nations = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("iso3"))
    cells = table(spark, d, "customer").select((F.col("c_custkey") + 1).cast("int").alias("pgid"), "c_nationkey")
    return cells.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("pgid", "iso3")


def events(spark: SparkSession, d: str) -> DataFrame:
    """(pgid, year, quarter, day, value, kind, status) per order."""
    o = table(spark, d, "orders")
    return o.select(
        (F.col("o_custkey") + 1).cast("int").alias("pgid"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"),
        F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("value"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("id"),
    )


def panel(spark: SparkSession, d: str) -> DataFrame:
    return entity_quarters(entities(spark, d), FIRST, LAST)


def quarterly(spark: SparkSession, d: str) -> DataFrame:
    """The panel with n and value per quarter, NULL in quarters without events."""
    sums = events(spark, d).groupBy("pgid", "year", "quarter").agg(F.count("*").cast("double").alias("n"), F.sum("value").alias("value"))
    return panel(spark, d).join(sums, ["pgid", "year", "quarter"], "left")


def yearly(spark: SparkSession, d: str) -> DataFrame:
    """(iso3, year, x): mean event value, years without remainder by 3 removed for some nations."""
    e = events(spark, d).join(entities(spark, d), "pgid")
    means = e.groupBy("iso3", "year").agg(F.avg("value").alias("x"))
    return means.where((F.col("year") + F.length("iso3")) % 3 != 0)


def nation_years(spark: SparkSession, d: str) -> DataFrame:
    """Every nation in every year, ``x`` with gaps."""
    keys = entities(spark, d).select("iso3").distinct().withColumn("year", F.explode(F.sequence(F.lit(1994), F.lit(2002))))
    return keys.join(yearly(spark, d), ["iso3", "year"], "left")


def daily(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, day, x): the daily maximum."""
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("x"))


#: The same as SQL, to stand after WITH.
SQL = """
entities AS (SELECT (c_custkey + 1)::INTEGER AS pgid, n_name AS iso3 FROM customer JOIN nation ON c_nationkey = n_nationkey),
ev AS (SELECT (o_custkey + 1)::INTEGER AS pgid, year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter, o_orderdate::DATE AS day,
       o_totalprice AS value, o_orderpriority AS kind, o_orderstatus AS status, o_orderkey AS id FROM orders),
panel AS (SELECT pgid, iso3, y::INTEGER AS year, q::INTEGER AS quarter, make_date(y::INTEGER, q::INTEGER * 3 - 2, 1) AS time
       FROM entities, range(1995, 2002) a(y), range(1, 5) b(q) WHERE y * 4 + q <= 2001 * 4 + 3),
sums AS (SELECT pgid, year, quarter, count(*)::DOUBLE AS n, sum(value) AS value FROM ev GROUP BY ALL),
quarterly AS (SELECT p.*, s.n, s.value FROM panel p LEFT JOIN sums s USING (pgid, year, quarter)),
yearly AS (SELECT * FROM (SELECT iso3, year, avg(value) AS x FROM ev JOIN entities USING (pgid) GROUP BY ALL) WHERE (year + length(iso3)) % 3 <> 0),
nation_years AS (SELECT k.iso3, k.year, y.x FROM (SELECT DISTINCT iso3, r::INTEGER AS year FROM entities, range(1994, 2003) t(r)) k LEFT JOIN yearly y USING (iso3, year)),
daily AS (SELECT user_id, ts::DATE AS day, max(value) AS x FROM events GROUP BY ALL)
"""
