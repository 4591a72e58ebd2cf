"""Smaller operators of panels, calendars and grids, and more recipes on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import calendar, cells
from riskweave.operators import events as E
from riskweave.operators import panel as P
from riskweave.operators import raster
from riskweave.plans import fixtures as X
from riskweave.plans.indicators import INDICATORS
from riskweave.plans.registry import query
from riskweave.session import table

W = f"WITH {X.SQL}"
KEYS = ["pgid", "year", "quarter"]


@query(
    """SELECT DISTINCT name, (((south + i / 2.0 + 0.25 + 90.25) * 2 - 1) * 720 + (west + j / 2.0 + 0.25 + 180.25) * 2)::INTEGER AS pgid
    FROM (SELECT lpad(abs(top)::VARCHAR, 2, '0') || CASE WHEN top >= 0 THEN 'N' ELSE 'S' END || '_' || lpad(abs(west)::VARCHAR, 3, '0') || CASE WHEN west >= 0 THEN 'E' ELSE 'W' END AS name, top - 10 AS south, west
      FROM (SELECT (c_custkey % 13 * 10 - 50)::INTEGER AS top, (c_custkey % 17 * 20 - 170)::INTEGER AS west FROM customer)), range(20) a(i), range(20) b(j)"""
)
def cells_of_tiles(spark, d):
    """From names of tiles to their cells."""
    k = F.col("c_custkey")
    names = table(spark, d, "customer").select(cells.tile_name((k % 13 * 10 - 60 + 1.25), (k % 17 * 20 - 170 + 3.75)).alias("name")).distinct()
    return names.select("name", F.explode(cells.tile_cells(F.col("name"))).alias("pgid"))


@query("SELECT DISTINCT event_id, time_bucket(INTERVAL 10 MINUTE, ts + INTERVAL 5 MINUTE) AS at FROM events")
def ten_minutes(spark, d):
    return table(spark, d, "events").select("event_id", calendar.nearest_minutes(F.col("ts").cast("timestamp")).alias("at")).distinct()


@query(
    """WITH q AS (SELECT DISTINCT o_custkey, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS name, date_trunc('quarter', o_orderdate) AS first FROM orders WHERE o_custkey % 10 = 0)
    SELECT o_custkey, name, count(*) AS days, max(day)::DATE AS last FROM (SELECT o_custkey, name, unnest(generate_series(first, first + INTERVAL 3 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM q WHERE name BETWEEN '1996Q2' AND '1998Q1') GROUP BY ALL"""
)
def quarter_day_ranges(spark, d):
    """The days of the quarters between two that customers have orders in."""
    o = table(spark, d, "orders").where("o_custkey % 10 = 0").withColumn("day", F.to_date("o_orderdate")).where(calendar.in_quarters(F.col("day"), F.lit("1996Q2"), F.lit("1998Q1")))
    q = o.select("o_custkey", calendar.quarter_name(F.col("day")).alias("name")).distinct()
    return q.select("o_custkey", "name", F.explode(calendar.quarter_days(F.col("name"))).alias("d")).groupBy("o_custkey", "name").agg(F.count("*").alias("days"), F.max("d").alias("last"))


@query(f"{W} SELECT pgid, y::INTEGER AS year, q::INTEGER AS quarter FROM entities, range(1996, 1999) a(y), range(1, 5) b(q) WHERE y * 4 + q BETWEEN 1996 * 4 + 2 AND 1998 * 4 + 1")
def last_complete_panel(spark, d):
    """The panel up to the last quarter that ended before a day."""
    return P.last_complete_panel(X.entities(spark, d), (1996, 2), F.lit("1998-06-30").cast("date")).select(*KEYS)


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderkey, o_totalprice) AS r FROM orders) WHERE r = 1")
def one_of_each(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return P.one_of_each(o, ["o_custkey"], ["o_orderstatus"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT user_id, event_type, ts::DATE AS day, round(max(value), 6) AS warmest, round(min(value), 6) AS coldest FROM events GROUP BY ALL")
def joined_alike(spark, d):
    """Two daily tables on all their keys, which must be the same."""
    e = table(spark, d, "events").groupBy("user_id", "event_type", F.to_date("ts").alias("day"))
    a, b = e.agg(F.round(F.max("value"), 6).alias("warmest")), e.agg(F.round(F.min("value"), 6).alias("coldest"))
    return P.joined_alike(a, b, ["user_id", "event_type", "day"])


@query(
    """WITH g AS (SELECT c_custkey AS pgid, c_custkey % 50 / 2.0 + 0.25 AS lon, c_custkey // 50 / 2.0 + 0.25 AS lat FROM customer),
    m AS (SELECT floor(s_suppkey % 40 * 0.7 / 0.5) AS i, floor(s_suppkey % 9 * 0.3 / 0.5) AS j, avg(s_acctbal) AS v FROM supplier GROUP BY ALL)
    SELECT pgid, round(v, 6) AS v FROM g LEFT JOIN m ON i = floor(lon / 0.5) AND j = floor(lat / 0.5)"""
)
def raster_on_grid(spark, d):
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    pixels = table(spark, d, "supplier").select((k % 40 * 0.7).alias("x"), (k % 9 * 0.3).alias("y"), F.col("s_acctbal").alias("v"))
    grid = table(spark, d, "customer").select(c.alias("pgid"), (c % 50 / 2 + 0.25).alias("lon"), (F.floor(c / 50) / 2 + 0.25).alias("lat"))
    return raster.on_grid(pixels, grid, "v").select("pgid", F.round("v", 6).alias("v"))


@query(f"{W} SELECT pgid, year, quarter, CASE WHEN pgid % 5 = 0 OR pgid % 10 / 10.0 + pgid % 4 / 10.0 <= 0.75 THEN n END AS n FROM quarterly")
def masked_by_share(spark, d):
    """Values of cells that are mostly barren or icy are missing; every fifth cell has no shares."""
    k = F.col("pgid")
    shares = X.entities(spark, d).where("pgid % 5 <> 0").select("pgid", (k % 10 / 10).alias("barren"), (k % 4 / 10).alias("ice"))
    return raster.masked_by_share(X.quarterly(spark, d), shares, "pgid", ["barren", "ice"], "n").select(*KEYS, "n")


@query(
    f"""{W}, s AS (SELECT e.iso3, ev.year, ev.quarter, unnest([kind, 'Civilians ' || status]) AS actor, value FROM ev JOIN entities e USING (pgid)), named AS (SELECT * FROM s WHERE NOT contains(lower(actor), 'civilians') AND NOT regexp_matches(actor, '^2-'))
    SELECT iso3, year, quarter, count(DISTINCT actor) AS actors FROM named GROUP BY ALL"""
)
def exploded_actors(spark, d):
    """Two sides of each event as rows, some names left out, counted once for each country and quarter."""
    e = X.events(spark, d).join(X.entities(spark, d), "pgid").withColumn("other", F.concat(F.lit("Civilians "), "status"))
    return E.actors(e, ["iso3", "year", "quarter"], ["kind", "other"], drop=["civilians"], drop_like="^2-")


def _run(name, tables):
    return INDICATORS[name].run(tables, start=1995).select(*KEYS, F.round(name, 8).alias("score"), F.round(f"{name}_raw", 6).alias("raw"))


def _counted(spark, d, hazard):
    urgent = X.events(spark, d).where("kind = '1-URGENT'").groupBy(*KEYS).agg(F.count("*").alias("count"))
    return _run(f"CLI_current_{hazard}", {"panel": X.panel(spark, d), f"{hazard}_counts": urgent})


_COUNTED = f"""{W}, u AS (SELECT pgid, year, quarter, count(*) AS c FROM ev WHERE kind = '1-URGENT' GROUP BY ALL),
z AS (SELECT p.pgid, p.year, p.quarter, CASE WHEN count(*) OVER w >= 4 THEN sum(coalesce(c, 0)) OVER w ELSE 0 END::DOUBLE AS raw FROM panel p LEFT JOIN u USING (pgid, year, quarter) WINDOW w AS (PARTITION BY pgid ORDER BY year, quarter ROWS 3 PRECEDING))"""
_LOGGED = f"{_COUNTED}, b AS (SELECT min(ln(1 + raw)) AS lo, max(ln(1 + raw)) AS hi FROM z) SELECT pgid, year, quarter, round((ln(1 + raw) - lo) / (hi - lo), 8) AS score, raw FROM z, b"


@query(_LOGGED)
def recipe_cyclones(spark, d):
    return _counted(spark, d, "cyclones")


@query(_LOGGED)
def recipe_wildfires(spark, d):
    return _counted(spark, d, "wildfires")


@query(f"{_COUNTED}, b AS (SELECT quantile_cont(raw, 0.005) AS lo, quantile_cont(raw, 0.9995) AS hi FROM z) SELECT pgid, year, quarter, round((greatest(least(raw, hi), lo) - lo) / (hi - lo), 8) AS score, raw FROM z, b")
def recipe_heavy_rain(spark, d):
    return _counted(spark, d, "heavy-precipitation")


@query(
    f"""{W}, s AS (SELECT pgid, year, quarter, avg(value) / 100000 - 1.5 AS spei FROM ev WHERE month(day) % 3 = 0 GROUP BY ALL), z AS (SELECT p.pgid, p.year, p.quarter, CASE WHEN spei < 0 THEN -spei WHEN spei IS NOT NULL THEN 0 END AS raw FROM panel p LEFT JOIN s USING (pgid, year, quarter)),
    b AS (SELECT quantile_cont(raw, 0.0) AS lo, quantile_cont(raw, 0.9995) AS hi FROM z) SELECT pgid, year, quarter, round(CASE WHEN raw IS NOT NULL THEN (least(raw, hi) - lo) / (hi - lo) END, 8) AS score, round(raw, 6) AS raw FROM z, b"""
)
def recipe_drought(spark, d):
    """Dryness from the last month of each quarter."""
    spei = X.events(spark, d).groupBy("pgid", "year", F.month("day").alias("month")).agg((F.avg("value") / 100000 - 1.5).alias("spei"))
    return _run("CLI_current_drought", {"panel": X.panel(spark, d), "spei": spei})


_2015 = "panel AS (SELECT pgid, 2015 + q // 4 AS year, q % 4 + 1 AS quarter FROM (SELECT (c_custkey + 1)::INTEGER AS pgid FROM customer), range(6) t(q))"


def _from_2015(spark, d):
    return P.entity_quarters(X.entities(spark, d), (2015, 1), (2016, 2))


@query(
    f"""WITH {_2015}, n AS (SELECT l_suppkey + 1 AS pgid, count(*) FILTER (l_linenumber % 4 > 0) AS land, count(*) FILTER (l_linenumber % 4 IN (2, 3)) AS fields, count(*) FILTER (l_linenumber % 4 = 3) AS rainfed FROM lineitem GROUP BY ALL)
    SELECT pgid, year::INTEGER AS year, quarter::INTEGER AS quarter, round(CASE WHEN year = 2015 AND fields::DOUBLE / land > 0.01 THEN rainfed::DOUBLE / land END, 8) AS score, round(CASE WHEN year = 2015 AND fields::DOUBLE / land > 0.01 THEN rainfed::DOUBLE / land END, 6) AS raw FROM panel LEFT JOIN n USING (pgid)"""
)
def recipe_irrigation(spark, d):
    pixels = table(spark, d, "lineitem").select((F.col("l_suppkey") + 1).cast("int").alias("pgid"), (F.col("l_linenumber") % 4).alias("value"))
    return _run("VUL_environmental_irrigation", {"panel": _from_2015(spark, d), "cropland_pixels": pixels})


@query(
    f"""WITH {_2015}, s AS (SELECT l_suppkey + 1 AS pgid, greatest(max(l_quantity) / 10 - 4.5, 0)::DOUBLE AS raw FROM lineitem GROUP BY ALL), z AS (SELECT pgid, year, quarter, raw FROM panel LEFT JOIN s USING (pgid)),
    b AS (SELECT min(ln(1 + raw)) AS lo, max(ln(1 + raw)) AS hi FROM z) SELECT pgid, year::INTEGER AS year, quarter::INTEGER AS quarter, round((ln(1 + raw) - lo) / (hi - lo), 8) AS score, round(raw, 6) AS raw FROM z, b"""
)
def recipe_sea_level(spark, d):
    rise = table(spark, d, "lineitem").select((F.col("l_suppkey") + 1).cast("int").alias("pgid"), (F.col("l_quantity").cast("double") / 10 - 4.5).alias("rise"))
    return _run("CLI_longterm_relative-sea-level", {"panel": _from_2015(spark, d), "sea_level": rise})
