"""Some of the indicator recipes on the test tables, as examples of binding them to data."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.plans import fixtures as X
from riskweave.plans.indicators import INDICATORS
from riskweave.plans.registry import query
from riskweave.session import table
from riskweave.streaming import counts

W = f"WITH {X.SQL}"
KEYS = ["pgid", "year", "quarter"]


def _run(name, tables):
    return INDICATORS[name].run(tables, start=1995).select(*KEYS, F.round(name, 8).alias("score"), F.round(f"{name}_raw", 6).alias("raw"))


def _counted(spark, d):
    """Urgent orders as a hazard's counts."""
    urgent = X.events(spark, d).where("kind = '1-URGENT'").groupBy(*KEYS).agg(F.count("*").alias("count"))
    return {"panel": X.panel(spark, d), "floods_counts": urgent, "heatwave_counts": urgent}


_COUNTED = f"""{W}, u AS (SELECT pgid, year, quarter, count(*) AS c FROM ev WHERE kind = '1-URGENT' GROUP BY ALL),
z AS (SELECT p.pgid, p.year, p.quarter, CASE WHEN count(*) OVER w >= 4 THEN sum(coalesce(c, 0)) OVER w ELSE 0 END::DOUBLE AS raw FROM panel p LEFT JOIN u USING (pgid, year, quarter) WINDOW w AS (PARTITION BY pgid ORDER BY year, quarter ROWS 3 PRECEDING))"""


@query(f"{_COUNTED}, b AS (SELECT min(ln(1 + raw)) AS lo, max(ln(1 + raw)) AS hi FROM z) SELECT pgid, year, quarter, round((ln(1 + raw) - lo) / (hi - lo), 8) AS score, raw FROM z, b")
def recipe_floods(spark, d):
    return _run("CLI_current_floods", _counted(spark, d))


@query(f"{_COUNTED}, b AS (SELECT quantile_cont(raw, 0.0) AS lo, quantile_cont(raw, 0.9995) AS hi FROM z) SELECT pgid, year, quarter, round((least(raw, hi) - lo) / (hi - lo), 8) AS score, raw FROM z, b")
def recipe_heatwave(spark, d):
    return _run("CLI_current_heatwave", _counted(spark, d))


_CAP = """l AS (SELECT 1 - avg((v <> 0)::INTEGER) * 0.01 AS level FROM z WHERE v IS NOT NULL),
k AS (SELECT year, quarter, v, row_number() OVER (PARTITION BY year, quarter ORDER BY v) - 1 AS i, (count(v) OVER (PARTITION BY year, quarter) - 1) * (SELECT level FROM l) AS place FROM z WHERE v IS NOT NULL),
q AS (SELECT year, quarter, max(CASE WHEN i = floor(place) THEN v END) + (max(CASE WHEN i = ceil(place) THEN v END) - max(CASE WHEN i = floor(place) THEN v END)) * (max(place) - floor(max(place))) AS q FROM k GROUP BY ALL),
qs AS (SELECT DISTINCT z.year, z.quarter, q.q FROM z LEFT JOIN q USING (year, quarter)),
t AS (SELECT year, quarter, CASE WHEN count(q) OVER w >= 8 THEN avg(q) OVER w END AS threshold FROM qs WINDOW w AS (ORDER BY year, quarter ROWS 7 PRECEDING)),
c AS (SELECT pgid, year, quarter, raw, CASE WHEN threshold IS NOT NULL AND v IS NOT NULL THEN least(v, threshold) END AS c FROM z JOIN t USING (year, quarter)),
y AS (SELECT year, min(c) AS lo, max(c) AS hi FROM c GROUP BY year)
SELECT pgid, c.year, quarter, round((c - lo) / nullif(hi - lo, 0), 8) AS score, raw FROM c JOIN y USING (year)"""


@query(f"{W}, cov AS (SELECT DISTINCT iso3, make_date(1995 + length(iso3) % 3, 1, 1) AS start FROM entities), a AS (SELECT pgid, year, quarter, sum(CASE WHEN status = 'F' THEN 10.0 ELSE 0 END) AS f FROM ev GROUP BY ALL), z AS (SELECT pgid, year, quarter, CASE WHEN time >= start THEN coalesce(f, 0) END AS raw, ln(1 + CASE WHEN time >= start THEN coalesce(f, 0) END) AS v FROM panel LEFT JOIN cov USING (iso3) LEFT JOIN a USING (pgid, year, quarter)), {_CAP}")
def recipe_conflict_intensity(spark, d):
    events = X.events(spark, d).select(*KEYS, (F.col("status") == "F").alias("armed"), (F.col("status") == "O").alias("unrest"), F.lit(10.0).alias("fatalities"))
    cov = X.entities(spark, d).select("iso3").distinct().withColumn("coverage_start", F.make_date(1995 + F.length("iso3") % 3, F.lit(1), F.lit(1)))
    return _run("CON_level_intensity", {"panel": X.panel(spark, d), "conflict_events": events, "coverage": cov})


@query("SELECT event_type, date_trunc('day', ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def windowed_counts(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return counts.windowed(e, "ts", ["event_type"], "value").withColumn("total", F.round("total", 4))


@query(
    """WITH g AS (SELECT user_id, ts, coalesce(ts >= lag(ts) OVER w + INTERVAL 6 HOUR, true)::INTEGER AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k"""
)
def session_counts(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return counts.sessions(e, "ts", ["user_id"], gap="6 hours")
