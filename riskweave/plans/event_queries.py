"""Events to counts, intervals, thresholds and tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import cells
from riskweave.operators import events as E
from riskweave.plans import fixtures as X
from riskweave.plans import hazards
from riskweave.plans.registry import query
from riskweave.session import table

W = f"WITH {X.SQL}"


@query(
    f"""{W} SELECT pgid, year, quarter, count(*) AS n_all, round(sum(value), 4) AS sum_all, count(*) FILTER (kind = '1-URGENT') AS n_urgent, round(coalesce(sum(value) FILTER (kind = '1-URGENT'), 0), 4) AS sum_urgent,
    count(*) FILTER (status = 'O') AS n_open, round(coalesce(sum(value) FILTER (status = 'O'), 0), 4) AS sum_open FROM ev GROUP BY ALL"""
)
def event_class_counts(spark, d):
    out = E.counts_by_class(X.events(spark, d), ["pgid", "year", "quarter"], {"urgent": F.col("kind") == "1-URGENT", "open": F.col("status") == "O"}, "value")
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c.startswith("sum_")})


@query(f"{W} SELECT iso3, year, quarter, count(DISTINCT pgid) AS cells FROM ev JOIN entities USING (pgid) GROUP BY ALL")
def distinct_per_cell(spark, d):
    return X.events(spark, d).join(X.entities(spark, d), "pgid").groupBy("iso3", "year", "quarter").agg(F.countDistinct("pgid").alias("cells"))


@query(f"{W} SELECT iso3, year, quarter, round(count(*) FILTER (n >= 1) / count(*), 9) AS extent FROM quarterly GROUP BY ALL")
def extent_share(spark, d):
    return X.quarterly(spark, d).groupBy("iso3", "year", "quarter").agg(F.round(F.sum((F.coalesce("n", F.lit(0.0)) >= 1).cast("int")) / F.count("*"), 9).alias("extent"))


@query(
    """WITH l AS (SELECT l_orderkey, max(l_shipdate)::DATE AS fin, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey),
    i AS (SELECT o_custkey, o_orderdate::DATE AS s, least(fin, o_orderdate::DATE + 40) AS e, q FROM orders JOIN l ON l_orderkey = o_orderkey)
    SELECT o_custkey, year(day)::INTEGER AS year, quarter(day)::INTEGER AS quarter, round(sum(q / (e - s + 1)), 6) AS q
    FROM (SELECT *, unnest(generate_series(s, e, INTERVAL 1 DAY))::DATE AS day FROM i WHERE e >= s) GROUP BY ALL"""
)
def interval_spread(spark, d):
    fin = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.max("l_shipdate")).alias("fin"), F.sum("l_quantity").alias("q"))
    start = F.to_date("o_orderdate")
    i = table(spark, d, "orders").join(fin, "o_orderkey").select("o_custkey", start.alias("s"), F.least("fin", F.date_add(start, 40)).alias("e"), "q")
    return E.spread(i, "s", "e", ["q"]).groupBy("o_custkey", F.year("day").alias("year"), F.quarter("day").alias("quarter")).agg(F.round(F.sum("q"), 6).alias("q"))


@query(
    f"""{W}, n AS (SELECT user_id % 20 AS k, x, strftime(day + o::INTEGER, '%m_%d') AS doy FROM daily, range(-3, 4) t(o))
    SELECT k, doy, round(quantile_cont(x, 0.95), 6) AS p95, round(quantile_cont(x, 0.25), 6) AS p25 FROM n GROUP BY ALL"""
)
def doy_quantile_window(spark, d):
    days = X.daily(spark, d).withColumn("k", F.col("user_id") % 20)
    out = E.by_day_of_year(days, ["k"], "day", "x", [0.95, 0.25], reach=3)
    return out.select("k", "doy", F.round("p95", 6).alias("p95"), F.round("p25", 6).alias("p25"))


@query(
    f"""{W}, l AS (SELECT iso3, quantile_cont(n, 0.95) AS lim FROM q0 WHERE year <= 1998 GROUP BY iso3), q0 AS (SELECT iso3, year, quarter, count(*) AS n FROM ev JOIN entities USING (pgid) GROUP BY ALL)
    SELECT iso3, year, quarter, CASE WHEN n > coalesce(lim, 0) THEN n ELSE 0 END AS n FROM q0 LEFT JOIN l USING (iso3)""".replace("l AS (SELECT iso3, quantile_cont(n, 0.95) AS lim FROM q0 WHERE year <= 1998 GROUP BY iso3), q0 AS (SELECT iso3, year, quarter, count(*) AS n FROM ev JOIN entities USING (pgid) GROUP BY ALL)", "q0 AS (SELECT iso3, year, quarter, count(*) AS n FROM ev JOIN entities USING (pgid) GROUP BY ALL), l AS (SELECT iso3, quantile_cont(n, 0.95) AS lim FROM q0 WHERE year <= 1998 GROUP BY iso3)")
)
def above_usual(spark, d):
    n = X.events(spark, d).join(X.entities(spark, d), "pgid").groupBy("iso3", "year", "quarter").agg(F.count("*").alias("n"))
    return E.above_usual(n, ["iso3"], "n", 0.95, F.col("year") <= 1998)


@query(
    f"""{W}, t AS (SELECT pgid, quantile_cont(value, 0.5) AS threshold FROM ev GROUP BY pgid)
    SELECT id, pgid FROM ev JOIN t USING (pgid) WHERE value > threshold AND value >= 200000"""
)
def over_threshold(spark, d):
    e = X.events(spark, d)
    t = e.groupBy("pgid").agg(F.percentile("value", 0.5).alias("threshold"))
    return E.over_threshold(e, t, ["pgid"], "value", 200000.0).select("id", "pgid")


@query(
    """WITH f AS (SELECT user_id, ts, max(value) AS v FROM events GROUP BY ALL),
    g AS (SELECT user_id, ts, v, lead(ts) OVER w AS t2, lead(v) OVER w AS v2 FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    h AS (SELECT *, unnest(generate_series(date_trunc('hour', ts + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND), t2 - INTERVAL 1 MICROSECOND, INTERVAL 1 HOUR)) AS hour FROM g WHERE t2 IS NOT NULL)
    SELECT user_id, hour, round(v + (v2 - v) * (epoch_us(hour) - epoch_us(ts)) / (epoch_us(t2) - epoch_us(ts)), 6) AS v FROM h"""
)
def track_hours(spark, d):
    f = table(spark, d, "events").groupBy("user_id", "ts").agg(F.max("value").alias("v"))
    return E.hourly_track(f, "user_id", "ts", ["v"]).select("user_id", "hour", F.round("v", 6).alias("v"))


@query("SELECT user_id, round(CASE WHEN count(value) >= 5 THEN avg(value) END, 6) AS mean_value FROM events GROUP BY user_id")
def requested_mean(spark, d):
    return E.requested(table(spark, d, "events"), ["user_id"], "mean value").select("user_id", F.round("mean_value", 6).alias("mean_value"))


@query("SELECT user_id, round(quantile_cont(value, 0.9), 6) AS p FROM events GROUP BY user_id")
def requested_percentile(spark, d):
    return E.requested(table(spark, d, "events"), ["user_id"], "percentile 90 value").select("user_id", F.round("percentile_90_value", 6).alias("p"))


@query("SELECT event_id, user_id FROM events WHERE value >= 10 AND value <= 90 AND event_type IN ('click', 'view') AND year(ts) BETWEEN 2020 AND 2030")
def storm_filter(spark, d):
    f = table(spark, d, "events").withColumn("type", F.col("event_type")).withColumn("season", F.year("ts"))
    return E.storms(f, {"value": 10.0}, {"value": 90.0}, ["click", "view"], (2020, 2030)).select("event_id", "user_id")


@query("SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n, round(avg((props::JSON->>'k')::DOUBLE), 6) AS k FROM events GROUP BY ALL")
def json_daily_counts(spark, d):
    e = table(spark, d, "events").withColumn("k", F.from_json("props", "k double")["k"])
    return e.groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.avg("k"), 6).alias("k"))


@query(
    f"""{W}, a AS (SELECT iso3, year, quarter, pgid, count(*) AS c FROM ev JOIN entities USING (pgid) GROUP BY ALL)
    SELECT iso3, year, quarter, count(*) AS actors, sum(c)::BIGINT AS events FROM a GROUP BY ALL"""
)
def actor_counts(spark, d):
    a = X.events(spark, d).join(X.entities(spark, d), "pgid").groupBy("iso3", "year", "quarter", "pgid").agg(F.count("*").alias("c"))
    return a.groupBy("iso3", "year", "quarter").agg(F.count("*").alias("actors"), F.sum("c").alias("events"))


# Hazard counts: orders stand for the raw records, the cell of each gives its place.


def _placed(df):
    return df.withColumns({"lat": cells.cell_lat(F.col("pgid")), "lon": cells.cell_lon(F.col("pgid"))})


@query(f"{W} SELECT pgid, year, quarter, count(DISTINCT day) AS count FROM ev WHERE value > 100000 GROUP BY ALL")
def flood_day_counts(spark, d):
    discharge = _placed(X.events(spark, d)).select("lat", "lon", "day", F.col("value").alias("discharge"))
    limits = _placed(X.entities(spark, d)).select("lat", "lon", F.lit(100000.0).alias("limit"))
    return hazards.flood_days(discharge, limits)


@query(f"{W} SELECT pgid, year, quarter, count(DISTINCT kind) AS count FROM ev GROUP BY ALL")
def storm_visit_counts(spark, d):
    return hazards.storm_visits(X.events(spark, d).select(F.col("kind").alias("storm"), "day", "pgid"))


@query(
    f"""{W}, n AS (SELECT pgid, year, quarter, count(*) AS n FROM ev WHERE 90 + id % 10 > 95 AND id % 2 = 0 GROUP BY ALL),
    l AS (SELECT pgid, quantile_cont(n, 0.95) AS usual FROM n WHERE year BETWEEN 2000 AND 2010 GROUP BY pgid)
    SELECT pgid, year, quarter, CASE WHEN n > coalesce(usual, 0) THEN n ELSE 0 END AS count FROM n LEFT JOIN l USING (pgid)"""
)
def fire_counts(spark, d):
    fires = _placed(X.events(spark, d)).select("lat", "lon", "day", (90 + F.col("id") % 10).alias("confidence"), (F.col("id") % 2).alias("type"))
    return hazards.fires_above_usual(fires)


@query(
    f"""{W}, l AS (SELECT pgid, quantile_cont(value / 1e7, 0.99) AS usual FROM ev WHERE year BETWEEN 1992 AND 1996 AND value / 1e7 > 0.001 GROUP BY pgid)
    SELECT pgid, year, quarter, count(*) AS count FROM ev JOIN l USING (pgid) WHERE value / 1e7 > usual AND value / 1e7 >= 0.01 GROUP BY ALL"""
)
def heavy_rain_counts(spark, d):
    daily = X.events(spark, d).select("pgid", "day", (F.col("value") / 1e7).alias("rain"))
    return hazards.heavy_rain_days(daily, (1992, 1996))


@query(
    f"""{W}, n AS (SELECT user_id % 20 AS k, x, strftime(day + o::INTEGER, '%m_%d') AS doy FROM daily, range(-3, 4) t(o)), q AS (SELECT k, doy, quantile_cont(x, 0.9) AS p90 FROM n GROUP BY ALL)
    SELECT user_id, day, round(x, 6) AS x FROM (SELECT user_id, day, x, user_id % 20 AS k, strftime(day, '%m_%d') AS doy FROM daily) JOIN q USING (k, doy) WHERE round(x, 6) > round(p90, 6)"""
)
def day_threshold_join(spark, d):
    """Days above what is usual at their time of the year."""
    days = X.daily(spark, d).withColumn("k", F.col("user_id") % 20)
    limits = E.by_day_of_year(days, ["k"], "day", "x", [0.9], reach=3)
    return E.with_day_thresholds(days, limits, ["k"], "day").where(F.round("x", 6) > F.round("p90", 6)).select("user_id", "day", F.round("x", 6).alias("x"))
