"""Tracks over the date line, changes over windows of time, and values nearest in time."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import sensitivity, tracks
from riskweave.plans.registry import query
from riskweave.session import table


def _fixes(spark, d):
    """Users as tracks that wander over the date line."""
    e = table(spark, d, "events").groupBy("user_id", "ts").agg(F.max("value").alias("v"))
    return e.select("user_id", "ts", (F.col("v") % 40 - 20).alias("lat"), tracks.wrapped(170 + F.col("v") * 7 % 20).alias("lon"), "v")


_FIXES = "WITH f AS (SELECT user_id, ts, v % 40 - 20 AS lat, (170 + v * 7 % 20 + 180) % 360 - 180 AS lon, v FROM (SELECT user_id, ts, max(value) AS v FROM events GROUP BY ALL))"
_HOURS = f"""{_FIXES}, g AS (SELECT *, lead(ts) OVER w AS t2, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2, lead(v) OVER w AS v2 FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
h AS (SELECT *, unnest(generate_series(date_trunc('hour', ts + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND), t2 - INTERVAL 1 MICROSECOND, INTERVAL 1 HOUR)) AS hour FROM g WHERE t2 IS NOT NULL),
s AS (SELECT user_id, hour, (epoch_us(hour) - epoch_us(ts)) / (epoch_us(t2) - epoch_us(ts))::DOUBLE AS k, lat, lat2, lon, lon2, v, v2 FROM h),
p AS (SELECT user_id, hour, lat + (lat2 - lat) * k AS lat, (lon + ((lon2 - lon + 540) % 360 - 180) * k + 540) % 360 - 180 AS lon, v + (v2 - v) * k AS v FROM s
  UNION ALL SELECT user_id, ts, lat, lon, v FROM g WHERE t2 IS NULL AND date_trunc('hour', ts) = ts)"""


@query(f"{_HOURS} SELECT user_id, hour, round(lat, 6) AS lat, round(lon, 6) AS lon FROM p")
def track_dateline(spark, d):
    out = tracks.hourly(_fixes(spark, d), "user_id", "ts", ["v"])
    return out.select("user_id", "hour", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


_RATES = f"""{_HOURS}, m AS (SELECT user_id, hour, v - lag(v) OVER w AS dv, ((lon - lag(lon) OVER w + 540) % 360 - 180) * cos(radians((lat + lag(lat) OVER w) / 2)) * {tracks.MILES} AS dx, (lat - lag(lat) OVER w) * {tracks.MILES} AS dy
FROM p WINDOW w AS (PARTITION BY user_id ORDER BY hour))"""


@query(
    f"""{_RATES}, r AS (SELECT user_id, hour, count(dv) OVER w AS n, sum(dv) OVER w AS change, avg(sqrt(dx * dx + dy * dy)) OVER w AS speed
    FROM m WINDOW w AS (PARTITION BY user_id ORDER BY hour RANGE BETWEEN INTERVAL 11 HOUR PRECEDING AND INTERVAL 12 HOUR FOLLOWING))
    SELECT user_id, hour, round(CASE WHEN n = 24 THEN change END, 5) AS change, round(CASE WHEN n = 24 THEN speed END, 5) AS speed FROM r"""
)
def track_window(spark, d):
    """Change and mean speed over the day around each hour."""
    moved = tracks.motion(tracks.hourly(_fixes(spark, d), "user_id", "ts", ["v"]), "user_id", "hour", ["v"])
    out = tracks.over_window(moved, "user_id", "hour", 24, ["dv_dt"], ["speed"])
    return out.select("user_id", "hour", F.round("dv_dt", 5).alias("change"), F.round("speed", 5).alias("speed"))


@query(
    """WITH s AS (SELECT o_custkey AS k, o_orderdate::DATE AS day, max(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
    w AS (SELECT DISTINCT o_custkey AS k, (o_orderdate + INTERVAL 20 DAY)::DATE AS day FROM orders),
    d AS (SELECT w.k, w.day, s.price, row_number() OVER (PARTITION BY w.k, w.day ORDER BY abs(date_diff('day', s.day, w.day)), s.day) AS r FROM w JOIN s ON s.k = w.k AND abs(date_diff('day', s.day, w.day)) <= 31)
    SELECT w.k, w.day, price FROM w LEFT JOIN (SELECT * FROM d WHERE r = 1) USING (k, day)"""
)
def nearest_in_time(spark, d):
    """The price of the nearest order of a status within 31 days."""
    o = table(spark, d, "orders")
    series = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"))
    wanted = o.select(F.col("o_custkey").alias("k"), F.date_add(F.to_date("o_orderdate"), 20).alias("day")).distinct()
    return tracks.nearest_in_time(wanted, series, ["k"], "day", "price", 31)


@query(
    """WITH c AS (SELECT corr(l_quantity, l_discount) AS r, count(*) AS n FROM lineitem) SELECT 'quantity' AS a, 'discount' AS b, round(r, 8) AS r, n FROM c"""
)
def correlation_p(spark, d):
    """The correlation of two columns that have nothing to do with each other; p is checked to be a probability where the rows are many."""
    line = table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("quantity"), F.col("l_discount").cast("double").alias("discount"))
    found = sensitivity.with_p(sensitivity.correlations(line, ["quantity", "discount"]))
    sure = F.when(~F.coalesce(F.col("p").between(0, 1), F.lit(False)), F.raise_error(F.lit("p is missing")).cast("double")).otherwise(F.round("r", 8))
    return found.select("a", "b", sure.alias("r"), "n")
