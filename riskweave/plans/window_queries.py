"""Windows over time and imputation."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskweave.operators import impute, rolling
from riskweave.plans import fixtures as X
from riskweave.plans.registry import query

W = f"WITH {X.SQL}"
CELL, TIME = ["pgid"], ["year", "quarter"]
BY = "PARTITION BY pgid ORDER BY year, quarter"


@query(f"{W} SELECT pgid, year, quarter, CASE WHEN count(*) OVER w >= 4 THEN sum(coalesce(n, 0)) OVER w ELSE 0 END AS x FROM quarterly WINDOW w AS ({BY} ROWS 3 PRECEDING)")
def rolling_sum_4q(spark, d):
    q = X.quarterly(spark, d).withColumn("n", F.coalesce("n", F.lit(0.0)))
    return q.select("pgid", "year", "quarter", rolling.full_sum("n", CELL, TIME, 4).alias("x"))


@query(
    f"""{W}, a AS (SELECT pgid, year, quarter, CASE WHEN count(*) OVER w >= 4 THEN sum(coalesce(n, 0)) OVER w ELSE 0 END AS s FROM quarterly WINDOW w AS ({BY} ROWS 3 PRECEDING))
    SELECT pgid, year, quarter, round(CASE WHEN count(*) OVER w >= 20 THEN avg(s) OVER w ELSE 0 END, 6) AS x FROM a WINDOW w AS ({BY} ROWS 19 PRECEDING)"""
)
def rolling_mean_20q(spark, d):
    q = X.quarterly(spark, d).withColumn("n", F.coalesce("n", F.lit(0.0))).withColumn("s", rolling.full_sum("n", CELL, TIME, 4))
    return q.select("pgid", "year", "quarter", F.round(rolling.full_mean("s", CELL, TIME, 20), 6).alias("x"))


@query(f"{W} SELECT pgid, year, quarter, round(CASE WHEN count(n) OVER w >= 3 THEN avg(n) OVER w END, 6) AS x FROM quarterly WINDOW w AS (PARTITION BY pgid, quarter ORDER BY year ROWS 4 PRECEDING)")
def seasonal_roll5(spark, d):
    return X.quarterly(spark, d).select("pgid", "year", "quarter", F.round(rolling.mean_of_at_least("n", ["pgid", "quarter"], ["year"], 5, 3), 6).alias("x"))


@query(f"{W} SELECT pgid, year, quarter, last_value(value IGNORE NULLS) OVER ({BY} ROWS UNBOUNDED PRECEDING) AS value FROM quarterly")
def ffill(spark, d):
    return impute.forward_fill(X.quarterly(spark, d), CELL, TIME, ["value"]).select("pgid", "year", "quarter", "value")


@query(f"{W} SELECT pgid, year, quarter, coalesce(last_value(value IGNORE NULLS) OVER ({BY} ROWS UNBOUNDED PRECEDING), first_value(value IGNORE NULLS) OVER ({BY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM quarterly")
def fill_all(spark, d):
    return impute.fill_all(X.quarterly(spark, d), CELL, TIME, ["value"]).select("pgid", "year", "quarter", "value")


def _lines(head: str, tail: str) -> str:
    """Interpolation by joins with the observations before and after each row."""
    through = lambda a, b: f"({a}.x + ({b}.x - {a}.x) * (r.t - {a}.t) / nullif({b}.t - {a}.t, 0))"
    ends = {"none": lambda near, a, b: "NULL", "fill": lambda near, a, b: f"{near}.x", "extrapolate": lambda near, a, b: through(a, b)}
    return f"""{W}, r AS (SELECT iso3, year, x, year - 1994 AS t FROM nation_years),
    o AS (SELECT *, row_number() OVER (PARTITION BY iso3 ORDER BY t) AS i, count(*) OVER (PARTITION BY iso3) AS m FROM r WHERE x IS NOT NULL)
    SELECT r.iso3, r.year, round(CASE WHEN r.x IS NOT NULL THEN r.x
      WHEN p.t IS NOT NULL AND n.t IS NOT NULL THEN {through('p', 'n')}
      WHEN p.t IS NULL THEN {ends[head]('n', 'o1', 'o2')} ELSE {ends[tail]('p', 'o3', 'o4')} END, 6) AS x
    FROM r ASOF LEFT JOIN o p ON r.iso3 = p.iso3 AND r.t >= p.t
    ASOF LEFT JOIN o n ON r.iso3 = n.iso3 AND r.t <= n.t
    LEFT JOIN o o1 ON o1.iso3 = r.iso3 AND o1.i = 1 LEFT JOIN o o2 ON o2.iso3 = r.iso3 AND o2.i = 2
    LEFT JOIN o o3 ON o3.iso3 = r.iso3 AND o3.i = o3.m - 1 LEFT JOIN o o4 ON o4.iso3 = r.iso3 AND o4.i = o4.m"""


def _interpolated(spark, d, head, tail):
    out = impute.interpolate(X.nation_years(spark, d), ["iso3"], ["year"], "x", head, tail)
    return out.select("iso3", "year", F.round("x", 6).alias("x"))


@query(_lines("extrapolate", "none"))
def interp_linear_head(spark, d):
    return _interpolated(spark, d, "extrapolate", "none")


@query(_lines("fill", "fill"))
def interp_fill_tails(spark, d):
    return _interpolated(spark, d, "fill", "fill")


@query(_lines("extrapolate", "extrapolate"))
def interp_extrapolate_both(spark, d):
    return _interpolated(spark, d, "extrapolate", "extrapolate")


@query(_lines("fill", "extrapolate"))
def interp_fill_extrapolate(spark, d):
    return _interpolated(spark, d, "fill", "extrapolate")


@query(_lines("fill", "none"))
def interp_fill_head(spark, d):
    return _interpolated(spark, d, "fill", "none")


@query(_lines("none", "none"))
def interp_interior(spark, d):
    return _interpolated(spark, d, "none", "none")


@query(f"{W} SELECT iso3, year, round(x / lag(x) OVER w - 1, 9) AS before, round((x - lag(x) OVER w) / x, 9) AS current FROM nation_years WINDOW w AS (PARTITION BY iso3 ORDER BY year)")
def growth(spark, d):
    return X.nation_years(spark, d).select("iso3", "year", F.round(rolling.growth("x", ["iso3"], ["year"]), 9).alias("before"), F.round(rolling.growth_of_current("x", ["iso3"], ["year"]), 9).alias("current"))


@query(f"{W} SELECT pgid, year, quarter, rank() OVER (PARTITION BY year, quarter ORDER BY n) + (count(*) OVER (PARTITION BY year, quarter, n) - 1) / 2.0 AS r FROM quarterly WHERE n IS NOT NULL")
def avg_rank(spark, d):
    q = X.quarterly(spark, d).where("n is not null")
    return q.select("pgid", "year", "quarter", rolling.average_rank(F.col("n"), TIME).alias("r"))


@query(
    f"""{W}, f AS (SELECT user_id, day, x > 40 AS f FROM daily), g AS (SELECT *, sum((NOT f)::INTEGER) OVER (PARTITION BY user_id ORDER BY day) AS run, max(day) OVER (PARTITION BY user_id) AS fin FROM f)
    SELECT user_id, min(day) AS "start", max(day) AS "end", count(*) AS length FROM g WHERE f GROUP BY user_id, run HAVING count(*) >= 3 AND max(day) < max(fin)"""
)
def heat_runs(spark, d):
    return rolling.runs(X.daily(spark, d), ["user_id"], "day", F.col("x") > 40, 3)


_FACTOR = math.exp(math.log(0.25) / 20)


@query(
    f"""{W.replace('WITH', 'WITH RECURSIVE', 1)}, s AS (SELECT pgid, year * 4 + quarter AS t, CASE WHEN n IS NULL AND t0 IS NULL THEN NULL ELSE coalesce(n, 0) / 10 END AS x
      FROM (SELECT *, max(n) OVER ({BY} ROWS UNBOUNDED PRECEDING) AS t0 FROM quarterly)),
    r AS (SELECT pgid, t, x AS v FROM s WHERE t = 1995 * 4 + 1
      UNION ALL SELECT s.pgid, s.t, CASE WHEN r.v IS NULL THEN s.x ELSE 0.5 * s.x + (1 - 0.5 * s.x) * {_FACTOR!r} * r.v END FROM r JOIN s ON s.pgid = r.pgid AND s.t = r.t + 1)
    SELECT pgid, t, round(v, 9) AS v FROM r"""
)
def decay_persistence(spark, d):
    from pyspark.sql import Window

    begun = F.max("n").over(Window.partitionBy("pgid").orderBy("year", "quarter").rowsBetween(Window.unboundedPreceding, 0))
    s = X.quarterly(spark, d).select("pgid", (F.col("year") * 4 + F.col("quarter")).alias("t"), F.when(begun.isNotNull(), F.coalesce("n", F.lit(0.0)) / 10).alias("x"))
    return rolling.decay(s, ["pgid"], "t", "x", 0.25, 5, 0.5, out="v").select("pgid", F.col("t").cast("long").alias("t"), F.round("v", 9).alias("v"))


@query(
    f"""{W}, c AS (SELECT pgid, year, quarter, n IS NULL AS gap, lag(n IS NULL) OVER ({BY}) AS before FROM quarterly)
    SELECT pgid, year, quarter, sum(coalesce((gap <> before)::INTEGER, 0)) OVER ({BY}) AS segment FROM c"""
)
def change_segments(spark, d):
    q = X.quarterly(spark, d).select("pgid", (F.col("year") * 4 + F.col("quarter")).alias("t"), "year", "quarter", F.col("n").isNull().alias("gap"))
    return rolling.segments(q, "gap", ["pgid"], "t").select("pgid", "year", "quarter", F.col("segment").cast("double").alias("segment"))


@query(
    f"""{W}, g AS (SELECT iso3, year, x, year * 100.0 + length(iso3) * year % 37 AS nat FROM nation_years),
    h AS (SELECT *, nat / lag(nat) OVER (PARTITION BY iso3 ORDER BY year) AS g0 FROM g),
    b AS (SELECT quantile_cont(g0, 0.01) AS lo, quantile_cont(g0, 0.99) AS hi FROM h),
    k AS (SELECT h.*, CASE WHEN g0 IS NOT NULL THEN greatest(least(g0, hi), lo) END AS gr, last_value(x IGNORE NULLS) OVER w AS l, count(x) OVER w AS seg FROM h, b WINDOW w AS (PARTITION BY iso3 ORDER BY year ROWS UNBOUNDED PRECEDING))
    SELECT iso3, year, round(coalesce(x, CASE WHEN sum((x IS NULL AND gr IS NULL)::INTEGER) OVER z = 0 THEN l * exp(sum(CASE WHEN x IS NULL THEN ln(gr) ELSE 0 END) OVER z) END), 6) AS extended
    FROM k WINDOW z AS (PARTITION BY iso3, seg ORDER BY year ROWS UNBOUNDED PRECEDING)"""
)
def growth_extension(spark, d):
    g = X.nation_years(spark, d).withColumn("nat", F.col("year") * 100.0 + F.length("iso3") * F.col("year") % 37)
    return impute.extend_by_growth(g, "iso3", "year", "x", "nat").select("iso3", "year", F.round("extended", 6).alias("extended"))
