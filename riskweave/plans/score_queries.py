"""Normalisation, aggregation and the risk chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import scores
from riskweave.operators import combine, rolling, scale
from riskweave.plans import fixtures as X
from riskweave.plans.registry import query
from riskweave.session import cut, table

W = f"WITH {X.SQL}"
KEYS = ["pgid", "year", "quarter"]


def _clip(x: str, lo: str, hi: str) -> str:
    return f"((least(greatest({x}, {lo}), {hi}) - {lo}) / nullif({hi} - {lo}, 0))"


@query(f"{W}, b AS (SELECT min(value) AS lo, max(value) AS hi FROM quarterly) SELECT pgid, year, quarter, round(CASE WHEN value IS NOT NULL THEN {_clip('value', 'lo', 'hi')} END, 9) AS x FROM quarterly, b")
def minmax(spark, d):
    return scale.scaled(X.quarterly(spark, d), "value", "x").select(*KEYS, F.round("x", 9).alias("x"))


@query(
    f"""{W}, z AS (SELECT pgid, year, quarter, CASE WHEN n IS NOT NULL THEN CASE WHEN n > 1 THEN value ELSE 0 END END AS v FROM quarterly),
    b AS (SELECT quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi FROM z WHERE v <> 0)
    SELECT pgid, year, quarter, round(CASE WHEN v IS NOT NULL THEN {_clip('v', 'lo', 'hi')} END, 9) AS x FROM z, b"""
)
def winsor_nonzero(spark, d):
    z = X.quarterly(spark, d).withColumn("v", F.when(F.col("n").isNotNull(), F.when(F.col("n") > 1, F.col("value")).otherwise(0.0)))
    return scale.scaled(z, "v", "x", (0.05, 0.95), nonzero=True).select(*KEYS, F.round("x", 9).alias("x"))


@query(
    f"""{W}, z AS (SELECT pgid, year, quarter, ln(1 + value) AS v FROM quarterly), b AS (SELECT quantile_cont(v, 0.005) AS lo, quantile_cont(v, 0.9995) AS hi FROM z WHERE year <= 1999)
    SELECT pgid, year, quarter, round(CASE WHEN v IS NOT NULL THEN {_clip('v', 'lo', 'hi')} END, 9) AS x FROM z, b"""
)
def ref_quantile_scale(spark, d):
    out = scale.scaled(X.quarterly(spark, d), "value", "x", (0.005, 0.9995), until=1999, transform="log1p")
    return out.select(*KEYS, F.round("x", 9).alias("x"))


@query(
    f"""{W}, z AS (SELECT pgid, year, quarter, CASE WHEN n IS NULL THEN 0.0 ELSE ln(1 + value) END AS v FROM quarterly),
    l AS (SELECT 1 - avg((v <> 0)::INTEGER) * (1 - 0.9) AS level FROM z),
    k AS (SELECT year, quarter, v, row_number() OVER (PARTITION BY year, quarter ORDER BY v) - 1 AS i, (count(*) OVER (PARTITION BY year, quarter) - 1) * (SELECT level FROM l) AS place FROM z),
    q AS (SELECT year, quarter, max(CASE WHEN i = floor(place) THEN v END) + (max(CASE WHEN i = ceil(place) THEN v END) - max(CASE WHEN i = floor(place) THEN v END)) * (max(place) - floor(max(place))) AS q FROM k GROUP BY ALL),
    t AS (SELECT year, quarter, CASE WHEN count(*) OVER w >= 8 THEN avg(q) OVER w END AS threshold FROM q WINDOW w AS (ORDER BY year, quarter ROWS 7 PRECEDING)),
    c AS (SELECT pgid, year, quarter, CASE WHEN threshold IS NOT NULL THEN least(v, threshold) END AS c FROM z JOIN t USING (year, quarter)),
    y AS (SELECT year, min(c) AS lo, max(c) AS hi FROM c GROUP BY year)
    SELECT pgid, c.year, quarter, round((c - lo) / nullif(hi - lo, 0), 8) AS x FROM c JOIN y USING (year)"""
)
def capped_by_time_quantile(spark, d):
    z = X.quarterly(spark, d).withColumn("v", F.when(F.col("n").isNull(), 0.0).otherwise(F.log1p("value")))
    return scale.capped_by_time(z, "v", "x", 0.9).select(*KEYS, F.round("x", 8).alias("x"))


@query(f"{W}, y AS (SELECT year, min(value) AS lo, max(value) AS hi FROM quarterly GROUP BY year) SELECT pgid, q.year, quarter, round((value - lo) / nullif(hi - lo, 0), 9) AS x FROM quarterly q JOIN y USING (year)")
def yearly_minmax(spark, d):
    return scale.scaled_within(X.quarterly(spark, d), "value", "x", ["year"]).select(*KEYS, F.round("x", 9).alias("x"))


_THREE = "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE (c_custkey % 100) / 100.0 END AS a, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE (c_custkey % 90 + 1) / 91.0 END AS b, CASE WHEN c_custkey % 77 = 0 OR c_custkey % 5 = 0 THEN NULL ELSE (c_custkey % 80 + 2) / 82.0 END AS c FROM customer"


def _three(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        "c_custkey", F.when(k % 7 != 0, (k % 100) / 100.0).alias("a"), F.when(k % 11 != 0, (k % 90 + 1) / 91.0).alias("b"),
        F.when((k % 77 != 0) & (k % 5 != 0), (k % 80 + 2) / 82.0).alias("c"),
    )


_PARTS = {"a": 2.0, "b": 1.0, "c": 1.0}
_DOWN = "((a IS NOT NULL)::INTEGER * 2.0 + (b IS NOT NULL)::INTEGER + (c IS NOT NULL)::INTEGER)"


def _sum(f: str) -> str:
    return " + ".join(f"coalesce({w} * {f.format(x)}, 0)" for x, w in _PARTS.items())


def _combined(spark, d, method, missing):
    three = _three(spark, d)
    return three.select("c_custkey", F.round(scores.combined(method, [(F.col(k), w) for k, w in _PARTS.items()], missing), 9).alias("x"))


@query(f"SELECT c_custkey, round(({_sum('{}')}) / nullif({_DOWN}, 0), 9) AS x FROM ({_THREE})")
def agg_mean_w(spark, d):
    return _combined(spark, d, "mean", "omit")


@query(f"SELECT c_custkey, round(CASE WHEN a = 0 THEN 0 ELSE exp(({_sum('ln(CASE WHEN {0} > 0 THEN {0} END)')}) / nullif({_DOWN}, 0)) END, 9) AS x FROM ({_THREE})")
def agg_gmean(spark, d):
    return _combined(spark, d, "gmean", "omit")


@query(f"SELECT c_custkey, round(sqrt(({_sum('{0} * {0}')}) / nullif({_DOWN}, 0)), 9) AS x FROM ({_THREE})")
def agg_pmean(spark, d):
    return _combined(spark, d, "pmean", "omit")


@query(f"SELECT c_custkey, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN sqrt((2 * a * a + b * b + c * c) / 4) END, 9) AS x FROM ({_THREE})")
def agg_propagate(spark, d):
    return _combined(spark, d, "pmean", "propagate")


@query(f"SELECT c_custkey, round((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif((a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER + (c IS NOT NULL)::INTEGER, 0), 9) AS mean, round(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0), 9) AS total FROM ({_THREE})")
def row_means(spark, d):
    cols = [F.col(x) for x in "abc"]
    return _three(spark, d).select("c_custkey", F.round(scores.row_mean(*cols), 9).alias("mean"), F.round(scores.row_sum(*cols), 9).alias("total"))


@query(
    """SELECT c_custkey, round(t - 273.15 + 0.5555 * (6.11 * exp(5417.753 * (1 / 273.15 - 1 / (t - 8))) - 10) + 273.15, 6) AS humidex,
      CASE WHEN k > 34 THEN round(k * k * 1e-4 * 6 / 6, 9) END AS ace, CASE WHEN k < 34 THEN 'TD' WHEN k < 64 THEN 'TS' ELSE 'HU' END AS class,
      round(((least(greatest(k, 20), 85) - 20) / 65 + (least(k / 4, 18) / 18 + least(k / 6, 15) / 15) / 2) / 2, 9) AS development, greatest(k - 50, 0) AS positive
    FROM (SELECT c_custkey, 290 + (c_custkey % 30)::DOUBLE AS t, (c_custkey % 120)::DOUBLE AS k FROM customer)"""
)
def climate_formulas(spark, d):
    t, k = (290 + F.col("c_custkey") % 30).cast("double"), (F.col("c_custkey") % 120).cast("double")
    return table(spark, d, "customer").select(
        "c_custkey", F.round(scores.humidex(t, t - 8), 6).alias("humidex"), F.round(scores.cyclone_energy(k, F.lit(6.0)), 9).alias("ace"), scores.storm_class(k).alias("class"),
        F.round(scores.development(k, k / 4, k / 6), 9).alias("development"), scores.zero_if_negative(k - 50).alias("positive"),
    )


def _indicators(spark, d):
    """Four indicators per cell and quarter and an exposure layer."""
    e = X.events(spark, d)
    sums = e.groupBy(*KEYS).agg(
        F.count("*").cast("double").alias("n"), F.sum("value").alias("value"),
        F.sum(F.when(F.col("kind").isin("1-URGENT", "2-HIGH"), 1.0).otherwise(0.0)).alias("urgent"), F.max("value").alias("peak"),
    )
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("n", "value", "urgent", "peak")}
    p = X.panel(spark, d).join(sums, KEYS, "left").withColumns(zero)
    p = p.withColumn("recent", rolling.full_sum("n", ["pgid"], ["year", "quarter"], 4).cast("double"))
    return scale.scaled_all(cut(p), [
        scale.Scaling("value", "CLI_now_value", until=1999, transform="log1p"), scale.Scaling("recent", "CLI_now_recent", transform="log1p"),
        scale.Scaling("urgent", "CON_level_urgent", transform="log1p"), scale.Scaling("peak", "CON_level_peak", (None, 0.99)),
    ])


INDEX = combine.Index.from_dict({
    "CLI_now": {"weights": {"CLI_now_value": 1, "CLI_now_recent": 2}, "method": "pmean"},
    "CON_level": {"weights": {"CON_level_urgent": 1, "CON_level_peak": 1}, "method": "mean"},
    "CLI": {"weights": {"CLI_now": 1}, "level": "pillar"},
    "CON": {"weights": {"CON_level": 1}, "level": "pillar"},
    "CLI_risk": {"weights": {"CLI": 1, "CON": 1}, "method": "gmean", "level": "risk"},
    "risk": {"weights": {"CLI_risk": 1, "CON": 1}, "method": "pmean", "level": "risk"},
})

_INDICATORS = f"""{W}, i0 AS (SELECT pgid, year, quarter, count(*)::DOUBLE AS n, sum(value) AS value, sum(CASE WHEN kind IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0 END) AS urgent, max(value) AS peak FROM ev GROUP BY ALL),
i1 AS (SELECT pgid, year, quarter, coalesce(n, 0) AS n, coalesce(i0.value, 0) AS value, coalesce(urgent, 0) AS urgent, coalesce(peak, 0) AS peak FROM panel LEFT JOIN i0 USING (pgid, year, quarter)),
i2 AS (SELECT *, CASE WHEN count(*) OVER w >= 4 THEN sum(n) OVER w ELSE 0 END AS recent FROM i1 WINDOW w AS (PARTITION BY pgid ORDER BY year, quarter ROWS 3 PRECEDING)),
b0 AS (SELECT max(ln(1 + value)) FILTER (year <= 1999) AS v1, min(ln(1 + value)) FILTER (year <= 1999) AS v0, max(ln(1 + recent)) AS r1, min(ln(1 + recent)) AS r0, max(ln(1 + urgent)) AS u1, min(ln(1 + urgent)) AS u0, quantile_cont(peak, 0.99) AS p1, min(peak) AS p0 FROM i2),
i3 AS (SELECT pgid, year, quarter, {_clip('ln(1 + value)', 'v0', 'v1')} AS a, {_clip('ln(1 + recent)', 'r0', 'r1')} AS b, {_clip('ln(1 + urgent)', 'u0', 'u1')} AS c, {_clip('peak', 'p0', 'p1')} AS d FROM i2, b0)"""

_CHAIN = f"""{_INDICATORS}, d0 AS (SELECT pgid, year, quarter, sqrt((a * a + 2 * b * b) / 3) AS cli, (c + d) / 2 AS con FROM i3),
d1 AS (SELECT pgid, year, quarter, (cli - min(cli) OVER ()) / (max(cli) OVER () - min(cli) OVER ()) AS cli, (con - min(con) OVER ()) / (max(con) OVER () - min(con) OVER ()) AS con FROM d0),
d2 AS (SELECT *, CASE WHEN cli = 0 OR con = 0 THEN 0 ELSE exp((ln(cli) + ln(con)) / 2) END AS g FROM d1),
d3 AS (SELECT pgid, year, quarter, cli, con, (g - min(g) OVER ()) / (max(g) OVER () - min(g) OVER ()) AS cli_risk FROM d2),
d4 AS (SELECT *, sqrt((cli_risk * cli_risk + con * con) / 2) AS p FROM d3)"""


@query(f"{_CHAIN} SELECT pgid, year, quarter, round(cli, 8) AS CLI, round(con, 8) AS CON, round(cli_risk, 8) AS CLI_risk, round((p - min(p) OVER ()) / (max(p) OVER () - min(p) OVER ()), 8) AS risk FROM d4")
def risk_chain(spark, d):
    out = combine.evaluate(_indicators(spark, d), INDEX)
    return out.select(*KEYS, *[F.round(c, 8).alias(c) for c in ("CLI", "CON", "CLI_risk", "risk")])


@query(
    f"""{W}, z AS (SELECT pgid, year, quarter, coalesce(n, 0) AS n, coalesce(value, 0) AS value FROM quarterly),
    e AS (SELECT quantile_cont(ln(1 + value), 0.99) AS hi, min(ln(1 + value)) AS lo FROM z WHERE year <= 1999),
    s AS (SELECT min(n) AS lo, max(n) AS hi FROM z),
    p AS (SELECT pgid, year, quarter, ln(1 + {_clip('n', 's.lo', 's.hi')} * {_clip('ln(1 + value)', 'e.lo', 'e.hi')}) AS p FROM z, e, s),
    b AS (SELECT quantile_cont(p, 0.0) AS lo, quantile_cont(p, 0.999) AS hi FROM p WHERE p <> 0)
    SELECT pgid, year, quarter, round({_clip('p', 'lo', 'hi')}, 8) AS x FROM p, b"""
)
def exposure_weighting(spark, d):
    z = X.quarterly(spark, d).withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("n", "value")})
    z = scale.scaled_all(cut(z), [scale.Scaling("value", "exposure", (None, 0.99), until=1999, transform="log1p"), scale.Scaling("n", "score")])
    return scale.exposed(z, "score", "exposure", "x").select(*KEYS, F.round("x", 8).alias("x"))
