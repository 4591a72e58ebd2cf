"""Validation of an index."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import combine, sensitivity
from riskweave.plans import fixtures as X
from riskweave.plans.registry import query
from riskweave.plans.score_queries import _CHAIN, _INDICATORS, _indicators, INDEX
from riskweave.session import table

W = f"WITH {X.SQL}"
_ABC = "SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS a, (c_custkey * 31 % 977)::DOUBLE AS b, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal * c_nationkey END AS c FROM customer"


def _abc(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        "c_custkey", F.when(k % 7 != 0, F.col("c_acctbal")).alias("a"), (k * 31 % 977).cast("double").alias("b"), F.when(k % 5 != 0, F.col("c_acctbal") * F.col("c_nationkey")).alias("c")
    )


@query(
    f"""WITH t AS ({_ABC}), r AS (SELECT 'a' AS a, 'b' AS b, corr(a, b) AS r, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS n FROM t
    UNION ALL SELECT 'a', 'c', corr(a, c), count(*) FILTER (a IS NOT NULL AND c IS NOT NULL) FROM t UNION ALL SELECT 'b', 'c', corr(b, c), count(*) FILTER (b IS NOT NULL AND c IS NOT NULL) FROM t)
    SELECT a, b, round(r, 9) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t FROM r"""
)
def pearson_matrix(spark, d):
    out = sensitivity.with_t(sensitivity.correlations(_abc(spark, d), ["a", "b", "c"]))
    return out.select("a", "b", F.round("r", 9).alias("r"), "n", F.round("t", 6).alias("t"))


@query(
    f"""WITH t AS ({_ABC}), q AS (SELECT quantile_cont(a, 0.9) AS qa, quantile_cont(b, 0.9) AS qb, quantile_cont(c, 0.9) AS qc FROM t),
    f AS (SELECT c_custkey, coalesce(a >= qa, false) AS x, coalesce(b >= qb, false) AS y, coalesce(c >= qc, false) AS z FROM t, q)
    SELECT c_custkey, CASE WHEN x AND y AND z THEN 5 WHEN x AND z THEN 4 WHEN y AND z THEN 3 WHEN x AND y THEN 2 WHEN x OR y OR z THEN 1 ELSE 0 END AS overlap FROM f"""
)
def overlap_classes(spark, d):
    return sensitivity.overlap_classes(_abc(spark, d), "a", "b", "c", 0.9).select("c_custkey", "overlap")


_SPEC = combine.Aggregate("score", {"CLI_now_value": 1.0, "CLI_now_recent": 2.0, "CON_level_peak": 1.0})
_LOO = f"""{_INDICATORS}, s0 AS (SELECT pgid, year, quarter, (a + 2 * b + d) / 4 AS s, (2 * b + d) / 3 AS s1, (a + d) / 2 AS s2, (a + 2 * b) / 3 AS s3 FROM i3),
s1 AS (SELECT pgid, year, quarter, {', '.join(f'({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}' for c in ('s', 's1', 's2', 's3'))} FROM s0),
dl AS (SELECT pgid, year, quarter, 'CLI_now_value' AS left_out, s1 - s AS delta FROM s1 UNION ALL SELECT pgid, year, quarter, 'CLI_now_recent', s2 - s FROM s1 UNION ALL SELECT pgid, year, quarter, 'CON_level_peak', s3 - s FROM s1)"""


def _deltas(spark, d):
    return sensitivity.leave_one_out(_indicators(spark, d), _SPEC, ["pgid", "year", "quarter"])


@query(f"{_LOO} SELECT pgid, year, quarter, left_out, round(delta, 8) + 0.0 AS delta FROM dl")
def loo_deltas(spark, d):
    return _deltas(spark, d).withColumn("delta", F.round("delta", 8) + 0.0)


@query(f"{_LOO} SELECT left_out, round(avg(delta), 8) AS mean, round(stddev_samp(delta), 8) AS sd, round(avg(abs(delta)), 8) AS mean_abs, round(stddev_samp(abs(delta)), 8) AS sd_abs FROM dl GROUP BY left_out")
def loo_summary(spark, d):
    out = sensitivity.summary(_deltas(spark, d))
    return out.select("left_out", *[F.round(c, 8).alias(c) for c in ("mean", "sd", "mean_abs", "sd_abs")])


@query(f"{_LOO} SELECT pgid, year, quarter, round(min(delta), 8) AS lowest, round(max(delta), 8) AS highest, round(stddev_samp(delta), 8) AS sd FROM dl GROUP BY ALL")
def loo_impact(spark, d):
    out = sensitivity.impact(_deltas(spark, d), ["pgid", "year", "quarter"])
    return out.select("pgid", "year", "quarter", *[F.round(c, 8).alias(c) for c in ("lowest", "highest", "sd")])


@query("SELECT least(floor((o_totalprice - 0) / 25000) + 1, 20)::INTEGER AS bin, count(*) AS n FROM orders WHERE o_totalprice BETWEEN 0 AND 500000 GROUP BY 1")
def histogram_20(spark, d):
    return sensitivity.histogram(table(spark, d, "orders"), "o_totalprice", 0.0, 500000.0, 20)


@query(f"{W}, f AS (SELECT pgid, year, quarter, last_value(value IGNORE NULLS) OVER (PARTITION BY pgid ORDER BY year, quarter ROWS UNBOUNDED PRECEDING) AS value FROM quarterly) SELECT pgid, value FROM f WHERE year = 2000 AND quarter = 2")
def quarter_snapshot(spark, d):
    at = (F.col("year") == 2000) & (F.col("quarter") == 2)
    return sensitivity.snapshot(X.quarterly(spark, d), ["pgid"], ["year", "quarter"], ["value"], at).select("pgid", "value")


@query(f"{_CHAIN}, k AS (SELECT *, ntile(10) OVER (ORDER BY p, pgid, year, quarter) AS t FROM d4) SELECT year, quarter, count(*) AS n, round(avg(cli), 8) AS cli, round(avg(con), 8) AS con FROM d4 GROUP BY ALL")
def risk_by_quarter(spark, d):
    out = combine.evaluate(_indicators(spark, d), INDEX)
    return out.groupBy("year", "quarter").agg(F.count("*").alias("n"), F.round(F.avg("CLI"), 8).alias("cli"), F.round(F.avg("CON"), 8).alias("con"))
