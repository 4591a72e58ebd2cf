"""The recipes of long-term climate on the test tables, with SQL.

Orders of one priority stand for a hazard's counts. The panel of 2013-2022 holds more than seven years.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators.panel import entity_quarters
from riskweave.plans import fixtures as X
from riskweave.plans.country_queries import BASE, SHIFT, figures, rows, run
from riskweave.plans.registry import query


def _panel(spark, d):
    return entity_quarters(X.entities(spark, d), (2013, 1), (2022, 3))


_LONG = f"{BASE}, pl AS (SELECT pgid, iso3, 2013 + k // 4 AS year, k % 4 + 1 AS quarter, 2013 * 4 + k AS t FROM entities, range(39) r(k))"


def _counted(kind: str) -> str:
    """Yearly sums, then their means over seven years; 0 until there are as many quarters."""
    return f"""{_LONG}, u AS (SELECT pgid, year + {SHIFT} AS year, quarter, count(*) AS c FROM ev WHERE kind = '{kind}' GROUP BY ALL),
    a AS (SELECT pl.*, CASE WHEN count(*) OVER w = 4 THEN sum(coalesce(c, 0)) OVER w ELSE 0 END AS s FROM pl LEFT JOIN u USING (pgid, year, quarter) WINDOW w AS (PARTITION BY pgid ORDER BY t ROWS 3 PRECEDING)),
    p AS (SELECT pgid, year, quarter, CASE WHEN count(*) OVER w = 28 THEN sum(s) OVER w / 28.0 ELSE 0 END AS raw FROM a WINDOW w AS (PARTITION BY pgid ORDER BY t ROWS 27 PRECEDING))"""


_LOGGED = rows("p", "(ln(1 + raw) - lo) / nullif(hi - lo, 0)", "raw", "SELECT min(ln(1 + raw)) FILTER (year <= 2020) AS lo, max(ln(1 + raw)) FILTER (year <= 2020) AS hi FROM p").replace("ln(1 + raw) - lo", "least(greatest(ln(1 + raw), lo), hi) - lo")
_CAPPED = rows("p", "(least(greatest(raw, lo), hi) - lo) / nullif(hi - lo, 0)", "raw", "SELECT quantile_cont(raw, 0.0) FILTER (year <= 2020) AS lo, quantile_cont(raw, 0.9995) FILTER (year <= 2020) AS hi FROM p")
_SINCE = " WHERE year >= 2015"


def _accumulated(spark, d, hazard: str, kind: str):
    counts = X.events(spark, d).where(F.col("kind") == kind).groupBy("pgid", (F.col("year") + SHIFT).cast("int").alias("year"), "quarter").agg(F.count("*").alias("count"))
    return run(f"CLI_accumulated_{hazard}", {"panel": _panel(spark, d), f"{hazard}_counts": counts})


@query(f"{_counted('1-URGENT')} {_LOGGED}{_SINCE}")
def recipe_floods_long(spark, d):
    return _accumulated(spark, d, "floods", "1-URGENT")


@query(f"{_counted('2-HIGH')} {_LOGGED}{_SINCE}")
def recipe_cyclones_long(spark, d):
    return _accumulated(spark, d, "cyclones", "2-HIGH")


@query(f"{_counted('3-MEDIUM')} {_LOGGED}{_SINCE}")
def recipe_wildfires_long(spark, d):
    return _accumulated(spark, d, "wildfires", "3-MEDIUM")


@query(f"{_counted('1-URGENT')} {_CAPPED}{_SINCE}")
def recipe_heatwave_long(spark, d):
    return _accumulated(spark, d, "heatwave", "1-URGENT")


@query(f"{_counted('5-LOW')} {_CAPPED}{_SINCE}")
def recipe_heavy_rain_long(spark, d):
    return _accumulated(spark, d, "heavy-precipitation", "5-LOW")


@query(
    f"""{_LONG}, s AS (SELECT iso3, year - 3 AS year, q AS quarter, ((s * q) % 97) / 24.0 - 2.5 AS spei FROM cy, range(1, 5) r(q)), dry AS (SELECT pl.*, CASE WHEN spei < 0 THEN -spei WHEN spei >= 0 THEN 0 END AS dry FROM pl LEFT JOIN s USING (iso3, year, quarter)),
    p AS (SELECT *, CASE WHEN count(dry) OVER w = 7 THEN avg(dry) OVER w END AS raw FROM dry WINDOW w AS (PARTITION BY pgid, quarter ORDER BY year ROWS 6 PRECEDING))
    {_CAPPED.replace("(least(greatest", "CASE WHEN raw IS NOT NULL THEN (least(greatest").replace("nullif(hi - lo, 0)", "nullif(hi - lo, 0) END")}{_SINCE}"""
)
def recipe_drought_long(spark, d):
    """The same season's dryness over seven years."""
    years = figures(spark, d).withColumn("q", F.explode(F.sequence(F.lit(1), F.lit(4))))
    index = years.select("iso3", (F.col("year") - 3).alias("year"), (F.col("q") * 3).alias("month"), (F.col("s") * F.col("q") % 97 / 24 - 2.5).alias("spei"))
    spei = X.entities(spark, d).join(index, "iso3").select("pgid", "year", "month", "spei")
    # Months that end no quarter count for nothing.
    return run("CLI_accumulated_drought", {"panel": _panel(spark, d), "spei": spei.unionByName(spei.withColumn("month", F.col("month") - 1).withColumn("spei", F.lit(-9.0)))})


@query(
    f"""{_LONG}, x AS (SELECT pgid, year + {SHIFT} AS year, quarter, sqrt(id % 97) AS rain FROM ev UNION ALL SELECT pgid, 1951 + id % 40, quarter, sqrt(id % 89) FROM ev), base AS (SELECT pgid, avg(rain) AS base FROM x WHERE year BETWEEN 1951 AND 1980 GROUP BY pgid),
    q AS (SELECT pgid, year, quarter, avg(rain) AS rain FROM x GROUP BY ALL), r AS (SELECT pgid, year, quarter, avg(rain) OVER (PARTITION BY pgid ORDER BY year, quarter ROWS 3 PRECEDING) AS rain FROM q),
    o AS (SELECT pgid, year, quarter, avg(abs(rain / nullif(base, 0) - 1)) OVER (PARTITION BY pgid ORDER BY year, quarter ROWS 9 PRECEDING) AS raw FROM r LEFT JOIN base USING (pgid)),
    p AS (SELECT pl.*, raw FROM pl LEFT JOIN o USING (pgid, year, quarter)) {rows("p", "CASE WHEN raw IS NOT NULL THEN (least(greatest(ln(1 + raw), lo), hi) - lo) / nullif(hi - lo, 0) END", "raw", "SELECT min(ln(1 + raw)) AS lo, max(ln(1 + raw)) AS hi FROM p WHERE year <= 2020")}{_SINCE}"""
)
def recipe_rain_anomaly(spark, d):
    e, k = X.events(spark, d), F.col("id")
    now = e.select("pgid", (F.col("year") + SHIFT).cast("int").alias("year"), "quarter", F.sqrt(k % 97).alias("rain"))
    then = e.select("pgid", (1951 + k % 40).cast("int").alias("year"), "quarter", F.sqrt(k % 89).alias("rain"))
    return run("CLI_longterm_precipitation-anomaly", {"panel": _panel(spark, d), "precipitation": now.unionByName(then)})


@query(
    f"""{_LONG}, m AS (SELECT pgid, 1850 + k AS year, 1 AS month FROM entities, range(51) r(k) UNION ALL SELECT pgid, 1985 + k // 12, k % 12 + 1 FROM entities, range(444) r(k)),
    x AS (SELECT pgid, year, month, CASE WHEN (pgid + year * 12 + month) % (CASE WHEN pgid % 3 = 0 THEN 8 ELSE 13 END) <> 0 THEN ((pgid * 31 + year * 7 + month * 13) % 97) / 24.0 + (year - 1850) * (pgid % 7 - 2) / 100.0 END AS v FROM m),
    o AS (SELECT pgid, year, month, v - avg(v) FILTER (year BETWEEN 1850 AND 1900) OVER (PARTITION BY pgid) AS off FROM x), r AS (SELECT pgid, year, month, CASE WHEN count(off) OVER w >= 324 THEN avg(off) OVER w END AS raw FROM o WINDOW w AS (PARTITION BY pgid ORDER BY year, month ROWS 359 PRECEDING)),
    p AS (SELECT pl.*, raw FROM pl LEFT JOIN (SELECT pgid, year, month // 3 AS quarter, raw FROM r WHERE month % 3 = 0) USING (pgid, year, quarter))
    {rows("p", "CASE WHEN raw IS NOT NULL THEN (least(greatest(raw, 0), hi) - lo) / nullif(hi - lo, 0) END", "raw", "SELECT min(CASE WHEN raw IS NOT NULL THEN greatest(raw, 0) END) AS lo, max(CASE WHEN raw IS NOT NULL THEN greatest(raw, 0) END) AS hi FROM p WHERE year <= 2020").replace("least(greatest(raw, 0), hi)", "least(greatest(raw, 0, lo), hi)")}{_SINCE}"""
)
def recipe_temperature_anomaly(spark, d):
    """Cells' monthly temperatures with gaps, too many in a third of the cells."""
    c, k = X.entities(spark, d).select("pgid"), F.col("k") - 51
    # Cells are dealt out before their months are made, so that months needn't be shuffled; some two million months a task.
    dealt = c.repartition(-(-c.count() // 4096) or 1, "pgid").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(494))))
    year, month = F.when(k < 0, 1901 + k).otherwise(1985 + F.floor(k / 12)), F.when(k < 0, 1).otherwise(k % 12 + 1)
    months = dealt.select("pgid", year.cast("int").alias("year"), month.alias("month"))
    p, y, m = F.col("pgid"), F.col("year"), F.col("month")
    there = (p + y * 12 + m) % F.when(p % 3 == 0, 8).otherwise(13) != 0
    months = months.withColumn("temperature", F.when(there, (p * 31 + y * 7 + m * 13) % 97 / 24 + (y - 1850) * (p % 7 - 2) / 100))
    return run("CLI_longterm_temperature-anomaly", {"panel": _panel(spark, d), "temperature": months})
