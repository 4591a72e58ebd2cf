"""The recipes of conflict on the test tables, with SQL: orders stand for events, their states for what happened."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.plans import fixtures as X
from riskweave.plans.country_queries import BASE, SHIFT, cells, figures, gap, known, mean, run
from riskweave.plans.registry import query


def _tables(spark, d):
    e = X.events(spark, d).select(
        "pgid", (F.col("year") + SHIFT).cast("int").alias("year"), "quarter", (F.col("status") == "F").alias("armed"), (F.col("status") == "O").alias("unrest"), (F.col("id") % 97).cast("double").alias("fatalities")
    )
    start = F.make_date(2015 + F.length("iso3") % 3, F.lit(1), F.lit(1))
    cov = X.entities(spark, d).select("iso3").distinct().withColumn("coverage_start", start)
    free = figures(spark, d).select("iso3", "year", known(F.col("s") % 89 / 89, 3).alias("libdem"))
    people = figures(spark, d).where("n % 7 <> 0").select("iso3", "year", (F.col("s") + 100).cast("double").alias("pop_total"))
    return {"panel": cells(spark, d), "conflict_events": e, "coverage": cov, "governance": free, "population": people}


#: Fatalities and unrest, 0 from the start of coverage on.
_FOUGHT = f"""{BASE}, a AS (SELECT pgid, year + {SHIFT} AS year, quarter, sum(id % 97) FILTER (status = 'F')::DOUBLE AS dead, count(*) FILTER (status = 'O') AS unrest FROM ev GROUP BY ALL),
f AS (SELECT pq.*, CASE WHEN year >= 2015 + length(iso3) % 3 THEN coalesce(dead, 0) END AS dead, CASE WHEN year >= 2015 + length(iso3) % 3 THEN coalesce(unrest, 0) END AS unrest FROM pq LEFT JOIN a USING (pgid, year, quarter))"""

#: Unrest weighed by what the country lacks in freedom, whose last value holds on.
_TENSION = f"""{_FOUGHT}, free AS (SELECT pgid, t, last_value(v IGNORE NULLS) OVER (PARTITION BY pgid ORDER BY t) AS libdem FROM (SELECT pgid, t, {gap("(s % 89) / 89.0", 3)} AS v FROM (SELECT pgid, t, pq.year, pq.iso3, CASE WHEN quarter = 4 THEN s END AS s FROM pq LEFT JOIN cy USING (iso3, year)))),
u AS (SELECT f.*, ln(1 + unrest) * (1 - libdem) AS tension FROM f LEFT JOIN free USING (pgid, t))"""


def _near(source: str, x: str) -> str:
    """Sums and means over the cells around, on a grid of 720 x 360 cells that is closed at the date line."""
    return f"""around AS (SELECT pgid, t, avg(x) AS m, sum(x) AS raw FROM (
      SELECT (row_ + dr) * 720 + (col + dc + 720) % 720 + 1 AS pgid, t, x FROM (SELECT (pgid - 1) // 720 AS row_, (pgid - 1) % 720 AS col, t, {x} AS x FROM {source} WHERE {x} IS NOT NULL), range(-1, 2) r(dr), range(-1, 2) c(dc)) GROUP BY ALL),
    z AS (SELECT pq.*, raw, ln(1 + m) AS v FROM pq LEFT JOIN around USING (pgid, t))"""


def _capped(source: str, extra: str = "raw", keys: str = "pgid") -> str:
    """Values of ``z`` below the mean of the last eight quarters' upper quantiles, as shares of their year's range."""
    return f"""share AS (SELECT 1 - avg((v <> 0)::INTEGER) * 0.01 AS level FROM {source} WHERE v IS NOT NULL),
k AS (SELECT t, v, row_number() OVER w - 1 AS i, (count(*) OVER (PARTITION BY t) - 1) * level AS place FROM {source}, share WHERE v IS NOT NULL WINDOW w AS (PARTITION BY t ORDER BY v)),
tops AS (SELECT t, max(v) FILTER (i = floor(place)) + (max(v) FILTER (i = ceil(place)) - max(v) FILTER (i = floor(place))) * (max(place) - floor(max(place))) AS q FROM k GROUP BY t),
ts AS (SELECT t, CASE WHEN count(q) OVER w = 8 THEN avg(q) OVER w END AS top FROM (SELECT DISTINCT t FROM {source}) LEFT JOIN tops USING (t) WINDOW w AS (ORDER BY t ROWS 7 PRECEDING)),
cut AS (SELECT {keys}, t, year, quarter, {extra}, CASE WHEN top IS NOT NULL AND v IS NOT NULL THEN least(v, top) END AS c FROM {source} JOIN ts USING (t)),
scored AS (SELECT {keys}, t, year, quarter, {extra}, (c - min(c) OVER y) / nullif(max(c) OVER y - min(c) OVER y, 0) AS score FROM cut WINDOW y AS (PARTITION BY year))"""


_LAST = "SELECT pgid, year::INTEGER AS year, quarter::INTEGER AS quarter, round(score, 8) AS score, round(raw, 6) AS raw FROM"


def _persisting(years: int, weight: float) -> str:
    """The memory of scores, step by step."""
    return f"""memory AS (SELECT pgid, t, score AS v FROM scored WHERE t = 2015 * 4 UNION ALL
      SELECT s.pgid, s.t, CASE WHEN m.v IS NULL AND NOT EXISTS (SELECT 1 FROM first_seen b WHERE b.pgid = s.pgid AND b.t < s.t) THEN s.score ELSE {weight} * s.score + (1 - {weight} * s.score) * power(0.25, 1.0 / (4 * {years})) * m.v END FROM memory m JOIN scored s ON s.pgid = m.pgid AND s.t = m.t + 1)
    SELECT pgid, (t // 4)::INTEGER AS year, (t % 4 + 1)::INTEGER AS quarter, round(v, 8) AS score, round(v, 6) AS raw FROM memory"""


def _remembered(before: str, years: int, weight: float) -> str:
    recursive = before.replace("WITH", "WITH RECURSIVE", 1)
    return f"{recursive}, first_seen AS (SELECT pgid, min(t) AS t FROM scored WHERE score IS NOT NULL GROUP BY pgid), {_persisting(years, weight)}"


@query(f"{_FOUGHT}, {_near('f', 'dead')}, {_capped('z')} {_LAST} scored")
def recipe_surrounding(spark, d):
    return run("CON_level_surrounding", _tables(spark, d))


@query(_remembered(f"{_FOUGHT}, z AS (SELECT *, dead AS raw, ln(1 + dead) AS v FROM f), {_capped('z')}", 5, 0.5))
def recipe_conflict_persistence(spark, d):
    return run("CON_level_persistence", _tables(spark, d))


@query(f"{_TENSION}, z AS (SELECT *, unrest AS raw, tension AS v FROM u), {_capped('z')} {_LAST} scored")
def recipe_tension(spark, d):
    return run("CON_soctens_intensity", _tables(spark, d))


@query(f"{_TENSION}, {_near('u', 'tension')}, {_capped('z')} {_LAST} scored")
def recipe_tension_around(spark, d):
    return run("CON_soctens_surrounding", _tables(spark, d))


@query(_remembered(f"{_TENSION}, z AS (SELECT *, unrest AS raw, tension AS v FROM u), {_capped('z')}", 1, 0.8))
def recipe_tension_kept(spark, d):
    return run("CON_soctens_persistence", _tables(spark, d))


@query(
    f"""{_FOUGHT}, n AS (SELECT iso3, t, year, quarter, sum(dead) AS dead, sum((coalesce(dead, 0) >= 1)::INTEGER) / count(*) AS extent FROM f GROUP BY ALL), z AS (SELECT n.*, ln(1 + dead / (s + 100)) AS v FROM n LEFT JOIN (SELECT * FROM cy WHERE n % 7 <> 0) USING (iso3, year)),
    {_capped("z", "extent", "iso3")}, r AS (SELECT iso3, t, {mean("score", "extent")} AS raw FROM scored), b AS (SELECT min(raw) AS lo, quantile_cont(raw, 0.99) AS hi FROM r), g AS (SELECT iso3, t, raw, CASE WHEN raw IS NOT NULL THEN (least(raw, hi) - lo) / nullif(hi - lo, 0) END AS score FROM r, b)
    {_LAST} pq LEFT JOIN g USING (iso3, t)"""
)
def recipe_conflict_country(spark, d):
    return run("CON_context_country", _tables(spark, d))


@query(
    f"""{_FOUGHT}, i AS (SELECT iso3, day + INTERVAL {SHIFT} YEAR AS first, id % 4 AS more, id % 97 AS best, kind AS one, CASE WHEN id % 5 = 0 THEN 'XXX' || id WHEN id % 5 = 1 THEN 'Some Civilians' ELSE status END AS other FROM ev JOIN entities USING (pgid) WHERE id % 11 <> 0),
    days AS (SELECT iso3, year(day) AS year, quarter(day) AS quarter, best / (more + 1.0) AS best, one, other FROM (SELECT *, first + INTERVAL (unnest(range(more + 1))) DAY AS day FROM i)), b AS (SELECT iso3, year, quarter, sum(best) AS best FROM days GROUP BY ALL),
    n AS (SELECT iso3, year, quarter, count(DISTINCT actor) AS actors FROM (SELECT iso3, year, quarter, unnest([one, other]) AS actor FROM days) WHERE actor NOT ILIKE '%civilians%' AND actor NOT LIKE 'XXX%' GROUP BY ALL),
    z AS (SELECT k.*, coalesce(actors, 0) AS raw, ln(1 + coalesce(actors, 0)) * ln(1 + coalesce(best, 0)) / ln(1 + s + 100) AS v FROM (SELECT DISTINCT iso3, t, year, quarter FROM pq) k LEFT JOIN b USING (iso3, year, quarter) LEFT JOIN n USING (iso3, year, quarter) LEFT JOIN (SELECT iso3, year, s FROM cy WHERE n % 7 <> 0) USING (iso3, year)),
    {_capped("z", "raw", "iso3")}, g AS (SELECT iso3, t, score, raw FROM scored) {_LAST} pq LEFT JOIN g USING (iso3, t)"""
)
def recipe_conflict_actors(spark, d):
    """Events of one to four days with two sides, some of which are no actors."""
    e = X.events(spark, d).join(X.entities(spark, d), "pgid").where("id % 11 <> 0")
    first, k = F.add_months("day", 12 * SHIFT), F.col("id")
    other = F.when(k % 5 == 0, F.concat(F.lit("XXX"), k)).when(k % 5 == 1, "Some Civilians").otherwise(F.col("status"))
    spans = e.select(
        "iso3", first.alias("date_start"), F.date_add(first, (k % 4).cast("int")).alias("date_end"), (k % 97).cast("double").alias("best"), F.col("kind").alias("side_a"), other.alias("side_b")
    )
    return run("CON_context_actors", {**_tables(spark, d), "interval_events": spans})
