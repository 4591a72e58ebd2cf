"""The recipes of countries' and cells' vulnerability on the test tables, with SQL.

Order counts and sums of nations stand for yearly national figures, twenty-one
years later, so that the panel of 2015-2021 begins before the first figures and reaches
past the reference year; figures have gaps by year and length of name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.panel import entity_quarters
from riskweave.plans import fixtures as X
from riskweave.plans.indicators import INDICATORS
from riskweave.plans.registry import query
from riskweave.session import table

KEYS = ["pgid", "year", "quarter"]
SHIFT = 21


def cells(spark, d) -> DataFrame:
    return entity_quarters(X.entities(spark, d), (2015, 1), (2021, 3))


def figures(spark, d) -> DataFrame:
    """(iso3, year, n, s): orders of a nation and the sum of their keys' last digits."""
    e = X.events(spark, d).join(X.entities(spark, d), "pgid")
    return e.groupBy("iso3", (F.col("year") + SHIFT).cast("int").alias("year")).agg(F.count("*").alias("n"), F.sum(F.col("id") % 1000).alias("s"))


def known(x: Column, every: int) -> Column:
    return F.when((F.col("year") + F.length("iso3")) % every != 0, x)


def run(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    return INDICATORS[name].run(tables).select(*KEYS, F.round(name, 8).alias("score"), F.round(f"{name}_raw", 6).alias("raw"))


# The same in SQL: pieces that stand after WITH, each a common table.

BASE = f"""WITH {X.SQL},
pq AS (SELECT pgid, iso3, 2015 + k // 4 AS year, k % 4 + 1 AS quarter, 2015 * 4 + k AS t FROM entities, range(27) r(k)),
cy AS (SELECT iso3, year + {SHIFT} AS year, count(*) AS n, sum(id % 1000) AS s FROM ev JOIN entities USING (pgid) GROUP BY ALL)"""


def gap(x: str, every: int) -> str:
    return f"CASE WHEN (year + length(iso3)) % {every} <> 0 THEN {x} END"


def line(out: str, source: str, by: str, t: str, x: str, head: str, tail: str) -> str:
    """``source`` with the gaps of ``x`` on straight lines."""
    ends = {
        "none": ("NULL", "NULL"),
        "fill": ("_xs[1]", "_xs[-1]"),
        "extrapolate": (f"_xs[1] + (_xs[2] - _xs[1]) * ({t} - _ts[1]) / (_ts[2] - _ts[1])", f"_xs[-1] + (_xs[-1] - _xs[-2]) * ({t} - _ts[-1]) / (_ts[-1] - _ts[-2])"),
    }
    return f"""{out} AS (SELECT * EXCLUDE (_i, _ts, _xs) REPLACE (CASE WHEN {x} IS NOT NULL THEN {x} WHEN _i = 0 THEN {ends[head][0]} WHEN _i = len(_ts) THEN {ends[tail][1]}
        ELSE _xs[_i] + (_xs[_i + 1] - _xs[_i]) * ({t} - _ts[_i]) / (_ts[_i + 1] - _ts[_i]) END AS {x})
      FROM (SELECT *, count({x}) OVER (PARTITION BY {by} ORDER BY {t}) AS _i FROM {source})
      LEFT JOIN (SELECT {by}, list({t}::DOUBLE ORDER BY {t}) AS _ts, list({x}::DOUBLE ORDER BY {t}) AS _xs FROM {source} WHERE {x} IS NOT NULL GROUP BY {by}) USING ({by}))"""


def lines(out: str, source: str, by: str, t: str, columns: list[str], head: str, tail: str) -> str:
    steps = [source, *[f"{out}_{c}" for c in columns[:-1]], out]
    return ",\n".join(line(b, a, by, t, c, head, tail) for a, b, c in zip(steps[:-1], steps[1:], columns, strict=True))


def quarters(out: str, source: str, columns: list[str], head: str = "extrapolate", tail: str = "none") -> str:
    """Nations' yearly values in fourth quarters, lines between them, on the panel."""
    names = ", ".join(columns)
    return f"""{out}_span AS (SELECT iso3, unnest(range(least(min(year), 2015) * 4, greatest(max(year), 2021) * 4 + 4)) AS t FROM {source} GROUP BY iso3),
{out}_all AS (SELECT iso3, t, {names} FROM {out}_span LEFT JOIN (SELECT iso3, year * 4 + 3 AS t, {names} FROM {source}) USING (iso3, t)),
{lines(f"{out}_line", f"{out}_all", "iso3", "t", columns, head, tail)},
{out} AS (SELECT pq.*, {names} FROM pq LEFT JOIN {out}_line USING (iso3, t))"""


def each_year(out: str, source: str, columns: list[str], head: str = "extrapolate", tail: str = "none") -> str:
    names = ", ".join(columns)
    return f"""{out}_all AS (SELECT iso3, year, {names} FROM (SELECT iso3, unnest(range((SELECT min(year) FROM {source}), (SELECT max(year) FROM {source}) + 1)) AS year FROM {source} GROUP BY iso3) LEFT JOIN {source} USING (iso3, year)),
{lines(out, f"{out}_all", "iso3", "year", columns, head, tail)}"""


def clip_fill(out: str, source: str, by: str, times: str, columns: list[str], every: bool = True) -> str:
    """Lines among the time steps with enough values, NULL at all others."""
    gaps = " + ".join(f"avg(({c} IS NULL)::INTEGER)" for c in columns)
    whole = "".join(f" AND count({c}) > 0" for c in columns) if every else ""
    return f"""{out}_good AS (SELECT {times} FROM {source} GROUP BY {times} HAVING ({gaps}) / {len(columns)} <= 0.75{whole}),
{out}_at AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {times}) AS _at FROM {source} SEMI JOIN {out}_good USING ({times})),
{lines(f"{out}_line", f"{out}_at", by, "_at", columns, "fill", "fill")},
{out} AS (SELECT s.* EXCLUDE ({", ".join(columns)}), {", ".join("l." + c for c in columns)} FROM {source} s LEFT JOIN {out}_line l USING ({by}, {times}))"""


def mean(*columns: str) -> str:
    there = " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in columns)
    return f"(({' + '.join(f'coalesce({c}, 0)' for c in columns)}) / nullif({there}, 0))"


def between(x: str, low: str = "lo", high: str = "hi") -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN (least(greatest({x}, {low}), {high}) - {low}) / nullif({high} - {low}, 0) END"


def rows(source: str, score: str, raw: str = "raw", bounds: str = "") -> str:
    """The last SELECT; ``bounds`` is a SELECT of lo and hi."""
    return f"SELECT pgid, year::INTEGER AS year, quarter::INTEGER AS quarter, round({score}, 8) AS score, round({raw}, 6) AS raw FROM {source}{f', ({bounds}) b' if bounds else ''}"


# Countries -------------------------------------------------------------------------------------


@query(
    f"""{BASE}, u AS (SELECT iso3, year, CASE WHEN s % 5 = 0 THEN 2.5 WHEN s % 5 < 4 THEN n + 0.5 END / 100 AS share FROM cy WHERE (year + length(iso3)) % 4 <> 0),
    {each_year("d", "u", ["share"])}, {quarters("p", "d", ["share"])}
    {rows("p", between("share"), "share * 100", "SELECT (SELECT min(share) FROM p) AS lo, quantile_cont(share, 0.99) AS hi FROM d WHERE year <= 2020")}"""
)
def recipe_hunger(spark, d):
    share = F.when(F.col("s") % 5 == 0, "<2.5").when(F.col("s") % 5 < 4, F.concat(F.col("n").cast("string"), F.lit(".5")))
    told = figures(spark, d).where((F.col("year") + F.length("iso3")) % 4 != 0).select("iso3", "year", share.alias("value"))
    return run("VUL_socioeconomic_hunger", {"panel": cells(spark, d), "undernourishment": told})


def _few(c: str, source: str) -> str:
    return f"CASE WHEN count({c}) OVER (PARTITION BY iso3) < 4 AND count({c}_model) OVER (PARTITION BY iso3) > 0 THEN {c}_model ELSE {c} END AS {c}"


@query(
    f"""{BASE}, l AS (SELECT iso3, year, {gap("s % 97", 2)} AS participation, (s % 89)::DOUBLE AS participation_model, {gap("(s % 83) / 83.0", 3)} AS farm_share, CASE WHEN n % 2 = 0 THEN (s % 79) / 79.0 END AS farm_share_model, {gap("(s % 71) / 0.71", 5)} AS value_added FROM cy),
    c AS (SELECT iso3, year, {_few("participation", "l")}, {_few("farm_share", "l")}, value_added FROM l), {clip_fill("f", "c", "iso3", "year", ["participation", "farm_share", "value_added"])},
    d AS (SELECT iso3, year, {mean("participation / 100 * farm_share", "value_added / 100")} AS raw FROM f), {quarters("p", "d", ["raw"])}
    {rows("p", between("raw"), "raw", "SELECT 0.0 AS lo, quantile_cont(raw, 0.99) AS hi FROM d WHERE year <= 2020")}"""
)
def recipe_agriculture(spark, d):
    s = F.col("s")
    labour = figures(spark, d).select(
        "iso3", "year", known((s % 97).cast("double"), 2).alias("participation"), (s % 89).cast("double").alias("participation_model"), known((s % 83) / 83, 3).alias("farm_share"),
        F.when(F.col("n") % 2 == 0, (s % 79) / 79).alias("farm_share_model"), known((s % 71) / 0.71, 5).alias("value_added"),
    )
    return run("VUL_socioeconomic_agriculture", {"panel": cells(spark, d), "labour": labour})


@query(
    f"""{BASE}, g AS (SELECT iso3, year + {SHIFT} AS year, sum(id % 10) / 1000.0 AS excluded FROM ev JOIN entities USING (pgid) WHERE status IN ('F', 'P') GROUP BY ALL), x AS (SELECT iso3, year, {gap("(s % 97) / 97.0", 3)} AS exclusion_index FROM cy WHERE n % 5 <> 0),
    o AS (SELECT iso3, year, exclusion_index, excluded FROM x FULL JOIN g USING (iso3, year)), {clip_fill("f", "o", "iso3", "year", ["exclusion_index", "excluded"])}, {quarters("p", "f", ["exclusion_index", "excluded"])}
    {rows("p", mean("excluded", "exclusion_index"), mean("excluded", "exclusion_index"))}"""
)
def recipe_ethnic(spark, d):
    """Order states stand for the groups' standing."""
    e = X.events(spark, d).join(X.entities(spark, d), "pgid")
    status = F.when(F.col("status") == "F", "POWERLESS").when(F.col("status") == "P", "DISCRIMINATED").otherwise("DOMINANT")
    groups = e.select("iso3", (F.col("year") + SHIFT).cast("int").alias("year"), status.alias("status"), (F.col("id") % 10 / 1000).alias("size"))
    index = figures(spark, d).where("n % 5 <> 0").select("iso3", "year", known(F.col("s") % 97 / 97, 3).alias("exclusion_index"))
    return run("VUL_political_ethnic", {"panel": cells(spark, d), "groups": groups, "exclusion": index})


@query(
    f"""{BASE}, i AS (SELECT iso3, year, {gap("(s % 101)", 3)} AS corruption, {gap("(s % 97) / 97.0", 4)} AS rule_of_law, {gap("(s % 61) / 10.0 - 3", 2)} AS effectiveness FROM cy), {quarters("q", "i", ["corruption", "rule_of_law", "effectiveness"])},
    r AS (SELECT pgid, year, quarter, {between("corruption", "0", "100")} AS corruption, rule_of_law, {between("effectiveness", "-2.5", "2.5")} AS effectiveness FROM q), {clip_fill("f", "r", "pgid", "year, quarter", ["corruption", "rule_of_law", "effectiveness"], every=False)}
    {rows("f", "1 - " + mean("corruption", "rule_of_law", "effectiveness"), "1 - " + mean("corruption", "rule_of_law", "effectiveness"))}"""
)
def recipe_institutions(spark, d):
    s = F.col("s")
    told = figures(spark, d).select("iso3", "year", known((s % 101).cast("double"), 3).alias("corruption"), known(s % 97 / 97, 4).alias("rule_of_law"), known(s % 61 / 10 - 3, 2).alias("effectiveness"))
    return run("VUL_political_institutions", {"panel": cells(spark, d), "institutions": told})


_SYSTEM = ["freedom", "libdem", "partip", "civlib"]


@query(
    f"""{BASE}, y AS (SELECT iso3, year, {", ".join(f"{gap(f'(s % {m}) / {m}.0', k)} AS {c}" for c, m, k in zip(_SYSTEM, (97, 89, 83, 79), (2, 3, 4, 5), strict=True))} FROM cy),
    {clip_fill("f", "y", "iso3", "year", _SYSTEM, every=False)}, {quarters("p", "f", _SYSTEM)} {rows("p", "1 - " + mean(*_SYSTEM), "1 - " + mean(*_SYSTEM))}"""
)
def recipe_system(spark, d):
    told = [known(F.col("s") % m / m, k).alias(c) for c, m, k in zip(_SYSTEM, (97, 89, 83, 79), (2, 3, 4, 5), strict=True)]
    return run("VUL_political_system", {"panel": cells(spark, d), "system": figures(spark, d).select("iso3", "year", *told)})


@query(
    f"""{BASE}, y AS (SELECT iso3, year, {gap("(s % 97) / 97.0", 3)} AS gii, {gap("(s % 89) / 89.0", 4)} AS exclusion FROM cy), {quarters("q", "y", ["gii", "exclusion"])},
    g AS (SELECT pgid, year, quarter, gii, exclusion, CASE WHEN (pgid + year) % 4 <> 0 THEN 0.5 + ((pgid * 7 + year + quarter) % 100) / 200.0 END AS sgdi FROM q), {clip_fill("f", "g", "pgid", "year, quarter", ["gii", "exclusion", "sgdi"], every=False)},
    b AS (SELECT quantile_cont(sgdi, 0.01) AS lo, 1.0 AS hi FROM f WHERE year BETWEEN 2012 AND 2020), r AS (SELECT pgid, year, quarter, gii, exclusion, 1 - ({between("sgdi")}) AS balance FROM f, b)
    {rows("r", mean("gii", "exclusion", "balance"), mean("gii", "exclusion", "balance"))}"""
)
def recipe_gender(spark, d):
    told = figures(spark, d).select("iso3", "year", known(F.col("s") % 97 / 97, 3).alias("gii"), known(F.col("s") % 89 / 89, 4).alias("exclusion"))
    gap_ = F.when((F.col("pgid") + F.col("year")) % 4 != 0, 0.5 + (F.col("pgid") * 7 + F.col("year") + F.col("quarter")) % 100 / 200)
    return run("VUL_political_gender", {"panel": cells(spark, d), "gender": told, "development_gap": cells(spark, d).select(*KEYS, gap_.alias("sgdi"))})


@query(
    f"""{BASE}, a AS (SELECT iso3, year, (s % 97 + s % 31)::DOUBLE / nullif(s % 53, 0) AS raw FROM cy WHERE (year + length(iso3)) % 3 <> 0),
    w AS (SELECT iso3, t, raw FROM (SELECT DISTINCT iso3, unnest(range(2015 * 4, 2022 * 4)) AS t FROM entities) LEFT JOIN (SELECT iso3, year * 4 + 1 AS t, raw FROM a) USING (iso3, t)), {line("f", "w", "iso3", "t", "raw", "extrapolate", "none")},
    p AS (SELECT pq.*, raw FROM pq LEFT JOIN f USING (iso3, t)) {rows("p", between("raw"), "raw", "SELECT quantile_cont(raw, 0.01) AS lo, quantile_cont(raw, 0.99) AS hi FROM p WHERE year <= 2020")}"""
)
def recipe_dependent(spark, d):
    s = F.col("s")
    ages = figures(spark, d).where((F.col("year") + F.length("iso3")) % 3 != 0).select("iso3", "year", (s % 97).alias("pop_youth"), (s % 31).alias("pop_old"), (s % 53).alias("pop_working"))
    return run("VUL_demographic_dependent", {"panel": cells(spark, d), "agegroups": ages})


@query(
    f"""{BASE}, y AS (SELECT iso3, year, (coalesce({gap("s % 97", 2)}, 0) + s % 31 + coalesce({gap("n", 3)}, 0))::DOUBLE / nullif(s % 53, 0) AS share FROM cy WHERE n % 4 <> 0), z AS (SELECT *, ln(1 + 100 * share) AS logged FROM y),
    {quarters("p", "z", ["share", "logged"])} {rows("p", between("logged"), "share", "SELECT 0.0 AS lo, quantile_cont(logged, 0.99) AS hi FROM z WHERE year <= 2020")}"""
)
def recipe_uprooted(spark, d):
    s = F.col("s")
    told = figures(spark, d).where("n % 4 <> 0").select(
        "iso3", "year", known(s % 97, 2).alias("refugees"), (s % 31).alias("asylum_seekers"), known(F.col("n"), 3).alias("others_need_of_protection"), F.lit(None).cast("long").alias("idps"), (s % 53).alias("pop_total")
    )
    return run("VUL_demographic_uprooted", {"panel": cells(spark, d), "displacement": told})


@query(
    f"""{BASE}, y AS (SELECT iso3, year, (s + 1000)::DOUBLE AS pop_total FROM cy WHERE (year + length(iso3)) % 3 <> 0), {quarters("q", "y", ["pop_total"])},
    p AS (SELECT *, (pop_total - lag(pop_total) OVER w) / nullif(pop_total, 0) AS raw FROM q WINDOW w AS (PARTITION BY pgid ORDER BY t)) {rows("p", between("raw"), "raw", "SELECT 0.0 AS lo, quantile_cont(raw, 0.99) AS hi FROM p WHERE year <= 2020")}"""
)
def recipe_popgrowth(spark, d):
    people = figures(spark, d).where((F.col("year") + F.length("iso3")) % 3 != 0).select("iso3", "year", (F.col("s") + 1000).cast("double").alias("pop_total"))
    return run("VUL_demographic_popgrowth", {"panel": cells(spark, d), "country_pop": people})


# Cells and regions -----------------------------------------------------------------------------

_CELL_YEARS = "c AS (SELECT pgid, year + 21 AS year, count(*) AS n, sum(id % 1000) AS s FROM ev GROUP BY ALL)"


def _cell_years(spark, d):
    e = X.events(spark, d).groupBy("pgid", (F.col("year") + SHIFT).cast("int").alias("year"))
    return e.agg(F.count("*").alias("n"), F.sum(F.col("id") % 1000).alias("s"))


@query(
    f"""{BASE}, {_CELL_YEARS}, p0 AS (SELECT pq.*, CASE WHEN s % 7 <> 0 AND s % 97 <> 0 THEN (s % 97) / 97.0 END AS raw FROM pq LEFT JOIN (SELECT pgid, year, 4 AS quarter, s FROM c) USING (pgid, year, quarter)), {line("p", "p0", "pgid", "t", "raw", "none", "none")}
    {rows("p", between("(1 - raw)"), "raw", "SELECT min(1 - raw) AS lo, quantile_cont(1 - raw, 0.99) AS hi FROM p WHERE year <= 2020")}"""
)
def recipe_biodiversity(spark, d):
    """Zero stands for no value."""
    bii = F.when(F.col("s") % 7 != 0, F.col("s") % 97 / 97).otherwise(0.0)
    return run("VUL_environmental_biodiversity", {"panel": cells(spark, d), "intactness": _cell_years(spark, d).select("pgid", "year", bii.alias("bii"))})


_PIXEL = "o_custkey + 1 AS pgid, l_linenumber % 5 AS k, l_quantity::DOUBLE AS q, (l_partkey % 3 > 0)::INTEGER AS land, CASE WHEN l_orderkey % 3 = 0 THEN 10 + l_suppkey % 10 ELSE 0 END AS lossyear"


@query(
    f"""{BASE}, x AS (SELECT {_PIXEL} FROM lineitem JOIN orders ON l_orderkey = o_orderkey), base AS (SELECT pgid, sum(q) AS total, avg(q) FILTER (land = 1) AS density FROM x GROUP BY pgid), lost AS (SELECT pgid, 2000 + lossyear AS ly, sum(q) AS q FROM x WHERE lossyear > 0 GROUP BY ALL),
    yl AS (SELECT pgid, year, coalesce((SELECT sum(q) FROM lost l WHERE l.pgid = base.pgid AND ly <= year), 0) / total * density / 100 AS raw FROM base, range(2014, (SELECT max(ly) FROM lost) + 1) r(year)),
    p0 AS (SELECT pq.*, raw FROM pq LEFT JOIN (SELECT pgid, year, 4 AS quarter, raw FROM yl) USING (pgid, year, quarter)), {line("p", "p0", "pgid", "t", "raw", "extrapolate", "none")}
    {rows("p", between("raw"), "raw", "SELECT min(raw) AS lo, quantile_cont(raw, 0.99) AS hi FROM p WHERE year <= 2020")}"""
)
def recipe_deforestation(spark, d):
    """Order lines stand for the pixels of their customer's cell."""
    l, o = table(spark, d, "lineitem"), table(spark, d, "orders").select("o_orderkey", "o_custkey")  # noqa: E741
    year = F.when(F.col("l_orderkey") % 3 == 0, 10 + F.col("l_suppkey") % 10).otherwise(0)
    pixels = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("o_custkey") + 1).cast("int").alias("pgid"), F.col("l_quantity").cast("double").alias("cover"), (F.col("l_partkey") % 3 > 0).cast("int").alias("datamask"), year.cast("int").alias("lossyear")
    )
    return run("VUL_environmental_deforestation", {"panel": cells(spark, d), "forest_pixels": pixels})


@query(
    f"""{BASE}, x AS (SELECT l_suppkey + 1 AS pgid, CASE WHEN l_partkey % 11 <> 0 THEN l_quantity * 1.3 END AS erosion, CASE WHEN l_partkey % 7 <> 0 THEN l_extendedprice::DOUBLE END AS carbon FROM lineitem),
    top AS (SELECT quantile_cont(carbon, 0.99) AS top FROM x), m AS (SELECT pgid, avg(CASE WHEN erosion > 50 THEN 50 ELSE erosion END) / 50 AS erosion, avg(CASE WHEN carbon > top THEN top ELSE carbon END) / max(top) AS carbon FROM x, top GROUP BY pgid),
    p AS (SELECT pq.*, {mean("erosion", "carbon")} AS raw FROM pq LEFT JOIN m USING (pgid)) {rows("p", between("raw"), "raw", "SELECT min(raw) AS lo, quantile_cont(raw, 0.99) AS hi FROM p")}"""
)
def recipe_soil(spark, d):
    x = table(spark, d, "lineitem")
    told = lambda c, k: F.when(F.col("l_partkey") % k != 0, c.cast("double")).otherwise(-9999.0)
    pixels = x.select((F.col("l_suppkey") + 1).cast("int").alias("pgid"), told(F.col("l_quantity").cast("double") * 1.3, 11).alias("erosion"), told(F.col("l_extendedprice"), 7).alias("carbon"))
    return run("VUL_environmental_soil", {"panel": cells(spark, d), "soil_pixels": pixels})


_BRIDGE = "br AS (SELECT pgid, area, share FROM (SELECT pgid, pgid % 40 AS area, 0.25 + pgid % 3 / 10.0 AS share FROM entities UNION ALL SELECT pgid, 40 + pgid % 30, 0.5 - pgid % 4 / 10.0 FROM entities))"


def _bridge(spark, d):
    e, k = X.entities(spark, d), F.col("pgid")
    one = e.select("pgid", (k % 40).alias("area"), (0.25 + k % 3 / 10).alias("share"))
    return one.unionByName(e.select("pgid", (40 + k % 30).alias("area"), (0.5 - k % 4 / 10).alias("share")))


@query(
    f"""{BASE}, {_BRIDGE}, s AS (SELECT p_partkey AS area, unnest([2019, 2030]) AS year, unnest([CASE WHEN p_partkey % 7 <> 0 THEN least(p_size / 41.0, 1) END, CASE WHEN p_partkey % 5 <> 0 THEN least(p_size / 31.0, 1) END]) AS v FROM part),
    c AS (SELECT pgid, year, sum(v * share) / nullif(sum(share) FILTER (v IS NOT NULL), 0) AS raw FROM br JOIN s USING (area) GROUP BY ALL), k AS (SELECT pgid, t FROM pq UNION ALL SELECT pgid, y * 4 + 3 FROM entities, range(2022, 2031) r(y)),
    n AS (SELECT pgid, t, row_number() OVER (PARTITION BY pgid ORDER BY t) AS step, raw FROM k LEFT JOIN (SELECT pgid, year * 4 + 3 AS t, raw FROM c) USING (pgid, t)), {line("f", "n", "pgid", "step", "raw", "fill", "none")},
    p AS (SELECT pq.*, raw FROM pq LEFT JOIN f USING (pgid, t)) {rows("p", "raw")}"""
)
def recipe_water(spark, d):
    size = F.col("p_size")
    told = lambda k, by: F.when(F.col("p_partkey") % k != 0, size / by).otherwise(-9999.0)
    basins = table(spark, d, "part").select(F.col("p_partkey").alias("pfaf_id"), told(7, 41).alias("bws_raw_2019"), told(5, 31).alias("bws_raw_2030"))
    return run("VUL_environmental_water", {"panel": cells(spark, d), "basin_stress": basins, "basins": _bridge(spark, d)})


#: Regions' own figures end in 2018; the nation's go on.
_GROWN = """y AS (SELECT p_partkey AS area, 2014 + k AS year, CASE WHEN k BETWEEN p_partkey % 2 AND 4 THEN (p_size + 20 + k) / 100.0 END AS local, CASE WHEN p_partkey % 9 <> 8 OR k <> 6 THEN (p_size + 30 + 2 * k + p_partkey % 3) / 100.0 END AS nat FROM part, range(8) r(k)),
g AS (SELECT *, nat / lag(nat) OVER (PARTITION BY area ORDER BY year) AS g FROM y), b AS (SELECT quantile_cont(g, 0.01) AS lo, quantile_cont(g, 0.99) AS hi FROM g),
h AS (SELECT area, year, local, CASE WHEN local IS NULL THEN CASE WHEN g IS NOT NULL THEN greatest(least(g, hi), lo) END ELSE 1 END AS step, last_value(local IGNORE NULLS) OVER w AS base, count(local) OVER w AS seg FROM g, b WINDOW w AS (PARTITION BY area ORDER BY year ROWS UNBOUNDED PRECEDING)),
v AS (SELECT area, year, round_even(coalesce(local, CASE WHEN count(*) OVER w = count(step) OVER w THEN base * product(step) OVER w END), 3) AS v FROM h WINDOW w AS (PARTITION BY area, seg ORDER BY year ROWS UNBOUNDED PRECEDING)),
v1 AS (SELECT area, year, least(greatest(v, 0), 1) AS v FROM v WHERE v IS NOT NULL)"""


def _regional(grown: str) -> str:
    return f"""{BASE}, {_BRIDGE}, {grown}, c AS (SELECT pgid, year, sum(v * share) / nullif(sum(share), 0) AS raw FROM br JOIN v1 USING (area) GROUP BY ALL), p0 AS (SELECT pq.*, raw FROM pq LEFT JOIN (SELECT pgid, year, 4 AS quarter, raw FROM c) USING (pgid, year, quarter)),
    {line("p", "p0", "pgid", "t", "raw", "extrapolate", "none")} {rows("p", "1 - raw")}"""


def _regions(spark, d, least: int):
    k, size = F.col("k"), F.col("p_size")
    part = table(spark, d, "part").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(7))))
    local = F.when((k >= F.col("p_partkey") % 2) & (k <= 4), (size + least + k) / 100)
    nation = F.when((F.col("p_partkey") % 9 != 8) | (k != 6), (size + 30 + 2 * k + F.col("p_partkey") % 3) / 100)
    return part.select(F.col("p_partkey").alias("gdlcode"), (2014 + k).alias("year"), local.alias("subnational"), nation.alias("national"))


@query(_regional(_GROWN))
def recipe_education(spark, d):
    return run("VUL_socioeconomic_education", {"panel": cells(spark, d), "education": _regions(spark, d, 20), "regions": _bridge(spark, d)})


@query(_regional(_GROWN.replace("p_size + 20", "p_size + 45")))
def recipe_health(spark, d):
    """As education, with figures near the upper bound."""
    return run("VUL_socioeconomic_health", {"panel": cells(spark, d), "health": _regions(spark, d, 45), "regions": _bridge(spark, d)})


@query(
    f"""{BASE}, {_CELL_YEARS}, y AS (SELECT iso3, year, CASE WHEN length(iso3) % 2 = 1 AND year < 2018 THEN NULL ELSE (s + 500)::DOUBLE END AS a, (s + 700)::DOUBLE AS o, n * 10.0 AS people FROM cy),
    u AS (SELECT iso3, year, people, CASE WHEN count(*) FILTER (a IS NULL) OVER w > 3 AND count(o) OVER w > 0 THEN o ELSE a END AS gdp FROM y WINDOW w AS (PARTITION BY iso3)), u1 AS (SELECT iso3, year, gdp, gdp / people AS per_head FROM u), {each_year("z", "u1", ["gdp", "per_head"], "extrapolate", "extrapolate")},
    lit AS (SELECT pgid, iso3, year, CASE WHEN n % 3 <> 0 THEN (s % 97) / 10.0 END AS ntl, (s % 53)::DOUBLE AS pop FROM c JOIN entities USING (pgid)), h AS (SELECT iso3, year, nullif(sum(pop), 0) AS heads FROM lit GROUP BY ALL),
    v AS (SELECT pgid, year, CASE WHEN gdp * (log10(1 + ntl) + 1) / heads > -1 THEN ln(1 + gdp * (log10(1 + ntl) + 1) / heads) END AS v, per_head FROM lit LEFT JOIN z USING (iso3, year) LEFT JOIN h USING (iso3, year)), b AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM v WHERE year <= 2020),
    sc AS (SELECT pgid, year, 4 AS quarter, 1 - ({between("v")}) AS score, per_head AS raw FROM v, b), p0 AS (SELECT pq.*, score, raw FROM pq LEFT JOIN sc USING (pgid, year, quarter)), {lines("p", "p0", "pgid", "t", ["score", "raw"], "extrapolate", "none")} {rows("p", "score")}"""
)
def recipe_deprivation(spark, d):
    odd = (F.length("iso3") % 2 == 1) & (F.col("year") < 2018)
    gdp = figures(spark, d).select(
        "iso3", "year", F.when(~odd, (F.col("s") + 500).cast("double")).alias("gdp_ppp"), (F.col("s") + 700).cast("double").alias("gdp_other"), (F.col("n") * 10.0).alias("pop_total")
    )
    lights = _cell_years(spark, d).select("pgid", "year", F.when(F.col("n") % 3 != 0, F.col("s") % 97 / 10).alias("ntl"), (F.col("s") % 53).cast("double").alias("pop_count"))
    return run("VUL_socioeconomic_deprivation", {"panel": cells(spark, d), "gdp": gdp, "lights": lights})


@query(
    f"""{BASE}, {_BRIDGE}, x AS (SELECT l_suppkey % 70 AS area, 2015 + l_linenumber % 6 AS year, (l_orderkey % 1000)::DOUBLE AS ntl, l_partkey % 9 AS pop FROM lineitem),
    ranked AS (SELECT area, year, ntl / pop AS v, row_number() OVER (PARTITION BY area, year ORDER BY ntl / pop) AS i, count(*) OVER (PARTITION BY area, year) AS m FROM x WHERE pop > 0), g AS (SELECT area, year, 2 * sum(i * v) / nullif(max(m) * sum(v), 0) - (max(m) + 1) / max(m)::DOUBLE AS gini FROM ranked GROUP BY ALL),
    c AS (SELECT pgid, year, 4 AS quarter, sum(gini * share) / nullif(sum(share) FILTER (gini IS NOT NULL), 0) AS gini FROM br JOIN g USING (area) GROUP BY ALL), y AS (SELECT iso3, year, {gap("s % 97", 3)}::DOUBLE AS income FROM cy), {quarters("q", "y", ["income"], "fill", "fill")},
    j AS (SELECT q.*, gini FROM q LEFT JOIN c USING (pgid, year, quarter)), {line("f", "j", "pgid", "t", "gini", "fill", "fill")}, p AS (SELECT *, {mean("gini", "income / 100")} AS raw FROM f)
    {rows("p", between("raw"), "raw", "SELECT quantile_cont(raw, 0.01) AS lo, quantile_cont(raw, 0.99) AS hi FROM p")}"""
)
def recipe_inequality(spark, d):
    """Order lines stand for lit pixels of 70 regions."""
    pixels = table(spark, d, "lineitem").select(
        (F.col("l_suppkey") % 70).alias("area"), (2015 + F.col("l_linenumber") % 6).cast("int").alias("year"), (F.col("l_orderkey") % 1000).cast("double").alias("ntl"), (F.col("l_partkey") % 9).alias("pop")
    )
    gini = figures(spark, d).select("iso3", "year", known((F.col("s") % 97).cast("double"), 3).alias("gini_disp"))
    return run("VUL_socioeconomic_inequality", {"panel": cells(spark, d), "light_pixels": pixels, "regions": _bridge(spark, d), "income_gini": gini})
