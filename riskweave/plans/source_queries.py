"""Data sets read from landed files. The files are written by Spark from the test tables, in each provider's layout."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.plans.registry import query
from riskweave.session import cut, shared_folder, table
from riskweave.sources import landed
from riskweave.sources.datasets import DATASETS, ILO_SERIES, Context

START = 1994


def _landed(spark, key: str, frame: DataFrame, **options) -> str:
    """The folder of the text files, with a header, that ``frame`` lands as."""
    path = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}/{key}"
    frame.write.options(header=True, **options).csv(path)
    return path


def _tidy(spark, d, key: str, frame: DataFrame, start: int = START, **options) -> DataFrame:
    names = table(spark, d, "nation").select(F.col("n_name").alias("alias"), _code().alias("iso3"))
    return DATASETS[key].tidy(spark, _landed(spark, key, frame, **options), Context(start, names))


def _code() -> Column:
    return F.concat(F.substring("n_name", 1, 2), F.char(65 + F.col("n_nationkey")))


_CODE = "substr(n_name, 1, 2) || chr(65 + n_nationkey::INTEGER)"


def _yearly(spark, d) -> DataFrame:
    """(n_name, n_nationkey, iso3, y, p, n): orders of each nation and year."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return cut(o.groupBy("n_name", "n_nationkey", _code().alias("iso3"), F.year("o_orderdate").alias("y")).agg(F.floor(F.max("o_totalprice")).alias("p"), F.count("*").alias("n")))


_YEARLY = f"""WITH b AS (SELECT n_name, n_nationkey, {_CODE} AS iso3, year(o_orderdate)::INTEGER AS y, floor(max(o_totalprice))::BIGINT AS p, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


@query(f"{_YEARLY} SELECT iso3, y AS year, p / 1000000.0 AS gii, n / 10.0 AS mys, round((least(p / 20000.0, 18) / 18 + least(n / 10.0, 15) / 15) / 2, 8) AS edu_index FROM b WHERE y >= {START}")
def source_hdi(spark, d):
    """Years beside each other, in an eight-bit encoding, with columns of other measures and rows of regions."""
    b = _yearly(spark, d).select("iso3", "y", (F.col("p") / 1e6).alias("gii"), (F.col("p") / 2e4).alias("eys"), (F.col("n") / 10).alias("mys"))
    years = sorted(r.y for r in b.select("y").distinct().collect())
    one = lambda m, y: F.max(F.when(F.col("y") == y, F.col(m)))
    cells = [one(m, y).alias(f"{m}_{y}") for y in years for m in ("gii", "eys", "mys")] + [F.lit(1).alias(f"gii_rank_{y}") for y in years] + [F.lit(9).alias(f"eys_f_{y}") for y in years]
    wide = b.groupBy("iso3").agg(F.lit("Réunion").alias("name"), *cells)
    wide = wide.unionByName(wide.withColumn("iso3", F.concat(F.lit("ZZ."), "iso3")))
    out = _tidy(spark, d, "hdi", wide, encoding="iso-8859-1").where("gii is not null")
    return out.select("iso3", "year", "gii", "mys", F.round("edu_index", 8).alias("edu_index"))


@query(
    f"""{_YEARLY}, v AS (SELECT CASE n_name WHEN 'MOROCCO' THEN 'MAR' ELSE iso3 END AS iso3, y AS year, p / 1000000.0 AS v2x_rule, n / 1000.0 AS v2x_libdem FROM b WHERE y >= {START})
    SELECT * FROM v UNION ALL SELECT 'ESH', year, v2x_rule, v2x_libdem FROM v WHERE iso3 = 'MAR'"""
)
def source_vdem(spark, d):
    code = F.when(F.col("n_name") == "MOROCCO", "MAR").otherwise(F.col("iso3"))
    empty = [F.lit(None).cast("double").alias(c) for c in ("v2x_civlib", "v2x_polyarchy", "v2xpe_exlsocgr", "v2xpe_exlgender")]
    b = _yearly(spark, d).select(F.col("n_name").alias("country_name"), code.alias("country_text_id"), F.col("y").alias("year"), (F.col("p") / 1e6).alias("v2x_rule"), (F.col("n") / 1000).alias("v2x_libdem"), *empty)
    gaza = b.limit(1).withColumn("country_name", F.lit("Palestine/Gaza"))
    return _tidy(spark, d, "vdem", b.unionByName(gaza)).select("iso3", "year", "v2x_rule", "v2x_libdem")


@query(
    f"""WITH g AS (SELECT {_CODE} AS iso3, s_suppkey, 1990 + s_suppkey % 9 AS a, 1990 + s_suppkey % 9 + s_suppkey % 6 - 1 AS b, (s_suppkey % 100) / 200.0 AS size FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name <> 'PERU')
    SELECT iso3, y::INTEGER AS year, 'group, ' || s_suppkey AS "group", size FROM g, range(1990, 2010) t(y) WHERE y BETWEEN a AND b AND b >= {START}"""
)
def source_epr(spark, d):
    """Periods of groups, with commas inside quotes and a state without a code."""
    k = F.col("s_suppkey")
    g = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.when(F.col("n_name") == "PERU", "nowhere").otherwise(F.lower("n_name"))
    rows = g.select(name.alias("statename"), (1990 + k % 9).alias("from"), (1990 + k % 9 + k % 6 - 1).alias("to"), F.concat(F.lit("group, "), k).alias("group"), ((k % 100) / 200).alias("size"), F.lit("POWERLESS").alias("status"))
    return _tidy(spark, d, "epr", rows).select("iso3", "year", "group", "size")


@query(f"{_YEARLY} SELECT iso3, y AS year, round(n / 1000.0, 8) AS gini_disp FROM b WHERE y >= {START} AND n_name <> 'PERU'")
def source_swiid(spark, d):
    b = _yearly(spark, d).select(F.when(F.col("n_name") == "PERU", "Nowhere").otherwise(F.initcap("n_name")).alias("country"), F.col("y").alias("year"), (F.col("n") / 10).alias("gini_disp"))
    return _tidy(spark, d, "swiid", b).select("iso3", "year", F.round("gini_disp", 8).alias("gini_disp"))


@query(f"{_YEARLY} SELECT iso3, y AS year, CASE WHEN n % 3 <> 0 THEN n::DOUBLE END AS refugees, p::DOUBLE AS idps, (CASE WHEN n % 3 <> 0 THEN n ELSE 0 END + p)::DOUBLE AS forcibly_displaced FROM b WHERE y >= {START}")
def source_unhcr(spark, d):
    """A dash stands for a missing number."""
    dash = F.when(F.col("n") % 3 != 0, F.col("n").cast("string")).otherwise("-")
    rows = _yearly(spark, d).select(
        F.col("iso3").alias("Country of asylum (ISO)"), F.col("y").alias("Year"), dash.alias("Refugees under UNHCR's mandate"), F.lit("-").alias("Asylum-seekers"),
        F.lit("-").alias("Other people in need of international protection"), F.col("p").alias("IDPs of concern to UNHCR"),
    )
    return _tidy(spark, d, "unhcr", rows).select("iso3", "year", "refugees", "idps", "forcibly_displaced")


@query(f"{_YEARLY} SELECT iso3, y AS year, p::DOUBLE AS gdp_ppp FROM b WHERE y >= {START} AND n % 4 <> 0")
def source_imf(spark, d):
    rows = _yearly(spark, d).select(F.col("n_name").alias("COUNTRY"), F.lit("PPPGDP").alias("INDICATOR"), F.col("y").alias("TIME_PERIOD"), F.when(F.col("n") % 4 != 0, F.col("p")).alias("OBS_VALUE"))
    return _tidy(spark, d, "imf", rows)


@query(f"{_YEARLY} SELECT iso3, y AS year, 'farm_share' AS name, round(n::DOUBLE / p, 8) AS value FROM b WHERE y >= {START - 5} UNION ALL SELECT iso3, y, 'participation', n::DOUBLE FROM b WHERE y >= {START - 5}")
def source_ilo(spark, d):
    """Compressed, with repeated rows, regions, and sectors as rows."""
    b = _yearly(spark, d).select("iso3", "y", "n", "p")
    row = lambda name, sex, kind, value: F.struct(F.lit(ILO_SERIES[name]).alias("indicator"), F.lit(sex).alias("sex"), F.lit(kind).alias("classif1"), value.cast("long").alias("obs_value"))
    kinds = F.array(
        row("farm_share", "SEX_T", "ECO_SECTOR_TOTAL", F.col("p")), row("farm_share", "SEX_T", "ECO_SECTOR_AGR", F.col("n")), row("farm_share", "SEX_F", "ECO_SECTOR_AGR", F.col("p")),
        row("participation", "SEX_T", "AGE_YTHADULT_YGE15", F.col("n")), row("participation", "SEX_T", "AGE_YTHADULT_YGE15", F.col("n")), row("participation", "SEX_T", "AGE_Y15-24", F.col("p")),
    )
    rows = b.unionByName(b.limit(5).withColumn("iso3", F.lit("X99"))).select(F.col("iso3").alias("ref_area"), F.col("y").alias("time"), F.explode(kinds).alias("k")).select("ref_area", "time", "k.*")
    names = F.when(F.col("indicator") == ILO_SERIES["farm_share"], "farm_share").otherwise("participation")
    return _tidy(spark, d, "ilo", rows, compression="gzip").select("iso3", "year", names.alias("name"), F.round("value", 8).alias("value"))


@query(f"{_YEARLY} SELECT iso3, y AS year, 'SN_ITK_DEFC' AS series, CASE WHEN n % 2 = 0 THEN '<2.5' ELSE n || '.0' END AS value FROM b WHERE y >= {START - 15}")
def source_sdg(spark, d):
    """Bounded numbers, both sexes only, areas without a code left out."""
    rows = _yearly(spark, d).select(F.lit("SN_ITK_DEFC").alias("SeriesCode"), F.col("n_name").alias("GeoAreaName"), F.col("y").alias("TimePeriod"), F.when(F.col("n") % 2 == 0, "<2.5").otherwise(F.concat("n", F.lit(".0"))).alias("Value"), F.lit("BOTHSEX").alias("[Sex]"))
    others = rows.withColumn("[Sex]", F.lit("MALE")).unionByName(rows.limit(3).withColumn("GeoAreaName", F.lit("Southern Africa"))).unionByName(rows.limit(3).withColumn("GeoAreaName", F.lit("World")))
    return _tidy(spark, d, "sdg", rows.unionByName(others)).select("iso3", "year", "series", "value")


@query(f"SELECT 'r' || s_suppkey AS gdlcode, y::INTEGER AS year, CASE WHEN (s_suppkey + y) % 5 <> 0 THEN (s_suppkey % 89 + y - 1980) / 200.0 END AS edindex FROM supplier, range(1985, 2001) t(y) WHERE y >= {START - 5}")
def source_shdi(spark, d):
    """A blank stands for a missing number; national rows are left out."""
    k, y = F.col("s_suppkey"), F.col("year")
    rows = table(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(1985), F.lit(2000))).alias("year"), F.explode(F.array(F.lit("Subnat"), F.lit("National"))).alias("level"))
    index = F.when((k + y) % 5 != 0, ((k % 89 + y - 1980) / 200).cast("string")).otherwise(" ")
    rows = rows.select(F.concat(F.lit("r"), k).alias("GDLCODE"), "level", "year", index.alias("edindex"), F.lit(" ").alias("healthindex"), F.lit(" ").alias("sgdi"))
    return _tidy(spark, d, "shdi", rows, ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False).select("gdlcode", "year", "edindex")


@query("SELECT p_partkey // 3 AS pfaf_id, CASE WHEN p_partkey // 3 % 7 <> 0 THEN (p_partkey // 3 % 50) / 25.0 END AS bws_raw FROM part GROUP BY ALL")
def source_aqueduct(spark, d):
    """Several rows a basin, a number for missing values, more columns than are wanted."""
    basin = F.floor(F.col("p_partkey") / 3)
    rows = table(spark, d, "part").select("p_name", basin.alias("pfaf_id"), "p_type", F.when(basin % 7 != 0, (basin % 50) / 25).otherwise(-9999.0).alias("bws_raw"))
    return _tidy(spark, d, "aqueduct", rows)
