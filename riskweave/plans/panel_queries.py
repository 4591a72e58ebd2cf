"""Panel construction, joins, filters and reshapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import calendar, cells, scores
from riskweave.operators import panel as P
from riskweave.plans import fixtures as X
from riskweave.plans.registry import query
from riskweave.session import table

W = f"WITH {X.SQL}"


@query(f"{W} SELECT pgid, iso3, year, quarter, time FROM panel")
def panel_dense(spark, d):
    return X.panel(spark, d)


@query(
    """SELECT pgid, round(lat, 6) AS lat, round(lon, 6) AS lon, (((lat + 90.25) * 2 - 1) * 720 + (lon + 180.25) * 2)::INTEGER AS back
    FROM (SELECT (c_custkey * 37 % 259200 + 1)::INTEGER AS pgid, floor((c_custkey * 37 % 259200) / 720) / 2 - 89.75 AS lat,
          (c_custkey * 37 % 259200) % 720 / 2 - 179.75 AS lon FROM customer)"""
)
def pgid_roundtrip(spark, d):
    ids = table(spark, d, "customer").select((F.col("c_custkey") * 37 % 259200 + 1).cast("int").alias("pgid"))
    placed = ids.withColumn("lat", cells.cell_lat(F.col("pgid")).cast("double")).withColumn("lon", cells.cell_lon(F.col("pgid")).cast("double"))
    return placed.select("pgid", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), cells.cell_id(F.col("lat"), F.col("lon")).alias("back"))


@query(
    """SELECT c_custkey, x, floor(w / 0.5) * 0.5 + 0.25 AS centre,
      (CASE WHEN v - floor(v) < 0.5 OR (v - floor(v) = 0.5 AND floor(v) % 2 = 0) THEN floor(v) ELSE floor(v) + 1 END) / 2 + 0.25 AS nearest,
      floor(x / 0.25) * 0.25 AS down, ceil(x / 0.25) * 0.25 AS up,
      lpad(abs(floor(x / 40) * 10 + 10)::INTEGER::VARCHAR, 2, '0') || CASE WHEN floor(x / 40) * 10 + 10 >= 0 THEN 'N' ELSE 'S' END || '_'
        || lpad(abs(floor(x / 10) * 10)::INTEGER::VARCHAR, 3, '0') || CASE WHEN floor(x / 10) >= 0 THEN 'E' ELSE 'W' END AS tile
    FROM (SELECT c_custkey, x, CASE WHEN x > 180 THEN x - 360 ELSE x END AS w, (x - 0.25) * 2 AS v FROM (SELECT c_custkey, (c_custkey % 2160) / 4.0 - 180 AS x FROM customer))"""
)
def coord_bins(spark, d):
    x = table(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") % 2160) / 4.0 - 180).alias("x"))
    c = F.col("x")
    return x.select(
        "c_custkey", "x", cells.bin_centre(c).alias("centre"), cells.nearest_centre(c).cast("double").alias("nearest"),
        cells.snap_down(c, 0.25).alias("down"), cells.snap_up(c, 0.25).alias("up"), cells.tile_name(c / 4, c).alias("tile"),
    )


@query(
    """SELECT o_orderkey, (date_trunc('quarter', o_orderdate))::DATE AS q_start, (date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS q_end,
      year(o_orderdate) * 4 + quarter(o_orderdate) - 2 AS last_complete,
      (month(o_orderdate) * 100 + day(o_orderdate) >= 1101 OR month(o_orderdate) * 100 + day(o_orderdate) <= 315) AS winter, strftime(o_orderdate, '%m_%d') AS doy FROM orders"""
)
def quarter_arithmetic(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", calendar.quarter_start(F.year(day), F.quarter(day)).alias("q_start"), calendar.quarter_end(F.year(day), F.quarter(day)).alias("q_end"),
        calendar.last_complete_quarter(day).cast("long").alias("last_complete"), calendar.in_season(day, (11, 1), (3, 15)).alias("winter"), calendar.day_key(day).alias("doy"),
    )


@query(f"{W} SELECT p.pgid, p.year, p.quarter, round(y.x, 6) AS x FROM panel p LEFT JOIN yearly y ON p.iso3 = y.iso3 AND p.year = y.year AND p.quarter = 4")
def yearly_to_quarterly(spark, d):
    out = P.yearly_to_quarterly(X.panel(spark, d), X.yearly(spark, d), ["iso3"])
    return out.select("pgid", "year", "quarter", F.round("x", 6).alias("x"))


@query(
    f"""{W}, cov AS (SELECT iso3, make_date((min(year) + length(iso3) % 4)::INTEGER, 1, 1) AS start FROM ev JOIN entities USING (pgid) GROUP BY iso3)
    SELECT pgid, year, quarter, CASE WHEN time >= start THEN coalesce(n, 0) END AS n FROM quarterly LEFT JOIN cov USING (iso3)"""
)
def covered_zero_fill(spark, d):
    e = X.events(spark, d).join(X.entities(spark, d), "pgid")
    start = e.groupBy("iso3").agg(F.min("year").alias("y")).select("iso3", F.make_date(F.col("y") + F.length("iso3") % 4, F.lit(1), F.lit(1)).alias("start"))
    return P.covered_zero(X.quarterly(spark, d).join(start, "iso3", "left"), ["n"], "start").select("pgid", "year", "quarter", "n")


@query(
    f"""{W}, two AS (SELECT iso3, year, x AS a, year * 10.0 + length(iso3) AS b FROM nation_years),
    g AS (SELECT iso3, count(*) FILTER (a IS NULL) AS gaps FROM two GROUP BY iso3)
    SELECT iso3, year, round(CASE WHEN gaps > 4 THEN b ELSE a END, 6) AS chosen FROM two JOIN g USING (iso3)"""
)
def source_fallback(spark, d):
    two = X.nation_years(spark, d).select("iso3", "year", F.col("x").alias("a"), (F.col("year") * 10.0 + F.length("iso3")).alias("b"))
    return P.fallback(two, "iso3", "a", "b", 4).select("iso3", "year", F.round("chosen", 6).alias("chosen"))


@query(
    """WITH b AS (SELECT o_orderkey, o_totalprice, 'base' AS version FROM orders WHERE o_orderkey % 3 <> 1),
    n AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, 'new' AS version FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_orderkey = b.o_orderkey) UNION ALL SELECT * FROM n"""
)
def upsert_supersede(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    base = o.where("o_orderkey % 3 <> 1").withColumn("version", F.lit("base"))
    newer = o.where("o_orderkey % 3 <> 0").withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("version", F.lit("new"))
    return P.supersede(base, newer, "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def left_semi_valid(spark, d):
    valid = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(valid, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query(f"{W} SELECT 'n' AS id, max(CASE WHEN n IS NOT NULL THEN year * 10 + quarter END) AS last FROM quarterly UNION ALL SELECT 'big', max(CASE WHEN value > 400000 THEN year * 10 + quarter END) FROM quarterly")
def recency(spark, d):
    q = X.quarterly(spark, d).withColumn("big", F.when(F.col("value") > 400000, F.col("value")))
    return P.recency(q, ["n", "big"])


@query(
    """WITH wide AS (SELECT n_name AS iso3, n_nationkey * 1.5 AS score_1999, n_nationkey * 2.5 AS score_2000, n_regionkey * 1.0 AS score_2001 FROM nation)
    SELECT iso3, score, substr(name, -4)::INTEGER AS year FROM (UNPIVOT wide ON score_1999, score_2000, score_2001 INTO NAME name VALUE score)"""
)
def unpivot_years(spark, d):
    n = table(spark, d, "nation")
    wide = n.select(F.col("n_name").alias("iso3"), (F.col("n_nationkey") * 1.5).cast("double").alias("score_1999"), (F.col("n_nationkey") * 2.5).cast("double").alias("score_2000"), (F.col("n_regionkey") * 1.0).cast("double").alias("score_2001"))
    return P.unpivot_years(wide, ["iso3"], "score_", "score")


@query(
    """SELECT c_nationkey, sum(c_acctbal) FILTER (c_mktsegment = 'BUILDING') IS NOT NULL AS building, round(sum(c_acctbal) FILTER (c_mktsegment = 'MACHINERY'), 4) AS machinery,
    round(sum(c_acctbal) FILTER (c_mktsegment = 'AUTOMOBILE'), 4) AS automobile FROM customer GROUP BY c_nationkey"""
)
def pivot_sector(spark, d):
    wide = table(spark, d, "customer").groupBy("c_nationkey").pivot("c_mktsegment", ["BUILDING", "MACHINERY", "AUTOMOBILE"]).agg(F.sum("c_acctbal"))
    return wide.select("c_nationkey", F.col("BUILDING").isNotNull().alias("building"), F.round("MACHINERY", 4).alias("machinery"), F.round("AUTOMOBILE", 4).alias("automobile"))


@query(
    f"""{W}, g AS (SELECT year, quarter FROM quarterly GROUP BY ALL HAVING avg((n IS NULL)::INTEGER) <= 0.72)
    SELECT q.pgid, q.year, q.quarter, CASE WHEN g.year IS NOT NULL THEN q.n END AS n FROM quarterly q LEFT JOIN g USING (year, quarter)"""
)
def availability_gate(spark, d):
    return P.gate(X.quarterly(spark, d), ["year", "quarter"], ["n"], 0.72).select("pgid", "year", "quarter", "n")


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal <= -500 THEN NULL ELSE c_acctbal END AS clean, CASE WHEN c_acctbal < 0 THEN -c_acctbal ELSE 0 END AS dryness,
      least(greatest(c_acctbal, 0), 5000) AS clipped, CASE WHEN c_custkey % 5 = 0 THEN 2.5 ELSE c_custkey END AS number,
      c_name NOT ILIKE '%7%' AS plain, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS heavy FROM customer"""
)
def cleaning(spark, d):
    b = F.col("c_acctbal")
    written = F.when(F.col("c_custkey") % 5 == 0, "<2.5").otherwise(F.col("c_custkey").cast("string"))
    return table(spark, d, "customer").select(
        "c_custkey", scores.without_sentinels(b, below=-500.0).alias("clean"), scores.reversed_negative(b).alias("dryness"), scores.clip(b, 0.0, 5000.0).alias("clipped"),
        scores.censored_number(written).alias("number"), (~F.lower("c_name").contains("7")).alias("plain"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 1).otherwise(0).alias("heavy"),
    )


@query(
    f"""{W}, n AS (SELECT iso3, year, x * 2 AS v FROM yearly WHERE year > 1998)
    SELECT a.iso3, a.year, round(coalesce(n.v, a.x), 6) AS over, round(coalesce(a.x, n.v), 6) AS fill FROM nation_years a LEFT JOIN n USING (iso3, year)"""
)
def update_values(spark, d):
    base = X.nation_years(spark, d)
    new = X.yearly(spark, d).where("year > 1998").select("iso3", "year", (F.col("x") * 2).alias("x"))
    over = P.update(base, new, ["iso3", "year"], "x").withColumnRenamed("x", "over")
    fill = P.update(base, new, ["iso3", "year"], "x", overwrite=False).withColumnRenamed("x", "fill")
    return over.join(fill, ["iso3", "year"]).select("iso3", "year", F.round("over", 6).alias("over"), F.round("fill", 6).alias("fill"))


@query(f"{W} SELECT c_custkey, c_acctbal, iso3 FROM (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50) JOIN entities ON pgid = c_custkey + 1")
def topk_enriched(spark, d):
    top = table(spark, d, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(50)
    return top.join(X.entities(spark, d), F.col("pgid") == F.col("c_custkey") + 1).select("c_custkey", "c_acctbal", "iso3")


@query(f"{W} SELECT pgid, CASE quarter WHEN 2 THEN 4 WHEN 4 THEN 2 ELSE quarter END AS quarter, year FROM panel")
def mid_year_swap(spark, d):
    return P.mid_year(X.panel(spark, d)).select("pgid", "quarter", "year")


@query(
    """WITH a AS (SELECT c_nationkey AS k, c_mktsegment AS s, avg(c_acctbal) AS x FROM customer WHERE c_custkey % 4 = 0 GROUP BY ALL),
    b AS (SELECT s_nationkey AS k, avg(s_acctbal) AS y FROM supplier GROUP BY ALL)
    SELECT coalesce(a.k, b.k) AS k, s, round(x, 4) AS x, round(y, 4) AS y FROM a FULL JOIN b ON a.k = b.k"""
)
def outer_concat(spark, d):
    a = table(spark, d, "customer").where("c_custkey % 4 = 0").groupBy(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("s")).agg(F.avg("c_acctbal").alias("x"))
    b = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.avg("s_acctbal").alias("y"))
    return a.join(b, "k", "full_outer").select("k", "s", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


_YEARLY_GAPS = """g AS (SELECT pgid, year, quarter, CASE WHEN year > 1998 THEN NULL ELSE value END AS a, CASE WHEN quarter <> 4 THEN n END AS b, CASE WHEN (pgid + year) % 3 = 0 THEN value END AS c FROM quarterly)"""


def _three_gaps(spark, d):
    late, last, third = F.col("year") > 1998, F.col("quarter") == 4, (F.col("pgid") + F.col("year")) % 3 == 0
    return X.quarterly(spark, d).select("pgid", "year", "quarter", F.when(~late, F.col("value")).alias("a"), F.when(~last, F.col("n")).alias("b"), F.when(third, F.col("value")).alias("c"))


@query(
    f"""WITH {X.SQL}, {_YEARLY_GAPS}, m AS (SELECT year, quarter, avg((a IS NULL)::INTEGER) AS ga, avg((b IS NULL)::INTEGER) AS gb, avg((c IS NULL)::INTEGER) AS gc FROM g GROUP BY ALL)
    SELECT year, quarter, (ga + gb + gc) / 3 <= 0.9 AS loose, (ga + gb + gc) / 3 <= 0.9 AND ga < 1 AND gb < 1 AND gc < 1 AS strict FROM m"""
)
def availability_three_columns(spark, d):
    g, at = _three_gaps(spark, d), ["year", "quarter"]
    steps = g.select(*at).distinct()
    for name, all_ in (("loose", False), ("strict", True)):
        good = P.availability(g, at, ["a", "b", "c"], 0.9, all_).withColumn(name, F.lit(True))
        steps = steps.join(good, at, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return steps


@query("SELECT o_orderkey, y::INTEGER AS year FROM (SELECT o_orderkey, unnest(range(year(o_orderdate), year(o_orderdate) + o_custkey % 4)) AS y FROM orders WHERE o_custkey % 4 > 0)")
def interval_years(spark, d):
    o = table(spark, d, "orders")
    first = F.year("o_orderdate")
    return P.years_of(o.select("o_orderkey", first.alias("a"), (first + F.col("o_custkey") % 4 - 1).cast("int").alias("b")), "a", "b")


@query("SELECT n_name, n_regionkey FROM nation UNION ALL SELECT 'EGYPT AND SUDAN', n_regionkey FROM nation WHERE n_name = 'EGYPT'")
def repeated_key(spark, d):
    return P.also_as(table(spark, d, "nation").select("n_name", "n_regionkey"), "n_name", {"EGYPT": "EGYPT AND SUDAN"})


@query("SELECT o_custkey, round(nullif(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END), 0)::DOUBLE, 4) AS urgent FROM orders GROUP BY o_custkey")
def total_or_null(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(0.0).alias("x"))
    return P.total_or_null(o, ["o_custkey"], "x", "urgent").withColumn("urgent", F.round("urgent", 4))


@query(f"WITH {X.SQL}, k AS (SELECT iso3, count(x) AS n FROM nation_years GROUP BY iso3) SELECT iso3, year, round(CASE WHEN n < 6 THEN year * 1.0 ELSE x END, 6) AS chosen FROM nation_years JOIN k USING (iso3)")
def model_fallback(spark, d):
    y = X.nation_years(spark, d).withColumn("model", F.col("year").cast("double"))
    return P.fallback_if_few(y, "iso3", "x", "model", 6).select("iso3", "year", F.round("chosen", 6).alias("chosen"))
