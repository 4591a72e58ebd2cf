"""Neighbourhoods, bridges, rasters and polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import cells
from riskweave.operators import grid, polygons, raster, spatial
from riskweave.plans import fixtures as X
from riskweave.plans.registry import query
from riskweave.session import table

W = f"WITH {X.SQL}"
_NEAR = """off AS (SELECT a.r, b.c FROM (VALUES (-1), (0), (1)) a(r), (VALUES (-1), (0), (1)) b(c)),
near AS (SELECT pgid, pgid + r * 720 + c + CASE WHEN c = -1 AND (pgid - 1) % 720 = 0 THEN 720 WHEN c = 1 AND (pgid - 1) % 720 = 719 THEN -720 ELSE 0 END AS other FROM entities, off)"""


@query(
    f"""{W}, {_NEAR} SELECT q.pgid, q.year, q.quarter, round(m, 6) AS near_mean, round(s, 6) AS near_sum FROM quarterly q
    LEFT JOIN (SELECT near.pgid, year, quarter, avg(value) AS m, sum(value) AS s FROM near JOIN quarterly o ON o.pgid = other GROUP BY ALL) n USING (pgid, year, quarter)"""
)
def neighbour_mean_sum(spark, d):
    out = spatial.neighbourhood(X.quarterly(spark, d), "pgid", ["year", "quarter"], "value")
    return out.select("pgid", "year", "quarter", F.round("near_mean", 6).alias("near_mean"), F.round("near_sum", 6).alias("near_sum"))


@query(f"{W}, {_NEAR} SELECT pgid, other::INTEGER AS other FROM near WHERE other BETWEEN 1 AND 259200 AND other <> pgid")
def dateline_neighbours(spark, d):
    return X.entities(spark, d).select("pgid", F.explode(cells.neighbours(F.col("pgid"), keep_centre=False)).alias("other"))


def _bridge(spark, d):
    line = table(spark, d, "lineitem").join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("area")), "l_partkey")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") + 1).cast("int").alias("pgid"))
    parts = line.join(o, "l_orderkey").groupBy("pgid", "area").agg(F.sum("l_quantity").alias("q"))
    return parts.join(parts.groupBy("pgid").agg(F.sum("q").alias("t")), "pgid").select("pgid", "area", (F.col("q") / F.col("t")).alias("share"))


_BRIDGE = """parts AS (SELECT (o_custkey + 1)::INTEGER AS pgid, p_brand AS area, sum(l_quantity) AS q FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL),
bridge AS (SELECT pgid, area, q / sum(q) OVER (PARTITION BY pgid) AS share FROM parts)"""


@query(
    f"""WITH {_BRIDGE}, v AS (SELECT p_brand AS area, CASE WHEN p_brand LIKE '%1' THEN NULL ELSE avg(p_retailprice) END AS x FROM part GROUP BY p_brand)
    SELECT pgid, round(sum(x * share) / sum(CASE WHEN x IS NOT NULL THEN share END), 6) AS x FROM bridge JOIN v USING (area) GROUP BY pgid"""
)
def area_weighted_mean(spark, d):
    v = table(spark, d, "part").groupBy(F.col("p_brand").alias("area")).agg(F.avg("p_retailprice").alias("x")).withColumn("x", F.when(~F.col("area").endswith("1"), F.col("x")))
    return spatial.bridged_mean(_bridge(spark, d), v, "area", ["pgid"], "x").select("pgid", F.round("x", 6).alias("x"))


@query(f"WITH {_BRIDGE} SELECT pgid, area, round(covered, 6) AS covered FROM (SELECT *, sum(share) OVER (PARTITION BY pgid) AS covered, row_number() OVER (PARTITION BY pgid ORDER BY share DESC, area) AS r FROM bridge) WHERE r = 1 AND covered >= 0.25")
def argmax_assignment(spark, d):
    return spatial.largest_share(_bridge(spark, d), "pgid", "area").select("pgid", "area", F.round("covered", 6).alias("covered"))


@query(
    f"""{W}, r AS (SELECT iso3, value, row_number() OVER (PARTITION BY iso3 ORDER BY value) AS i, count(*) OVER (PARTITION BY iso3) AS n FROM ev JOIN entities USING (pgid))
    SELECT iso3, round(2 * sum(i * value) / (max(n) * sum(value)) - (max(n) + 1.0) / max(n), 8) AS gini FROM r GROUP BY iso3"""
)
def gini_by_group(spark, d):
    e = X.events(spark, d).join(X.entities(spark, d), "pgid")
    return spatial.gini(e, ["iso3"], "value").select("iso3", F.round("gini", 8).alias("gini"))


#: Rows of a task that groups by pixel.
PART = 500_000


def _pixels(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"), F.col("l_quantity").alias("v"))


@query("SELECT l_partkey // 50 AS zone, round(avg(l_quantity), 6) AS mean, sum(l_quantity) AS sum, count(l_quantity) AS n FROM lineitem GROUP BY 1")
def zonal_stats(spark, d):
    out = raster.zonal(_pixels(spark, d), F.floor(F.col("x") / 50), "v")
    return out.select("zone", F.round("mean", 6).alias("mean"), "sum", "n")


@query("SELECT l_suppkey AS zone, count(*) FILTER (l_linenumber = 1)::BIGINT AS water, count(*) FILTER (l_linenumber = 2)::BIGINT AS crop FROM lineitem GROUP BY 1")
def pixel_categories(spark, d):
    return raster.categories(table(spark, d, "lineitem"), F.col("l_suppkey"), "l_linenumber", {"water": 1, "crop": 2})


@query("SELECT l_partkey // 5 AS x, l_suppkey // 5 AS y, sum(l_quantity) AS v FROM lineitem GROUP BY ALL")
def coarsen_5x5(spark, d):
    return raster.coarsen(_pixels(spark, d), "v", 5)


@query(
    """WITH p AS (SELECT l_partkey AS x, l_suppkey AS y, sum(l_quantity) AS v FROM lineitem GROUP BY ALL), m AS (SELECT l_partkey AS x, l_suppkey AS y, max(l_tax) AS t FROM lineitem WHERE l_linenumber < 4 GROUP BY ALL)
    SELECT p.x, p.y, CASE WHEN t <= 0.05 THEN v END AS v FROM p LEFT JOIN m USING (x, y)"""
)
def masked_pixels(spark, d):
    """Pixels are nearly as many as rows, so both layers are grouped after their shuffle, in parts of as many rows at any size."""
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"), F.col("l_quantity").alias("v"), F.col("l_tax").alias("t"), "l_linenumber")
    dealt = rows.repartition(-(-rows.count() // PART) or 1, "x", "y")
    p = dealt.groupBy("x", "y").agg(F.sum("v").alias("v"))
    m = dealt.where("l_linenumber < 4").groupBy("x", "y").agg(F.max("t").alias("t"))
    return raster.masked(p, m, F.col("t") <= 0.05, "v").select("x", "y", "v")


_NODES = "nodes AS (SELECT (i % 20)::DOUBLE AS x, (i // 20)::DOUBLE AS y, (i * i % 101)::DOUBLE AS v FROM range(400) t(i))"


def _nodes(spark):
    i = F.col("id")
    return spark.range(400).select((i % 20).cast("double").alias("x"), F.floor(i / 20).cast("double").alias("y"), (i * i % 101).cast("double").alias("v"))


@query(
    f"""WITH {_NODES}, t AS (SELECT DISTINCT (c_custkey % 76) / 4.0 AS x, (c_custkey % 73) / 4.0 AS y FROM customer),
    k AS (SELECT t.x, t.y, n.v, CASE WHEN n.x = floor(t.x) THEN 1 - (t.x - floor(t.x)) ELSE t.x - floor(t.x) END * CASE WHEN n.y = floor(t.y) THEN 1 - (t.y - floor(t.y)) ELSE t.y - floor(t.y) END AS w
      FROM t JOIN nodes n ON n.x BETWEEN floor(t.x) AND floor(t.x) + 1 AND n.y BETWEEN floor(t.y) AND floor(t.y) + 1)
    SELECT x, y, round(sum(v * w), 8) AS v FROM k GROUP BY ALL"""
)
def bilinear_resample(spark, d):
    k = F.col("c_custkey")
    t = table(spark, d, "customer").select(((k % 76) / 4.0).alias("x"), ((k % 73) / 4.0).alias("y")).distinct()
    return raster.bilinear(_nodes(spark), t, "v").select("x", "y", F.round("v", 8).alias("v"))


@query(f"WITH {_NODES}, t AS (SELECT DISTINCT (c_custkey % 76) / 4.0 AS x, (c_custkey % 73) / 4.0 AS y FROM customer) SELECT t.x, t.y, n.v FROM t LEFT JOIN nodes n ON n.x = round(t.x) AND n.y = round(t.y)")
def nearest_resample(spark, d):
    k = F.col("c_custkey")
    t = table(spark, d, "customer").select(((k % 76) / 4.0).alias("x"), ((k % 73) / 4.0).alias("y")).distinct()
    return raster.nearest(_nodes(spark), t, "v", 1.0)


@query(f"{W}, b AS (SELECT pgid, avg(value) AS base FROM quarterly WHERE year <= 1997 GROUP BY pgid) SELECT pgid, year, quarter, round(value - base, 6) AS anomaly FROM quarterly LEFT JOIN b USING (pgid)")
def baseline_anomaly(spark, d):
    out = raster.anomaly(X.quarterly(spark, d), ["pgid"], "value", F.col("year") <= 1997)
    return out.select("pgid", "year", "quarter", F.round("anomaly", 6).alias("anomaly"))


@query(
    """WITH p AS (SELECT l_suppkey AS zone, l_quantity AS cover, l_linenumber - 1 AS lossyear, l_linenumber % 3 AS datamask FROM lineitem),
    b AS (SELECT zone, sum(cover) AS a, avg(CASE WHEN datamask = 1 THEN cover END) AS dens FROM p GROUP BY zone)
    SELECT zone, y::INTEGER AS year, round(coalesce((SELECT sum(cover) FROM p WHERE p.zone = b.zone AND lossyear > 0 AND lossyear <= y), 0) / a * dens / 100, 8) AS loss FROM b, range(1, 7) t(y)"""
)
def loss_share(spark, d):
    n = F.col("l_linenumber")
    p = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("z"), F.col("l_quantity").alias("cover"), (n - 1).alias("lossyear"), (n % 3).alias("datamask"))
    return raster.loss_share(p, F.col("z"), (1, 6)).select("zone", "year", F.round("loss", 8).alias("loss"))


def _arrows(spark, d):
    """A shape for each nation: a square with a notch cut from above and a square hole; shapes of neighbours overlap."""
    k = F.col("n_nationkey")
    x, y = k % 5 * 3 + 0.37, F.floor(k / 5) * 2.75 + 0.21
    corner = lambda dx, dy: F.format_string("%s %s", (x + dx).cast("string"), (y + dy).cast("string"))
    ring = lambda *at: F.concat(F.lit("("), F.concat_ws(", ", *[corner(*p) for p in (*at, at[0])]), F.lit(")"))
    outer, hole = ring((0, 0), (4, 0), (4, 4), (2, 2), (0, 4)), ring((1, 0.5), (1.5, 0.5), (1.5, 1), (1, 1))
    wkt = F.concat(F.lit("POLYGON ("), outer, F.lit(", "), hole, F.lit(")"))
    return table(spark, d, "nation").select(F.col("n_name").alias("area"), F.col("n_nationkey").alias("no"), polygons.polygon_parts(wkt).alias("parts"))


def _dots(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), (k % 187 / 10 + 0.031).alias("x"), (k % 149 / 10 + 0.073).alias("y"))


_ARROWS = """WITH p AS (SELECT c_custkey AS id, c_custkey % 187 / 10.0 + 0.031 AS x, c_custkey % 149 / 10.0 + 0.073 AS y FROM customer),
hit AS (SELECT id, n_name AS area, n_nationkey AS no FROM (SELECT id, n_name, n_nationkey, x - (n_nationkey % 5 * 3 + 0.37) AS u, y - (n_nationkey // 5 * 2.75 + 0.21) AS v FROM p, nation)
WHERE u > 0 AND u < 4 AND v > 0 AND v < abs(u - 2) + 2 AND NOT (u BETWEEN 1 AND 1.5 AND v BETWEEN 0.5 AND 1))"""


@query(f"{_ARROWS} SELECT id, area FROM hit")
def points_in_polygons(spark, d):
    return polygons.points_in_polygons(_dots(spark, d), _arrows(spark, d)).select("id", "area")


@query(f"{_ARROWS} SELECT id, arg_max(area, no) AS area FROM p LEFT JOIN hit USING (id) GROUP BY id")
def last_polygon_of_points(spark, d):
    """Where areas overlap, the later one counts."""
    return polygons.area_of_points(_dots(spark, d), _arrows(spark, d), ["id"], "no")


def _overlap(a: str, b: str, c: str, e: str) -> str:
    return f"greatest(least(lon + 0.25 - x, {c}) - greatest(lon - 0.25 - x, {a}), 0) * greatest(least(lat + 0.25 - y, {e}) - greatest(lat - 0.25 - y, {b}), 0)"


@query(
    f"""WITH g AS (SELECT c_custkey AS pgid, c_custkey % 40 / 2.0 + 0.25 AS lon, c_custkey // 40 % 40 / 2.0 + 0.25 AS lat FROM customer),
    a AS (SELECT pgid, n_name AS area, lon, lat, n_nationkey % 5 * 3 + 0.37 AS x, n_nationkey // 5 * 2.75 + 0.21 AS y FROM g, nation)
    SELECT pgid, area, round(share, 8) AS share FROM (SELECT pgid, area, 4 * ({_overlap("0", "0", "4", "4")} - {_overlap("2", "2", "4", "4")} - {_overlap("1", "0.5", "1.5", "1")}) AS share FROM a) WHERE share > 1e-9"""
)
def polygon_shares(spark, d):
    """Shares of cells that customers stand for, in shapes like an L with a hole, one for each nation."""
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    g = table(spark, d, "customer").select(k.alias("pgid"), (k % 40 / 2 + 0.25).alias("lon"), (F.floor(k / 40) % 40 / 2 + 0.25).alias("lat"))
    x, y = n % 5 * 3 + 0.37, F.floor(n / 5) * 2.75 + 0.21
    at = lambda *c: F.concat_ws(", ", *[F.concat((x + a).cast("string"), F.lit(" "), (y + b).cast("string")) for a, b in (*c, c[0])])
    wkt = F.concat(F.lit("POLYGON (("), at((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)), F.lit("), ("), at((1, 0.5), (1, 1), (1.5, 1), (1.5, 0.5)), F.lit("))"))
    shapes = table(spark, d, "nation").select(F.col("n_name").alias("area"), polygons.polygon_parts(wkt).alias("parts"))
    return polygons.area_bridge(g, shapes).where("share > 1e-9").select("pgid", "area", F.round("share", 8).alias("share"))


@query("SELECT s_suppkey, b / 2.0 + 0.25 AS lon, (s_suppkey % 7)::DOUBLE + 0.25 AS lat FROM supplier, range(0, 6) t(b) WHERE b <= floor((s_suppkey % 5) / 2.0 / 0.5 + 0.5)")
def line_cells(spark, d):
    k = F.col("s_suppkey")
    y = (k % 7).cast("double") + 0.2
    lines = table(spark, d, "supplier").select("s_suppkey", F.lit(0.1).alias("x0"), y.alias("y0"), (F.lit(0.1) + (k % 5) / 2.0 + 0.2).alias("x1"), y.alias("y1"))
    return spatial.touched_cells(lines).select("s_suppkey", "lon", "lat")


@query(
    """SELECT (((lat + 90.25) * 2 - 1) * 720 + (lon + 180.25) * 2)::INTEGER AS pgid, lat, lon
    FROM (SELECT 9.75 + r / 2.0 AS lat, -20.25 + c / 2.0 AS lon FROM range(12) a(r), range(62) b(c))"""
)
def grid_from_bounds(spark, d):
    return grid.from_bounds(spark, -20.1, 9.8, 10.3, 15.2).select("pgid", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))


@query(
    """SELECT iso3, r_regionkey, dense_rank() OVER (ORDER BY iso3) - 1 AS cid FROM (SELECT CASE n_name WHEN 'FRANCE' THEN 'GERMANY' ELSE n_name END AS iso3, n_regionkey AS r_regionkey FROM nation WHERE n_name <> 'PERU' AND n_nationkey <> 7)
    """
)
def country_numbers(spark, d):
    n = table(spark, d, "nation").select(F.col("n_name").alias("iso3"), F.col("n_regionkey").alias("r_regionkey"), "n_nationkey")
    out = grid.countries(n, {"FRANCE": "GERMANY"}, ["PERU"], F.col("n_nationkey") == 7)
    return out.select("iso3", "r_regionkey", F.col("cid").cast("long").alias("cid"))


@query(
    """WITH f AS (SELECT user_id, ts, max(value) / 2 AS lat, (max(value) * 37) % 360 - 180 AS lon FROM events GROUP BY ALL),
    n AS (SELECT *, lead(ts) OVER w AS t2, lead(lat) OVER w AS la2, lead(lon) OVER w AS lo2 FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    m AS (SELECT user_id, ts, (epoch_us(t2) - epoch_us(ts)) / 3.6e9 AS hours, sqrt(pow((lo2 - lon + 180 - 360 * floor((lo2 - lon + 180) / 360) - 180) * cos(radians((lat + la2) / 2)) * 111.2, 2) + pow((la2 - lat) * 111.2, 2)) AS km FROM n)
    SELECT user_id, ts, round(hours, 6) AS hours, round(km, 4) AS km FROM m"""
)
def track_motion(spark, d):
    f = table(spark, d, "events").groupBy("user_id", "ts").agg((F.max("value") / 2).alias("lat"), ((F.max("value") * 37) % 360 - 180).alias("lon"))
    return grid.track_motion(f, "user_id", "ts").select("user_id", "ts", F.round("hours", 6).alias("hours"), F.round("km", 4).alias("km"))
