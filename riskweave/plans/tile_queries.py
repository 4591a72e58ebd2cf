"""Tile layers, zonal sums that are brought up to date, and lookups kept as maps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskweave.operators import tiles
from riskweave.plans.registry import query
from riskweave.session import shared_folder, table

_PIXELS = "l_suppkey % 12 AS tile, l_partkey % 211 AS x, l_suppkey % 7 AS y"


@query(
    f"""WITH cover AS (SELECT {_PIXELS}, max(CASE WHEN l_suppkey % 12 IN (4, 5) THEN CASE l_suppkey % 12 WHEN 5 THEN 0 ELSE 2 END ELSE l_quantity END) AS cover FROM lineitem GROUP BY ALL),
    loss AS (SELECT {_PIXELS}, max(l_linenumber) AS loss FROM lineitem WHERE l_suppkey % 12 NOT IN (4, 5) GROUP BY ALL),
    mask AS (SELECT {_PIXELS}, max(l_linenumber % 3) AS mask FROM lineitem WHERE l_suppkey % 12 <> 7 GROUP BY ALL),
    beside AS (SELECT *, CASE WHEN tile = 4 THEN 0 ELSE loss END AS lost, row_number() OVER (PARTITION BY x, y ORDER BY tile % 5, tile) AS r
      FROM cover LEFT JOIN loss USING (tile, x, y) LEFT JOIN mask USING (tile, x, y) WHERE tile NOT IN (5, 7, 9))
    SELECT x, y, tile, cover::DOUBLE AS cover, lost::DOUBLE AS loss, mask::DOUBLE AS mask FROM beside WHERE r = 1"""
)
def tile_mosaic(spark, d):
    """Three layers in overlapping tiles: 4 lacks its losses and has cover, 5 lacks both, 7 lacks its mask, 9 isn't in the index."""
    line = table(spark, d, "lineitem")
    at = [(F.col("l_suppkey") % 12).alias("tile"), (F.col("l_partkey") % 211).alias("x"), (F.col("l_suppkey") % 7).alias("y")]
    pixels = lambda rows, v: rows.groupBy(*at).agg(F.max(v).alias("value"))
    t = F.col("l_suppkey") % 12
    layers = {
        "cover": pixels(line, F.when(t == 5, 0.0).when(t == 4, 2.0).otherwise(F.col("l_quantity").cast("double"))),
        "loss": pixels(line.where(~t.isin(4, 5)), F.col("l_linenumber")),
        "mask": pixels(line.where(t != 7), F.col("l_linenumber") % 3),
    }
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("layer"), F.col("tile").isin(gone) == F.lit(False)) for n, gone in (("cover", []), ("loss", [4, 5]), ("mask", [7]))])).alias("l")
    index = line.select(at[0]).distinct().where("tile <> 9").select("tile", (F.col("tile") % 5).alias("rank"), each)
    index = index.select("tile", "rank", "l.layer", F.col("l.col2").alias("there"))
    return tiles.mosaic(index, layers, "cover", {"loss": 0.0}).select("x", "y", "tile", "cover", "loss", "mask")


@query("SELECT l_suppkey % 50 AS zone, year(l_shipdate)::INTEGER AS year, sum(l_quantity)::DOUBLE AS sum, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL")
def zonal_incremental(spark, d):
    """Early years first, then all: the second run adds the rest, the third has nothing to do."""
    pixels = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("unit"), F.year("l_shipdate").alias("year"), (F.col("l_suppkey") % 50).alias("z"), F.col("l_quantity").alias("v"))
    required = pixels.select("unit", "year").distinct().withColumn("version", F.lit("v1"))
    zones = tiles.YearlyZones(spark, f"{shared_folder(spark)}/zones-{uuid.uuid4().hex}")
    early = zones.update(required.where("year <= 1995"), lambda todo: pixels, F.col("z"), "v")
    rest = zones.update(required, lambda todo: pixels, F.col("z"), "v")
    again = zones.update(required, lambda todo: pixels, F.col("z"), "v")
    if again or not early or not rest:
        raise RuntimeError(f"units computed: {early}, {rest}, {again}")
    return zones.load()


@query(
    """WITH q AS (SELECT o_custkey AS key, o_orderpriority AS name, count(*)::DOUBLE AS number, max(o_orderstatus) AS s FROM orders GROUP BY ALL),
    k AS (SELECT key, name, CASE WHEN key % 3 = 0 THEN number * 2 ELSE number END AS number FROM q) SELECT key, name, number FROM k"""
)
def lookup_cache(spark, d):
    """Maps of the orders by priority of each customer; every third is replaced by a later version, all are merged again."""
    q = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("name")).agg(F.count("*").cast("double").alias("number"))
    maps = lambda number: q.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("name", number))).alias("value"))
    cache = tiles.LookupCache(spark, f"{shared_folder(spark)}/lookup-{uuid.uuid4().hex}")
    cache.merge(maps(F.col("number")))
    latest = maps(F.when(F.col("key") % 3 == 0, F.col("number") * 2).otherwise(F.col("number")))
    cache.merge(latest)
    cache.merge(latest)
    return cache.load()
