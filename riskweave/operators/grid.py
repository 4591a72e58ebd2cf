"""The base grid and the countries on it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.functions import cells
from riskweave.operators.spatial import largest_share


def from_bounds(spark: SparkSession, west: float, south: float, east: float, north: float, margin: float = 0.0) -> DataFrame:
    """(pgid, lat, lon) of all cells that touch the bounds, snapped outwards by half degrees.

    Rows are generated from a range, so any number of tasks can make them.
    """
    west, east = math.floor((west - margin) * 2) / 2, math.ceil((east + margin) * 2) / 2
    south, north = math.floor((south - margin) * 2) / 2, math.ceil((north + margin) * 2) / 2
    if west < -180 or east > 180 or south < -90 or north > 90 or west >= east or south >= north:
        raise ValueError("bounds are empty or leave the globe")
    columns, rows = round((east - west) * 2), round((north - south) * 2)
    placed = spark.range(columns * rows).select(
        (south + 0.25 + F.floor(F.col("id") / columns) / 2).alias("lat"), (west + 0.25 + F.col("id") % columns / 2).alias("lon")
    )
    return placed.select(cells.cell_id(F.col("lat"), F.col("lon")).alias("pgid"), "lat", "lon")


def countries(areas: DataFrame, merge: dict[str, str], drop: list[str], disputed: Column | None = None) -> DataFrame:
    """Areas with their final code and ``cid``, counted from 0 in order of the code.

    ``merge`` gives parts another code; dropped codes and disputed areas go. One
    row per country: the numbering's single task stays small.
    """
    coded = areas.withColumn("iso3", F.coalesce(*[F.when(F.col("iso3") == a, F.lit(b)) for a, b in merge.items()], F.col("iso3")) if merge else F.col("iso3"))
    kept = coded.where(~F.col("iso3").isin(drop)) if drop else coded
    if disputed is not None:
        kept = kept.where(~F.coalesce(disputed, F.lit(False)))
    numbers = kept.select("iso3").distinct().withColumn("cid", F.row_number().over(Window.orderBy("iso3")) - 1)
    return kept.join(F.broadcast(numbers), "iso3")


def matched(grid: DataFrame, shares: DataFrame, lakes: DataFrame, least_land: float = 0.25, most_lake: float = 0.75) -> DataFrame:
    """Grid cells with the country of the largest share, of enough land and not mostly lake."""
    owners = largest_share(shares.withColumnRenamed("area", "iso3"), "pgid", "iso3", least_land).select("pgid", "iso3")
    wet = lakes.where(F.col("share") > most_lake).select("pgid")
    return grid.join(owners, "pgid").join(wet, "pgid", "left_anti")


def dense(values: DataFrame, spark: SparkSession, column: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """``column`` on every cell of a box, NULL where the panel has none."""
    return from_bounds(spark, west, south, east, north).join(values.select("pgid", column), "pgid", "left")


def track_motion(fixes: DataFrame, track: str, at: str) -> DataFrame:
    """Hours and distance (km) to a track's next fix, and the speed between them."""
    line = Window.partitionBy(track).orderBy(at)
    nxt = fixes.withColumns({"_t": F.lead(at).over(line), "_lat": F.lead("lat").over(line), "_lon": F.lead("lon").over(line)})
    hours = (F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col(at).cast("timestamp"))) / 3.6e9
    turn = F.pmod(F.col("_lon") - F.col("lon") + 180, F.lit(360.0)) - 180
    east = turn * F.cos(F.radians((F.col("lat") + F.col("_lat")) / 2)) * 111.2
    moved = nxt.withColumn("hours", hours).withColumn("km", F.sqrt(east * east + F.pow((F.col("_lat") - F.col("lat")) * 111.2, 2)))
    return moved.withColumn("speed", F.try_divide("km", "hours")).drop("_t", "_lat", "_lon")
