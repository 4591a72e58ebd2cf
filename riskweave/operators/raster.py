"""Rasters as long tables of pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zonal(pixels: DataFrame, zone: Column, value: str) -> DataFrame:
    """Mean, sum and count of pixel values per zone; a zone is arithmetic on the pixel's place."""
    return pixels.groupBy(zone.alias("zone")).agg(F.avg(value).alias("mean"), F.sum(value).alias("sum"), F.count(value).alias("n"))


def categories(pixels: DataFrame, zone: Column, value: str, names: dict[str, int]) -> DataFrame:
    """How many pixels of each category a zone has."""
    return pixels.groupBy(zone.alias("zone")).agg(*[F.sum(F.when(F.col(value) == v, 1).otherwise(0)).alias(k) for k, v in names.items()])


def coarsen(pixels: DataFrame, value: str, block: int) -> DataFrame:
    """Sums over square blocks of pixels; incomplete blocks at the edges count what is there."""
    at = lambda c: F.floor(F.col(c) / block).cast("long").alias(c)
    return pixels.groupBy(at("x"), at("y")).agg(F.sum(value).alias(value))


def masked(pixels: DataFrame, mask: DataFrame, keep: Column, value: str) -> DataFrame:
    """NULL where the mask layer doesn't pass or has no pixel."""
    return pixels.join(mask, ["x", "y"], "left").withColumn(value, F.when(keep, F.col(value)))


def bilinear(nodes: DataFrame, targets: DataFrame, value: str, step: float = 1.0) -> DataFrame:
    """``value`` at target points (x, y) from the four nodes of a regular grid around each.

    Nodes are keyed by whole steps. Each target is sent to its four nodes with
    their weights and met there by one equality join.
    """
    corner = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (0, 1) for dy in (0, 1)]))
    bx, by = F.floor(F.col("x") / step), F.floor(F.col("y") / step)
    fx, fy = F.col("x") / step - bx, F.col("y") / step - by
    sent = targets.select("x", "y", corner.alias("c")).select(
        "x", "y", (bx + F.col("c.dx")).alias("_i"), (by + F.col("c.dy")).alias("_j"),
        (F.when(F.col("c.dx") == 1, fx).otherwise(1 - fx) * F.when(F.col("c.dy") == 1, fy).otherwise(1 - fy)).alias("_w"),
    )
    keyed = nodes.select(F.round(F.col("x") / step).cast("long").alias("_i"), F.round(F.col("y") / step).cast("long").alias("_j"), value)
    joined = sent.join(keyed, ["_i", "_j"], "left").where("_w > 0")
    whole = F.count(value) == F.count(F.lit(1))  # a missing corner leaves the point missing
    return joined.groupBy("x", "y").agg(F.when(whole, F.sum(F.col("_w") * F.col(value))).alias(value))


def nearest(nodes: DataFrame, targets: DataFrame, value: str, step: float) -> DataFrame:
    """``value`` at target points from the nearest node of a regular grid."""
    at = lambda c: F.round(F.col(c) / step).cast("long")
    keyed = nodes.select(at("x").alias("_i"), at("y").alias("_j"), value)
    return targets.withColumn("_i", at("x")).withColumn("_j", at("y")).join(keyed, ["_i", "_j"], "left").drop("_i", "_j")


def anomaly(series: DataFrame, keys: list[str], value: str, baseline: Column) -> DataFrame:
    """``value`` minus its key's mean over the baseline rows."""
    base = series.where(baseline).groupBy(*keys).agg(F.avg(value).alias("_base"))
    return series.join(base, keys, "left").withColumn("anomaly", F.col(value) - F.col("_base")).drop("_base")


def loss_share(pixels: DataFrame, zone: Column, years: tuple[int, int]) -> DataFrame:
    """Per zone and year the cover lost so far as a share of the first cover, weighted by the cover on land."""
    base = pixels.groupBy(zone.alias("zone")).agg(F.sum("cover").alias("_all"), F.avg(F.when(F.col("datamask") == 1, F.col("cover"))).alias("_density"))
    lost = pixels.where("lossyear > 0").groupBy(zone.alias("zone"), F.col("lossyear").alias("_y")).agg(F.sum("cover").alias("_lost"))
    grid = base.withColumn("year", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))))
    lost = lost.withColumnRenamed("zone", "_z")
    joined = grid.join(lost, (F.col("zone") == F.col("_z")) & (F.col("_y") <= F.col("year")), "left")
    total = joined.groupBy("zone", "year").agg(F.sum("_lost").alias("_l"), F.first("_all").alias("_all"), F.first("_density").alias("_density"))
    return total.select("zone", "year", (F.coalesce(F.try_divide(F.coalesce("_l", F.lit(0.0)), F.col("_all")), F.lit(0.0)) * F.col("_density") / 100).alias("loss"))


def on_grid(pixels: DataFrame, grid: DataFrame, value: str, step: float = 0.5) -> DataFrame:
    """The mean of pixels (x, y, value) in each cell of a grid (pgid, lon, lat), NULL in cells without pixels; pixels off the grid are left out."""
    at = lambda c: F.floor(F.col(c) / step)
    means = pixels.groupBy(at("x").alias("_i"), at("y").alias("_j")).agg(F.avg(value).alias(value))
    placed = grid.withColumns({"_i": at("lon"), "_j": at("lat")})
    return means.join(placed, ["_i", "_j"], "right").select("pgid", value)


def masked_by_share(values: DataFrame, shares: DataFrame, key: str, columns: list[str], value: str, most: float = 0.75) -> DataFrame:
    """NULL where the shares of a key (of barren and icy land, say) add up to more than ``most``; a key without shares keeps its values."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in columns), F.lit(0.0))
    joined = values.join(shares.select(key, total.alias("_share")), key, "left")
    return joined.withColumn(value, F.when(F.coalesce(F.col("_share") <= most, F.lit(True)), F.col(value))).drop("_share")
