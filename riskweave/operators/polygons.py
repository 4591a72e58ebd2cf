"""Polygons on a grid of cells, as joins and windows over their edges.

A polygon is never tested as a whole. Its edges are cut at the borders of the
cells they pass through, so each cell of a border holds the few edges in it, and
one window down each column of cells tells what lies between two border cells: for
areas by the horizontal extent of all edge pieces above, for points by the winding
number above. Cells inside are found in the gaps, whole, without any test. Rows
grow with the cells that borders pass through and with the cells that areas
cover, whatever the number of corners.

Rings may turn either way, the first of a part is its outside, others are holes;
parts of an area should not overlap. Points on an edge that runs along an axis
belong to the area above and right of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares below this come from rounding only.
NOTHING = 1e-12


def polygon_parts(wkt: Column) -> Column:
    """The parts of a WKT POLYGON or MULTIPOLYGON: each an array of rings, the outer one first, of (x, y)."""
    body = F.regexp_replace(wkt, r"^[^(]*", "")
    point = lambda p: F.struct(F.split(p, r"\s+")[0].cast("double").alias("x"), F.split(p, r"\s+")[1].cast("double").alias("y"))
    ring = lambda r: F.transform(F.split(F.regexp_replace(r, r"[()]", ""), ","), lambda p: point(F.trim(p)))
    rings = lambda part: F.transform(F.split(part, r"\)\s*,\s*\("), ring)
    parts = F.transform(F.split(body, r"\)\s*\)\s*,\s*\(\s*\("), rings)
    return F.when(body.contains("("), parts).otherwise(F.array().cast("array<array<array<struct<x:double,y:double>>>>"))


def edges(polygons: DataFrame) -> DataFrame:
    """(area, s, x0, y0, x1, y1): the edges of the polygons (area, parts); s is 1 or -1, so that s times a step to the right counts what is below as inside."""
    parts = polygons.select("area", F.explode("parts").alias("part")).select("area", F.posexplode("part").alias("no", "ring"))
    following = lambda i: F.get("ring", (i + 1) % F.size("ring"))
    each = F.transform(F.sequence(F.lit(0), F.size("ring") - 1), lambda i: F.struct(
        F.get("ring", i)["x"].alias("x0"), F.get("ring", i)["y"].alias("y0"), following(i)["x"].alias("x1"), following(i)["y"].alias("y1")
    ))
    rings = parts.where(F.size("ring") > 2).select("area", "no", "ring", each.alias("edges"))
    # From the first corner, so that far-off coordinates cost no digits.
    at = lambda e, k, c: e[f"{c}{k}"] - F.get("ring", F.lit(0))[c]
    double_area = F.aggregate("edges", F.lit(0.0), lambda sum_, e: sum_ + at(e, 0, "x") * at(e, 1, "y") - at(e, 1, "x") * at(e, 0, "y"))
    turned = rings.withColumn("s", F.when(F.col("no") == 0, -F.signum(double_area)).otherwise(F.signum(double_area)))
    return turned.where("s <> 0").select("area", "s", F.explode("edges").alias("e")).select("area", "s", "e.*").where("x0 <> x1 or y0 <> y1")


def _in_columns(found: DataFrame, step: float) -> DataFrame:
    """Edges cut at the borders between columns: _bx, and the piece from (_l, _yl) to (_r, _yr), leftmost first."""
    low, high = F.least("x0", "x1"), F.greatest("x0", "x1")
    cut = found.withColumn("_bx", F.explode(F.sequence(F.floor(low / step), F.floor(high / step))))
    cut = cut.withColumn("_l", F.greatest(low, F.col("_bx") * step)).withColumn("_r", F.least(high, (F.col("_bx") + 1) * step))
    return cut.withColumn("_yl", height(F.col("_l"), F.least("y0", "y1"))).withColumn("_yr", height(F.col("_r"), F.greatest("y0", "y1")))


def height(x: Column, upright: Column) -> Column:
    """An edge's y at x, exact at its ends; ``upright`` for an edge without width."""
    slope = F.try_divide(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    return F.when(F.col("x0") == F.col("x1"), upright).when(x == F.col("x0"), F.col("y0")).when(x == F.col("x1"), F.col("y1")).otherwise(F.col("y0") + slope * (x - F.col("x0")))


def shares(polygons: DataFrame, step: float = 0.5) -> DataFrame:
    """(area, bx, by, share): how much of each cell, counted in steps from 0, every polygon covers.

    A cell's area is what lies below the edge pieces in it and above its floor,
    and its whole height below the pieces in the cells above.
    """
    cut = _in_columns(edges(polygons).where("x0 <> x1"), step).where("_r > _l")
    low, high = F.least("_yl", "_yr"), F.greatest("_yl", "_yr")
    rows = cut.withColumn("_lo", low).withColumn("_hi", high).withColumn("by", F.explode(F.sequence(F.floor(low / step), F.floor(high / step))))
    a, b = F.greatest("_lo", F.col("by") * step), F.least("_hi", (F.col("by") + 1) * step)
    part = F.coalesce(F.try_divide(b - a, F.col("_hi") - F.col("_lo")), F.lit(1.0))
    width = F.col("s") * F.signum(F.col("x1") - F.col("x0")) * (F.col("_r") - F.col("_l")) * part
    sized = rows.select("area", F.col("_bx").alias("bx"), "by", width.alias("width"), ((a + b) / 2 - F.col("by") * step).alias("mean"))
    border = sized.groupBy("area", "bx", "by").agg(F.sum("width").alias("width"), F.sum(F.col("width") * F.col("mean")).alias("below"))
    down = Window.partitionBy("area", "bx").orderBy(F.col("by").desc())
    above = F.coalesce(F.sum("width").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    seen = border.withColumn("above", above).withColumn("next", F.lead("by").over(down))
    own = F.struct("by", ((F.col("below") + F.col("above") * step) / (step * step)).alias("share"))
    gap = (F.col("above") + F.col("width")) / step
    between = F.when((F.col("next") < F.col("by") - 1) & (F.abs(gap) > 1e-9), F.transform(F.sequence(F.col("next") + 1, F.col("by") - 1), lambda y: F.struct(y.alias("by"), gap.alias("share"))))
    cells = F.explode(F.concat(F.array(own), F.coalesce(between, F.array().cast("array<struct<by:bigint,share:double>>")))).alias("cell")
    return seen.select("area", "bx", cells).select("area", "bx", "cell.by", F.col("cell.share").alias("share")).where(F.col("share") > NOTHING)


def area_bridge(grid: DataFrame, polygons: DataFrame, step: float = 0.5) -> DataFrame:
    """(pgid, area, share): how much of each cell (pgid, lon, lat at its centre) every polygon (area, parts) covers.

    Cells inside a cell-sized strip share one latitude scale, so plain areas give the right shares.
    """
    placed = grid.select("pgid", F.floor(F.col("lon") / step).alias("bx"), F.floor(F.col("lat") / step).alias("by"))
    return placed.join(shares(polygons, step), ["bx", "by"]).select("pgid", "area", "share")


def cover(polygons: DataFrame, step: float = 0.5) -> DataFrame:
    """(area, bx, by, above, edges): the cells of each polygon. ``edges`` are those in a border cell, NULL in a cell inside;
    ``above`` is the winding number at the middle of a border cell's top."""
    cut = _in_columns(edges(polygons), step)
    middle = (F.col("_bx") + 0.5) * step
    crosses = (F.col("x0") > middle) != (F.col("x1") > middle)
    at = F.floor(height(middle, F.col("y0")) / step)  # the row where an edge crosses the middle of its column
    first, last = F.floor(F.least("_yl", "_yr") / step), F.floor(F.greatest("_yl", "_yr") / step)
    rows = F.sequence(F.when(crosses, F.least(first, at)).otherwise(first), F.when(crosses, F.greatest(last, at)).otherwise(last))
    edge = F.struct("s", "x0", "y0", "x1", "y1").alias("edge")
    turn = F.when(crosses & (F.col("by") == at), F.col("s") * F.signum(F.col("x1") - F.col("x0"))).otherwise(0.0)
    touched = cut.withColumn("by", F.explode(rows)).select("area", F.col("_bx").alias("bx"), "by", edge, turn.alias("turn"))
    border = touched.groupBy("area", "bx", "by").agg(F.collect_list("edge").alias("edges"), F.sum("turn").alias("turn"))
    down = Window.partitionBy("area", "bx").orderBy(F.col("by").desc())
    above = F.coalesce(F.sum("turn").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    seen = border.withColumn("above", above).withColumn("next", F.lead("by").over(down))
    inside = (F.col("next") < F.col("by") - 1) & (F.col("above") + F.col("turn") != 0)
    gaps = seen.where(inside).select("area", "bx", F.explode(F.sequence(F.col("next") + 1, F.col("by") - 1)).alias("by"))
    nothing = [F.lit(None).cast("double").alias("above"), F.lit(None).cast(dict(border.dtypes)["edges"]).alias("edges")]
    return seen.select("area", "bx", "by", "above", "edges").unionByName(gaps.select("area", "bx", "by", *nothing))


def _winding(step: float) -> Column:
    """The winding number at (x, y) of a border cell: from the middle of its top down to y, then over to x."""
    x, y, middle = F.col("x"), F.col("y"), (F.col("bx") + 0.5) * step

    def crossings(sum_: Column, e: Column) -> Column:
        at = e["y0"] + F.try_divide(e["y1"] - e["y0"], e["x1"] - e["x0"]) * (middle - e["x0"])
        exact = F.when(middle == e["x0"], e["y0"]).when(middle == e["x1"], e["y1"]).otherwise(at)
        down = ((e["x0"] > middle) != (e["x1"] > middle)) & (F.floor(exact / step) == F.col("by")) & (exact > y)
        across = e["x0"] + F.try_divide(y - e["y0"], e["y1"] - e["y0"]) * (e["x1"] - e["x0"])
        over = ((e["y0"] > y) != (e["y1"] > y)) & ((across > x) != (across > middle))
        to_x = F.when(e["y1"] < e["y0"], 1.0).otherwise(-1.0) * F.when(across > x, 1.0).otherwise(-1.0)
        return sum_ + e["s"] * (F.when(down, F.signum(e["x1"] - e["x0"])).otherwise(0.0) + F.when(over, to_x).otherwise(0.0))

    return F.col("above") + F.aggregate("edges", F.lit(0.0), crossings)


def points_in_polygons(points: DataFrame, polygons: DataFrame, step: float = 0.5) -> DataFrame:
    """Points (x, y, and more) joined with the polygons (area, parts) that hold them: a row for each.

    Points meet cells of the cover by an equality join; those in a cell inside
    are hits, the others are tested against the edges in their cell.
    """
    placed = points.withColumns({"bx": F.floor(F.col("x") / step), "by": F.floor(F.col("y") / step)})
    met = placed.join(cover(polygons, step), ["bx", "by"])
    return met.where(F.col("edges").isNull() | (_winding(step) != 0)).select(*[F.col(f"`{c}`") for c in points.columns], "area")


def area_of_points(points: DataFrame, polygons: DataFrame, key: list[str], order: str, step: float = 0.5) -> DataFrame:
    """(key, area): the one area of each point; of several the one that comes last by ``order``, a column of ``polygons``, NULL of none."""
    found = points_in_polygons(points, polygons, step).join(polygons.select("area", order), "area")
    last = found.groupBy(*key).agg(F.max_by("area", F.struct(order, "area")).alias("area"))
    return points.select(*key).join(last, key, "left")
