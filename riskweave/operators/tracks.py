"""Tracks of storms and other things that move, and values that are nearest in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Nautical miles of a degree on a sphere of 6371 km.
MILES = 6371 * 0.539957 * 3.141592653589793 / 180


def turn(a: Column, b: Column) -> Column:
    """Degrees from longitude a to b on the shorter way, from -180 up to 180."""
    return F.pmod(b - a + 180, F.lit(360.0)) - 180


def wrapped(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def between(lat0: Column, lon0: Column, lat1: Column, lon1: Column, share: Column) -> tuple[Column, Column]:
    """Latitude and longitude at a share of the great circle between two places; of opposite places there is no one way, and it is NULL."""
    rad = F.radians
    vector = lambda lat, lon: (F.cos(rad(lat)) * F.cos(rad(lon)), F.cos(rad(lat)) * F.sin(rad(lon)), F.sin(rad(lat)))
    a, b = vector(lat0, lon0), vector(lat1, lon1)
    half = sum((F.pow(p - q, 2) for p, q in zip(a, b, strict=True)), F.lit(0.0))
    angle = 2 * F.asin(F.least(F.sqrt(half) / 2, F.lit(1.0)))
    near = angle < 1e-9
    wa, wb = (F.when(near, linear).otherwise(F.try_divide(F.sin(angle * s), F.sin(angle))) for linear, s in ((1 - share, 1 - share), (share, share)))
    x, y, z = (wa * p + wb * q for p, q in zip(a, b, strict=True))
    found = angle < 3.141592653589793 - 1e-9
    return F.when(found, F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))), F.when(found, F.degrees(F.atan2(y, x)))


def hourly(fixes: DataFrame, track: str, at: str, columns: list[str], great_circle: bool = False) -> DataFrame:
    """(track, hour, lat, lon, columns) at every full hour from a track's first fix to its last.

    Columns lie on straight lines between fixes, longitudes on the shorter way, over the date line as well; with
    ``great_circle`` positions lie on the sphere's shortest way. A column missing at either fix is missing between them.
    """
    line = Window.partitionBy(track).orderBy("_t")
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    placed = fixes.select(track, micros.alias("_t"), "lat", "lon", *columns)
    legs = placed.withColumns({f"_next_{c}": F.lead(c).over(line) for c in ("_t", "lat", "lon", *columns)} | {"_last": F.lead("_t").over(line).isNull()})
    hour = 3_600_000_000
    first = F.ceil(F.col("_t") / hour)
    # Each leg has the hours before its end; a track's last fix has its own, if it is one.
    last = F.when(F.col("_last"), F.floor(F.col("_t") / hour)).otherwise(F.ceil(F.col("_next__t") / hour) - 1)
    each = legs.where(first <= last).withColumn("_h", F.explode(F.sequence(first, last)))
    share = F.coalesce(F.try_divide(F.col("_h") * hour - F.col("_t"), F.col("_next__t") - F.col("_t")), F.lit(0.0))
    end = lambda c: F.when(F.col("_last"), F.col(c)).otherwise(F.col(f"_next_{c}"))
    straight = lambda c: F.col(c) + (end(c) - F.col(c)) * share
    if great_circle:
        lat, lon = between(F.col("lat"), F.col("lon"), end("lat"), end("lon"), share)
    else:
        lat, lon = straight("lat"), wrapped(F.col("lon") + turn(F.col("lon"), end("lon")) * share)
    return each.select(track, F.timestamp_micros(F.col("_h") * hour).alias("hour"), lat.alias("lat"), lon.alias("lon"), *[straight(c).alias(c) for c in columns])


def motion(points: DataFrame, track: str, at: str, changes: list[str]) -> DataFrame:
    """Adds dx_dt, dy_dt and speed (nautical miles an hour) from the point before, and d<column>_dt, changes an hour."""
    line = Window.partitionBy(track).orderBy(at)
    before = lambda c: F.lag(c).over(line)
    hours = (F.unix_micros(at) - F.unix_micros(before(at))) / 3.6e9
    rate = lambda x: F.try_divide(x, hours)
    moved = points.withColumns({
        "dx_dt": rate(turn(before("lon"), F.col("lon")) * F.cos(F.radians((F.col("lat") + before("lat")) / 2)) * MILES),
        "dy_dt": rate((F.col("lat") - before("lat")) * MILES),
        **{f"d{c}_dt": rate(F.col(c) - before(c)) for c in changes},
    })
    return moved.withColumn("speed", F.sqrt(F.col("dx_dt") * F.col("dx_dt") + F.col("dy_dt") * F.col("dy_dt")))


def over_window(points: DataFrame, track: str, at: str, hours: int, sums: list[str], means: list[str], align: str = "middle") -> DataFrame:
    """Hourly rates over a window of ``hours``: their sums (changes) and means (motion); missing where the window has a missing hour.

    The window is a range of time, so gaps in the hours count. It ends at the point's time, starts there, or has it in
    the middle (with an even number, one hour more after it).
    """
    before = {"end": hours - 1, "middle": (hours - 1) // 2, "start": 0}[align]
    frame = Window.partitionBy(track).orderBy(F.unix_seconds(at)).rangeBetween(-before * 3600, (hours - 1 - before) * 3600)
    whole = lambda c, f: F.when(F.count(c).over(frame) == hours, f(c).over(frame))
    return points.withColumns({c: whole(c, F.sum) for c in sums} | {c: whole(c, F.avg) for c in means})


def nearest_in_time(wanted: DataFrame, series: DataFrame, keys: list[str], at: str, value: str, tolerance: float) -> DataFrame:
    """``wanted`` (keys, at, and more) with ``value`` of the key's nearest row of ``series`` (keys, at, value) by time.

    Times are numbers or dates, ``tolerance`` a number of their units (days for dates); further rows don't count. Of two
    rows as near, the earlier one wins, of rows at one time the greatest value. NULL values are no rows. Both tables are stacked and each row
    looks back and ahead in its key's line, so there is no join of ranges; a NULL time finds nothing.
    """
    place = F.col(at) if dict(series.dtypes)[at] != "date" else F.unix_date(at)
    number = place.cast("double")
    names = wanted.columns
    asked = wanted.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], number.alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(dict(series.dtypes)[value]).alias("_v"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    known = series.where(F.col(value).isNotNull() & F.col(at).isNotNull()).groupBy(*keys, at).agg(F.max(value).alias(value))
    known = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], number.alias("_t"), F.lit(0).alias("_kind"), F.col(value).alias("_v"), F.lit(None).cast(dict(asked.dtypes)["_row"]).alias("_row"))
    by = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_t", "_kind")
    there = F.when(F.col("_kind") == 0, F.struct("_t", "_v"))
    seen = known.unionByName(asked).withColumns({
        "_before": F.last(there, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_after": F.first(there, ignorenulls=True).over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    }).where("_kind = 1")
    back, ahead = F.col("_t") - F.col("_before._t"), F.col("_after._t") - F.col("_t")
    ok = lambda d: F.coalesce(d <= tolerance, F.lit(False))
    best = F.when(ok(back) & (ahead.isNull() | (back <= ahead)), F.col("_before._v")).when(ok(ahead), F.col("_after._v"))
    return seen.select("_row.*", best.alias(value))
