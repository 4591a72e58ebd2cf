"""From dated events to panel counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import calendar


def counts_by_class(events: DataFrame, keys: list[str], classes: dict[str, Column], magnitude: str) -> DataFrame:
    """Per key and class the number of events and their summed magnitude, in one aggregate."""
    aggs = []
    for name, is_class in {"all": F.lit(True), **classes}.items():
        aggs.append(F.sum(F.when(is_class, 1).otherwise(0)).alias(f"n_{name}"))
        aggs.append(F.sum(F.when(is_class, F.col(magnitude)).otherwise(0.0)).alias(f"sum_{name}"))
    return events.groupBy(*keys).agg(*aggs)


def spread(intervals: DataFrame, start: str, end: str, amounts: list[str]) -> DataFrame:
    """One row a day for interval events, amounts divided by the days; reversed intervals are left out."""
    days = F.datediff(end, start) + 1
    shared = intervals.where(F.col(end) >= F.col(start)).withColumns({a: F.col(a) / days for a in amounts})
    return shared.withColumn("day", F.explode(F.sequence(F.col(start), F.col(end))))


def by_day_of_year(daily: DataFrame, keys: list[str], day: str, x: str, levels: list[float], reach: int = 15) -> DataFrame:
    """Quantiles of ``x`` per key and calendar day (``doy``, MM_DD) over the days around it in all years.

    An observation counts for the calendar days that are within ``reach`` (below 180) of it in its own year, so in a year
    without 29 February none counts for that day. Missing values are dropped; days without any are left out.

    Observations are shuffled once. A key's values stand in two circles of days, those of leap years and of the others,
    and each day's window is an arc of either, sorted inside the row; a key holds its years, some 370 values each.
    """
    if not 0 <= reach < 180:
        raise ValueError("reach is from 0 to 179 days")
    known = daily.where(F.col(x).isNotNull() & F.col(day).isNotNull())
    leap = F.day(F.last_day(F.make_date(F.year(day), F.lit(2), F.lit(1)))) == 29
    found = known.select(*keys, leap.alias("_leap"), F.dayofyear(day).alias("_day"), F.array(F.col(x).cast("double")).alias("_v"))
    # One empty list for each day of both circles, so that a place in the circle is a day.
    each = F.explode(F.sequence(F.lit(1), F.lit(366)))
    empty = known.select(*keys).distinct().withColumn("_leap", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("_day", each).withColumn("_v", F.array().cast("array<double>"))
    lists = found.unionByName(empty.where("_leap or _day <= 365")).groupBy(*keys, "_leap", "_day").agg(F.flatten(F.collect_list("_v")).alias("_v"))
    circle = lambda of_leap: F.transform(F.array_sort(F.collect_list(F.when(F.col("_leap") == of_leap, F.struct("_day", "_v")))), lambda d: d["_v"])
    circles = lists.groupBy(*keys).agg(F.struct(circle(True).alias("leap"), circle(False).alias("other")).alias("_c"))
    offsets = F.sequence(F.lit(-reach), F.lit(reach))
    arc = lambda values, at, size: F.flatten(F.transform(offsets, lambda o: F.get(values, F.pmod(at + o, F.lit(size)))))

    def of_day(c: Column, d: Column) -> Column:
        in_other = F.when(d < 60, d - 1).when(d > 60, d - 2)  # the 60th day of a leap year is none of another
        values = F.array_sort(F.concat(arc(c["leap"], d - 1, 366), F.coalesce(arc(c["other"], in_other, 365), F.array().cast("array<double>"))))

        def pick(v: Column) -> Column:
            place = lambda q: (F.size(v) - 1) * F.lit(float(q))
            at = lambda i: F.get(v, i.cast("int"))
            low, high = lambda q: at(F.floor(place(q))), lambda q: at(F.ceil(place(q)))
            return F.when(F.size(v) > 0, F.struct(d.alias("d"), *[(low(q) + (high(q) - low(q)) * (place(q) - F.floor(place(q)))).alias(f"p{round(q * 100)}") for q in levels]))

        return F.get(F.transform(F.array(values), pick), F.lit(0))

    days = F.get(F.transform(F.array("_c"), lambda c: F.transform(F.sequence(F.lit(1), F.lit(366)), lambda d: of_day(c, d))), F.lit(0))
    rows = circles.select(*keys, F.explode(days).alias("_r")).where("_r is not null")
    doy = F.date_format(F.date_add(F.to_date(F.lit("2000-01-01")), F.col("_r.d") - 1), "MM_dd")
    return rows.select(*keys, doy.alias("doy"), *[f"_r.p{round(q * 100)}" for q in levels])


def with_day_thresholds(daily: DataFrame, limits: DataFrame, keys: list[str], day: str) -> DataFrame:
    """``daily`` with its key's thresholds of the calendar day, as ``by_day_of_year`` gives them; NULL where there are none."""
    return daily.withColumn("doy", calendar.day_key(F.col(day))).join(limits, [*keys, "doy"], "left")


def actors(events: DataFrame, keys: list[str], sides: list[str], drop: list[str] = (), drop_like: str | None = None) -> DataFrame:
    """(keys, actors): how many different actors the events' sides name, those left out whose name contains one of ``drop`` in any case, or matches."""
    named = events.select(*keys, F.explode(F.array(*sides)).alias("_actor")).where("_actor is not null")
    for part in drop:
        named = named.where(~F.lower("_actor").contains(part.lower()))
    if drop_like:
        named = named.where(~F.col("_actor").rlike(drop_like))
    return named.groupBy(*keys, "_actor").agg(F.lit(1).alias("_n")).groupBy(*keys).agg(F.count("*").alias("actors"))


def over_threshold(events: DataFrame, thresholds: DataFrame, keys: list[str], x: str, least: float) -> DataFrame:
    """Events above their key's threshold and at least ``least``."""
    return events.join(thresholds, keys).where((F.col(x) > F.col("threshold")) & (F.col(x) >= least))


def above_usual(counts: DataFrame, keys: list[str], x: str, level: float, usual: Column) -> DataFrame:
    """Counts, but 0 where they don't exceed their key's quantile over the usual rows (0 without any)."""
    limits = counts.where(usual).groupBy(*keys).agg(F.percentile(x, level).alias("_limit"))
    joined = counts.join(limits, keys, "left")
    return joined.withColumn(x, F.when(F.col(x) > F.coalesce("_limit", F.lit(0.0)), F.col(x)).otherwise(0)).drop("_limit")


def hourly_track(fixes: DataFrame, track: str, at: str, columns: list[str]) -> DataFrame:
    """Positions at every full hour between fixes, on straight lines."""
    line = Window.partitionBy(track).orderBy(at)
    fixes = fixes.withColumn(at, F.col(at).cast("timestamp"))
    nxt = fixes.withColumns({f"_{c}": F.lead(c).over(line) for c in [at, *columns]})
    legs = nxt.where(F.col(f"_{at}").isNotNull())
    hours = F.sequence(
        F.date_trunc("hour", F.col(at)) + F.when(F.date_trunc("hour", F.col(at)) < F.col(at), F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR")),
        F.col(f"_{at}") - F.expr("INTERVAL 1 MICROSECOND"),
        F.expr("INTERVAL 1 HOUR"),
    )
    some = F.date_trunc("hour", F.col(f"_{at}") - F.expr("INTERVAL 1 MICROSECOND")) >= F.col(at)
    each = legs.where(some).withColumn("hour", F.explode(hours))
    share = (F.unix_micros("hour") - F.unix_micros(at)) / (F.unix_micros(f"_{at}") - F.unix_micros(at))
    return each.select(track, "hour", *[(F.col(c) + (F.col(f"_{c}") - F.col(c)) * share).alias(c) for c in columns])


def storms(fixes: DataFrame, least: dict[str, float] | None = None, most: dict[str, float] | None = None, kinds: list[str] | None = None, years: tuple[int, int] | None = None, box: tuple[float, float, float, float] | None = None, days: tuple[tuple[int, int], tuple[int, int]] | None = None) -> DataFrame:
    """Track points within thresholds, kinds, years (of ``season``), a (west, south, east, north) box, and days from one (month, day) to another.

    A box whose west is greater than its east runs over the date line, days whose first is later than the last over the new year.
    """
    keep = F.lit(True)
    for c, v in (least or {}).items():
        keep = keep & (F.col(c) >= v)
    for c, v in (most or {}).items():
        keep = keep & (F.col(c) <= v)
    if kinds:
        keep = keep & F.col("type").isin(kinds)
    if years:
        keep = keep & F.col("season").between(*years)
    if box:
        lon = F.col("lon")
        keep = keep & (lon.between(box[0], box[2]) if box[0] <= box[2] else (lon >= box[0]) | (lon <= box[2])) & F.col("lat").between(box[1], box[3])
    if days:
        keep = keep & calendar.in_season(F.col("time"), *days)
    return fixes.where(keep)


#: Aggregates that a request may name.
REQUESTS = {
    "max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "mean": F.avg,
}


def requested(df: DataFrame, keys: list[str], request: str) -> DataFrame:
    """Run a request such as "max vmax", "mean vmax" or "percentile 95 vmax" per key.

    A mean of fewer than five values is missing.
    """
    words = request.split()
    if words[0] == "percentile" and len(words) == 3:
        agg = F.percentile(words[2], float(words[1]) / 100)
    elif words[0] == "mean" and len(words) == 2:
        agg = F.when(F.count(words[1]) >= 5, F.avg(words[1]))
    elif words[0] in REQUESTS and len(words) == 2:
        agg = REQUESTS[words[0]](words[1])
    else:
        raise ValueError(f"request not understood: {request}")
    return df.groupBy(*keys).agg(agg.alias("_".join(words)))
