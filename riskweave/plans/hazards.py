"""From raw hazard records to the counts per cell and quarter that the climate recipes read.

Every function gives (pgid, year, quarter, count) and only rows that have
something to count; the recipes fill the rest of the panel with zeros.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import cells
from riskweave.operators import events, rolling

KEYS = ["pgid", "year", "quarter"]

#: Limits and reference years of the hazards; rain in metres, temperatures in degrees Celsius.
LEAST_DISCHARGE = 0.1
WET_DAY, HEAVY_DAY, WET_YEARS = 0.001, 0.01, (1951, 1980)
HOT, HUMID, HOT_DAYS, HOT_YEARS = 35.0, 40.0, 3, (1981, 2010)
SURE_FIRE, VEGETATION_FIRE, FIRE_YEARS = 95, 0, (2000, 2010)


def _by_quarter(rows: DataFrame, day: str, count: Column) -> DataFrame:
    return rows.groupBy("pgid", F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(count.cast("long").alias("count"))


def _cell(lat: str = "lat", lon: str = "lon") -> Column:
    # Only longitudes wrap: a grid may have rows beyond 180.
    return cells.cell_id(cells.snap_down(F.col(lat), 0.5) + 0.25, cells.bin_centre(F.col(lon)))


def flood_days(discharge: DataFrame, limits: DataFrame) -> DataFrame:
    """Days on which any river pixel of the cell exceeds its own limit.

    ``discharge`` has (lat, lon, day, discharge), ``limits`` (lat, lon, limit); pixels match at three decimals.
    """
    at = {"lat": F.round("lat", 3), "lon": F.round("lon", 3)}
    met = discharge.withColumns(at).join(limits.withColumns(at), ["lat", "lon"])
    flooded = met.where((F.col("discharge") > F.col("limit")) & (F.col("discharge") >= LEAST_DISCHARGE))
    return _by_quarter(flooded.select(_cell().alias("pgid"), "day").distinct(), "day", F.count("*"))


def storm_visits(hits: DataFrame) -> DataFrame:
    """Distinct storms of each quarter; ``hits`` has (storm, day, pgid), a row for every cell in reach of a track point."""
    return _by_quarter(hits, "day", F.count_distinct("storm"))


def fires_above_usual(fires: DataFrame, land: Column | None = None) -> DataFrame:
    """Sure vegetation fires where they exceed the cell's usual count, else 0.

    ``fires`` has (lat, lon, day, confidence, type); ``land`` may narrow them to land covers that burn.
    """
    sure = fires.where((F.col("confidence") > SURE_FIRE) & (F.col("type") == VEGETATION_FIRE))
    counted = _by_quarter((sure if land is None else sure.where(land)).withColumn("pgid", _cell()), "day", F.count("*"))
    return events.above_usual(counted, ["pgid"], "count", 0.95, F.col("year").between(*FIRE_YEARS)).select(*KEYS, F.col("count").cast("long"))


def hot_days(daily: DataFrame, years: tuple[int, int] = HOT_YEARS) -> DataFrame:
    """Days in runs of hot days: over the usual for the time of year and over a fixed limit.

    ``daily`` has (pgid, day, tmax, humidex), a row for every day; a run that the data end in is left out.
    """
    usual = events.by_day_of_year(daily.where(F.year("day").between(*years)), ["pgid"], "day", "tmax", [0.95])
    placed = daily.withColumn("doy", F.date_format("day", "MM_dd")).join(usual, ["pgid", "doy"], "left")
    hot = (F.col("tmax") > F.col("p95")) & ((F.col("tmax") > HOT) | (F.col("humidex") > HUMID))
    waves = rolling.runs(placed, ["pgid"], "day", hot, HOT_DAYS)
    return _by_quarter(waves.select("pgid", F.explode(F.sequence("start", "end")).alias("day")), "day", F.count("*"))


def heavy_rain_days(daily: DataFrame, years: tuple[int, int] = WET_YEARS) -> DataFrame:
    """Days over the cell's usual extreme of wet days; ``daily`` has (pgid, day, rain)."""
    wet = daily.where(F.year("day").between(*years) & (F.col("rain") > WET_DAY))
    limits = wet.groupBy("pgid").agg(F.percentile("rain", 0.99).alias("threshold"))
    return _by_quarter(events.over_threshold(daily, limits, ["pgid"], "rain", HEAVY_DAY), "day", F.count("*"))


#: The raw tables of each hazard and what counts them.
COUNTERS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "floods": (("discharge", "discharge_limits"), flood_days),
    "cyclones": (("storm_hits",), storm_visits),
    "wildfires": (("fires",), fires_above_usual),
    "heatwave": (("daily_temperature",), hot_days),
    "heavy-precipitation": (("daily_rain",), heavy_rain_days),
}


def with_counts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``tables`` with the counts of every hazard whose raw tables are there; counts that are given stay."""
    found = dict(tables)
    for hazard, (raw, counter) in COUNTERS.items():
        if all(name in tables for name in raw):
            found.setdefault(f"{hazard}_counts", counter(*(tables[name] for name in raw)))
    return found
