"""Hazard counts against plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from riskweave.functions import cells
from riskweave.plans import hazards, indicators


def counted(df):
    return {(r.pgid, r.year, r.quarter): r["count"] for r in df.collect()}


def quarter(day):
    return day.year, (day.month + 2) // 3


def cell(spark, lat, lon):
    return spark.range(1).select(cells.cell_id(cells.bin_centre(F.lit(lat)), cells.bin_centre(F.lit(lon))).alias("c")).first().c


def test_flood_days(spark):
    day = date(2020, 3, 31)
    rows = [(1.1001, 2.1, day, 9.0), (1.2, 2.2, day, 9.0), (1.1001, 2.1, day + timedelta(1), 9.0), (1.1001, 2.1, day - timedelta(1), 5.0), (1.3, 2.3, day - timedelta(2), 0.09)]
    discharge = spark.createDataFrame(rows, "lat double, lon double, day date, discharge double")
    limits = spark.createDataFrame([(1.1, 2.1, 5.0), (1.2, 2.2, 5.0), (1.3, 2.3, 0.01)], "lat double, lon double, limit double")
    here = cell(spark, 1.1, 2.1)
    assert counted(hazards.flood_days(discharge, limits)) == {(here, 2020, 1): 1, (here, 2020, 2): 1}


def test_storm_visits(spark):
    rows = [("a", date(2020, 1, 1), 7), ("a", date(2020, 1, 2), 7), ("b", date(2020, 1, 2), 7), ("a", date(2020, 4, 1), 7)]
    assert counted(hazards.storm_visits(spark.createDataFrame(rows, "storm string, day date, pgid int"))) == {(7, 2020, 1): 2, (7, 2020, 2): 1}


def test_fires_above_usual(spark):
    rng = random.Random(5)
    rows = [(0.3, 0.3, date(rng.randint(2000, 2014), rng.randint(1, 12), 5), rng.choice([90, 96, 100]), rng.choice([0, 0, 2])) for _ in range(800)]
    wanted = defaultdict(int)
    for _, _, day, confidence, kind in rows:
        if confidence > 95 and kind == 0:
            wanted[quarter(day)] += 1
    limit = np.percentile([n for (y, _), n in wanted.items() if 2000 <= y <= 2010], 95)
    here = cell(spark, 0.3, 0.3)
    found = counted(hazards.fires_above_usual(spark.createDataFrame(rows, "lat double, lon double, day date, confidence int, type int")))
    assert found == {(here, *q): n if n > limit else 0 for q, n in wanted.items()}
    assert set(found.values()) > {0}


def test_hot_days(spark):
    rng, first = random.Random(6), date(2009, 1, 1)
    days = [first + timedelta(i) for i in range(3 * 365)]
    heat, humid, warm = {}, {}, 30.0
    for d in days:
        warm = 0.8 * warm + 0.2 * rng.uniform(18, 52)
        heat[d], humid[d] = warm, warm + rng.uniform(-2, 8)
    rows = [(3, d, heat[d], humid[d]) for d in days]

    near = defaultdict(list)
    for d in days:
        if d.year <= 2010:
            for shift in range(-15, 16):
                near[f"{d + timedelta(shift):%m_%d}"].append(heat[d])
    wanted, run = defaultdict(int), []
    for d in days:
        if heat[d] > np.percentile(near[f"{d:%m_%d}"], 95) and (heat[d] > 35 or humid[d] > 40):
            run.append(d)
            continue
        for each in run if len(run) >= 3 else []:
            wanted[(3, *quarter(each))] += 1
        run = []
    assert wanted
    assert counted(hazards.hot_days(spark.createDataFrame(rows, "pgid int, day date, tmax double, humidex double"))) == wanted


def test_heavy_rain_days(spark):
    rng = random.Random(7)
    rows = [(cell_, date(y, m, d), rng.choice([0.0, 0.0005, rng.expovariate(300 if cell_ == 1 else 2000)])) for cell_ in (1, 2) for y in (1950, 1980, 1990) for m in range(1, 13) for d in range(1, 29)]
    limit = {c: np.percentile([x for k, d, x in rows if k == c and d.year == 1980 and x > 0.001], 99) for c in (1, 2)}
    wanted = defaultdict(int)
    for c, d, x in rows:
        if x > limit[c] and x >= 0.01:
            wanted[(c, *quarter(d))] += 1
    assert wanted
    assert counted(hazards.heavy_rain_days(spark.createDataFrame(rows, "pgid int, day date, rain double"))) == wanted


def test_recipes_read_the_counts(spark):
    hits = spark.createDataFrame([("a", date(2020, 1, 1), 7), ("b", date(2020, 2, 1), 7), ("b", date(2020, 2, 1), 8)], "storm string, day date, pgid int")
    panel = spark.createDataFrame([(c, y, q) for c in (7, 8, 9) for y in (2019, 2020) for q in (1, 2, 3, 4)], "pgid int, year int, quarter int")
    tables = hazards.with_counts({"panel": panel, "storm_hits": hits})
    assert set(tables) == {"panel", "storm_hits", "cyclones_counts"}
    raw = {(r.pgid, r.year, r.quarter): r.raw for r in indicators._count_recipe("cyclones", 1)(tables).select("pgid", "year", "quarter", "raw").collect()}
    assert (raw[7, 2020, 4], raw[8, 2020, 1], raw[9, 2020, 4]) == (2.0, 1.0, 0.0)


def test_rows_beyond_180_degrees_keep_their_cells(spark):
    """Only longitudes wrap."""
    here, day = 400_000, date(2020, 3, 31)
    placed = spark.range(here, here + 1).select(cells.cell_lat(F.col("id")).alias("lat"), cells.cell_lon(F.col("id")).alias("lon"))
    flood = placed.select("*", F.lit(day).alias("day"), F.lit(9.0).alias("discharge"))
    assert counted(hazards.flood_days(flood, placed.withColumn("limit", F.lit(5.0)))) == {(here, 2020, 1): 1}
    fires = placed.select("*", F.lit(day).alias("day"), F.lit(99).alias("confidence"), F.lit(0).alias("type"))
    assert counted(hazards.fires_above_usual(fires)) == {(here, 2020, 1): 1}
