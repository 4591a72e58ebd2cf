from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import events, scale


def test_grouped_quantiles_against_numpy(spark, monkeypatch):
    rng = random.Random(1)
    draw = {
        "zeros": lambda: 0.0 if rng.random() < 0.9 else rng.random(), "skewed": lambda: rng.lognormvariate(0, 4), "few": lambda: float(rng.randrange(3)),
        "even": rng.random, "signed": lambda: rng.gauss(0, 1e6), "gaps": lambda: rng.choice([None, 1.5]),
        "steps": lambda: rng.choice([0.0, 0.0, 0.0, 5.0, 9.0]),
    }
    rows = [(k, f()) for k, f in draw.items() for _ in range(701)] + [("one", 4.0), ("same", 2.0), ("same", 2.0), (None, 1.0), (None, 3.0), ("nothing", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    for slices, level in ((1024, 0.0), (1024, 0.37), (1024, 0.5999), (2, 0.6001), (1024, 0.6), (2, 0.5), (3, 0.973), (1024, 0.9999), (4, 1.0)):
        monkeypatch.setattr(scale, "SLICES", slices)
        got = {r.k: r.q for r in scale.grouped_quantile(df, ["k"], "x", level, "q").where("k is not null").collect()}
        want = {k: np.quantile([x for j, x in rows if j == k and x is not None], level) for k in {k for k, x in rows if x is not None and k}}
        assert got == pytest.approx(want)


def test_days_of_year_against_all_pairs(spark):
    rng = random.Random(2)
    days = [dt.date(y, 1, 1) + dt.timedelta(days=i) for y in (1999, 2000, 2001, 2003) for i in range(366) if rng.random() < 0.4]
    rows = [(rng.choice("ab"), d, rng.random() if rng.random() < 0.9 else None) for d in days] + [("c", dt.date(2000, 2, 29), 1.0), ("d", dt.date(2001, 3, 1), 2.0), ("e", None, 1.0)]
    out = events.by_day_of_year(spark.createDataFrame(rows, "k string, day date, x double"), ["k"], "day", "x", [0.9, 0.25], reach=7)
    got = {(r.k, r.doy): (r.p90, r.p25) for r in out.collect()}
    near: dict = {}
    for k, d, x in rows:
        if x is not None and d is not None:
            for o in range(-7, 8):
                near.setdefault((k, (d + dt.timedelta(days=o)).strftime("%m_%d")), []).append(x)
    assert got.keys() == near.keys() and ("d", "02_29") not in got
    assert all(got[at] == pytest.approx((np.quantile(v, 0.9), np.quantile(v, 0.25))) for at, v in near.items())


def test_day_thresholds_join(spark):
    daily = spark.createDataFrame([("a", dt.date(2000, 2, 29), 3.0), ("a", dt.date(2001, 12, 31), 1.0), ("b", dt.date(2001, 1, 1), 5.0)], "k string, day date, x double")
    limits = events.by_day_of_year(daily, ["k"], "day", "x", [0.5], reach=0).where("k = 'a'")
    out = {(r.k, r.day.month): r.p50 for r in events.with_day_thresholds(daily, limits, ["k"], "day").collect()}
    assert out == {("a", 2): 3.0, ("a", 12): 1.0, ("b", 1): None}


def test_each_observation_is_shuffled_once(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    daily = spark.range(10).select(F.lit(1).alias("k"), F.current_date().alias("day"), F.col("id").cast("double").alias("x"))
    assert "date_add" not in plan(events.by_day_of_year(daily, ["k"], "day", "x", [0.5])).split("Aggregate")[-1]
