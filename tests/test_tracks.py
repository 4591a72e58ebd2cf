from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import events, rolling, sensitivity, tracks

T = dt.datetime(2020, 1, 1)


def fixes(spark, rows):
    return spark.createDataFrame([(k, T + dt.timedelta(hours=h), float(lat), float(lon), v) for k, h, lat, lon, v in rows], "id string, at timestamp, lat double, lon double, v double")


def test_the_shorter_way_over_the_date_line(spark):
    df = fixes(spark, [("a", 0, 0, 178, 1.0), ("a", 4, 4, -178, None), ("a", 6, 4, 179, 3.0), ("b", 0.5, 1, 1, 1.0), ("b", 0.75, 2, 2, 1.0)])
    out = {(r.id, r.hour.hour): (r.lat, r.lon, r.v) for r in tracks.hourly(df, "id", "at", ["v"]).collect()}
    assert [out["a", h][1] for h in range(7)] == pytest.approx([178, 179, -180, -179, -178, -179.5, 179])
    assert out["a", 2][2] is None and out["a", 6] == (4.0, 179.0, 3.0)
    assert not [k for k in out if k[0] == "b"]  # no full hour


def test_great_circles(spark):
    df = fixes(spark, [("a", 0, 60, 170, 0.0), ("a", 2, 60, -170, 0.0), ("p", 0, 80, 0, 0.0), ("p", 2, 80, 179, 0.0), ("s", 0, 5, 5, 0.0), ("s", 2, 5, 5, 0.0)])
    out = {r.id: r for r in tracks.hourly(df, "id", "at", [], great_circle=True).where(F.hour("hour") == 1).collect()}
    north = math.degrees(math.atan2(math.tan(math.radians(60)), math.cos(math.radians(10))))
    assert (out["a"].lat, abs(out["a"].lon)) == pytest.approx((north, 180.0))
    assert out["p"].lat > 89.9 and (out["s"].lat, out["s"].lon) == pytest.approx((5.0, 5.0))


@pytest.mark.parametrize("align", ["start", "middle", "end"])
def test_windows_against_plain_python(spark, align):
    rng = random.Random(1)
    hours = [h for h in range(60) if h not in (20, 41)]
    lon = [170 + 20 * rng.random() for _ in hours]
    df = fixes(spark, [("a", h, rng.random() * 10, x - 360 * (x > 180), rng.random() * 50) for h, x in zip(hours, lon, strict=True)])
    moved = tracks.motion(df, "id", "at", ["v"])
    rates = {int((r["at"] - T).total_seconds() // 3600): r for r in moved.collect()}
    got = {int((r["at"] - T).total_seconds() // 3600): r for r in tracks.over_window(moved, "id", "at", 6, ["dv_dt"], ["speed"], align).collect()}
    before = {"start": 0, "middle": 2, "end": 5}[align]
    assert abs(rates[1].dx_dt) < 20 * 60.1
    for h in hours:
        span = [rates.get(k) for k in range(h - before, h - before + 6)]
        if any(r is None or r.dv_dt is None for r in span):
            assert got[h].dv_dt is None and got[h].speed is None
        else:
            assert got[h].dv_dt == pytest.approx(sum(r.dv_dt for r in span))
            assert got[h].speed == pytest.approx(sum(r.speed for r in span) / 6)


def test_storm_filter_over_date_line_and_new_year(spark):
    rows = [(1, 179.0, dt.date(2019, 12, 30)), (2, -179.0, dt.date(2020, 1, 2)), (3, 100.0, dt.date(2020, 1, 2)), (4, 179.0, dt.date(2020, 7, 1))]
    df = spark.createDataFrame(rows, "id int, lon double, time date").withColumn("lat", F.lit(0.0))
    assert [r.id for r in events.storms(df, box=(170.0, -5.0, -170.0, 5.0), days=((12, 1), (2, 28))).orderBy("id").collect()] == [1, 2]


def test_nearest_in_time(spark):
    rng = random.Random(3)
    series = [(rng.choice("abc"), rng.randrange(200), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(60)] + [(None, 5, 7.0), ("a", None, 9.0)]
    wanted = [(k, t, i) for i, (k, t) in enumerate([(rng.choice("abcd"), rng.randrange(220)) for _ in range(100)] + [("a", None), (None, 6)])]
    out = tracks.nearest_in_time(spark.createDataFrame(wanted, "k string, t int, id int"), spark.createDataFrame(series, "k string, t int, v double"), ["k"], "t", "v", 6)
    got = {r.id: r.v for r in out.collect()}
    for k, t, i in wanted:
        near = [(abs(s - t), s, -v) for key, s, v in series if key == k and t is not None and s is not None and v is not None and abs(s - t) <= 6]
        assert got[i] == (-min(near)[2] if near else None)


def test_decay_of_a_long_series(spark):
    n, weight, factor = 5_000, 0.5, math.exp(math.log(0.25) / 20)
    x = [((i * 7919) % 1000) / 1000 for i in range(n)]
    df = spark.range(n).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("t"), (F.col("id") * 7919 % 1000 / 1000).alias("x"))
    want, v = [], None
    for value in x:
        v = value if v is None else weight * value + (1 - weight * value) * factor * v
        want.append(v)
    got = [r.decayed for r in rolling.decay(df, ["k"], "t", "x", 0.25, 5, weight).orderBy("t").collect()]
    assert got == pytest.approx(want)


def test_p_values_of_many_rows(spark):
    rows = [(r, n) for n in (2003, 40_003, 3_000_000, 10**9) for r in (0.0, 1e-5, 0.001, -0.01, 0.05, 0.3)]
    got = {(x.r, x.n): x.p for x in sensitivity.with_p(spark.createDataFrame(rows, "r double, n long")).collect()}
    for r, n in rows:
        df = n - 2
        z = math.sqrt(-df * math.log1p(-r * r)) * (8 * df + 1) / (8 * df + 3)
        assert got[r, n] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-9, abs=1e-300)
    # Both ways agree where one takes over from the other.
    summed = [x.p for x in sensitivity.with_p(spark.createDataFrame([(r, 2002) for r in (0.01, 0.05, 0.1)], "r double, n long")).collect()]
    passed = [x.p for x in sensitivity.with_p(spark.createDataFrame([(r, 2003) for r in (0.01, 0.05, 0.1)], "r double, n long")).collect()]
    assert summed == pytest.approx(passed, rel=0.05)
    exact = [math.erfc(math.sqrt(-2000 * math.log1p(-r * r)) * 16001 / 16003 / math.sqrt(2)) for r in (0.01, 0.05, 0.1)]
    assert summed == pytest.approx(exact, rel=1e-5)
