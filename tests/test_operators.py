from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave.functions import cells, scores
from riskweave.operators import combine, events, impute, panel, raster, rolling, scale, sensitivity, spatial


def series(spark, values, key=1):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values)], "k int, t int, x double")


def filled(spark, values, head, tail):
    rows = impute.interpolate(series(spark, values), ["k"], ["t"], "x", head, tail).orderBy("t").collect()
    return [r.x for r in rows]


@pytest.mark.parametrize(
    ("values", "head", "tail", "wanted"),
    [
        ([None, 1.0, None, 3.0, None], "extrapolate", "none", [0.0, 1.0, 2.0, 3.0, None]),
        ([None, 1.0, None, 3.0, None], "fill", "fill", [1.0, 1.0, 2.0, 3.0, 3.0]),
        ([None, 1.0, None, 3.0, None], "extrapolate", "extrapolate", [0.0, 1.0, 2.0, 3.0, 4.0]),
        ([None, 5.0, None], "extrapolate", "extrapolate", [None, 5.0, None]),
        ([None, 5.0, None], "fill", "none", [5.0, 5.0, None]),
        ([None, None], "fill", "fill", [None, None]),
        ([1.0, 2.0], "none", "none", [1.0, 2.0]),
    ],
)
def test_interpolation_tails(spark, values, head, tail, wanted):
    assert filled(spark, values, head, tail) == wanted


def test_interpolation_agrees_with_a_plain_loop(spark):
    rng = random.Random(3)
    for _ in range(5):
        values = [rng.choice([None, None, rng.random()]) for _ in range(15)]
        seen = [(i, v) for i, v in enumerate(values) if v is not None]
        wanted = []
        for i, v in enumerate(values):
            before, after = [s for s in seen if s[0] <= i], [s for s in seen if s[0] >= i]
            if v is not None or not before or not after:
                wanted.append(v)
            else:
                (a, x), (b, y) = before[-1], after[0]
                wanted.append(x + (y - x) * (i - a) / (b - a))
        assert filled(spark, values, "none", "none") == pytest.approx(wanted)


def test_unknown_tail_is_refused(spark):
    with pytest.raises(ValueError, match="tails"):
        impute.interpolate(series(spark, [1.0]), ["k"], ["t"], "x", head="guess")


def test_decay_follows_the_recurrence(spark):
    target, years, weight = 0.25, 5, 0.5
    factor = math.exp(math.log(target) / (4 * years))
    values = [None, 1.0, 0.0, 0.5, None, 0.2]
    wanted, before, begun = [], None, False
    for x in values:
        begun_now = begun or x is not None
        if not begun:
            value = x
        else:
            value = None if x is None or before is None else weight * x + (1 - weight * x) * factor * before
        before, begun = value, begun_now
        wanted.append(value)
    got = rolling.decay(series(spark, values), ["k"], "t", "x", target, years, weight).orderBy("t").collect()
    assert [r.decayed for r in got] == pytest.approx(wanted)


def test_runs(spark):
    days = [1, 1, 1, 0, 1, 1, 0, 1, 1, 1]
    df = series(spark, [float(d) for d in days])
    closed = rolling.runs(df, ["k"], "t", F.col("x") > 0, 3).collect()
    assert [(r.start, r.end, r.length) for r in closed] == [(0, 2, 3)]
    every = rolling.runs(df, ["k"], "t", F.col("x") > 0, 3, closed_only=False).orderBy("start").collect()
    assert [(r.start, r.end) for r in every] == [(0, 2), (7, 9)]


def test_scaling_of_a_constant_is_missing(spark):
    assert {r.s for r in scale.scaled(series(spark, [2.0, 2.0]), "x", "s").collect()} == {None}


def test_scaling_of_nothing_is_missing(spark):
    assert {r.s for r in scale.scaled(series(spark, [None, None]), "x", "s").collect()} == {None}


def test_clip_keeps_missing_values(spark):
    got = series(spark, [None, -1.0, 5.0]).select(scores.clip(F.col("x"), 0.0, 1.0).alias("c")).collect()
    assert [r.c for r in got] == [None, 0.0, 1.0]


@pytest.mark.parametrize(("method", "wanted"), [("mean", 1.0 / 3), ("gmean", 0.0), ("pmean", math.sqrt(1 / 3))])
def test_means(spark, method, wanted):
    df = spark.createDataFrame([(0.0, 1.0, None)], "a double, b double, c double")
    parts = [(F.col("a"), 2), (F.col("b"), 1), (F.col("c"), 5)]
    assert df.select(scores.combined(method, parts)).first()[0] == pytest.approx(wanted)
    assert df.select(scores.combined(method, parts, "propagate")).first()[0] is None


def test_own_mean_can_be_added(spark):
    scores.METHODS["least"] = lambda parts: F.least(*[x for x, _ in parts])
    try:
        df = spark.createDataFrame([(0.5, 0.2)], "a double, b double")
        assert df.select(scores.combined("least", [(F.col("a"), 1), (F.col("b"), 1)])).first()[0] == 0.2
    finally:
        del scores.METHODS["least"]


def test_neighbours_wrap_and_stop(spark):
    df = spark.createDataFrame([(721,), (1440,), (1,), (259200,)], "c int")
    got = {r.c: set(r.n) for r in df.select("c", cells.neighbours(F.col("c")).alias("n")).collect()}
    assert got[721] == {1440, 721, 722, 720, 1, 2, 2160, 1441, 1442}
    assert got[1440] == {1439, 1440, 721, 719, 720, 1, 2159, 2160, 1441}
    assert got[1] == {720, 1, 2, 1440, 721, 722}
    assert len(got[259200]) == 6


def test_neighbourhood_skips_what_is_not_there(spark):
    p = spark.createDataFrame([(1000, 2000, 1, 2.0), (1001, 2000, 1, 4.0), (5000, 2000, 1, None)], "pgid int, year int, quarter int, x double")
    got = {r.pgid: (r.near_mean, r.near_sum) for r in spatial.neighbourhood(p, "pgid", ["year", "quarter"], "x").collect()}
    assert got == {1000: (3.0, 6.0), 1001: (3.0, 6.0), 5000: (None, None)}


def test_edges_round_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(cells.nearest_centre(F.col("x"))).collect()] == [0.25, 1.25, 1.25, -0.75]


def test_spread_of_intervals(spark):
    rows = [("2000-12-31", "2001-01-01", 4.0), ("2000-05-05", "2000-05-05", 3.0), ("2000-05-06", "2000-05-05", 9.0)]
    df = spark.createDataFrame(rows, "a string, b string, n double").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"), "n")
    got = sorted((str(r.day), r.n) for r in events.spread(df, "a", "b", ["n"]).collect())
    assert got == [("2000-05-05", 3.0), ("2000-12-31", 2.0), ("2001-01-01", 2.0)]


def test_gini(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)] + [("b", 5.0)] * 3 + [("c", None)], "k string, x double")
    got = {r.k: r.gini for r in spatial.gini(df, ["k"], "x").collect()}
    assert got == pytest.approx({"a": 0.25, "b": 0.0})


def test_growth_extension(spark):
    df = spark.createDataFrame([("a", y, x, n) for y, x, n in [(1, 10.0, 1.0), (2, None, 2.0), (3, None, 3.0)]], "k string, t int, x double, n double")
    got = [r.extended for r in impute.extend_by_growth(df, "k", "t", "x", "n", cut_share=0.0).orderBy("t").collect()]
    assert got == pytest.approx([10.0, 20.0, 30.0])


def test_panel_checks_its_keys(spark):
    good = spark.createDataFrame([(1, 2015, 1)], "pgid int, year int, quarter int")
    assert panel.validate(good, ["pgid", "year", "quarter"], 2015).count() == 1
    with pytest.raises(Exception, match="bad panel key"):
        panel.validate(good, ["pgid", "year", "quarter"], 2016).collect()


def test_bilinear_needs_all_corners(spark):
    nodes = spark.createDataFrame([(0.0, 0.0, 1.0), (1.0, 0.0, 3.0), (0.0, 1.0, 5.0)], "x double, y double, v double")
    targets = spark.createDataFrame([(0.5, 0.0), (0.5, 0.5)], "x double, y double")
    got = {(r.x, r.y): r.v for r in raster.bilinear(nodes, targets, "v").collect()}
    assert got == {(0.5, 0.0): 2.0, (0.5, 0.5): None}


def test_missing_parts_stop_the_index(spark):
    spec = combine.Aggregate("s", {"nope": 1.0})
    with pytest.raises(KeyError, match="nope"):
        combine.aggregate(series(spark, [1.0]), spec)


def test_leaving_out_everywhere(spark):
    df = spark.createDataFrame([(1, 0.1, 0.9), (2, 0.5, 0.2), (3, 0.3, 0.4)], "k int, a double, b double")
    index = combine.Index.from_dict({"d": {"weights": {"a": 1, "b": 1}}, "e": {"weights": {"d": 1}, "level": "pillar"}})
    assert index.needs() == {"a", "b"}
    out = sensitivity.leave_out(df, index, "b").orderBy("k").collect()
    assert [r.d for r in out] == pytest.approx([0.0, 1.0, 0.5])


@pytest.mark.parametrize("most", [1, 10, 100_000])
def test_quantile_is_exact(spark, most):
    rng = random.Random(5)
    for values in ([rng.gauss(0, 1) for _ in range(500)], [0.0] * 300 + [rng.random() for _ in range(200)], [1.0, 2.0], [7.0]):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
        for level in (0.0, 0.05, 0.5, 0.61, 0.99, 1.0):
            ranked, place = sorted(values), level * (len(values) - 1)
            low = math.floor(place)
            wanted = ranked[low] + (ranked[min(low + 1, len(values) - 1)] - ranked[low]) * (place - low)
            assert scale.quantile(df, F.col("x"), level, most) == pytest.approx(wanted)
    assert scale.quantile(df.where("false"), F.col("x"), 0.5) is None


def test_p_values_are_the_tail_of_t(spark):
    """Against numeric integration of the density."""
    import math

    from riskweave.operators import sensitivity

    def tail(r, n, steps=4000):
        df = n - 2
        t = abs(r) * math.sqrt(df / (1 - r * r))
        scale_ = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        f = lambda x: scale_ * (1 + x * x / df) ** (-(df + 1) / 2)
        h = t / steps
        return 1 - 2 * h / 3 * (f(0) + f(t) + 4 * sum(f((2 * i - 1) * h) for i in range(1, steps // 2 + 1)) + 2 * sum(f(2 * i * h) for i in range(1, steps // 2)))

    rows = [(r, n) for r in (0.0, 0.1, -0.3, 0.9) for n in (4, 5, 6, 7, 10, 31, 400)]
    got = [x.p for x in sensitivity.with_p(spark.createDataFrame(rows, "r double, n long")).collect()]
    assert got == pytest.approx([tail(r, n) for r, n in rows], abs=1e-9)


def test_clip_fill_leaves_poor_steps_missing(spark):
    from riskweave.operators import panel

    rows = [("A", 1, 1.0, 1.0), ("A", 2, None, None), ("A", 3, 3.0, None), ("A", 4, None, None), ("B", 1, None, 2.0), ("B", 2, 5.0, 4.0), ("B", 3, None, 6.0), ("B", 4, None, None)]
    df = spark.createDataFrame(rows, "k string, t int, x double, y double")
    out = {(r.k, r.t): (r.x, r.y) for r in panel.clip_fill(df, ["k"], ["t"], ["x", "y"]).collect()}
    # Step 4 has no value at all; the others have a quarter of theirs at least, and both columns some.
    assert out[("A", 4)] == out[("B", 4)] == (None, None)
    assert out[("A", 2)] == (2.0, 1.0) and out[("A", 3)] == (3.0, 1.0)
    assert out[("B", 1)] == (5.0, 2.0) and out[("B", 3)] == (5.0, 6.0)
