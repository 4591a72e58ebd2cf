from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from riskweave.operators import panel, prepare


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_each_year(spark):
    df = spark.createDataFrame([("a", 2000, 2002), ("b", 2001, 2001), ("c", 2002, 2001), ("d", 2000, None)], "iso3 string, start int, stop int")
    assert rows(panel.years_of(df, "start", "stop"), "iso3", "year") == [("a", 2000), ("a", 2001), ("a", 2002), ("b", 2001)]


def test_also_as(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "iso3 string, x int")
    assert rows(panel.also_as(df, "iso3", {"a": "z"}), "x", "iso3") == [("a", 1), ("z", 1), ("b", 2), (None, 3)]


def test_shares_and_sums(spark):
    df = spark.createDataFrame([("a", "x", 20.0), ("a", "y", 10.0), ("b", "y", 0.0), ("c", "x", None)], "iso3 string, status string, size double")
    assert rows(prepare.share_of_most(df, {"size": 40}).where("size = 10").select("size_percent"), "size_percent") == [(0.25,)]
    assert rows(prepare.sum_where(df, ["iso3"], "size", F.col("status") == "x", "s"), "iso3") == [("a", 20.0), ("c", None)]
    assert rows(panel.total_or_null(df, ["iso3"], "size", "s"), "iso3") == [("a", 30.0), ("b", None), ("c", None)]


def test_one_value(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (1, 2.0), (2, None)], "k int, x double")
    assert rows(panel.one_value(df, ["k"], "x"), "k") == [(1, 2.0), (2, None)]
    with pytest.raises(Exception, match="x has several values at 1"):
        panel.one_value(df.union(spark.createDataFrame([(1, 3.0)], "k int, x double")), ["k"], "x").collect()


def test_next_year(spark):
    df = spark.createDataFrame([("a", 2001, 2.0), ("a", 2000, 1.0), ("b", 2000, 9.0)], "iso3 string, year int, x double")
    assert rows(prepare.next_year(df, "iso3", "x"), "iso3", "year") == [("a", 2000, 2.0), ("a", 2001, None), ("b", 2000, None)]


def test_growth_since(spark):
    data = [("a", 2019, 50.0), ("a", 2020, 1.0), ("a", 2021, -2.0), ("a", 2022, 3.0), ("b", 2020, 1.0), ("b", 2022, 1.0), ("c", 2020, None), ("c", 2021, 1.0), ("d", 2020, -100.0)]
    found = {(r[0], r[1]): r[2] for r in prepare.growth_since(spark.createDataFrame(data, "iso3 string, year int, g double"), "iso3", "g", 2020).collect()}
    assert found.keys() == {("a", 2021), ("a", 2022), ("a", 2023), ("b", 2021), ("b", 2023), ("c", 2021), ("c", 2022), ("d", 2021)}
    assert found["a", 2023] == pytest.approx(math.prod([1.01, 0.98, 1.03]))
    assert (found["b", 2023], found["c", 2022], found["d", 2021]) == (None, None, 0.0)
