from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskweave.operators.tiles import LookupCache, YearlyZones, mosaic


def test_mosaic(spark):
    index = [("a", 1, "cover", True), ("a", 1, "loss", True), ("b", 0, "cover", True), ("b", 0, "loss", False), ("c", 2, "cover", True), ("c", 2, "loss", False), ("d", 0, "loss", True)]
    tiles = spark.createDataFrame(index, "tile string, rank int, layer string, there boolean")
    cover = spark.createDataFrame([("a", 0, 0, 5.0), ("a", 1, 0, 6.0), ("b", 1, 0, 7.0), ("b", 2, 0, 0.0), ("c", 3, 0, 0.0), ("d", 4, 0, 9.0), ("e", 5, 0, 1.0)], "tile string, x int, y int, value double")
    loss = spark.createDataFrame([("a", 0, 0, 3.0), ("a", 9, 9, 1.0), ("d", 4, 0, 1.0)], "tile string, x int, y int, value double")
    got = {(r.x, r.y): (r.tile, r.cover, r.loss) for r in mosaic(tiles, {"cover": cover, "loss": loss}, "cover", {"loss": 0.0}).collect()}
    # b wins the shared pixel by rank and has no loss layer; c has neither losses nor cover; d and e are not published whole.
    assert got == {(0, 0): ("a", 5.0, 3.0), (1, 0): ("b", 7.0, 0.0), (2, 0): ("b", 0.0, 0.0)}


PIXELS = [("u1", 2000, 1, 2.0), ("u1", 2000, 1, 3.0), ("u1", 2000, 2, None), ("u2", 2000, 1, 10.0), ("u2", 2001, 1, 7.0), ("u3", 2001, 3, 1.0)]


@pytest.fixture
def zones(spark, tmp_path):
    return YearlyZones(spark, str(tmp_path / "zones"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "unit string, year int, cell int, v double")


def wanted(spark, *rows):
    return spark.createDataFrame(rows, "unit string, year int, version string")


def found(zones):
    return {(r.zone, r.year): (r.sum, r.n) for r in zones.load().collect()}


def test_only_what_is_missing_is_read(spark, zones):
    assert zones.load().collect() == []
    asked = []

    def pixels(todo):
        asked.append(sorted((r.unit, r.year) for r in todo.collect()))
        return frame(spark, PIXELS)

    zone = F.col("cell")
    assert zones.update(wanted(spark, ("u1", 2000, "a"), ("u2", 2000, "a")), pixels, zone, "v") == 2
    assert found(zones) == {(1, 2000): (15.0, 3), (2, 2000): (0.0, 0)}
    every = wanted(spark, ("u1", 2000, "a"), ("u2", 2000, "a"), ("u2", 2001, "a"), ("u3", 2001, "a"))
    assert zones.update(every, pixels, zone, "v") == 2
    full = {(1, 2000): (15.0, 3), (2, 2000): (0.0, 0), (1, 2001): (7.0, 1), (3, 2001): (1.0, 1)}
    assert found(zones) == full
    assert zones.update(every, lambda todo: pytest.fail("nothing is missing"), zone, "v") == 0
    assert asked == [[("u1", 2000), ("u2", 2000)], [("u2", 2001), ("u3", 2001)]]


def test_a_run_that_was_cut_off_heals(spark, zones, monkeypatch):
    required = wanted(spark, ("u1", 2000, "a"), ("u2", 2000, "a"))
    monkeypatch.setattr(YearlyZones, "commit", lambda self, done: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        zones.update(required, lambda todo: frame(spark, [("u1", 2000, 1, 99.0)]), F.col("cell"), "v")
    assert found(zones) == {}  # written, but not entered
    monkeypatch.undo()
    assert zones.update(required, lambda todo: frame(spark, PIXELS), F.col("cell"), "v") == 2
    assert found(zones) == {(1, 2000): (15.0, 3), (2, 2000): (0.0, 0)}


def test_a_new_version_replaces_its_unit_only(spark, zones):
    zones.update(wanted(spark, ("u1", 2000, "a"), ("u2", 2000, "a")), lambda todo: frame(spark, PIXELS), F.col("cell"), "v")
    newer = [("u1", 2000, 5, 4.0), ("u2", 2000, 1, 1000.0)]
    assert zones.update(wanted(spark, ("u1", 2000, "b"), ("u2", 2000, "a")), lambda todo: frame(spark, newer), F.col("cell"), "v") == 1
    assert found(zones) == {(1, 2000): (10.0, 1), (5, 2000): (4.0, 1)}
    # A version without any pixel leaves none of the older values.
    assert zones.update(wanted(spark, ("u1", 2000, "c")), lambda todo: frame(spark, newer[1:]), F.col("cell"), "v") == 1
    assert found(zones) == {(1, 2000): (10.0, 1)}


def test_lookup_cache(spark, tmp_path):
    cache = LookupCache(spark, str(tmp_path / "cache"))
    rows = lambda *r: spark.createDataFrame(list(r), "key int, value map<string,double>")
    cache.merge(rows((1, {"a": 0.5, "b": 0.5}), (1, {"b": 0.5, "a": 0.5}), (2, {"c": 1.0}), (3, {})))
    cache.merge(rows((2, {"d": 1.0}), (1, {"b": 0.5, "a": 0.5})))
    assert {(r.key, r.name, r.number) for r in cache.load().collect()} == {(1, "a", 0.5), (1, "b", 0.5), (2, "d", 1.0)}
    assert spark.read.parquet(str(tmp_path / "cache" / "entries")).count() == 4  # what is known is not written again
    cache.merge(rows((4, {"x": 1.0}), (4, {"x": 2.0})))
    with pytest.raises(Exception, match="several maps for the key 4"):
        cache.load().collect()
