from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from riskweave.sources import files
from riskweave.sources.store import Store, component_id
from riskweave.streaming import counts
from tests.conftest import DATA


def test_store_round_trip(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert not store.exists("output", "x")
    df = spark.createDataFrame([(1, 2015, 1, 0.5, 3.0, 0.1), (1, 2015, 2, None, 4.0, 0.2)], "pgid int, year int, quarter int, A_b_c double, A_b_c_raw double, A_b_c_exposure double")
    name = store.release(df, 2015, 2)
    assert store.restore(name) == ["A_b_c"]
    assert store.load("output", "A_b_c").columns == ["pgid", "year", "quarter", "A_b_c", "A_b_c_raw"]
    assert store.current("A_b_c", "A_b_c", 2015, 1) and not store.current("A_b_c", "A_b_c", 2015, 2)
    assert {r.id: r.last for r in store.load("output", f"recency_{name}", name).collect()} == {"A_b_c": 20151, "A_b_c_raw": 20152, "A_b_c_exposure": 20152}


def test_ids_have_no_underscores():
    assert component_id("CLI", "current", "heavy-precipitation") == "CLI_current_heavy-precipitation"
    with pytest.raises(ValueError):
        component_id("CLI", "a_b")


def test_csv_and_json(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.csv").write_text("k,v\nx,-\ny,2\n")
    rows = files.csv(spark, str(tmp_path), "k string, v int", missing="-", recursive=True).collect()
    assert {(r.k, r.v) for r in rows} == {("x", None), ("y", 2)}
    page = {"Result": [{"id": 1}, {"id": 2}, {"id": 2}]}
    (tmp_path / "p.json").write_text(json.dumps(page))
    assert files.json_pages(spark, str(tmp_path / "p.json"), "Result", "id int").count() == 2


def test_lookups(spark):
    names = spark.createDataFrame([("f_v1.2.csv",), ("f_v1.10.csv",), ("other",)], "n string")
    assert files.latest_version(names, "n", r"f_(v[\d.]+)\.csv").first()[0] == "v1.10"
    alias = spark.createDataFrame([("Ivory  Coast", "CIV")], "alias string, iso3 string")
    got = files.country_codes(spark.createDataFrame([("ivory coast ",), ("Nowhere",)], "c string"), "c", alias).collect()
    assert {r.c: r.iso3 for r in got} == {"ivory coast ": "CIV", "Nowhere": None}
    both = spark.createDataFrame([(1, "early", 5), (1, "final", 6), (2, "early", 7)], "k int, v string, x int")
    assert {r.k: r.x for r in files.by_priority(both, ["k"], "v", ["final", "early"]).collect()} == {1: 6, 2: 7}
    assert files.plain_names(spark.createDataFrame([(1,)], "`Some Name (x)` int")).columns == ["some_name_x"]


def test_stream_equals_batch(spark, tmp_path):
    path = f"{DATA}/events.parquet"
    batch = spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = counts.windowed(stream, "ts", ["event_type"], "value", late="60 days").writeStream.outputMode("complete").format("memory").queryName("counted").start()
    query.processAllAvailable()
    query.stop()
    got = {(r.event_type, r.start): r.n for r in spark.table("counted").collect()}
    assert got == {(r.event_type, r.start): r.n for r in counts.windowed(batch, "ts", ["event_type"], "value").collect()}


def test_sessions(spark):
    rows = [("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:20:00"), ("u", "2024-01-01 02:00:00")]
    df = spark.createDataFrame(rows, "u string, s string").select("u", F.to_timestamp("s").alias("ts"))
    assert sorted(r.n for r in counts.sessions(df, "ts", ["u"]).collect()) == [1, 2]


def test_publishing(spark, tmp_path):
    from riskweave.plans import publish
    from riskweave.restore import main

    (tmp_path / "spec.json").write_text(json.dumps({"d": {"weights": {"a": 1}}}))
    assert publish.load_spec(spark, str(tmp_path / "spec.json")).needs() == {"a"}
    df = spark.createDataFrame([(1, 2015, 1, 0.5, 1.0), (1, 2015, 2, None, 2.0)], "pgid int, year int, quarter int, d double, d_raw double")
    shown = publish.dashboard(df, ["d"])
    assert {(r.quarter, r.d, r.d_raw) for r in shown.collect()} == {(1, 0.5, 1.0), (2, 0.5, 2.0)}
    assert publish.latest(shown, ["d"]).first().quarter == 2
    a, b = (spark.createDataFrame([(k, 2000, 1.0)], f"iso3 string, year int, {k} double") for k in ("x", "y"))
    assert publish.country_data([a, b]).count() == 2
    Store(spark, str(tmp_path)).release(df, 2015, 2)
    assert main([str(tmp_path), "2015_Q2"]) == ["d"]


def test_grid_of_countries(spark):
    from riskweave.operators import grid

    with pytest.raises(ValueError):
        grid.from_bounds(spark, -190, 0, 0, 1)
    g = grid.from_bounds(spark, 0, 0, 1, 1)
    ids = sorted(r.pgid for r in g.collect())
    assert len(ids) == 4
    shares = spark.createDataFrame([(ids[0], "A", 0.6), (ids[0], "B", 0.4), (ids[1], "A", 0.1), (ids[2], "B", 0.9)], "pgid int, area string, share double")
    lakes = spark.createDataFrame([(ids[2], 0.8)], "pgid int, share double")
    assert [(r.pgid, r.iso3) for r in grid.matched(g, shares, lakes).collect()] == [(ids[0], "A")]
    assert grid.dense(shares, spark, "share", 0, 0, 1, 1).where("share is null").count() == 1
