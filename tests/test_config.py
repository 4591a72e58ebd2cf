from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from riskweave.operators.panel import entity_quarters
from riskweave.plans import config as C
from riskweave.sources.store import Store

SOIL, FIELDS, BIO = "VUL_environmental_soil", "VUL_environmental_irrigation", "VUL_environmental_biodiversity"
SPEC = {
    "tables": {"panel": "1", "soil_pixels": "1", "cropland_pixels": "1", "intactness": "1"},
    "indicators": {SOIL: {}, FIELDS: {}, BIO: {}},
    "aggregates": {"VUL_environmental": {"weights": {SOIL: 1, FIELDS: 1}}, "VUL": {"weights": {"VUL_environmental": 1}}, "CLI_longterm": {"weights": {BIO: 1}}},
}


def changed(**more):
    return C.Config.from_dict({**SPEC, **more})


@pytest.fixture(scope="module")
def tables(spark):
    cells = spark.createDataFrame([(100000 + i, "AAA") for i in range(5)], "pgid int, iso3 string")
    panel = entity_quarters(cells, (2014, 1), (2018, 4))
    pixels = cells.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(9))))
    return {
        "panel": panel,
        "soil_pixels": pixels.select("pgid", ((F.col("i") * 7 + F.col("pgid")) % 13).cast("double").alias("erosion"), F.col("i").cast("double").alias("carbon")),
        "cropland_pixels": pixels.select("pgid", ((F.col("i") * 3 + F.col("pgid")) % 4).alias("value")),
        "intactness": panel.where("quarter = 4").select("pgid", "year", ((F.col("pgid") + F.col("year")) % 10 / 10.0).alias("bii")),
    }


def test_runs_compute_only_what_a_change_concerns(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    asked = []

    def give(name):
        asked.append(name)
        return tables[name]

    def run(config):
        asked.clear()
        return set(C.run(store, config, give, (2018, 4)))

    all_made = set(C.Config.from_dict(SPEC).aggregates)
    assert run(changed()) == {SOIL, FIELDS, BIO, *all_made}
    before = {n: store.load("output", n).orderBy("pgid", "year", "quarter").collect() for n in ("VUL", "CLI_longterm")}
    assert run(changed()) == set() and asked == []
    # Another weight concerns its dimension, pillar and risks, and no indicator.
    heavier = {**SPEC["aggregates"], "VUL_environmental": {"weights": {SOIL: 3, FIELDS: 1}}}
    assert run(changed(aggregates=heavier)) == {"VUL_environmental", "VUL", "CLI_risk", "CON_risk", "index"}
    assert set(asked) == {"panel"}
    after = {n: store.load("output", n).orderBy("pgid", "year", "quarter").collect() for n in ("VUL", "CLI_longterm")}
    assert after["CLI_longterm"] == before["CLI_longterm"] and after["VUL"] != before["VUL"]
    # A new version of one table concerns its indicator and what is made of it.
    newer = {**SPEC["tables"], "cropland_pixels": "2"}
    assert run(changed(aggregates=heavier, tables=newer)) == {FIELDS, "VUL_environmental", "VUL", "CLI_risk", "CON_risk", "index"}
    assert set(asked) == {"panel", "cropland_pixels"}
    assert run(changed(aggregates=heavier, tables=newer, regenerate=[BIO])) == {BIO, "CLI_longterm", "CLI", "CLI_risk", "index"}
    assert run(changed(aggregates=heavier, tables=newer)) == set()


def test_a_run_that_stopped_goes_on(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))

    def fails(name):
        if name == "intactness":
            raise OSError("gone")
        return tables[name]

    with pytest.raises(OSError, match="gone"):
        C.run(store, changed(), fails, (2018, 4))
    done = set(C.saved_digests(store))
    left = C.run(store, changed(), tables.__getitem__, (2018, 4))
    assert BIO in left and not done & set(left)


def test_exposure_concerns_its_dimensions(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    exposure = tables["panel"].select("pgid", "year", "quarter", ((F.col("pgid") % 5 + 1) / 5).alias("exposure"))
    C.run(store, changed(exposure="1"), tables.__getitem__, (2018, 4), exposure)
    again = C.run(store, changed(exposure="2"), tables.__getitem__, (2018, 4), exposure)
    assert "CLI_longterm" in again and "VUL_environmental" not in again and SOIL not in again


def test_graph_and_faults(spark, tmp_path):
    config = C.Config.from_dict({"data": {"wpp": {"version": "2024"}, "unhcr": {}}, "indicators": {"VUL_demographic_dependent": {}, "VUL_demographic_uprooted": {}}})
    graph = config.graph()
    assert graph["table:agegroups"] == ("data:wpp",) and set(graph["table:displacement"]) == {"data:unhcr", "data:wpp"}
    newer = C.Config.from_dict({"data": {"wpp": {"version": "2024"}, "unhcr": {"version": 3}}, "indicators": {"VUL_demographic_dependent": {}, "VUL_demographic_uprooted": {}}})
    stale = newer.stale(config.digests())
    assert "VUL_demographic_uprooted" in stale and "VUL_demographic_dependent" not in stale and "VUL" in stale and "CLI" not in stale
    assert C.Config.from_dict({"start": 2016}).digests()["VUL"] != C.Config.from_dict({}).digests()["VUL"]
    for wrong in ({"data": {"nothing": {}}}, {"indicators": {"X_y_z": {}}}, {"weights": {}}, {"regenerate": ["nothing"]}, {"aggregates": {"VUL": {"weights": {"A_b_c": 1}}}}):
        with pytest.raises(KeyError):
            C.Config.from_dict(wrong)
    (tmp_path / "c.json").write_text(json.dumps(SPEC, indent=1))
    assert C.Config.load(spark, str(tmp_path / "c.json")).digests() == C.Config.from_dict(SPEC).digests()
