from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave.plans import indicators as I
from riskweave.operators.panel import entity_quarters

Y0, Y1 = 2010, 2024


@pytest.fixture(scope="module")
def tables(spark):
    """Small made-up inputs of every shape that a recipe reads."""
    cells = spark.createDataFrame([(100000 + i, "AAA" if i < 3 else "BBB") for i in range(6)], "pgid int, iso3 string")
    panel = entity_quarters(cells, (Y0, 1), (Y1, 4)).cache()
    noise = lambda m: F.pmod(F.xxhash64("pgid", "year", "quarter", F.lit(m)), F.lit(m))
    countries = cells.select("iso3").distinct().withColumn("year", F.explode(F.sequence(F.lit(Y0 - 1), F.lit(Y1))))
    wave = lambda m: (F.pmod(F.xxhash64("iso3", "year", F.lit(m)), F.lit(1000)) + 1) / 1000.0
    yearly = countries.select("iso3", "year", *[wave(i).alias(f"w{i}") for i in range(6)])
    months = cells.withColumn("year", F.explode(F.sequence(F.lit(1850), F.lit(Y1)))).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    monthly = months.withColumn("v", F.pmod(F.xxhash64("pgid", "year", "month"), F.lit(100)) / 10.0)
    cell_years = panel.where("quarter = 4").select("pgid", "iso3", "year")
    pixels = cells.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(9))))
    day = lambda y, m, d: dt.date(y, m, d)
    out = {
        "panel": panel,
        **{f"{h}_counts": panel.where(noise(3) > 0).select("pgid", "year", "quarter", noise(7).alias("count")) for h in I.COUNTS},
        "spei": monthly.where(f"year >= {Y0}").select("pgid", "year", "month", (F.col("v") - 5).alias("spei")),
        "temperature": monthly.select("pgid", "year", "month", (F.col("v") + F.col("year") / 100).alias("temperature")),
        "precipitation": monthly.where("year >= 1951").select("pgid", "year", "month", F.quarter(F.make_date("year", "month", F.lit(1))).alias("quarter"), (F.col("v") + 1).alias("rain")),
        "sea_level": cells.select("pgid", ((F.col("pgid") % 4) / 10.0 - 0.1).alias("rise")),
        "conflict_events": panel.where(noise(2) == 0).select("pgid", "year", "quarter", (noise(3) > 0).alias("armed"), (noise(3) == 0).alias("unrest"), noise(11).cast("double").alias("fatalities")),
        "coverage": spark.createDataFrame([("AAA", day(2010, 1, 1)), ("BBB", day(2012, 1, 1))], "iso3 string, coverage_start date"),
        "governance": yearly.select("iso3", "year", F.col("w0").alias("libdem")),
        "population": yearly.select("iso3", "year", (F.col("w1") * 1e6 + 1000).alias("pop_total")),
        "interval_events": spark.createDataFrame([("AAA", day(2015, 3, 30), day(2015, 4, 2), "army", "rebels", 8.0), ("BBB", day(2016, 1, 1), day(2016, 1, 1), "army", "Civilians", 2.0)], "iso3 string, date_start date, date_end date, side_a string, side_b string, best double"),
        "labour": yearly.select("iso3", "year", (F.col("w0") * 100).alias("participation"), F.lit(50.0).alias("participation_model"), F.when(F.col("iso3") == "AAA", F.col("w1")).alias("farm_share"), F.col("w4").alias("farm_share_model"), (F.col("w2") * 100).alias("value_added")),
        "undernourishment": yearly.select("iso3", "year", F.when(F.col("w0") < 0.3, "<2.5").otherwise((F.col("w0") * 30).cast("string")).alias("value")),
        "exclusion": yearly.select("iso3", "year", F.col("w1").alias("exclusion_index")),
        "groups": yearly.select("iso3", "year", (F.col("w0") / 2).alias("size"), F.lit("POWERLESS").alias("status")),
        "institutions": yearly.select("iso3", "year", (F.col("w0") * 100).alias("corruption"), (F.col("w1") * 5 - 2.5).alias("effectiveness"), F.col("w2").alias("rule_of_law")),
        "system": yearly.select("iso3", "year", *[F.col(f"w{i}").alias(n) for i, n in enumerate(("freedom", "libdem", "partip", "civlib"))]),
        "gender": yearly.select("iso3", "year", F.col("w0").alias("gii"), F.col("w1").alias("exclusion")),
        "development_gap": panel.select("pgid", "year", "quarter", (noise(50) / 100 + 0.5).alias("sgdi")),
        "agegroups": yearly.select("iso3", "year", *[F.col(f"w{i}").alias(n) for i, n in enumerate(("pop_youth", "pop_working", "pop_old"))]),
        "displacement": yearly.select("iso3", "year", *[F.col(f"w{i}").alias(n) for i, n in enumerate(("refugees", "asylum_seekers", "others_need_of_protection", "idps"))], F.lit(1000.0).alias("pop_total")),
        "gdp": yearly.select("iso3", "year", F.when(F.col("w0") > 0.4, F.col("w1") * 1e4).alias("gdp_ppp"), (F.col("w2") * 1e4).alias("gdp_other"), F.lit(1e6).alias("pop_total")),
        "lights": cell_years.select("pgid", "year", (F.col("pgid") % 5).cast("double").alias("ntl"), F.lit(5000.0).alias("pop_count")),
        "country_pop": yearly.select("iso3", "year", (F.col("w1") * 1e6).alias("pop_total")),
        "regions": spark.createDataFrame([(100000 + i, f"r{i % 2}", 0.6) for i in range(6)] + [(100000, "r1", 0.4)], "pgid int, area string, share double"),
        "income_gini": yearly.select("iso3", "year", (F.col("w3") * 60).alias("gini_disp")),
        "light_pixels": spark.range(200).select(F.concat(F.lit("r"), (F.col("id") % 2).cast("string")).alias("area"), (2015 + F.col("id") % 5).cast("int").alias("year"), (F.col("id") % 17).cast("double").alias("ntl"), (F.col("id") % 7).cast("double").alias("pop")),
        "intactness": cell_years.where("year % 5 = 0").select("pgid", "year", ((F.col("pgid") + F.col("year")) % 10 / 10.0).alias("bii")),
        "forest_pixels": pixels.select("pgid", (F.col("i") * 10.0).alias("cover"), F.when(F.col("i") % 3 == 0, 15 + F.col("i")).otherwise(0).alias("lossyear"), F.lit(1).alias("datamask")),
        "cropland_pixels": pixels.select("pgid", ((F.col("i") + F.col("pgid")) % 4).alias("value")),
        "soil_pixels": pixels.select("pgid", ((F.col("i") * 7 + F.col("pgid")) % 13).cast("double").alias("erosion"), F.col("i").cast("double").alias("carbon")),
        "basin_stress": spark.createDataFrame([(1, 0.2, 0.6), (2, -9999.0, 4.0)], "pfaf_id int, bws_raw_2019 double, bws_raw_2030 double"),
        "basins": cells.select("pgid", (F.col("pgid") % 2 + 1).cast("int").alias("area"), F.lit(1.0).alias("share")),
    }
    for name in ("education", "health"):
        out[name] = spark.range(30).select(
            F.concat(F.lit("r"), (F.col("id") % 2).cast("string")).alias("gdlcode"), (2010 + F.floor(F.col("id") / 2)).cast("int").alias("year"),
            F.when(F.col("id") < 20, 0.3 + F.col("id") / 100).alias("subnational"), (0.5 + F.col("id") / 100).alias("national"),
        )
    return out


def test_there_are_41():
    assert len(I.INDICATORS) == 41


@pytest.mark.parametrize("name", sorted(I.INDICATORS))
def test_recipe_gives_a_panel(tables, name):
    out = I.INDICATORS[name].run(tables)
    assert out.columns == ["pgid", "year", "quarter", name, f"{name}_raw"]
    n, keys, low, high, some = out.agg(
        F.count("*"), F.count_distinct("pgid", "year", "quarter"), F.min(name), F.max(name), F.count(name)
    ).first()
    assert n == keys == 6 * 4 * (Y1 - 2015 + 1)
    assert some > 0
    assert low >= -1e-9 and high <= 1 + 1e-9


def test_index_from_indicators(spark):
    names = sorted(I.INDICATORS)
    columns = ", ".join(f"`{n}` double" for n in names)
    rows = [(i, 2020, 1, 1.0 + i, *[((i * 7 + j * 3) % 11) / 11 for j in range(len(names))]) for i in range(12)]
    df = spark.createDataFrame(rows, f"pgid int, year int, quarter int, density double, {columns}")
    df = I.scale.exposure_layer(df, "density", "exposure", 2020)
    out = I.evaluate_index(df, "exposure").select("index", "CLI_risk", "CON_risk").toPandas()
    assert out["index"].between(0, 1).all() and out["index"].max() == 1.0


def test_exposure_comes_before_aggregation(spark):
    """Indicators of an exposed dimension are weighed, logged and scaled, then combined; against plain numpy."""
    import numpy as np

    names = sorted(I.INDICATORS)
    rng = np.random.default_rng(2)
    values = rng.random((40, len(names)))
    density = rng.random(40)
    columns = ", ".join(f"`{n}` double" for n in names)
    rows = [(i, 2020, 1, float(density[i]), *map(float, values[i])) for i in range(40)]
    df = spark.createDataFrame(rows, f"pgid int, year int, quarter int, exposure double, {columns}")
    got = {r.pgid: r for r in I.evaluate_index(df, "exposure").collect()}

    def exposed(x):
        p = np.log1p(x * density)
        low, high = np.quantile(p[p != 0], [0.0, 0.999])
        return (np.clip(p, low, high) - low) / (high - low)

    parts = {n: exposed(values[:, names.index(n)]) for n in I.DIMENSIONS["CLI_longterm"]["weights"]}
    mean = np.sqrt(sum(v * v for v in parts.values()) / len(parts))
    wanted = (mean - mean.min()) / (mean.max() - mean.min())
    assert np.allclose([got[i].CLI_longterm for i in range(40)], wanted)
    assert np.allclose([got[i]["CLI_longterm_temperature-anomaly_exposure"] for i in range(40)], parts["CLI_longterm_temperature-anomaly"])
    plain = I.evaluate_index(df.drop("exposure")).collect()
    assert {r.pgid: r.VUL for r in plain} == pytest.approx({i: r.VUL for i, r in got.items()})


def test_release_from_tables(spark, tables, tmp_path):
    from riskweave.sources.store import Store

    store = Store(spark, str(tmp_path))
    names = ["VUL_environmental_irrigation", "VUL_environmental_soil"]
    assert I.run_release(store, tables, (2020, 4), names) == "2020_Q4"
    out = store.load("output", "scores_2020_Q4", "2020_Q4")
    assert out.count() == 6 * 4 * 6 and set(names) <= set(out.columns)
    assert out.where("VUL_environmental is not null").count() > 0
    saved = {n: store.load("output", n).count() for n in names}
    # What is current is not computed again: an unusable table is never read.
    assert I.run_release(store, {**tables, "soil_pixels": tables["panel"]}, (2020, 4), names) == "2020_Q4"
    assert {n: store.load("output", n).count() for n in names} == saved
    assert set(store.restore("2020_Q4")) >= {*names, "VUL_environmental"}
