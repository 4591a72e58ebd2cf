"""What shows only on larger tables: grids without end, windows of many rows, inputs read once, nothing large broadcast."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskweave import session
from riskweave.operators import panel, rolling, spatial
from riskweave.plans import indicators as I
from riskweave.plans import spatial_queries
from riskweave.operators.panel import entity_quarters
from tests.conftest import DATA


def once(spark, df):
    """``df`` behind a counter of the rows that are read of it."""
    read = spark.sparkContext.accumulator(0)

    def count(row):
        read.add(1)
        return row

    return spark.createDataFrame(df.rdd.map(count), df.schema), read


def test_neighbourhood_has_no_northern_end(spark):
    df = spark.createDataFrame([(300_000, 1, 2.0), (300_001, 1, 3.0)], "pgid int, t int, x double")
    assert {r.pgid: r.near_sum for r in spatial.neighbourhood(df, "pgid", ["t"], "x").collect()} == {300_000: 5.0, 300_001: 5.0}


@pytest.fixture
def tables(spark):
    cells = spark.createDataFrame([(300_000 + i, "AAA") for i in range(3)], "pgid int, iso3 string")
    base = entity_quarters(cells, (2015, 1), (2021, 4))
    years = spark.range(2014, 2022).select(F.lit("AAA").alias("iso3"), F.col("id").cast("int").alias("year"))
    events = base.select("pgid", "year", "quarter", (F.col("pgid") == 300_000).alias("armed"), (F.col("pgid") == 300_000).alias("unrest"), (F.col("year") % 5 + 1.0).alias("fatalities"))
    months = cells.select("pgid", F.explode(F.sequence(F.lit(1980 * 12), F.lit(2021 * 12 + 11))).alias("k"))
    months = months.select("pgid", F.floor(F.col("k") / 12).cast("int").alias("year"), (F.col("k") % 12 + 1).cast("int").alias("month"), (F.col("k") % 7 * 1.0).alias("temperature"))
    return {
        "panel": base, "conflict_events": events, "coverage": spark.createDataFrame([("AAA", dt.date(2015, 1, 1))], "iso3 string, coverage_start date"),
        "governance": years.withColumn("libdem", F.lit(0.5)), "population": years.withColumn("pop_total", F.lit(1e6)),
        "temperature": months.unionByName(months.withColumn("year", F.col("year") - 100).where("year < 1901")),
        "light_pixels": spark.range(60).select((F.col("id") % 2).alias("area"), (2015 + F.col("id") % 5).cast("int").alias("year"), (F.col("id") % 17 * 1.0).alias("ntl"), (F.col("id") % 7).alias("pop")),
        "regions": cells.select("pgid", (F.col("pgid") % 2).alias("area"), F.lit(0.6).alias("share")), "income_gini": years.withColumn("gini_disp", F.col("year") % 9 * 5.0),
        "gender": years.select("*", (F.col("year") % 3 / 3).alias("gii"), (F.col("year") % 4 / 4).alias("exclusion")), "development_gap": base.select("pgid", "year", "quarter", (F.col("pgid") % 9 / 9).alias("sgdi")),
        "education": years.select((F.col("year") % 2).alias("gdlcode"), "year", F.when(F.col("year") < 2018, 0.5).alias("subnational"), (F.col("year") / 4000).alias("national")),
    }


@pytest.mark.parametrize("name", ["CON_level_surrounding", "CON_soctens_surrounding"])
def test_conflict_around_beyond_the_globes_last_cell(tables, name):
    assert I.INDICATORS[name].run(tables).where("pgid = 300001 and year >= 2018").where(F.col(f"{name}_raw") > 0).count() > 0


@pytest.mark.parametrize(("name", "of"), [
    ("CLI_longterm_temperature-anomaly", "temperature"), ("CON_context_country", "conflict_events"), ("CON_soctens_surrounding", "conflict_events"),
    ("VUL_socioeconomic_inequality", "light_pixels"), ("VUL_political_gender", "development_gap"), ("VUL_socioeconomic_education", "education"),
])
def test_a_recipe_reads_its_largest_input_once(spark, tables, name, of):
    tables[of], read = once(spark, tables[of])
    I.INDICATORS[name].run(tables).collect()
    used = read.value
    tables[of].rdd.count()
    assert used == read.value - used


def test_long_mean_is_the_sliding_mean(spark):
    values = [1.5, None, -2.0, 1e3, math.inf, 4.0, 5.0, -math.inf, math.nan, 6.0, None, None, None, None, 7.25, 8.0, 9.0, 0.1]
    df = spark.createDataFrame([(k, i, v if k else (v if v is None or math.isfinite(v) else 0.5)) for k in (0, 1) for i, v in enumerate(values)], "k int, t int, x double")
    both = rolling.long_mean(df, "x", ["k"], ["t"], 4, 2, "a").withColumn("b", rolling.mean_of_at_least("x", ["k"], ["t"], 4, 2))
    for r in both.collect():
        assert (r.a is None) == (r.b is None) and (r.a is None or math.isnan(r.a) == math.isnan(r.b)), r
        assert r.a is None or math.isnan(r.a) or r.a == pytest.approx(r.b), r


def test_only_few_counted_rows_are_broadcast(spark, monkeypatch):
    """Estimates leave out what ``explode`` adds."""
    monkeypatch.setattr(session, "FEW", 10, raising=False)
    bridge = spark.range(50).select("id", F.col("id").alias("area"), F.lit(0.5).alias("share"))
    values = spark.range(50).select(F.col("id").alias("area"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("year"), F.lit(2.0).alias("x"))
    out = spatial.bridged_mean(bridge, values, "area", ["id", "year"], "x")
    assert out.count() == 400 and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_gini_counts_equal_values(spark):
    xs = [0.0, 0.0, 1.0, 1.0, 1.0, 5.0]
    df = spark.createDataFrame([(1, x) for x in xs], "k int, x double")
    n = len(xs)
    wanted = 2 * sum((i + 1) * x for i, x in enumerate(sorted(xs))) / (n * sum(xs)) - (n + 1) / n
    assert spatial.gini(df, ["k"], "x").first().gini == pytest.approx(wanted)


def test_clip_fill_doesnt_join_the_panel_with_itself(spark):
    df = spark.createDataFrame([(1, t, 1.0 * t if t % 2 else None) for t in range(6)], "k int, t int, x double")
    out = panel.clip_fill(df, ["k"], ["t"], ["x"], require_all=False)
    assert {r.t: r.x for r in out.collect()} == {0: None, 1: 1.0, 2: None, 3: 3.0, 4: None, 5: 5.0}
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_masked_pixels_are_grouped_in_parts_of_bounded_size(spark, monkeypatch):
    rows = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    monkeypatch.setattr(spatial_queries, "PART", 1000, raising=False)
    assert spatial_queries.masked_pixels(spark, DATA).rdd.getNumPartitions() == -(-rows // 1000)
