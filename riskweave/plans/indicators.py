"""The 41 indicators and the index they make.

An indicator is a function from a mapping of input tables to a panel
(pgid, year, quarter, score, raw). Inputs are tables that a source has landed:
events, counts per quarter, country-year values, pixels and bridges. All
scaling finds its bounds while planning, in at most three passes over a stored panel.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import calendar, scores
from riskweave.operators import events, impute, panel, raster, rolling, scale, spatial
from riskweave.operators.combine import Index, evaluate
from riskweave.session import cut, few
from riskweave.sources.store import Store

Tables = Mapping[str, DataFrame]
CELL, TIME = ["pgid"], ["year", "quarter"]
KEYS = [*CELL, *TIME]
START, REFERENCE = 2015, 2020


@dataclass(frozen=True)
class Indicator:
    """A named recipe and the tables it reads."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[[Tables], DataFrame]

    def run(self, tables: Tables, start: int = START) -> DataFrame:
        """The indicator's panel from the start year on, its columns named after it."""
        absent = [i for i in self.inputs if i not in tables]
        if absent:
            raise KeyError(f"{self.name} needs the tables {absent}")
        out = self.build(tables).where(F.col("year") >= start)
        return out.select(*KEYS, F.col("score").alias(self.name), F.col("raw").cast("double").alias(f"{self.name}_raw"))


INDICATORS: dict[str, Indicator] = {}


def _scaled(df: DataFrame, *limits, **settings) -> DataFrame:
    """``raw`` scaled to ``score``. Bounds read the panel in up to three passes, so it is stored before, with what is needed of it."""
    return scale.scaled(cut(df.select(*KEYS, "raw")), "raw", "score", *limits, **settings)


def indicator(name: str, *inputs: str):
    """Register a recipe under its composite id, pillar_dimension_id."""
    if name.count("_") != 2:
        raise ValueError(f"{name}: an id has three parts without underscores")

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        INDICATORS[name] = Indicator(name, inputs, f)
        return f

    return register


# Climate ---------------------------------------------------------------------------------------

#: The transformation and the quantile limits of each count indicator, now and over seven years.
COUNTS = {
    "floods": ("log1p", (None, None), (None, None)),
    "cyclones": ("log1p", (None, None), (None, None)),
    "wildfires": ("log1p", (None, None), (None, None)),
    "heatwave": ("identity", (0.0, 0.9995), (0.0, 0.9995)),
    "heavy-precipitation": ("identity", (0.005, 0.9995), (0.0, 0.9995)),
}


def _count_recipe(hazard: str, years: int) -> Callable[[Tables], DataFrame]:
    transform, now, long = COUNTS[hazard]

    def build(tables: Tables) -> DataFrame:
        counted = tables["panel"].join(tables[f"{hazard}_counts"].select(*KEYS, "count"), KEYS, "left")
        out = counted.withColumn("raw", F.coalesce("count", F.lit(0)).cast("double")).withColumn("raw", rolling.full_sum("raw", CELL, TIME, 4).cast("double"))
        if years > 1:
            out = out.withColumn("raw", rolling.full_mean("raw", CELL, TIME, 4 * years))
        return _scaled(out, now if years == 1 else long, until=REFERENCE, transform=transform)

    return build


for _hazard in COUNTS:
    indicator(f"CLI_current_{_hazard}", "panel", f"{_hazard}_counts")(_count_recipe(_hazard, 1))
    indicator(f"CLI_accumulated_{_hazard}", "panel", f"{_hazard}_counts")(_count_recipe(_hazard, 7))


def _dry(tables: Tables) -> DataFrame:
    """The index of the quarter's last month, its sign turned where it is dry."""
    last = tables["spei"].where(F.col("month") % 3 == 0).withColumn("quarter", F.floor(F.col("month") / 3).cast("int"))
    joined = tables["panel"].join(last.select(*KEYS, "spei"), KEYS, "left")
    return joined.withColumn("raw", scores.reversed_negative(F.col("spei")))


@indicator("CLI_current_drought", "panel", "spei")
def _drought_now(tables):
    return _scaled(_dry(tables), (0.0, 0.9995), until=REFERENCE)


@indicator("CLI_accumulated_drought", "panel", "spei")
def _drought_long(tables):
    seasons = _dry(tables).withColumn("raw", rolling.mean_of_at_least("raw", ["pgid", "quarter"], ["year"], 7, 7))
    return _scaled(seasons, (0.0, 0.9995), until=REFERENCE)


@indicator("CLI_longterm_temperature-anomaly", "panel", "temperature")
def _temperature(tables):
    """Thirty-year mean of monthly departures from 1850-1900, at the end of each quarter.

    The baseline and the means are windows of the cell, over one shuffle of the months.
    """
    base = F.avg(F.when(F.col("year").between(1850, 1900), F.col("temperature"))).over(Window.partitionBy("pgid"))
    t = tables["temperature"].select("pgid", "year", "month", (F.col("temperature") - base).alias("anomaly"))
    t = rolling.long_mean(t, "anomaly", CELL, ["year", "month"], 360, 324, "raw")
    ends = t.where((F.col("month") % 3 == 0) & F.col("raw").isNotNull()).withColumn("quarter", F.floor(F.col("month") / 3).cast("int"))
    return _scaled(tables["panel"].select(*KEYS).join(ends.select(*KEYS, "raw"), KEYS, "left"), until=REFERENCE, transform="zero_if_negative")


@indicator("CLI_longterm_precipitation-anomaly", "panel", "precipitation")
def _precipitation(tables):
    """Relative departures of yearly rain from the cell's baseline, averaged over ten steps of the cell."""
    q = tables["precipitation"].groupBy(*KEYS).agg(F.avg("rain").alias("rain"))
    base = tables["precipitation"].where(F.col("year").between(1951, 1980)).groupBy("pgid").agg(F.avg("rain").alias("base"))
    q = q.withColumn("rain", rolling.mean_of_at_least("rain", CELL, TIME, 4, 1)).join(base, "pgid", "left")
    q = q.withColumn("off", F.abs(F.try_divide("rain", "base") - 1)).withColumn("raw", rolling.mean_of_at_least("off", CELL, TIME, 10, 1))
    return _scaled(tables["panel"].join(q.select(*KEYS, "raw"), KEYS, "left"), until=REFERENCE, transform="log1p")


@indicator("CLI_longterm_relative-sea-level", "panel", "sea_level")
def _sea_level(tables):
    """The largest rise of a cell's coast, not below 0, from 2015 on."""
    rise = tables["sea_level"].groupBy("pgid").agg(F.greatest(F.max("rise"), F.lit(0.0)).alias("raw"))
    first = rise.withColumn("year", F.lit(START)).withColumn("quarter", F.lit(1))
    joined = tables["panel"].join(first, KEYS, "left")
    return _scaled(impute.forward_fill(joined, CELL, TIME, ["raw"]), transform="log1p")


# Conflict --------------------------------------------------------------------------------------

CAP = 0.99


def _fought(tables: Tables) -> DataFrame:
    """Fatalities of armed events, 0 where events are covered."""
    counts = events.counts_by_class(tables["conflict_events"], KEYS, {"armed": F.col("armed"), "unrest": F.col("unrest")}, "fatalities")
    joined = tables["panel"].join(counts, KEYS, "left").join(few(tables["coverage"]), "iso3", "left")
    return panel.covered_zero(joined, ["sum_armed", "n_unrest"], "coverage_start")


def _capped(df: DataFrame, value: str) -> DataFrame:
    return scale.capped_by_time(df.withColumn("_v", F.log1p(value)), "_v", "score", CAP).drop("_v")


@indicator("CON_level_intensity", "panel", "conflict_events", "coverage")
def _intensity(tables):
    return _capped(_fought(tables).select(*KEYS, F.col("sum_armed").alias("raw")), "raw")


@indicator("CON_level_surrounding", "panel", "conflict_events", "coverage")
def _surrounding(tables):
    return _around(_fought(tables), "sum_armed")


def _around(df: DataFrame, value: str) -> DataFrame:
    """What happens in the cells around; the panel is read twice, so it is stored before."""
    near = spatial.neighbourhood(cut(df.select(*KEYS, value)), "pgid", TIME, value)
    return _capped(near.select(*KEYS, "near_mean", F.col("near_sum").alias("raw")), "near_mean")


def _persisting(base: DataFrame, years: float, weight: float) -> DataFrame:
    """Decay to a quarter of the value over the given years."""
    line = base.select("pgid", calendar.ordinal(F.col("year"), F.col("quarter")).alias("t"), "score")
    kept = rolling.decay(line, CELL, "t", "score", 0.25, years, weight, out="score")
    year, quarter = calendar.from_ordinal(F.col("t"))
    return kept.select("pgid", year.alias("year"), quarter.alias("quarter"), "score", F.col("score").alias("raw"))


@indicator("CON_level_persistence", "panel", "conflict_events", "coverage")
def _persistence(tables):
    return _persisting(_intensity(tables), 5, 0.5)


def _unrest(tables: Tables) -> DataFrame:
    """Logged unrest events, weighing less the more liberal the country is."""
    free = panel.yearly_to_quarterly(_fought(tables).select(*KEYS, "iso3", "n_unrest"), few(tables["governance"].select("iso3", "year", "libdem")), ["iso3"])
    free = impute.forward_fill(free, CELL, TIME, ["libdem"])
    return free.select(*KEYS, (F.log1p("n_unrest") * (1 - F.col("libdem"))).alias("tension"), F.col("n_unrest").alias("raw"))


@indicator("CON_soctens_intensity", "panel", "conflict_events", "coverage", "governance")
def _tension(tables):
    return scale.capped_by_time(_unrest(tables), "tension", "score", CAP)


@indicator("CON_soctens_surrounding", "panel", "conflict_events", "coverage", "governance")
def _tension_around(tables):
    return _around(_unrest(tables), "tension")


@indicator("CON_soctens_persistence", "panel", "conflict_events", "coverage", "governance")
def _tension_kept(tables):
    return _persisting(_tension(tables), 1, 0.8)


@indicator("CON_context_country", "panel", "conflict_events", "coverage", "population")
def _country(tables):
    """A country's fatalities per head and the share of its cells with any, averaged."""
    nation = ["iso3", *TIME]
    per = _fought(tables).groupBy(*nation).agg(
        F.sum("sum_armed").alias("dead"), (F.sum((F.coalesce("sum_armed", F.lit(0.0)) >= 1).cast("int")) / F.count("*")).alias("extent")
    )
    per = per.join(tables["population"].groupBy("iso3", "year").agg(F.sum("pop_total").alias("people")), ["iso3", "year"], "left")
    per = scale.capped_by_time(per.withColumn("rate", F.log1p(F.try_divide("dead", "people"))), "rate", "burden", CAP)
    per = cut(per.withColumn("raw", scores.row_mean(F.col("burden"), F.col("extent"))))
    return tables["panel"].join(few(scale.scaled(per, "raw", "score", (None, 0.99)).select(*nation, "score", "raw")), nation, "left")


@indicator("CON_context_actors", "panel", "interval_events", "population")
def _actors(tables):
    """Armed actors of a country and the deaths they are part of, relative to its people."""
    nation = ["iso3", *TIME]
    days = events.spread(tables["interval_events"], "date_start", "date_end", ["best"])
    dated = days.withColumn("year", F.year("day")).withColumn("quarter", F.quarter("day"))
    dead = dated.groupBy(*nation).agg(F.sum("best").alias("best"))
    sides = dated.select(*nation, F.explode(F.array("side_a", "side_b")).alias("actor"))
    named = sides.where(~F.lower("actor").contains("civilians") & ~F.col("actor").rlike("^XXX"))
    acting = named.groupBy(*nation, "actor").agg(F.count("*").alias("n")).groupBy(*nation).agg(F.count("*").alias("actors"))
    people = tables["population"].select("iso3", "year", "pop_total")
    per = tables["panel"].select(*nation).distinct().join(dead, nation, "left").join(acting, nation, "left").join(people, ["iso3", "year"], "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("best", "actors")}
    per = per.withColumns(zero).withColumn("raw", F.col("actors").cast("double"))
    per = per.withColumn("value", F.try_divide(F.log1p("actors") * F.log1p("best"), F.log1p("pop_total")))
    return tables["panel"].join(few(scale.capped_by_time(per, "value", "score", CAP).select(*nation, "score", "raw")), nation, "left")


# Vulnerability ---------------------------------------------------------------------------------


def _quarters(tables: Tables, yearly: DataFrame, columns: list[str], head: str = "extrapolate", tail: str = "none") -> DataFrame:
    """Country-year values in the fourth quarters of the panel, lines between them."""
    yearly = cut(yearly.select("iso3", "year", *columns))
    line = yearly.groupBy("iso3").agg(F.min("year").alias("_a"), F.max("year").alias("_b"))
    first = tables["panel"].agg(F.min("year"), F.max("year")).first()
    if first[0] is None:
        return tables["panel"].withColumns({c: F.lit(None).cast("double") for c in columns})
    span = line.select("iso3", F.explode(F.sequence(F.least("_a", F.lit(first[0])) * 4, F.greatest("_b", F.lit(first[1])) * 4 + 3)).alias("_t"))
    filled = span.join(yearly.select("iso3", (F.col("year") * 4 + 3).alias("_t"), *columns), ["iso3", "_t"], "left")
    for c in columns:
        filled = impute.interpolate(filled, ["iso3"], ["_t"], c, head, tail)
    year, quarter = calendar.from_ordinal(F.col("_t"))
    return tables["panel"].join(few(filled.select("iso3", year.alias("year"), quarter.alias("quarter"), *columns)), ["iso3", *TIME], "left")


def _placed(tables: Tables, yearly: DataFrame, head: str = "extrapolate", tail: str = "none") -> DataFrame:
    return _quarters(tables, yearly.select("iso3", "year", "raw"), ["raw"], head, tail)


def _each_year(yearly: DataFrame, columns: list[str], head: str = "extrapolate", tail: str = "none") -> DataFrame:
    """Every country in every year of the table, gaps filled by lines."""
    ends = yearly.agg(F.min("year"), F.max("year")).first()
    if ends[0] is None:
        return yearly
    out = panel.densify(yearly, ["iso3"], *ends)
    for c in columns:
        out = impute.interpolate(out, ["iso3"], ["year"], c, head, tail)
    return out


def _mean(*columns: str):
    return scores.row_mean(*[F.col(c) for c in columns])


@indicator("VUL_socioeconomic_agriculture", "panel", "labour")
def _agriculture(tables):
    """Farm workers among all people of working age, and the farms' part of the product; modelled series where too little is observed."""
    d = tables["labour"]
    for c in ("participation", "farm_share"):
        filled = panel.fallback_if_few(d, "iso3", c, f"{c}_model", 4)
        d = filled.withColumn(c, F.col("chosen")).drop("chosen", f"{c}_model")
    d = panel.clip_fill(d, ["iso3"], ["year"], ["participation", "farm_share", "value_added"])
    d = cut(d.withColumn("raw", scores.row_mean(F.col("participation") / 100 * F.col("farm_share"), F.col("value_added") / 100)))
    return scale.scaled(_placed(tables, d), "raw", "score", (None, 0.99), (0.0, None), bounds_of=d, until=REFERENCE)


@indicator("VUL_socioeconomic_hunger", "panel", "undernourishment")
def _hunger(tables):
    """The share of the undernourished; 2.5 stands for any share below."""
    d = tables["undernourishment"].withColumn("share", scores.censored_number(F.col("value").cast("string")) / 100)
    d = cut(_each_year(d.select("iso3", "year", "share"), ["share"]).withColumn("raw", F.col("share")))
    placed = cut(_placed(tables, d))
    low = placed.agg(F.min("raw")).first()[0]
    out = scale.scaled(placed, "raw", "score", (None, 0.99), (low, None), bounds_of=d, until=REFERENCE)
    return out.withColumn("raw", F.col("raw") * 100)


@indicator("VUL_political_ethnic", "panel", "groups", "exclusion")
def _ethnic(tables):
    """The size of powerless and discriminated groups, and the index of exclusion by social group."""
    out = tables["groups"].where(F.col("status").isin("DISCRIMINATED", "POWERLESS")).groupBy("iso3", "year").agg(F.sum("size").alias("excluded"))
    both = tables["exclusion"].select("iso3", "year", "exclusion_index").join(out, ["iso3", "year"], "full_outer")
    placed = _quarters(tables, panel.clip_fill(both, ["iso3"], ["year"], ["exclusion_index", "excluded"]), ["exclusion_index", "excluded"])
    return placed.withColumn("raw", _mean("excluded", "exclusion_index")).withColumn("score", F.col("raw"))


@indicator("VUL_political_institutions", "panel", "institutions")
def _institutions(tables):
    """Corruption, law and effectiveness between their natural bounds, turned round."""
    columns = ["corruption", "rule_of_law", "effectiveness"]
    q = _quarters(tables, tables["institutions"], columns)
    q = q.withColumns({"corruption": scores.rescale(F.col("corruption"), 0, 100), "effectiveness": scores.rescale(F.col("effectiveness"), -2.5, 2.5)})
    q = panel.clip_fill(q.select(*KEYS, *columns), CELL, TIME, columns, require_all=False)
    return q.withColumn("raw", 1 - _mean(*columns)).withColumn("score", F.col("raw"))


@indicator("VUL_political_system", "panel", "system")
def _system(tables):
    columns = ["freedom", "libdem", "partip", "civlib"]
    yearly = panel.clip_fill(tables["system"], ["iso3"], ["year"], columns, require_all=False)
    return _quarters(tables, yearly, columns).withColumn("raw", 1 - _mean(*columns)).withColumn("score", F.col("raw"))


@indicator("VUL_political_gender", "panel", "gender", "development_gap")
def _gender(tables):
    """Inequality and exclusion by gender of countries, and the regions' development gap, turned round above its lowest values of 2012-2020."""
    q = _quarters(tables, tables["gender"], ["gii", "exclusion"]).join(tables["development_gap"].select(*KEYS, "sgdi"), KEYS, "left")
    q = cut(q.select(*KEYS, "gii", "exclusion", "sgdi"))
    q = cut(panel.clip_fill(q, CELL, TIME, ["gii", "exclusion", "sgdi"], require_all=False))
    q = scale.scaled(q, "sgdi", "balance", (0.01, None), (None, 1.0), since=2012, until=REFERENCE)
    return q.withColumn("raw", scores.row_mean(F.col("gii"), F.col("exclusion"), 1 - F.col("balance"))).withColumn("score", F.col("raw"))


@indicator("VUL_demographic_dependent", "panel", "agegroups")
def _dependent(tables):
    """The young and old for each person of working age; estimates hold at mid-year."""
    ratio = tables["agegroups"].select("iso3", "year", F.try_divide(F.col("pop_youth") + F.col("pop_old"), F.col("pop_working")).alias("raw"))
    # Whole years, so that the second quarter of the last one has its estimate.
    ends = tables["panel"].agg(F.min("year"), F.max("year")).first()
    countries = tables["panel"].select("iso3").distinct()
    whole = panel.entity_quarters(countries, (ends[0] or START, 1), (ends[1] or START, 4)).drop("time")
    moved = panel.mid_year(panel.yearly_to_quarterly(whole, ratio, ["iso3"]))
    filled = impute.interpolate(moved, ["iso3"], TIME, "raw", "extrapolate", "none")
    out = cut(tables["panel"].join(filled, ["iso3", *TIME], "left"))
    return scale.scaled(out, "raw", "score", (0.01, 0.99), until=REFERENCE)


@indicator("VUL_demographic_uprooted", "panel", "displacement")
def _uprooted(tables):
    """Displaced people per hundred inhabitants, logged."""
    displaced = scores.row_sum(*[F.col(c).cast("double") for c in ("refugees", "asylum_seekers", "others_need_of_protection", "idps")])
    d = tables["displacement"].withColumn("share", F.try_divide(displaced, F.col("pop_total")))
    d = cut(d.select("iso3", "year", "share", F.log1p(100 * F.col("share")).alias("logged")))
    out = _quarters(tables, d, ["share", "logged"]).withColumn("raw", F.col("share"))
    return scale.scaled(out, "logged", "score", (None, 0.99), (0.0, None), bounds_of=d, until=REFERENCE)


@indicator("VUL_socioeconomic_deprivation", "panel", "gdp", "lights")
def _deprivation(tables):
    """Country product shared out by light among its people, logged and turned round; a second source where the first has gaps.

    The country's people are the sum over its cells; the raw value is product per head by the yearly estimates.
    """
    gdp = panel.fallback(tables["gdp"], "iso3", "gdp_ppp", "gdp_other", 3).withColumn("gdp", F.col("chosen")).withColumn("per_head", F.try_divide("chosen", "pop_total"))
    gdp = _each_year(gdp.select("iso3", "year", "gdp", "per_head"), ["gdp", "per_head"], "extrapolate", "extrapolate")
    owners = tables["panel"].select("pgid", "iso3").distinct()
    lit = tables["lights"].join(owners, "pgid")
    people = panel.total_or_null(lit, ["iso3", "year"], "pop_count", "people")
    yearly = lit.join(gdp, ["iso3", "year"], "left").join(people, ["iso3", "year"], "left")
    yearly = yearly.withColumn("value", F.log1p(F.try_divide(F.col("gdp") * (F.log10(1 + F.col("ntl")) + 1), F.col("people"))))
    yearly = scale.scaled(cut(yearly.select("pgid", "year", "value", "per_head")), "value", "score", (0.01, 0.99), until=REFERENCE)
    placed = panel.yearly_to_quarterly(tables["panel"], yearly.select("pgid", "year", (1 - F.col("score")).alias("score"), F.col("per_head").alias("raw")), ["pgid"])
    for c in ("score", "raw"):
        placed = impute.interpolate(placed, CELL, TIME, c, "extrapolate", "none")
    return placed


def _regional(table: str):
    """Subnational indices extended by national growth, by area shares, turned round."""

    def build(tables: Tables) -> DataFrame:
        long = impute.extend_by_growth(tables[table], "gdlcode", "year", "subnational", "national")
        bounded = long.withColumn("raw", scores.clip(F.bround("extended", 3), 0.0, 1.0)).withColumn("area", F.col("gdlcode"))
        cells = spatial.bridged_mean(tables["regions"], bounded.select("area", "year", "raw"), "area", ["pgid", "year"], "raw")
        out = impute.interpolate(panel.yearly_to_quarterly(tables["panel"].select(*KEYS), cells, ["pgid"]), CELL, TIME, "raw", "extrapolate", "none")
        return out.withColumn("score", 1 - F.col("raw"))

    return build


indicator("VUL_socioeconomic_education", "panel", "education", "regions")(_regional("education"))
indicator("VUL_socioeconomic_health", "panel", "health", "regions")(_regional("health"))


@indicator("VUL_socioeconomic_inequality", "panel", "light_pixels", "regions", "income_gini")
def _inequality(tables):
    """Gini of light per head within regions, and the country's income Gini."""
    lit = tables["light_pixels"].withColumn("per_head", F.try_divide("ntl", "pop"))
    areas = spatial.gini(lit.where("pop > 0"), ["area", "year"], "per_head")
    cells = spatial.bridged_mean(tables["regions"], areas, "area", ["pgid", "year"], "gini")
    income = _placed(tables, tables["income_gini"].select("iso3", "year", F.col("gini_disp").alias("raw")), "fill", "fill").withColumnRenamed("raw", "income")
    out = income.select(*KEYS, "income").join(cells.withColumn("quarter", F.lit(4)), KEYS, "left")
    out = impute.interpolate(out, CELL, TIME, "gini", "fill", "fill")
    return _scaled(out.withColumn("raw", scores.row_mean(F.col("gini"), F.col("income") / 100)), (0.01, 0.99))


@indicator("VUL_demographic_popgrowth", "panel", "country_pop")
def _popgrowth(tables):
    """Change of the population from the quarter before relative to the present one, losses counting as none."""
    people = _quarters(tables, tables["country_pop"], ["pop_total"])
    out = cut(people.withColumn("raw", rolling.growth_of_current("pop_total", CELL, TIME)))
    bounds = out.where(F.col("year") >= START)
    return scale.scaled(out, "raw", "score", (None, 0.99), (0.0, None), bounds_of=bounds, until=REFERENCE)


def _cell_years(tables: Tables, yearly: DataFrame, head: str, tail: str) -> DataFrame:
    return impute.interpolate(panel.yearly_to_quarterly(tables["panel"], yearly.select("pgid", "year", "raw"), ["pgid"]), CELL, TIME, "raw", head, tail)


@indicator("VUL_environmental_biodiversity", "panel", "intactness")
def _biodiversity(tables):
    """What is lost of the local species; intactness is the raw value."""
    kept = tables["intactness"].withColumn("raw", scores.without_sentinels(F.col("bii"), 0.0))
    lost = cut(_cell_years(tables, kept, "none", "none").withColumn("lost", 1 - F.col("raw")))
    return scale.scaled(lost, "lost", "score", (None, 0.99), bounds_of=lost.where(F.col("year") >= START), until=REFERENCE)


@indicator("VUL_environmental_deforestation", "panel", "forest_pixels")
def _deforestation(tables):
    """Tree cover lost since 2000. Loss years are counted from 2000, as the data set does; years run from before the start to the last one with a loss."""
    pixels = tables["forest_pixels"].withColumn("lossyear", F.when(F.col("lossyear") > 0, F.col("lossyear") + 2000).otherwise(0))
    last = pixels.agg(F.max("lossyear")).first()[0] or 0
    lost = raster.loss_share(pixels, F.col("pgid"), (START - 1, max(last, START)))
    placed = cut(_cell_years(tables, lost.select(F.col("zone").alias("pgid"), "year", F.col("loss").alias("raw")), "extrapolate", "none"))
    return scale.scaled(placed, "raw", "score", (None, 0.99), bounds_of=placed.where(F.col("year") >= START), until=REFERENCE)


@indicator("VUL_environmental_irrigation", "panel", "cropland_pixels")
def _irrigation(tables):
    """Rain-fed fields as a share of land, missing where hardly any land is cropped; known for the quarters of 2015."""
    n = raster.categories(tables["cropland_pixels"], F.col("pgid"), "value", {"water": 0, "other": 1, "irrigated": 2, "rainfed": 3})
    land = F.col("other") + F.col("irrigated") + F.col("rainfed")
    share = F.try_divide(F.col("irrigated") + F.col("rainfed"), land)
    known = n.select(F.col("zone").alias("pgid"), F.when(share > 0.01, F.try_divide("rainfed", land)).alias("raw"))
    return tables["panel"].join(known.withColumn("year", F.lit(2015)), ["pgid", "year"], "left").withColumn("score", F.col("raw"))


#: Fixed value: the cap of soil erosion, its 99th percentile over the world.
EROSION_CAP = 50.0


@indicator("VUL_environmental_soil", "panel", "soil_pixels")
def _soil(tables):
    """Mean of soil erosion and carbon debt per cell, each as a share of its cap; constant over time.

    Erosion is capped at a fixed value, carbon debt at its exact 99th percentile over all pixels. The two layers may have
    different pixels: a row then holds one of them.
    """
    p = tables["soil_pixels"].withColumns({c: scores.without_sentinels(F.col(c), -9999.0) for c in ("erosion", "carbon")})
    caps = {"erosion": F.lit(EROSION_CAP), "carbon": F.lit(scale.quantile(p, F.col("carbon"), 0.99)).cast("double")}
    shares = [F.try_divide(F.avg(scores.clip(F.col(c), high=cap)), cap).alias(c) for c, cap in caps.items()]
    means = p.groupBy("pgid").agg(*shares).select("pgid", _mean("erosion", "carbon").alias("raw"))
    return scale.scaled(cut(tables["panel"].join(means, "pgid", "left")), "raw", "score", (None, 0.99))


@indicator("VUL_environmental_water", "panel", "basin_stress", "basins")
def _water(tables):
    """Water stress of a cell's basins in 2019 and 2030, capped at 1."""
    wide = tables["basin_stress"].withColumns({f"y{y}": scores.clip(scores.without_sentinels(F.col(f"bws_raw_{y}"), -9999.0), high=1.0) for y in (2019, 2030)})
    long = panel.unpivot_years(wide.select(F.col("pfaf_id").alias("area"), "y2019", "y2030"), ["area"], "y", "raw")
    cells = spatial.bridged_mean(tables["basins"], long, "area", ["pgid", "year"], "raw")
    ends = tables["panel"].agg(F.max("year")).first()[0]
    beyond = panel.entity_years(tables["panel"].select("pgid").distinct(), (ends or START) + 1, max(2030, (ends or START) + 1)).withColumn("quarter", F.lit(4))
    line = tables["panel"].select(*KEYS).unionByName(beyond.select(*KEYS))
    filled = impute.interpolate(line.join(cells.withColumn("quarter", F.lit(4)), KEYS, "left").withColumn("_t", calendar.ordinal(F.col("year"), F.col("quarter"))), CELL, ["_t"], "raw", "fill", "none")
    return tables["panel"].join(filled.select(*KEYS, "raw"), KEYS, "left").withColumn("score", F.col("raw"))


# The index -------------------------------------------------------------------------------------


def _equal(prefix: str) -> dict[str, float]:
    return {n: 1.0 for n in INDICATORS if n.startswith(prefix)}


#: Weights and means of dimensions, pillars and risks. Exposure comes between dimensions and pillars.
DIMENSIONS = {
    "CON_level": {"weights": {"CON_level_intensity": 2, "CON_level_surrounding": 1, "CON_level_persistence": 1}, "method": "pmean"},
    "CON_soctens": {"weights": {"CON_soctens_intensity": 2, "CON_soctens_surrounding": 1, "CON_soctens_persistence": 1}, "method": "pmean"},
    "CON_context": {"weights": _equal("CON_context_"), "method": "mean"},
    "VUL_socioeconomic": {"weights": _equal("VUL_socioeconomic_"), "method": "mean"},
    "VUL_political": {"weights": _equal("VUL_political_"), "method": "mean"},
    "VUL_demographic": {"weights": _equal("VUL_demographic_"), "method": "mean"},
    "VUL_environmental": {"weights": _equal("VUL_environmental_"), "method": "mean"},
    "CLI_current": {"weights": _equal("CLI_current_"), "method": "pmean"},
    "CLI_accumulated": {"weights": {n: 1.0 if n.endswith("floods") else 2.0 for n in _equal("CLI_accumulated_")}, "method": "pmean"},
    "CLI_longterm": {"weights": _equal("CLI_longterm_"), "method": "pmean"},
}
EXPOSED = ("CON_context", "CLI_current", "CLI_accumulated", "CLI_longterm")
PILLARS = {
    "CON": {"weights": {"CON_level": 2, "CON_soctens": 1, "CON_context": 1}, "level": "pillar"},
    "VUL": {"weights": {"VUL_socioeconomic": 1, "VUL_political": 1, "VUL_demographic": 1, "VUL_environmental": 1}, "level": "pillar"},
    "CLI": {"weights": {"CLI_current": 1, "CLI_accumulated": 1, "CLI_longterm": 1}, "level": "pillar"},
}
RISKS = {
    "CLI_risk": {"weights": {"CLI": 1, "VUL": 1}, "method": "gmean", "level": "risk"},
    "CON_risk": {"weights": {"CON": 1, "VUL": 1}, "method": "gmean", "level": "risk"},
    "index": {"weights": {"CLI_risk": 1, "CON_risk": 1}, "method": "pmean", "level": "risk"},
}


def gather(base: DataFrame, panels: list[DataFrame]) -> DataFrame:
    """All indicator panels beside the base panel; each is keyed alike, so they share one partitioning."""
    out = base.select(*KEYS)
    for p in panels:
        out = out.join(p, KEYS, "left")
    return out


def evaluate_index(df: DataFrame, exposure: str | None = None) -> DataFrame:
    """Dimensions, pillars and risks from a panel of indicators.

    Gaps are filled forward. With ``exposure``, the indicators of the dimensions
    in ``EXPOSED`` are weighed by it, logged and scaled anew before they are
    combined; they come back as columns ending in ``_exposure``.
    """
    index = Index.from_dict({**DIMENSIONS, **PILLARS, **RISKS})
    df = impute.forward_fill(df, CELL, TIME, sorted(index.needs()))
    if not exposure:
        return evaluate(df, index)
    weighed = {p: f"{p}_exposure" for d in EXPOSED for p in DIMENSIONS[d]["weights"]}
    df = scale.exposed_all(cut(df), weighed, exposure)
    return evaluate(df, index.with_parts(weighed))


def validated(df: DataFrame, name: str, raw: bool = True) -> DataFrame:
    """An indicator's panel, checked while it is read: key columns filled, scores between 0 and 1."""
    wrong = (F.col(name) < -1e-9) | (F.col(name) > 1 + 1e-9)
    stop = F.raise_error(F.lit(f"{name} leaves the range from 0 to 1")).cast("double")
    checked = panel.validate(df, KEYS, START)
    columns = [*KEYS, name, *([f"{name}_raw"] if raw and f"{name}_raw" in df.columns else [])]
    return checked.withColumn(name, F.when(wrong, stop).otherwise(F.col(name))).select(*columns)


def run_release(store: Store, tables: Tables, at: tuple[int, int], names: list[str] | None = None, exposure: DataFrame | None = None) -> str:
    """The whole index from tables to a saved release of the quarter ``at``; returns its name.

    Every indicator is computed, checked and saved, unless a saved one already has values up to that quarter. The saved
    panels are joined to the base panel, filled forward, weighed by ``exposure`` (pgid, year, quarter, exposure) and
    combined; scores, raw values and how recent each column is become the release.
    """
    names = sorted(INDICATORS) if names is None else names
    for name in names:
        if not store.current(name, name, *at):
            store.save(validated(INDICATORS[name].run(tables), name), "output", name)
    base = tables["panel"].where((F.col("year") >= START) & (calendar.ordinal(F.col("year"), F.col("quarter")) <= at[0] * 4 + at[1] - 1))
    df = gather(base, [store.load("output", name) for name in names])
    if exposure is not None:
        df = df.join(exposure.select(*KEYS, "exposure"), KEYS, "left")
    for name in set(INDICATORS) - set(names):
        df = df.withColumn(name, F.lit(None).cast("double"))
    out = evaluate_index(df, "exposure" if exposure is not None else None)
    made = [*DIMENSIONS, *PILLARS, *RISKS]
    weighed = [c for c in out.columns if c.endswith("_exposure")]
    return store.release(out.select(*KEYS, *names, *[f"{n}_raw" for n in names], *weighed, *made).orderBy(*KEYS), *at)
