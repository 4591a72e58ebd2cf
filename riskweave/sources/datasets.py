"""Data sets: what their landed files become, and the tables that recipes read.

A data set loads its landed files through its own data source and prepares one
tidy table; years and codes that no recipe can use are left out as early as the
source can leave them out. ``recipe_tables`` puts the prepared tables together
as the recipes want them, so an index runs from folders of landed files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import scores
from riskweave.operators import panel, prepare
from riskweave.sources import files, landed


@dataclass(frozen=True)
class Context:
    """The first year of the index and the names of countries, as (alias, iso3)."""

    start: int
    aliases: DataFrame


@dataclass(frozen=True)
class Dataset:
    key: str
    prepare: Callable[[DataFrame, Context], DataFrame]
    years_before: int = 0

    def load(self, spark: SparkSession, path: str, start: int | None = None) -> DataFrame:
        """The rows of the landed files, from ``start`` and the years before it that the data set needs."""
        return landed.load(spark, self.key, path, **({} if start is None else {"first_year": start - self.years_before}))

    def tidy(self, spark: SparkSession, path: str, context: Context) -> DataFrame:
        return self.prepare(self.load(spark, path, context.start), context)


DATASETS: dict[str, Dataset] = {}


def dataset(key: str, years_before: int = 0):
    def register(f: Callable[[DataFrame, Context], DataFrame]) -> Callable[[DataFrame, Context], DataFrame]:
        DATASETS[key] = Dataset(key, f, years_before)
        return f

    return register


def _named(df: DataFrame, name: str, context: Context) -> DataFrame:
    """Rows of known countries with their code."""
    return files.country_codes(df, name, context.aliases).where("iso3 is not null")


@dataset("hdi")
def _hdi(df: DataFrame, context: Context) -> DataFrame:
    """Human development by country and year, without regions, and its two indices."""
    school = (scores.clip(F.col("eys"), high=18.0) / 18 + scores.clip(F.col("mys"), high=15.0) / 15) / 2
    return df.where(~F.col("iso3").contains(".")).withColumns({"le_index": (scores.clip(F.col("le"), 20.0, 85.0) - 20) / 65, "edu_index": school})


@dataset("cpi")
def _cpi(df: DataFrame, context: Context) -> DataFrame:
    return df.where("cpi_score is not null").select(files.renamed_keys("iso3", {"KSV": "XKX"}).alias("iso3"), "year", "cpi_score")


@dataset("worldbank", years_before=5)
def _worldbank(df: DataFrame, context: Context) -> DataFrame:
    """Series of countries; aggregates have no known code."""
    return df.join(context.aliases.select("iso3").distinct(), "iso3", "left_semi").where("value is not null")


@dataset("vdem")
def _vdem(df: DataFrame, context: Context) -> DataFrame:
    """One of two areas with the same code goes; what is not coded on its own has its neighbour's values."""
    return panel.also_as(df.where(F.col("country") != "Palestine/Gaza").drop("country"), "iso3", {"MAR": "ESH"})


#: Areas without cells of their own.
NOT_MAPPED = [
    "Pakistani Kashmir", "Indian Kashmir", "Somaliland", "Northern Cyprus", "Gaza Strip", "Puerto Rico", "Abkhazia", "Crimea", "Eastern Donbas", "Nagorno-Karabakh",
    "South Ossetia", "Tibet", "Transnistria", "Russian-Occupied Territories of Ukraine",
]
#: The most points of each rating.
MOST_POINTS = {"political_rights": 40, "civil_liberties": 60, "fh_score": 100}


@dataset("freedomhouse")
def _freedom(df: DataFrame, context: Context) -> DataFrame:
    """Ratings as shares of the most points; an edition rates the year before it."""
    rated = df.where(~F.col("country").isin(NOT_MAPPED)).withColumn("year", F.col("edition") - 1).drop("edition")
    return prepare.share_of_most(_named(rated, "country", context).drop("country"), MOST_POINTS)


@dataset("epr")
def _epr(df: DataFrame, context: Context) -> DataFrame:
    """Groups in each year of their periods, those that ended before the start left out."""
    return panel.years_of(_named(df.where(F.col("stop") >= context.start), "statename", context).drop("statename"), "start", "stop")


@dataset("swiid")
def _swiid(df: DataFrame, context: Context) -> DataFrame:
    return _named(df, "country", context).select("iso3", "year", (F.col("gini_disp") / 100).alias("gini_disp"))


@dataset("unhcr")
def _unhcr(df: DataFrame, context: Context) -> DataFrame:
    kinds = [F.col(c) for c in ("refugees", "asylum_seekers", "others_need_of_protection", "idps")]
    return df.withColumn("forcibly_displaced", scores.row_sum(*kinds))


@dataset("imf")
def _imf(df: DataFrame, context: Context) -> DataFrame:
    return _named(df, "country", context).where("gdp_ppp is not null").select("iso3", "year", "gdp_ppp")


@dataset("ilo", years_before=5)
def _ilo(df: DataFrame, context: Context) -> DataFrame:
    """(iso3, year, indicator, value): participation in percent, and the share of farm workers; regions have codes that start with X."""
    both = df.where((F.col("sex") == "SEX_T") & ~F.col("iso3").startswith("X")).dropDuplicates()
    code = files.renamed_keys("iso3", {"KOS": "XKX"})
    of_age = both.where(F.col("classif") == "AGE_YTHADULT_YGE15").select(code.alias("iso3"), "year", "indicator", "value")
    sector = lambda c: F.max(F.when(F.col("classif") == c, F.col("value")))
    sectors = both.where(F.col("classif").isin("ECO_SECTOR_TOTAL", "ECO_SECTOR_AGR")).groupBy(code.alias("iso3"), "year", "indicator")
    return of_age.unionByName(sectors.agg(F.try_divide(sector("ECO_SECTOR_AGR"), sector("ECO_SECTOR_TOTAL")).alias("value")))


@dataset("sdg", years_before=15)
def _sdg(df: DataFrame, context: Context) -> DataFrame:
    """Series of both sexes, on every year of every country."""
    found = _named(df.where("(sex is null or sex = 'BOTHSEX') and country <> 'Southern Africa'"), "country", context)
    return found.select("iso3", "year", "series", "value")


@dataset("wpp", years_before=15)
def _wpp(df: DataFrame, context: Context) -> DataFrame:
    """People, not thousands; a 1 January's population is that of the year before."""
    countries = df.where(F.col("type") == "Country/Area").drop("type", "country")
    counts = [(F.max(c) * 1000).alias(c) for c in ("pop_total", "pop_youth", "pop_working", "pop_old")]
    people = countries.groupBy("iso3", "year").agg(*counts, F.max("pop_change").alias("pop_change"))  # totals and ages land in files of their own
    return prepare.next_year(people, "iso3", "pop_total")


@dataset("shdi", years_before=5)
def _shdi(df: DataFrame, context: Context) -> DataFrame:
    return df.where(F.col("level") == "Subnat").drop("level")


@dataset("aqueduct")
def _aqueduct(df: DataFrame, context: Context) -> DataFrame:
    """One value a basin; the parts of a basin must agree."""
    return panel.one_value(df, ["pfaf_id"], "bws_raw")


#: Series of the labour office and the bank, by the columns that recipes read.
ILO_SERIES = {
    "farm_share": "EMP_TEMP_SEX_ECO_NB_A", "farm_share_model": "EMP_2EMP_SEX_ECO_NB_A", "participation": "EAP_DWAP_SEX_AGE_RT_A", "participation_model": "EAP_2WAP_SEX_AGE_RT_A",
}
WB_SERIES = {"value_added": "NV.AGR.TOTL.ZS", "gdp_ppp": "NY.GDP.MKTP.PP.CD", "effectiveness": "GOV_WGI_RL.EST"}
UNDERNOURISHED = "SN_ITK_DEFC"


def _columns_of(df: DataFrame, by: str, names: Mapping[str, str], kind: str = "double") -> DataFrame:
    """Series as columns, one aggregate for all."""
    values = [F.max(F.when(F.col(by) == code, F.col("value"))).cast(kind).alias(name) for name, code in names.items()]
    return df.where(F.col(by).isin(*names.values())).groupBy("iso3", "year").agg(*values)


def _beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.join(other, ["iso3", "year"], "full_outer")
    return first


def _labour(t: Mapping[str, DataFrame]) -> DataFrame:
    return _beside(_columns_of(t["ilo"], "indicator", ILO_SERIES), _columns_of(t["worldbank"], "series", {"value_added": WB_SERIES["value_added"]}))


def _undernourishment(t: Mapping[str, DataFrame]) -> DataFrame:
    return _columns_of(t["sdg"], "series", {"value": UNDERNOURISHED}, "string")


def _institutions(t: Mapping[str, DataFrame]) -> DataFrame:
    cpi = t["cpi"].select("iso3", "year", F.col("cpi_score").alias("corruption"))
    rule = t["vdem"].select("iso3", "year", F.col("v2x_rule").alias("rule_of_law"))
    return _beside(cpi, rule, _columns_of(t["worldbank"], "series", {"effectiveness": WB_SERIES["effectiveness"]}))


def _system(t: Mapping[str, DataFrame]) -> DataFrame:
    """Four ratings from 0 to 1, as the recipe means them: rights and liberties of one source, democracy and liberties of the other."""
    free = t["freedomhouse"].select("iso3", "year", F.col("political_rights_percent").alias("freedom"), F.col("civil_liberties_percent").alias("partip"))
    return _beside(free, t["vdem"].select("iso3", "year", F.col("v2x_polyarchy").alias("libdem"), F.col("v2x_civlib").alias("civlib")))


def _gender(t: Mapping[str, DataFrame]) -> DataFrame:
    return _beside(t["hdi"].select("iso3", "year", "gii"), t["vdem"].select("iso3", "year", F.col("v2xpe_exlgender").alias("exclusion")))


def _displacement(t: Mapping[str, DataFrame]) -> DataFrame:
    kinds = ["refugees", "asylum_seekers", "others_need_of_protection", "idps"]
    return t["wpp"].where("pop_total is not null").select("iso3", "year", "pop_total").join(t["unhcr"].select("iso3", "year", *kinds), ["iso3", "year"], "left")


def _gdp(t: Mapping[str, DataFrame]) -> DataFrame:
    bank = _columns_of(t["worldbank"], "series", {"gdp_ppp": WB_SERIES["gdp_ppp"]})
    other = t["imf"].select("iso3", "year", F.col("gdp_ppp").alias("gdp_other"))
    return _beside(bank, other).join(t["wpp"].select("iso3", "year", "pop_total"), ["iso3", "year"], "left")


def _regional(region: str, nation: str) -> Callable[[Mapping[str, DataFrame]], DataFrame]:
    """A region's index beside its country's, whose code begins the region's."""

    def build(t: Mapping[str, DataFrame]) -> DataFrame:
        own = t["shdi"].select("gdlcode", "year", F.substring("gdlcode", 1, 3).alias("iso3"), F.col(region).alias("subnational"))
        codes = own.select("gdlcode", "iso3").distinct()
        national = t["hdi"].where(F.col(nation).isNotNull()).select("iso3", "year", F.col(nation).alias("national"))
        return own.drop("iso3").join(codes.join(national, "iso3").drop("iso3"), ["gdlcode", "year"], "full_outer")

    return build


#: The data sets that each table of the recipes comes from, and how.
RECIPE_TABLES: dict[str, tuple[tuple[str, ...], Callable[[Mapping[str, DataFrame]], DataFrame]]] = {
    "labour": (("ilo", "worldbank"), _labour),
    "undernourishment": (("sdg",), _undernourishment),
    "groups": (("epr",), lambda t: t["epr"].select("iso3", "year", "status", "size")),
    "exclusion": (("vdem",), lambda t: t["vdem"].select("iso3", "year", F.col("v2xpe_exlsocgr").alias("exclusion_index"))),
    "governance": (("vdem",), lambda t: t["vdem"].select("iso3", "year", F.col("v2x_libdem").alias("libdem"))),
    "institutions": (("cpi", "vdem", "worldbank"), _institutions),
    "system": (("freedomhouse", "vdem"), _system),
    "gender": (("hdi", "vdem"), _gender),
    "agegroups": (("wpp",), lambda t: t["wpp"].select("iso3", "year", "pop_youth", "pop_working", "pop_old")),
    "country_pop": (("wpp",), lambda t: t["wpp"].where("pop_total is not null").select("iso3", "year", "pop_total")),
    "displacement": (("unhcr", "wpp"), _displacement),
    "gdp": (("worldbank", "imf", "wpp"), _gdp),
    "income_gini": (("swiid",), lambda t: t["swiid"].select("iso3", "year", (F.col("gini_disp") * 100).alias("gini_disp"))),
    "education": (("shdi", "hdi"), _regional("edindex", "edu_index")),
    "health": (("shdi", "hdi"), _regional("healthindex", "le_index")),
}


def recipe_tables(spark: SparkSession, paths: Mapping[str, str], context: Context) -> dict[str, DataFrame]:
    """Every table of the recipes whose data sets have landed at ``paths`` (by data set)."""
    unknown = set(paths) - set(DATASETS)
    if unknown:
        raise KeyError(f"no data sets {sorted(unknown)}")
    tidy = {key: DATASETS[key].tidy(spark, path, context) for key, path in paths.items()}
    return {name: build(tidy) for name, (needs, build) in RECIPE_TABLES.items() if set(needs) <= set(tidy)}
