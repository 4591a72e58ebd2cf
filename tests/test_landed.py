from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from riskweave.operators.panel import entity_quarters
from riskweave.plans import indicators
from riskweave.sources import landed
from riskweave.sources.datasets import DATASETS, ILO_SERIES, RECIPE_TABLES, WB_SERIES, Context, recipe_tables
from riskweave.sources.store import Store

YEARS = range(2008, 2022)


def read(spark, key, path, **options):
    return landed.load(spark, key, str(path), **options)


def test_header_below_other_lines_and_years_as_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Source","W"\n\n"Last Updated","x"\n\n"Country Name","Country Code","Indicator Name","Indicator Code","2019","2020",\n"A, b","AAA","n","S1","","2.5",\n"C","CCC","n","S2","1","2",\n')
    rows = {tuple(r) for r in read(spark, "worldbank", tmp_path / "a.csv").collect()}
    assert rows == {("AAA", "S1", 2019, None), ("AAA", "S1", 2020, 2.5), ("CCC", "S2", 2019, 1.0), ("CCC", "S2", 2020, 2.0)}
    some = read(spark, "worldbank", tmp_path, first_year=2020, only_series="S2|S9")
    assert [tuple(r) for r in some.collect()] == [("CCC", "S2", 2020, 2.0)]


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 20])
def test_ranges_give_every_line_once(spark, tmp_path, size):
    lines = "".join(f'S{i % 3},"Name, {i}",{2000 + i % 20},{"<2.5" if i % 2 else i}\r\n' for i in range(60))
    (tmp_path / "sdg.csv").write_bytes(b"\xef\xbb\xbfSeriesCode,GeoAreaName,TimePeriod,Value\r\n" + lines.encode().rstrip(b"\r\n"))
    (tmp_path / "_SUCCESS").write_text("no data")
    (tmp_path / "empty.csv").write_text("")
    got = read(spark, "sdg", tmp_path, range_bytes=max(size, 50)).collect() if size < 50 else read(spark, "sdg", tmp_path, range_bytes=size).collect()
    assert sorted(r.country for r in got) == sorted(f"Name, {i}" for i in range(60))
    assert {r.sex for r in got} == {None} and sum(r.value == "<2.5" for r in got) == 30


def test_lines_between_ranges():
    import os
    import tempfile

    text = b"head\n" + b"".join(b"%d\n" % (10**i) for i in range(9)) + b"last"
    with tempfile.TemporaryDirectory() as d:
        path = os.path.join(d, "f")
        with open(path, "wb") as f:
            f.write(text)
        for size in range(1, len(text) + 2):
            parts = landed.parts_of(path, size)
            found = b"".join(landed._lines_between(landed.pafs.LocalFileSystem(), p.path, 5, p.start, p.stop) for p in parts)
            assert found == text[5:]


def test_encodings_compression_and_faults(spark, tmp_path):
    (tmp_path / "hdi.csv").write_bytes("iso3,country,gii_2020,gii_rank_2020,le_2020\nCIV,Côte “d”,0.5,9,70\nZZ.R,x,1,1,1\n".encode("windows-1252"))
    assert [tuple(r) for r in read(spark, "hdi", tmp_path / "hdi.csv").where("iso3 = 'CIV'").collect()] == [("CIV", 2020, 0.5, None, None, 70.0)]
    with gzip.open(tmp_path / "ilo.csv.gz", "wt") as f:
        f.write('ref_area,note,indicator,sex,classif1,time,obs_value\nAAA,"two\nlines",I,SEX_T,A,2010,1.5\n')
    assert [tuple(r) for r in read(spark, "ilo", tmp_path / "ilo.csv.gz").collect()] == [("AAA", "I", "SEX_T", "A", 2010, 1.5)]
    (tmp_path / "imf.csv").write_text("COUNTRY,TIME_PERIOD\nA,2000\n")
    with pytest.raises(Exception, match="no column .*OBS_VALUE"):
        read(spark, "imf", tmp_path / "imf.csv").collect()
    with pytest.raises(Exception, match="nowhere"):
        read(spark, "imf", tmp_path / "nowhere").collect()


def test_two_filters_on_one_frame(spark, tmp_path):
    (tmp_path / "s.csv").write_text("country,year,gini_disp\nA,2000,1\nB,2001,2\n")
    df = read(spark, "swiid", tmp_path / "s.csv")
    assert sorted(r.year for r in df.where("year = 2000").unionByName(df.where("country = 'B'")).collect()) == [2000, 2001]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Small files in the layout of every data set: two countries, A-land and B-land."""
    root = tmp_path_factory.mktemp("landed")
    names = {"AAA": "A-land", "BBB": "B-land"}
    v = lambda iso, y, k=0: round(0.2 + 0.6 * ((ord(iso[0]) * 7 + y * 3 + k * 5) % 11) / 11, 4)
    each = [(iso, name, y) for iso, name in names.items() for y in YEARS]

    def put(key, text, name="data.csv"):
        (root / key).mkdir(exist_ok=True)
        (root / key / name).write_text(text)

    wide = lambda f: ",".join(f(y) for y in YEARS)
    put("hdi", "iso3," + ",".join(wide(lambda y, m=m: f"{m}_{y}") for m in ("gii", "eys", "mys", "le")) + "\n" + "".join(f"{iso}," + ",".join(wide(lambda y, k=k: str(v(iso, y) * k)) for k in (1, 15, 10, 90)) + "\n" for iso in names))
    put("cpi", "Index\nof\nyears\nCountry / Territory,ISO3," + wide(lambda y: f"CPI score {y}") + "\n" + "".join(f"{name},{iso}," + wide(lambda y: str(v(iso, y) * 100)) + "\n" for iso, name in names.items()))
    series = {"NV.AGR.TOTL.ZS": 40, "NY.GDP.MKTP.PP.CD": 1e9, "GOV_WGI_RL.EST": 2}
    put("worldbank", "a\nb\nc\nd\nCountry Name,Country Code,Indicator Name,Indicator Code," + wide(str) + "\n" + "".join(f"{n},{iso},x,{s}," + wide(lambda y: str(v(iso, y) * k)) + "\n" for iso, n in {**names, "WLD": "World"}.items() for s, k in series.items()))
    put("vdem", "country_name,country_text_id,year,v2x_civlib,v2x_polyarchy,v2x_libdem,v2x_rule,v2xpe_exlsocgr,v2xpe_exlgender\n" + "".join(f"{n},{iso},{y}," + ",".join(str(v(iso, y, k)) for k in range(6)) + "\n" for iso, n, y in each))
    put("freedomhouse", "title\nCountry/Territory,Edition,Status,PR,CL,Total\n" + "".join(f"{n},{y + 1},F,{int(v(iso, y) * 40)},{int(v(iso, y, 1) * 60)},{int(v(iso, y, 2) * 100)}\n" for iso, n, y in each) + "Tibet,2015,NF,1,1,2\n")
    put("epr", "statename,from,to,group,size,status\nA-land,2000,2030,g,0.2,POWERLESS\nA-land,2010,2015,h,0.1,DISCRIMINATED\nB-land,2000,2030,k,0.5,DOMINANT\nB-land,1990,2000,old,0.5,POWERLESS\n")
    put("swiid", "country,year,gini_disp,gini_mkt\n" + "".join(f"{n},{y},{v(iso, y) * 60},1\n" for iso, n, y in each))
    put("unhcr", "Year,Country of asylum (ISO),Refugees under UNHCR's mandate,Asylum-seekers,Other people in need of international protection,IDPs of concern to UNHCR\n" + "".join(f"{y},{iso},{int(v(iso, y) * 1000)},-,-,{y}\n" for iso, n, y in each))
    put("imf", "COUNTRY,TIME_PERIOD,OBS_VALUE\n" + "".join(f"{n},{y},{v(iso, y) * 1e9}\n" for iso, n, y in each))
    put("ilo", "ref_area,indicator,sex,classif1,time,obs_value\n" + "".join(
        f"{iso},{ILO_SERIES[s]},SEX_T,{c},{y},{v(iso, y, k) * m}\n" for iso, n, y in each for k, (s, c, m) in enumerate([
            ("farm_share", "ECO_SECTOR_TOTAL", 1000), ("farm_share", "ECO_SECTOR_AGR", 200), ("farm_share_model", "ECO_SECTOR_TOTAL", 1000), ("farm_share_model", "ECO_SECTOR_AGR", 100),
            ("participation", "AGE_YTHADULT_YGE15", 90), ("participation_model", "AGE_YTHADULT_YGE15", 80)])))
    put("sdg", "SeriesCode,GeoAreaName,TimePeriod,Value,[Sex]\n" + "".join(f"SN_ITK_DEFC,{n},{y},{'<2.5' if y % 4 == 0 else v(iso, y) * 30},BOTHSEX\nSN_ITK_DEFC,{n},{y},77,MALE\n" for iso, n, y in each))
    head = "\n" * 16 + 'Type,"Region, subregion, country or area *",ISO3 Alpha-code,Year,'
    put("wpp", head + '"Total Population, as of 1 January (thousands)",Population Growth Rate (percentage)\n' + "".join(f"Country/Area,{n},{iso},{y},{1000 + y},1.0\n" for iso, n, y in each) + "World,World,,2010,9e6,1\n", "total.csv")
    put("wpp", head + "0-14,15-64,65+\n" + "".join(f"Country/Area,{n},{iso},{y},{v(iso, y) * 100},{v(iso, y, 1) * 100},{'...' if (iso, y) == ('BBB', 2016) else 20}\n" for iso, n, y in each), "ages.csv")
    put("shdi", "GDLCODE,level,year,edindex,healthindex,sgdi\n" + "".join(f"{iso}r1,Subnat,{y},{v(iso, y)},{v(iso, y, 1)}, \n{iso}t,National,{y},0,0,0\n" for iso, n, y in each if y < 2018))
    put("aqueduct", "pfaf_id,bws_raw,x\n1,0.5,a\n1,-9999,b\n2,0.25,c\n")
    return root


@pytest.fixture(scope="module")
def context(spark):
    return Context(2015, spark.createDataFrame([("A-land", "AAA"), ("B-Land ", "BBB")], "alias string, iso3 string"))


def test_tables_of_recipes(spark, files, context):
    assert set(DATASETS) == set(landed.SOURCES)
    t = recipe_tables(spark, {k: str(files / k) for k in DATASETS}, context)
    assert set(t) == set(RECIPE_TABLES)
    get = lambda name, where: t[name].where(where).first()
    v = lambda iso, y, k=0: round(0.2 + 0.6 * ((ord(iso[0]) * 7 + y * 3 + k * 5) % 11) / 11, 4)
    at = "iso3 = 'BBB' and year = 2016"
    assert get("country_pop", at).pop_total == (1000 + 2017) * 1000  # the first of January of 2017
    assert get("agegroups", at).pop_old is None and get("agegroups", at).pop_youth == pytest.approx(v("BBB", 2016) * 1e5)
    assert get("undernourishment", at)["value"] == "<2.5" and t["undernourishment"].where("value = '77'").isEmpty()
    assert get("system", at).freedom == int(v("BBB", 2016) * 40) / 40
    assert get("labour", at).farm_share == pytest.approx(v("BBB", 2016, 1) * 200 / (v("BBB", 2016) * 1000))
    assert get("institutions", at).corruption == pytest.approx(v("BBB", 2016) * 100)
    assert get("displacement", at).idps == 2016 and get("displacement", at).asylum_seekers is None
    assert get("gdp", at).gdp_other == pytest.approx(v("BBB", 2016) * 1e9)
    assert {(r.year, r.size) for r in t["groups"].where("iso3 = 'AAA' and status = 'DISCRIMINATED'").collect()} == {(y, 0.1) for y in range(2010, 2016)}
    assert t["groups"].where("iso3 = 'BBB' and status = 'POWERLESS'").isEmpty()  # ended before the start
    education = {r.year: r for r in t["education"].where("gdlcode = 'AAAr1'").collect()}
    assert education[2016].subnational == v("AAA", 2016) and education[2020].subnational is None and education[2020].national is not None
    assert t["institutions"].where("iso3 = 'WLD'").isEmpty()
    assert t["labour"].agg(F.min("year")).first()[0] == 2010
    basins = DATASETS["aqueduct"].tidy(spark, str(files / "aqueduct"), context)
    assert {tuple(r) for r in basins.collect()} == {(1, 0.5), (2, 0.25)}


def test_from_landed_files_to_a_release(spark, files, context, tmp_path):
    cells = spark.createDataFrame([(100000 + i, "AAA" if i < 3 else "BBB") for i in range(6)], "pgid int, iso3 string")
    tables = {"panel": entity_quarters(cells, (2010, 1), (2021, 4)), **recipe_tables(spark, {k: str(files / k) for k in DATASETS}, context)}
    tables["regions"] = cells.select("pgid", F.concat("iso3", F.lit("r1")).alias("area"), F.lit(1.0).alias("share"))
    names = [n for n, i in indicators.INDICATORS.items() if n.startswith("VUL_") and set(i.inputs) <= set(tables)]
    assert len(names) == 10
    store = Store(spark, str(tmp_path))
    out = store.load("output", f"scores_{indicators.run_release(store, tables, (2020, 4), names)}", "2020_Q4")
    known = out.where("year = 2016 and quarter = 4").agg(*[F.count(n).alias(n) for n in names], F.count("VUL_political").alias("VUL_political")).first().asDict()
    assert known == dict.fromkeys([*names, "VUL_political"], 6)
