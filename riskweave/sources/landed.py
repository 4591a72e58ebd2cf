"""Landed files of published data sets, as data sources for ``spark.read.format``.

Each layout says what a provider's text file looks like: lines before the header,
its encoding and signs for missing values, which columns are wanted under which
names, and whether years stand beside each other in column names. A source reads
one file or a folder of them, plain files in ranges of bytes and compressed ones
whole, decodes with Arrow, and returns tidy rows of a fixed schema.

The options ``first_year`` and ``last_year`` bound the years, ``only_<column>``
lists wanted values of a text column, parted by |: columns of other years are
never decoded, rows of other values never leave the source. These are options
and no pushed filters, as Spark 4.1 keeps what is pushed with the loaded frame:
two scans of one frame with different filters would both get those of the last.

Files are opened through Arrow's file systems, so a path may be local or a URI
that Arrow knows. Quoted values must not hold line breaks, unless the file is
compressed. Missing columns are an error, optional ones are NULL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a file that one task reads.
RANGE_BYTES = 64 << 20
ANY_YEAR = (-(1 << 31), (1 << 31) - 1)
TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}


@dataclass(frozen=True)
class Layout:
    """``columns``: output names and types, with the name in the file; ``wide``: for columns named by year, the measure and its pattern, whose group is the year."""

    columns: dict[str, tuple[str, str]]
    wide: dict[str, str] = field(default_factory=dict)
    optional: frozenset[str] = frozenset()
    skip: int = 0
    encoding: str = "utf8"
    missing: tuple[str, ...] = ("",)
    separator: str = ","

    @property
    def fields(self) -> dict[str, str]:
        own = {name: kind for name, (kind, _) in self.columns.items()}
        return {**own, "year": "int", **dict.fromkeys(self.wide, "double")} if self.wide else own

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.fields.items())


def _plain(**named: str) -> dict[str, tuple[str, str]]:
    """Columns from ``name="kind header"``; without a header the name itself."""
    return {name: (kind.split(" ", 1)[0], (kind.split(" ", 1) + [name])[1]) for name, kind in named.items()}


#: The layouts of the providers' files; spreadsheets land as the text export of their sheet.
LAYOUTS = {
    "hdi": Layout(_plain(iso3="string"), {m: rf"{m}_(\d{{4}})" for m in ("gii", "eys", "mys", "le")}, encoding="windows-1252"),
    "cpi": Layout(_plain(country="string Country / Territory", iso3="string ISO3"), {"cpi_score": r"CPI [Ss]core (\d{4})"}, skip=3),
    "worldbank": Layout(_plain(iso3="string Country Code", series="string Indicator Code"), {"value": r"(\d{4})"}, skip=4),
    "vdem": Layout(
        _plain(
            country="string country_name", iso3="string country_text_id", year="int", v2x_civlib="double", v2x_polyarchy="double", v2x_libdem="double", v2x_rule="double",
            v2xpe_exlsocgr="double", v2xpe_exlgender="double",
        )
    ),
    "freedomhouse": Layout(_plain(country="string Country/Territory", edition="int Edition", political_rights="double PR", civil_liberties="double CL", fh_score="double Total"), skip=1),
    "epr": Layout(_plain(statename="string", start="int from", stop="int to", group="string", size="double", status="string")),
    "swiid": Layout(_plain(country="string", year="int", gini_disp="double")),
    "unhcr": Layout(
        _plain(
            iso3="string Country of asylum (ISO)", year="int Year", refugees="double Refugees under UNHCR's mandate", asylum_seekers="double Asylum-seekers",
            others_need_of_protection="double Other people in need of international protection", idps="double IDPs of concern to UNHCR",
        ),
        missing=("", "-"),
    ),
    "imf": Layout(_plain(country="string COUNTRY", year="int TIME_PERIOD", gdp_ppp="double OBS_VALUE")),
    "ilo": Layout(_plain(iso3="string ref_area", indicator="string", sex="string", classif="string classif1", year="int time", value="double obs_value")),
    "sdg": Layout(_plain(series="string SeriesCode", country="string GeoAreaName", year="int TimePeriod", value="string Value", sex="string [Sex]"), optional=frozenset({"sex"})),
    "wpp": Layout(
        _plain(
            type="string Type", country="string Region, subregion, country or area *", iso3="string ISO3 Alpha-code", year="int Year",
            pop_total="double Total Population, as of 1 January (thousands)", pop_change="double Population Growth Rate (percentage)",
            pop_youth="double 0-14", pop_working="double 15-64", pop_old="double 65+",
        ),
        optional=frozenset({"pop_total", "pop_change", "pop_youth", "pop_working", "pop_old"}), skip=16, missing=("", "..."),
    ),
    "shdi": Layout(_plain(gdlcode="string GDLCODE", level="string", year="int", edindex="double", healthindex="double", sgdi="double"), missing=("", " ")),
    "aqueduct": Layout(_plain(pfaf_id="long", bws_raw="double"), missing=("", "-9999", "-9999.0")),
}


class Part(NamedTuple):
    path: str
    start: int
    stop: int | None


class LandedPartition(InputPartition):
    def __init__(self, part: Part) -> None:
        super().__init__(part)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/[^/]", path):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def parts_of(path: str, range_bytes: int = RANGE_BYTES) -> list[Part]:
    """The ranges that the files at ``path`` are read in."""
    system, root = _opened(path)
    scheme = path[: len(path) - len(root)] if path.endswith(root) else ""
    info = system.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(root, recursive=True))
    parts = []
    for f in sorted(found, key=lambda f: f.path):
        if not f.is_file or re.search(r"(^|/)[._][^/]*$", f.path):
            continue
        if f.path.endswith((".gz", ".bz2", ".zst")):
            parts.append(Part(scheme + f.path, 0, None))
        else:
            parts += [Part(scheme + f.path, at, min(at + range_bytes, f.size)) for at in range(0, f.size, range_bytes)]
    return parts


class LandedReader(DataSourceReader):
    def __init__(self, layout: Layout, options: dict[str, str]) -> None:
        self.layout, self.path, self.range_bytes = layout, options["path"], int(options.get("range_bytes", RANGE_BYTES))
        self.first, self.last = int(options.get("first_year", ANY_YEAR[0])), int(options.get("last_year", ANY_YEAR[1]))
        self.only = {name: options[f"only_{name}"].split("|") for name in layout.fields if f"only_{name}" in options}

    def partitions(self) -> list[LandedPartition]:
        return [LandedPartition(p) for p in parts_of(self.path, self.range_bytes)] or [LandedPartition(Part("", 0, 0))]

    def read(self, partition: LandedPartition) -> Iterator[pa.RecordBatch]:
        path, start, stop = partition.value
        if not path:
            return
        system, inside = _opened(path)
        layout = self.layout
        with system.open_input_stream(inside) as head:  # decompresses by the file's ending
            lines, left = [], b""
            while len(lines) <= layout.skip:
                more = head.read(1 << 16)
                *whole, left = (left + more).split(b"\n")
                lines += whole if more else [*whole, left]
                if not more:
                    break
        if len(lines) <= layout.skip:
            return
        data = sum(len(line) + 1 for line in lines[: layout.skip + 1])
        names = self._names(lines[layout.skip])
        places = {i: (out, kind) for out, (kind, name) in layout.columns.items() if (i := names.get(name)) is not None}
        absent = [name for out, (_, name) in layout.columns.items() if name not in names and out not in layout.optional]
        if absent:
            raise ValueError(f"{path} has no column {absent}")
        years = {}
        for name, i in names.items():
            for measure, pattern in layout.wide.items():
                if (m := re.fullmatch(pattern, name)) and self.first <= int(m[1]) <= self.last:
                    years.setdefault(int(m[1]), {})[measure] = i
        wanted = sorted({*places, *(i for by in years.values() for i in by.values())})
        width = max(names.values()) + 1
        convert = pacsv.ConvertOptions(
            include_columns=[f"c{i}" for i in wanted], column_types={f"c{i}": pa.string() for i in wanted}, null_values=list(layout.missing), strings_can_be_null=True, quoted_strings_can_be_null=True
        )
        parse = pacsv.ParseOptions(delimiter=layout.separator, newlines_in_values=stop is None)
        read = pacsv.ReadOptions(use_threads=False, column_names=[f"c{i}" for i in range(width)], encoding=layout.encoding, skip_rows=layout.skip + 1 if stop is None else 0)
        if stop is None:
            with system.open_input_stream(inside) as stream, pacsv.open_csv(stream, read, parse, convert) as batches:
                for batch in batches:
                    yield from self._tidy(pa.Table.from_batches([batch]), places, years)
            return
        block = _lines_between(system, inside, data, start, stop)
        if block.strip():
            yield from self._tidy(pacsv.read_csv(pa.BufferReader(block), read, parse, convert), places, years)

    def _names(self, header: bytes) -> dict[str, int]:
        """Column places by name; of equal names the first."""
        text = header.decode(self.layout.encoding).removeprefix("\ufeff").rstrip("\r\n")
        row = pacsv.read_csv(
            pa.BufferReader((text + "\n").encode()), pacsv.ReadOptions(use_threads=False, autogenerate_column_names=True), pacsv.ParseOptions(delimiter=self.layout.separator), pacsv.ConvertOptions(column_types={f"f{i}": pa.string() for i in range(text.count(self.layout.separator) + 1)})
        )
        names: dict[str, int] = {}
        for i, column in enumerate(row.columns):
            names.setdefault((column[0].as_py() or "").strip() or f"#{i}", i)
        return names

    def _tidy(self, table: pa.Table, places: dict[int, tuple[str, str]], years: dict[int, dict[str, int]]) -> Iterator[pa.RecordBatch]:
        layout, n = self.layout, len(table)
        schema = pa.schema([(name, TYPES[kind]) for name, kind in layout.fields.items()])
        column = lambda i, kind: _typed(table.column(f"c{i}"), kind)
        own = {out: column(i, kind) for i, (out, kind) in places.items()}
        if layout.wide:
            for year, measures in sorted(years.items()):
                made = {**own, "year": pa.repeat(pa.scalar(year, pa.int32()), n), **{m: column(i, "double") for m, i in measures.items()}}
                yield from self._kept(made, schema, n)
        else:
            yield from self._kept(own, schema, n)

    def _kept(self, made: dict, schema: pa.Schema, n: int) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_arrays([made[f.name] if f.name in made else pa.nulls(n, f.type) for f in schema], schema=schema)
        if "year" in schema.names and (self.first, self.last) != ANY_YEAR:
            table = table.filter(pc.and_(pc.greater_equal(table.column("year"), self.first), pc.less_equal(table.column("year"), self.last)))
        for name, values in self.only.items():
            table = table.filter(pc.is_in(table.column(name), pa.array(values, pa.string())))
        yield from table.to_batches()


def _lines_between(system: pafs.FileSystem, path: str, data: int, start: int, stop: int) -> bytes:
    """The lines that begin in a range of bytes, after the header."""
    begin = max(start, data)
    if begin >= stop:
        return b""
    with system.open_input_file(path) as f:
        f.seek(begin - 1)
        block = f.read(stop - begin + 1)
        if begin > data:  # a line that begins before belongs to the range before
            cut = block.find(b"\n")
            if cut < 0:
                return b""
            block = block[cut + 1 :]
        else:
            block = block[1:]
        if not block:
            return b""
        while not block.endswith(b"\n"):
            more = f.read(1 << 16)
            if not more:
                break
            end = more.find(b"\n")
            block += more if end < 0 else more[: end + 1]
        return block


def _typed(column: pa.ChunkedArray, kind: str) -> pa.ChunkedArray:
    if kind == "string":
        return column
    plain = pc.utf8_trim_whitespace(column)
    return pc.cast(plain, TYPES[kind])


class LandedSource(DataSource):
    """One of the layouts; ``load`` takes the path, the options are those above and ``range_bytes``, what one task reads."""

    layout: Layout

    @classmethod
    def name(cls) -> str:
        return f"landed_{cls.__name__.removeprefix('Landed').lower()}"

    def schema(self) -> str:
        return self.layout.ddl

    def reader(self, schema) -> LandedReader:
        return LandedReader(self.layout, self.options)


SOURCES: dict[str, type[LandedSource]] = {}
for _key, _layout in LAYOUTS.items():
    _name = f"Landed{_key.capitalize()}"
    SOURCES[_key] = type(_name, (LandedSource,), {"layout": _layout, "__module__": __name__, "__doc__": f"Files of {_key}."})
    globals()[_name] = SOURCES[_key]  # found by name where tasks unpickle it


def register(spark: SparkSession) -> None:
    """Make all sources known to the session, as landed_<key>."""
    for source in SOURCES.values():
        spark.dataSource.register(source)


def load(spark: SparkSession, key: str, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format(f"landed_{key}").options(**options).load(path)
