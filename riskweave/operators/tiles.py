"""Rasters in tiles: layers put together, and yearly zonal sums that grow by what is missing."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import cut


def mosaic(tiles: DataFrame, layers: dict[str, DataFrame], base: str, absent: dict[str, float]) -> DataFrame:
    """(x, y, tile, a column for each layer): the pixels of all layers side by side, each pixel of one tile.

    ``tiles`` is the index (tile, rank, layer, there): whether a tile's layer has been published. Layers are (tile, x, y,
    value). Where tiles overlap, the least rank gives the whole pixel, of equal ranks the lesser tile. A tile without one
    of the layers in ``absent`` takes that layer's number, if its ``base`` layer adds up to something, and is left out
    else; a tile without any other layer is left out too. Pixels that the base layer lacks are left out.

    All layers are stacked and meet in one shuffle on the pixel's place, which serves the choice between tiles as well.
    """
    state = tiles.groupBy("tile").agg(F.min("rank").alias("rank"), *[F.coalesce(F.bool_or((F.col("layer") == n) & F.col("there")), F.lit(False)).alias(f"has_{n}") for n in layers])
    some = layers[base].groupBy("tile").agg((F.sum("value") != 0).alias("some"))
    complete = F.lit(True)
    for n in layers:
        has = F.col(f"has_{n}")
        complete = complete & ((has | F.coalesce("some", F.lit(False))) if n in absent else has)
    used = cut(state.join(some, "tile", "left").where(complete).drop("some"))
    stacked = None
    for n, pixels in layers.items():
        rows = pixels.select("tile", "x", "y", F.lit(n).alias("layer"), F.col("value").cast("double").alias("value"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    beside = stacked.repartition("x", "y").groupBy("x", "y", "tile").agg(*[F.max(F.when(F.col("layer") == n, F.col("value"))).alias(n) for n in layers])
    filled = beside.join(used, "tile").where(F.col(base).isNotNull())
    filled = filled.withColumns({n: F.when(F.col(f"has_{n}"), F.col(n)).otherwise(F.lit(v)) for n, v in absent.items()})
    best = F.min_by(F.struct("tile", *[F.col(n) for n in layers]), F.struct("rank", "tile")).alias("best")
    return filled.groupBy("x", "y").agg(best).select("x", "y", "best.*")


@dataclass(frozen=True)
class YearlyZones:
    """Sums and counts of pixels per zone and year, computed once for each unit (a country's file, say) and year.

    Below ``root`` lie ``values``, partitioned by year and unit, and ``manifest``: a row for each unit and year whose
    values are complete, with the version of the data that they come from. The manifest is written last, so a run that
    was cut off leaves partitions without a row, which the next run overwrites; and rows count only if their version is
    the one in the manifest. One writer at a time is assumed.
    """

    spark: SparkSession
    root: str

    _MANIFEST = "unit string, year int, version string, run string, number long"

    def _table(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def complete(self) -> DataFrame:
        """(unit, year, version): what is there."""
        found = self._table("manifest")
        if found is None:
            return self.spark.createDataFrame([], "unit string, year int, version string")
        return found.groupBy("unit", "year").agg(F.max_by("version", "number").alias("version"))

    def missing(self, required: DataFrame) -> DataFrame:
        """The rows of ``required`` (unit, year, version) that have not been computed from that version."""
        return required.select("unit", F.col("year").cast("int").alias("year"), "version").distinct().join(self.complete(), ["unit", "year", "version"], "left_anti")

    def update(self, required: DataFrame, pixels: Callable[[DataFrame], DataFrame], zone: Column, value: str) -> int:
        """Compute what is missing and return how many units and years that were.

        ``pixels`` is called only if anything is missing, with (unit, year, version), and returns a table with at least
        the columns unit, year, those of ``zone``, and ``value``; its other units and years are left out, which prunes the
        partitions of a table that is stored by them.
        """
        todo = cut(self.missing(required))
        n = todo.count()
        if not n:
            return 0
        rows = pixels(todo).withColumn("year", F.col("year").cast("int")).join(todo, ["unit", "year"], "left_semi")
        sums = rows.groupBy("unit", "year", zone.alias("zone")).agg(F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("sum"), F.count(value).alias("n"))
        made = sums.join(todo, ["unit", "year"]).select("zone", "sum", "n", "version", "year", "unit")
        made.repartition("year", "unit").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "unit").parquet(f"{self.root.rstrip('/')}/values")
        self.commit(todo)
        return n

    def commit(self, done: DataFrame) -> None:
        """Enter units, years and versions in the manifest, after their values have been written."""
        before = self._table("manifest")
        number = 0 if before is None else before.agg(F.max("number")).first()[0] + 1
        rows = done.select("unit", "year", "version", F.lit(uuid.uuid4().hex).alias("run"), F.lit(number).cast("long").alias("number"))
        rows.coalesce(1).write.mode("append").parquet(f"{self.root.rstrip('/')}/manifest")

    def load(self) -> DataFrame:
        """(zone, year, sum, n) over all units that are complete; a zone that several units share adds them up."""
        values = self._table("values")
        if values is None:
            return self.spark.createDataFrame([], "zone long, year int, sum double, n long")
        current = values.withColumn("unit", F.col("unit").cast("string")).withColumn("year", F.col("year").cast("int")).join(self.complete(), ["unit", "year", "version"], "left_semi")
        return current.groupBy("zone", "year").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class LookupCache:
    """A lookup from a key to a MAP of names and numbers (the areas of a cell and their shares, say), kept in versions.

    Entries are appended and never changed. The last version of a key counts; within one version a key given again with
    the same map is one entry, with another map an error when it is read.
    """

    spark: SparkSession
    root: str

    def _entries(self) -> DataFrame | None:
        return YearlyZones(self.spark, self.root)._table("entries")

    def merge(self, rows: DataFrame) -> None:
        """Add ``rows`` (key, value map<string,double>); what is there already with the same map is not written again."""
        known = self._entries()
        new = rows.select("key", "value", lookup_digest(F.col("value")).alias("digest"))
        if known is not None:
            new = new.join(self.current().select("key", "digest"), ["key", "digest"], "left_anti")
        number = 0 if known is None else known.agg(F.max("number")).first()[0] + 1
        new.dropDuplicates(["key", "digest"]).withColumn("number", F.lit(number).cast("long")).write.mode("append").parquet(f"{self.root.rstrip('/')}/entries")

    def current(self) -> DataFrame:
        """(key, value, digest): the last version of every key."""
        entries = self._entries()
        last = entries.groupBy("key").agg(F.max("number").alias("number"))
        found = entries.join(last, ["key", "number"]).groupBy("key").agg(F.min("digest").alias("digest"), F.max("digest").alias("other"), F.min_by("value", "digest").alias("value"))
        clash = F.raise_error(F.concat(F.lit("several maps for the key "), F.col("key").cast("string"))).cast("string")
        return found.select("key", "value", F.when(F.col("digest") == F.col("other"), F.col("digest")).otherwise(clash).alias("digest")).where("digest is not null")

    def load(self) -> DataFrame:
        """(key, name, number): the last maps as rows, as bridges are read."""
        return self.current().select("key", F.explode("value").alias("name", "number"))


def lookup_digest(value: Column) -> Column:
    """A digest of a map, whatever the order of its entries; bounded by the map's own size."""
    return F.sha2(F.to_json(F.array_sort(F.map_entries(value))), 256)
