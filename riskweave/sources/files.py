"""Reading landed files. Everything goes through Spark's readers, so any store works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def panel(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def csv(spark: SparkSession, path: str, schema: str, missing: str = "", encoding: str = "UTF-8", recursive: bool = False, sep: str = ",") -> DataFrame:
    """A CSV with a header, also gzipped; ``missing`` reads as NULL."""
    return (
        spark.read.schema(schema).option("header", True).option("nullValue", missing).option("encoding", encoding)
        .option("recursiveFileLookup", recursive).option("sep", sep).csv(path)
    )


def json_pages(spark: SparkSession, path: str, items: str, schema: str) -> DataFrame:
    """The rows inside the ``items`` array of landed response pages, each once."""
    pages = spark.read.schema(f"`{items}` array<struct<{schema}>>").option("multiLine", True).json(path)
    return pages.select(F.explode(items).alias("item")).select("item.*").dropDuplicates()


def days(spark: SparkSession, *paths: str) -> DataFrame:
    """Many daily files as one table."""
    return spark.read.parquet(*paths)


def database(spark: SparkSession, url: str, table: str, columns: list[str], **options: str) -> DataFrame:
    """A database table over JDBC; only the listed columns are asked for."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)


def latest_version(names: DataFrame, column: str, pattern: str) -> DataFrame:
    """The greatest version that ``pattern``'s first group finds in file names; its numbers are compared as numbers."""
    found = F.regexp_extract(column, pattern, 1)
    order = F.transform(F.regexp_extract_all(found, F.lit(r"(\d+)")), lambda n: n.cast("long"))
    return names.where(found != "").agg(F.max_by(found, F.struct(order.alias("numbers"), found.alias("text"))).alias("version"))


def missing(required: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """What is required and not there."""
    return required.join(present.select(*on).distinct(), on, "left_anti")


def by_priority(df: DataFrame, keys: list[str], version: str, order: list[str]) -> DataFrame:
    """One row per key, that of the first version in ``order``."""
    rank = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(version))
    best = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.when(rank > 0, rank).otherwise(len(order) + 1))
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")


def renamed_keys(key: str, patches: dict[str, str]) -> Column:
    """A key column with outdated codes replaced."""
    out = F.col(key)
    for old, new in patches.items():
        out = F.when(F.col(key) == old, new).otherwise(out)
    return out


def country_codes(df: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """Adds ``iso3`` from a table of (alias, iso3), case and blanks aside; unknown names give NULL."""
    plain = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    keyed = aliases.select(plain(F.col("alias")).alias("_alias"), F.col("iso3"))
    return df.withColumn("_alias", plain(F.col(name))).join(keyed, "_alias", "left").drop("_alias")


def plain_names(df: DataFrame) -> DataFrame:
    """Column names in lower case, other signs as underscores."""
    import re

    return df.toDF(*[re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_") for c in df.columns])
