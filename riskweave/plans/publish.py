"""Tables for dashboards, and an index specification from a file."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.combine import Index
from riskweave.operators.impute import forward_fill

KEYS = ["pgid", "year", "quarter"]


def load_spec(spark: SparkSession, path: str) -> Index:
    """An index from a JSON file, read by Spark, so it may lie in any store."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return Index.from_dict(json.loads(text))


def country_data(tables: list[DataFrame]) -> DataFrame:
    """One wide country-year table from many: a chain of full outer joins on one key."""
    return reduce(lambda a, b: a.join(b, ["iso3", "year"], "full_outer"), tables)


def dashboard(scores: DataFrame, columns: list[str], with_raw: bool = True) -> DataFrame:
    """Scores after filling gaps forward, with their raw columns if asked."""
    raw = [f"{c}_raw" for c in columns if with_raw and f"{c}_raw" in scores.columns]
    return forward_fill(scores, ["pgid"], ["year", "quarter"], columns).select(*KEYS, *columns, *raw)


def latest(scores: DataFrame, columns: list[str]) -> DataFrame:
    """Each cell's last quarter."""
    at = F.struct("year", "quarter", *columns)
    return scores.groupBy("pgid").agg(F.max_by(at, F.col("year") * 4 + F.col("quarter")).alias("_r")).select("pgid", "_r.*")
