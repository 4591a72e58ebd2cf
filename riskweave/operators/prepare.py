"""From landed country tables to the inputs of the recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_most(df: DataFrame, most: dict[str, float]) -> DataFrame:
    """Points as ``<column>_percent``, shares of the most points there are."""
    return df.withColumns({f"{c}_percent": F.col(c) / m for c, m in most.items()})


def sum_where(df: DataFrame, keys: list[str], x: str, chosen: Column, name: str) -> DataFrame:
    """The sum of the chosen rows per key; keys without any are left out."""
    return df.where(chosen).groupBy(*keys).agg(F.sum(x).alias(name))


def next_year(df: DataFrame, entity: str, x: str) -> DataFrame:
    """Values moved to the row before, as those of a year's first day stand for the year that ended; the last row has none."""
    return df.withColumn(x, F.lead(x).over(Window.partitionBy(entity).orderBy("year")))


def growth_since(rates: DataFrame, entity: str, rate: str, base: int) -> DataFrame:
    """(entity, year, multiplier): growth in percent multiplied up from ``base`` to the start of each later year.

    A year without its rate makes all later multipliers NULL. Rates have one row for each entity and year.
    """
    line = Window.partitionBy(entity).orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    factor = 1 + F.col(rate) / 100
    sized = rates.where(F.col("year") >= base).withColumns({
        "_log": F.sum(F.ln(F.abs(factor))).over(line), "_signs": F.sum((factor < 0).cast("int")).over(line),
        "_zeros": F.sum((factor == 0).cast("int")).over(line), "_known": F.count(factor).over(line),
    })
    product = F.when(F.col("_zeros") > 0, 0.0).otherwise(F.exp("_log") * F.when(F.col("_signs") % 2 == 1, -1).otherwise(1))
    return sized.select(entity, (F.col("year") + 1).alias("year"), F.when(F.col("_known") == F.col("year") - base + 1, product).alias("multiplier"))
