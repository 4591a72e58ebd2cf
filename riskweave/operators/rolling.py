"""Windows over the time steps of an entity."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _last(entity: list[str], order: list[str], rows: int):
    return Window.partitionBy(*entity).orderBy(*order).rowsBetween(1 - rows, 0)


def full_sum(x: str, entity: list[str], order: list[str], rows: int) -> Column:
    """The sum of the last rows, 0 until there are that many."""
    w = _last(entity, order, rows)
    return F.when(F.count(F.lit(1)).over(w) >= rows, F.sum(x).over(w)).otherwise(0)


def full_mean(x: str, entity: list[str], order: list[str], rows: int) -> Column:
    """The mean of the last rows, 0 until there are that many."""
    w = _last(entity, order, rows)
    return F.when(F.count(F.lit(1)).over(w) >= rows, F.avg(x).over(w)).otherwise(0.0)


def mean_of_at_least(x: str, entity: list[str], order: list[str], rows: int, values: int) -> Column:
    """The mean of what the last rows have, NULL with fewer values than asked for."""
    w = _last(entity, order, rows)
    return F.when(F.count(x).over(w) >= values, F.avg(x).over(w))


def long_mean(df: DataFrame, x: str, entity: list[str], order: list[str], rows: int, values: int, out: str) -> DataFrame:
    """``out``: as ``mean_of_at_least``, for windows of many rows, whose sums are differences of running sums.

    A sliding frame adds up all its rows again at each row; here a row costs the same however long the window. Values
    that aren't finite are counted apart, since they would stay in all later sums.
    """
    line = Window.partitionBy(*entity).orderBy(*order)
    v, inf = F.col(x).cast("double"), float("inf")
    parts = {
        "_s": F.sum(F.when(F.abs(v) < inf, v).otherwise(0.0)), "_n": F.count(v), "_nan": F.count(F.when(F.isnan(v), 1)),
        "_up": F.count(F.when(v == inf, 1)), "_down": F.count(F.when(v == -inf, 1)),
    }
    running = df.withColumns({c: f.over(line.rowsBetween(Window.unboundedPreceding, 0)) for c, f in parts.items()})
    here = running.withColumns({c: F.col(c) - F.lag(c, rows, 0).over(line) for c in parts})
    total = F.when((F.col("_nan") > 0) | ((F.col("_up") > 0) & (F.col("_down") > 0)), float("nan")).when(F.col("_up") > 0, inf).when(F.col("_down") > 0, -inf).otherwise(F.col("_s"))
    return here.withColumn(out, F.when(F.col("_n") >= values, F.try_divide(total, F.col("_n")))).drop(*parts)


def growth(x: str, entity: list[str], order: list[str]) -> Column:
    """Change from the step before, relative to that."""
    return F.try_divide(F.col(x), F.lag(x).over(Window.partitionBy(*entity).orderBy(*order))) - 1


def growth_of_current(x: str, entity: list[str], order: list[str]) -> Column:
    """Change from the step before, relative to the present value."""
    return F.try_divide(F.col(x) - F.lag(x).over(Window.partitionBy(*entity).orderBy(*order)), F.col(x))


def average_rank(x: Column, within: list[str]) -> Column:
    """Ranks from 1; ties share their mean rank."""
    by = Window.partitionBy(*within)
    return F.rank().over(by.orderBy(x)) + (F.count(F.lit(1)).over(Window.partitionBy(*within, x)) - 1) / 2.0


def runs(df: DataFrame, entity: list[str], order: str, flag: Column, least: int, closed_only: bool = True) -> DataFrame:
    """(entity, start, end, length) of flagged runs of at least ``least`` rows.

    A run still open at an entity's last row is left out unless asked for.
    """
    line = Window.partitionBy(*entity).orderBy(order)
    marked = df.withColumn("_f", F.coalesce(flag, F.lit(False))).withColumn("_run", F.sum((~F.col("_f")).cast("int")).over(line))
    last = F.max(order).over(Window.partitionBy(*entity))
    found = marked.withColumn("_end", last).where("_f").groupBy(*entity, "_run").agg(
        F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("length"), F.max("_end").alias("_end")
    )
    kept = found.where(F.col("length") >= least)
    return (kept.where(F.col("end") < F.col("_end")) if closed_only else kept).drop("_run", "_end")


#: Steps of a series that are folded together.
STRETCH = 64


def decay(df: DataFrame, entity: list[str], order: str, x: str, target: float, years: float, weight: float, out: str = "decayed") -> DataFrame:
    """Exponential memory: v = w*x + (1 - w*x) * e^k * v_before, from the first value on.

    Without new input a value falls to ``target`` of itself in ``years`` of
    quarters. A missing value after the start makes all later ones missing. A
    series is one entity's. It is folded in stretches, each of which hands its
    last value on, so no step copies more than one stretch and the list of
    stretches grows by one for each.
    """
    factor = math.exp(math.log(target) / (4 * years))
    series = F.array_sort(F.collect_list(F.struct(F.col(order).alias("t"), F.col(x).cast("double").alias("x"))))
    item = f"array<struct<t:{dict(df.dtypes)[order]},v:double>>"

    def step(state: Column, now: Column) -> Column:
        value = F.when(~state["begun"], now["x"]).otherwise(
            weight * now["x"] + (1 - weight * now["x"]) * factor * state["v"]
        )
        return F.struct(
            (state["begun"] | now["x"].isNotNull()).alias("begun"),
            value.cast("double").alias("v"),
            F.array_append(state["all"], F.struct(now["t"].alias("t"), value.cast("double").alias("v"))).alias("all"),
        )

    def stretch(state: Column, part: Column) -> Column:
        begin = F.struct(state["begun"].alias("begun"), state["v"].alias("v"), F.array().cast(item).alias("all"))
        return F.transform(F.array(F.aggregate(part, begin, step)), lambda done: F.struct(
            done["begun"].alias("begun"), done["v"].alias("v"), F.array_append(state["all"], done["all"]).alias("all")
        ))[0]

    start = F.struct(F.lit(False).alias("begun"), F.lit(None).cast("double").alias("v"), F.array().cast(f"array<{item}>").alias("all"))
    # Bound by a lambda, so that the sorted list is made once and not for each stretch.
    whole = lambda s: F.flatten(F.aggregate(F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / STRETCH).cast("int")), lambda k: F.slice(s, k * STRETCH + 1, F.lit(STRETCH))), start, stretch)["all"])
    folded = df.groupBy(*entity).agg(series.alias("_s")).select(*entity, F.explode(F.transform(F.array("_s"), whole)[0]).alias("_r"))
    return folded.select(*entity, F.col("_r.t").alias(order), F.col("_r.v").alias(out))


def segments(df: DataFrame, x: str, entity: list[str], order: str, out: str = "segment") -> DataFrame:
    """Number the stretches of equal ``x`` within an entity, from 0."""
    line = Window.partitionBy(*entity).orderBy(order)
    changed = df.withColumn("_changed", F.coalesce((F.col(x) != F.lag(x).over(line)).cast("int"), F.lit(0)))
    return changed.withColumn(out, F.sum("_changed").over(line)).drop("_changed")
