"""Filling gaps within an entity, by windows over its time steps.

Time steps are equally spaced ordinals. ``head`` and ``tail`` say what happens
before the first and after the last observation: "none", "fill" (the nearest
observation) or "extrapolate" (the line through the two nearest ones, NULL if
there is only one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskweave.operators.scale import quantiles
from riskweave.session import cut

TAILS = ("none", "fill", "extrapolate")


def _frames(entity: list[str], order: list[str]):
    line = Window.partitionBy(*entity).orderBy(*order)
    return line, line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(0, Window.unboundedFollowing)


def forward_fill(df: DataFrame, entity: list[str], order: list[str], columns: list[str]) -> DataFrame:
    _, before, _ = _frames(entity, order)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in columns})


def fill_all(df: DataFrame, entity: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last observation, else the next one."""
    _, before, after = _frames(entity, order)
    return df.withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after)) for c in columns}
    )


def interpolate(df: DataFrame, entity: list[str], order: list[str], column: str, head: str = "none", tail: str = "none", out: str | None = None) -> DataFrame:
    """Straight lines between observations; all windows share one partitioning and sort."""
    ends_needed = "extrapolate" in (head, tail)
    if head not in TAILS or tail not in TAILS:
        raise ValueError(f"tails are {TAILS}")
    line, before, after = _frames(entity, order)
    whole = Window.partitionBy(*entity)
    at, x = F.col("_at"), F.col(column)
    seen = F.when(x.isNotNull(), F.struct(at.alias("t"), x.alias("v")))
    rows = df.withColumn("_at", F.row_number().over(line)).withColumn("_seen", seen)
    rows = rows.withColumns({
        "_prev": F.last("_seen", ignorenulls=True).over(before),
        "_next": F.first("_seen", ignorenulls=True).over(after),
        "_nth": F.count("_seen").over(before),
        "_n": F.count("_seen").over(whole),
    })
    rows = rows.withColumns({
        f"_o{i}": F.max(F.when((F.col("_nth") == n) & F.col("_seen").isNotNull(), F.col("_seen"))).over(whole) if ends_needed else F.lit(None)
        for i, n in ((1, F.lit(1)), (2, F.lit(2)), (3, F.col("_n") - 1), (4, F.col("_n")))
    })

    def through(a: Column, b: Column) -> Column:
        return a["v"] + (b["v"] - a["v"]) * F.try_divide(at - a["t"], b["t"] - a["t"])

    ends = {"none": lambda near, *_: F.lit(None).cast("double"), "fill": lambda near, *_: near["v"], "extrapolate": lambda near, a, b: through(a, b)}
    o = [F.col(f"_o{i}") for i in range(1, 5)]
    filled = (
        F.when(x.isNotNull(), x)
        .when(F.col("_prev").isNotNull() & F.col("_next").isNotNull(), through(F.col("_prev"), F.col("_next")))
        .when(F.col("_prev").isNull(), ends[head](F.col("_next"), o[0], o[1]))
        .otherwise(ends[tail](F.col("_prev"), o[2], o[3]))
    )
    extra = ["_at", "_seen", "_prev", "_next", "_nth", "_n", "_o1", "_o2", "_o3", "_o4"]
    return rows.withColumn(out or column, filled).drop(*extra)


def extend_by_growth(df: DataFrame, entity: str, order: str, local: str, national: str, cut_share: float = 0.01) -> DataFrame:
    """Extend ``local`` past its last observation by the year-on-year growth of ``national``.

    Growth is bounded by its global quantiles at cut_share and 1 - cut_share; the running
    product of growth since the last observation scales it.
    """
    line = Window.partitionBy(entity).orderBy(order)
    rows = cut(df.withColumn("_g", F.try_divide(F.col(national), F.lag(national).over(line))))
    low, high = quantiles(rows, [(F.col("_g"), level) for level in (cut_share, 1 - cut_share)])
    rows = rows.withColumn("_g", F.when(F.col("_g").isNotNull(), F.greatest(F.least("_g", F.lit(high)), F.lit(low))))
    before = line.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_last", F.last(local, ignorenulls=True).over(before)).withColumn("_seg", F.count(local).over(before))
    seg = Window.partitionBy(entity, "_seg").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col(local).isNull(), F.ln("_g")).otherwise(0.0)
    broken = F.sum((F.col(local).isNull() & F.col("_g").isNull()).cast("int")).over(seg) > 0
    grown = F.when(~broken, F.col("_last") * F.exp(F.sum(step).over(seg)))
    return rows.withColumn("extended", F.coalesce(local, grown)).drop("_g", "_last", "_seg")
