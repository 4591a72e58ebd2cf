"""Building panels: one row for each entity and time step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import calendar


def entity_years(entities: DataFrame, first: int, last: int) -> DataFrame:
    """Every entity in every year; rows are generated, not joined."""
    return entities.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))


def entity_quarters(entities: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Every entity in every quarter from ``first`` to ``last``, with ``time``, the quarter's first day."""
    a, b = (y * 4 + q - 1 for y, q in (first, last))
    rows = entities.withColumn("step", F.explode(F.sequence(F.lit(a), F.lit(b))))
    year, quarter = calendar.from_ordinal(F.col("step"))
    return rows.withColumn("year", year).withColumn("quarter", quarter).drop("step").withColumn(
        "time", calendar.quarter_start(F.col("year"), F.col("quarter"))
    )


def yearly_to_quarterly(panel: DataFrame, yearly: DataFrame, on: list[str]) -> DataFrame:
    """Left join yearly values onto the fourth quarters of a panel; other quarters stay NULL."""
    placed = yearly.withColumn("quarter", F.lit(4))
    return panel.join(placed, [*on, "year", "quarter"], "left")


def mid_year(panel: DataFrame) -> DataFrame:
    """Swap quarters 2 and 4, for estimates that hold at mid-year."""
    return panel.withColumn("quarter", F.when(F.col("quarter") == 2, 4).when(F.col("quarter") == 4, 2).otherwise(F.col("quarter")))


def covered_zero(panel: DataFrame, columns: list[str], start: str) -> DataFrame:
    """0 for missing counts from the coverage start on, NULL before it or without one."""
    return panel.withColumns({c: F.when(F.col("time") >= F.col(start), F.coalesce(c, F.lit(0))) for c in columns})


def fallback(df: DataFrame, key: str, first: str, second: str, max_missing: int) -> DataFrame:
    """``chosen``: ``first``, but ``second`` throughout an entity where ``first`` has more gaps than allowed.

    A grouped aggregate joined back: it combines before the shuffle.
    """
    gaps = df.groupBy(key).agg(F.sum(F.col(first).isNull().cast("int")).alias("gaps"), F.count(second).alias("others"))
    use = (F.col("gaps") > max_missing) & (F.col("others") > 0)
    return df.join(gaps, key).withColumn("chosen", F.when(use, F.col(second)).otherwise(F.col(first))).drop("gaps", "others")


def fallback_if_few(df: DataFrame, key: str, first: str, second: str, least: int) -> DataFrame:
    """``chosen``: ``first``, but ``second`` throughout an entity where ``first`` has fewer values than asked for and ``second`` has any."""
    known = df.groupBy(key).agg(F.count(first).alias("values"), F.count(second).alias("others"))
    use = (F.col("values") < least) & (F.col("others") > 0)
    return df.join(known, key).withColumn("chosen", F.when(use, F.col(second)).otherwise(F.col(first))).drop("values", "others")


def update(base: DataFrame, new: DataFrame, keys: list[str], column: str, overwrite: bool = True) -> DataFrame:
    """Fill ``column`` of ``base`` from ``new``: new values win, or only fill gaps."""
    joined = base.join(new.select(*keys, F.col(column).alias("new_value")), keys, "left")
    order = ("new_value", column) if overwrite else (column, "new_value")
    return joined.withColumn(column, F.coalesce(*order)).drop("new_value")


def supersede(base: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """``base`` without the ids that ``newer`` has, and all of ``newer``."""
    return base.join(newer.select(key).distinct(), key, "left_anti").unionByName(newer)


def recency(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the last quarter with a value, as year*10+quarter; one pass over the panel."""
    at = F.col("year") * 10 + F.col("quarter")
    last = panel.agg(*[F.max(F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])
    return last.unpivot([], columns, "id", "last")


def validate(panel: DataFrame, keys: list[str], start_year: int) -> DataFrame:
    """The panel, checked while it is read: a missing key or an earlier year stops the job."""
    bad = [F.col(k).isNull() for k in keys] + [F.col("year") < start_year]
    wrong = bad[0]
    for b in bad[1:]:
        wrong = wrong | b
    first = keys[0]
    return panel.withColumn(first, F.when(wrong, F.raise_error(F.lit("bad panel key")).cast(panel.schema[first].dataType)).otherwise(F.col(first)))


def densify(df: DataFrame, keys: list[str], first: int, last: int) -> DataFrame:
    """Every key in every year, joined with what is there."""
    return entity_years(df.select(*keys).distinct(), first, last).join(df, [*keys, "year"], "left")


def unpivot_years(wide: DataFrame, keys: list[str], prefix: str, value: str) -> DataFrame:
    """Columns named prefix + year as rows."""
    years = [c for c in wide.columns if c.startswith(prefix) and c[-4:].isdigit()]
    return wide.unpivot(keys, years, "name", value).withColumn("year", F.substring("name", -4, 4).cast("int")).drop("name")


def availability(panel: DataFrame, times: list[str], columns: list[str], most_missing: float = 0.75, require_all: bool = True) -> DataFrame:
    """The time steps at which the mean share of missing values over the columns is within bounds; with ``require_all``
    no column may be wholly missing."""
    shares = panel.groupBy(*times).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"gap_{c}") for c in columns])
    gaps = [F.col(f"gap_{c}") for c in columns]
    ok = sum(gaps[1:], gaps[0]) / len(gaps) <= most_missing
    if require_all:
        ok = ok & (F.greatest(*gaps, F.lit(0.0)) < 1)
    return shares.where(ok).select(*times)


def gate(panel: DataFrame, times: list[str], columns: list[str], most_missing: float = 0.75, require_all: bool = True) -> DataFrame:
    """NULL in every column at time steps that fail ``availability``."""
    good = availability(panel, times, columns, most_missing, require_all).withColumn("passes", F.lit(True))
    joined = panel.join(good, times, "left")
    return joined.withColumns({c: F.when(F.col("passes"), F.col(c)) for c in columns}).drop("passes")


def clip_fill(panel: DataFrame, entity: list[str], times: list[str], columns: list[str], most_missing: float = 0.75, require_all: bool = True) -> DataFrame:
    """Gaps filled by straight lines, and by the nearest value at both ends, among the time steps that pass
    ``availability``; NULL at all others."""
    from riskweave.operators import impute

    # One row a time step: few. ``panel`` is read twice: store it before if it is costly.
    good = F.broadcast(availability(panel, times, columns, most_missing, require_all).withColumn("_passes", F.lit(True)))
    filled = panel.join(good, times, "left").withColumn("_passes", F.coalesce("_passes", F.lit(False)))
    for c in columns:
        filled = impute.interpolate(filled, [*entity, "_passes"], times, c, "fill", "fill")
    return filled.withColumns({c: F.when(F.col("_passes"), F.col(c)) for c in columns}).drop("_passes")


def years_of(intervals: DataFrame, first: str, last: str) -> DataFrame:
    """A row for each ``year`` of an interval of years; reversed intervals are left out."""
    return intervals.where(F.col(last) >= F.col(first)).withColumn("year", F.explode(F.sequence(F.col(first), F.col(last)))).drop(first, last)


def also_as(df: DataFrame, key: str, copies: dict[str, str]) -> DataFrame:
    """``df`` with the rows of some keys given once more under another key, as {from: to}."""
    again = df.where(F.col(key).isin(*copies))
    return df.unionByName(again.replace(copies, subset=[key]))


def one_value(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """The value that all rows of a key share, NULL if all are; several values are an error when the rows are read."""
    same = F.min(x).eqNullSafe(F.max(x))
    several = F.raise_error(F.concat_ws(" ", F.lit(f"{x} has several values at"), *[F.col(k).cast("string") for k in keys]))
    return df.groupBy(*keys).agg(F.when(same, F.avg(x)).otherwise(several.cast("double")).alias(x))


def total_or_null(df: DataFrame, keys: list[str], x: str, out: str) -> DataFrame:
    """Sums per key; a sum of 0 is missing."""
    return df.groupBy(*keys).agg(F.nullif(F.sum(F.col(x).cast("double")), F.lit(0.0)).alias(out))


def one_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the least by ``order``, then by all its columns, so that reruns agree."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min_by(F.struct(*df.columns), F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(best).select("_row.*")


def joined_alike(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The inner join of two tables that must have the same keys, once each; a key of one of them only, or a repeated one, stops the job."""
    count = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n))
    sizes = count(a, "_a").join(count(b, "_b"), keys, "full_outer")
    wrong = F.raise_error(F.concat_ws(" ", F.lit("not once in both tables:"), *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])).cast("long")
    same = F.coalesce((F.col("_a") == 1) & (F.col("_b") == 1), F.lit(False))
    return a.join(b, keys).join(sizes.select(*keys, F.when(same, F.lit(1).cast("long")).otherwise(wrong).alias("_ok")), keys, "right").where("_ok = 1").drop("_ok")


def last_complete_panel(entities: DataFrame, first: tuple[int, int], today: Column) -> DataFrame:
    """Every entity in every quarter from ``first`` to the last one that ended before ``today``."""
    from_, until = first[0] * 4 + first[1] - 1, calendar.last_complete_quarter(today)
    rows = entities.withColumn("_until", until).where(F.col("_until") >= from_).withColumn("_step", F.explode(F.sequence(F.lit(from_), F.col("_until"))))
    year, quarter = calendar.from_ordinal(F.col("_step"))
    dated = rows.withColumns({"year": year, "quarter": quarter}).drop("_step", "_until")
    return dated.withColumn("time", calendar.quarter_start(F.col("year"), F.col("quarter")))
