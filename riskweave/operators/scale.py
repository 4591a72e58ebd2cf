"""Normalisers: bounds come from one aggregate over the panel, or one per time step."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.scores import rescale, zero_if_negative
from riskweave.session import cut, few

#: Transformations applied before scaling.
TRANSFORMS = {"log1p": F.log1p, "exp": F.exp, "zero_if_negative": zero_if_negative, "identity": lambda x: x}


def quantiles(df: DataFrame, wanted: list[tuple[Column, float]], most: int = 100_000) -> list[float | None]:
    """The exact quantiles of (column, level) pairs, interpolated linearly between ranks, in two passes over ``df``.

    ``percentile`` would bring every distinct value into one task. Here the first
    pass brackets all wanted ranks by approximate quantiles at once; the second
    counts the values inside the brackets and the rows below them, which confirms
    each bracket. Only brackets that hold more than ``most`` rows, or miss their
    rank, take further passes, with a sketch as much finer as the bracket is narrower.
    """
    values = df.select(*[x.cast("double").alias(f"x{k}") for k, (x, _) in enumerate(wanted)])
    out: list[float | None] = [None] * len(wanted)
    open_ = {k: 0.001 for k in range(len(wanted))}
    inside = {k: (None, None) for k in open_}
    missed: set[int] = set()  # their next, wider bracket is counted whatever its size, so the passes end
    while open_:
        if any(span[0] is None for k, span in inside.items() if k in open_):
            totals = values.agg(*[f(f"x{k}").alias(f"{n}{k}") for k in open_ for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))],
                                *[F.percentile_approx(f"x{k}", F.array(*[F.lit(min(max(wanted[k][1] + d * open_[k], 0.0), 1.0)) for d in (-1, 1)]), round(10 / open_[k])).alias(f"q{k}") for k in open_]).first()
            for k in list(open_):
                if not totals[f"n{k}"]:
                    del open_[k]
                    continue
                ends = list(totals[f"q{k}"])
                # At the ends of the column the bracket reaches to the end.
                at = wanted[k][1]
                inside[k] = (totals[f"lo{k}"] if at <= open_[k] else ends[0], totals[f"hi{k}"] if at >= 1 - open_[k] else ends[1])
        if not open_:
            break
        # Rows inside a bracket keep their value, rows below it count under NULL.
        below = lambda k: F.when(F.col(f"x{k}").between(*inside[k]), F.col(f"x{k}"))
        sizes = values.agg(*[F.count(below(k)).alias(f"c{k}") for k in open_]).first() if totals_large(totals, open_, most) else None
        easy = [k for k in open_ if sizes is None or k in missed or sizes[f"c{k}"] <= most]
        rows = values.select(F.explode(F.array(*[
            F.when(F.col(f"x{k}") <= inside[k][1], F.struct(F.lit(k).alias("k"), below(k).alias("x"))) for k in easy
        ])).alias("v")).where("v is not null").groupBy("v.k", "v.x").agg(F.count("*").alias("n")) if easy else None
        counted: dict[int, list[tuple[float | None, int]]] = {k: [] for k in easy}
        for row in rows.toLocalIterator() if easy else ():
            counted[row["k"]].append((row["x"], row["n"]))
        for k in list(open_):
            if k in counted and (value := _at_rank(counted[k], wanted[k][1], totals[f"n{k}"])) is not None:
                out[k] = value
                del open_[k]
            elif k in counted:  # the bracket missed
                missed.add(k)
                open_[k] *= 4
                inside[k] = (None, None)
            else:  # too wide: a narrower bracket
                open_[k] /= 8
                inside[k] = (None, None)
    return out


def totals_large(totals, open_: dict[int, float], most: int) -> bool:
    """True if a bracket may hold more rows than may be counted by value."""
    return any(2 * slack * totals[f"n{k}"] > most for k, slack in open_.items())


def _at_rank(counted: list[tuple[float | None, int]], level: float, n: int) -> float | None:
    """The quantile from (value, times) inside a bracket, the rows below it under None; None if the bracket misses it."""
    place = level * (n - 1)
    first, last = math.floor(place), min(math.floor(place) + 1, n - 1)
    before = sum(times for x, times in counted if x is None)
    found: list[float | None] = [None, None]
    if first < before:
        return None
    for value, times in sorted(c for c in counted if c[0] is not None):
        for i, rank in enumerate((first, last)):
            if before <= rank < before + times:
                found[i] = value
        before += times
    return None if None in found else found[0] + (found[1] - found[0]) * (place - first)


def quantile(df: DataFrame, x: Column, level: float, most: int = 100_000) -> float | None:
    """The exact quantile of a whole column; see ``quantiles``."""
    return quantiles(df, [(x, level)], most)[0]


@dataclass(frozen=True)
class Scaling:
    """``out``: ``x`` transformed and scaled to 0-1.

    ``fixed`` bounds win; else ``limits`` are quantile levels, None the least or
    greatest value. ``nonzero`` leaves zeros out of the bounds, ``until`` takes
    them from the years up to a reference year, ``since`` from the years from one on.
    """

    x: str
    out: str
    limits: tuple[float | None, float | None] = (None, None)
    fixed: tuple[float | None, float | None] = (None, None)
    nonzero: bool = False
    until: int | None = None
    since: int | None = None
    transform: str = "identity"

    @property
    def value(self) -> Column:
        return TRANSFORMS[self.transform](F.col(self.x).cast("double"))

    @property
    def counting(self) -> Column:
        where = F.lit(True)
        if self.nonzero:
            where = where & (self.value != 0)
        if self.until is not None:
            where = where & (F.col("year") <= self.until)
        if self.since is not None:
            where = where & (F.col("year") >= self.since)
        return F.when(where, self.value)


def all_bounds(df: DataFrame, scalings: list[Scaling]) -> list[tuple[float | None, float | None]]:
    """The bounds of many scalings together: one pass for least and greatest values, two for all quantiles."""
    plain = [(i, end) for i, s in enumerate(scalings) for end in (0, 1) if s.fixed[end] is None and s.limits[end] is None]
    levels = [(i, end) for i, s in enumerate(scalings) for end in (0, 1) if s.fixed[end] is None and s.limits[end] is not None]
    found = {(i, end): s.fixed[end] for i, s in enumerate(scalings) for end in (0, 1)}
    if plain:
        row = df.agg(*[(F.max if end else F.min)(scalings[i].counting).alias(f"b{n}") for n, (i, end) in enumerate(plain)]).first()
        found.update({at: row[n] for n, at in enumerate(plain)})
    if levels:
        found.update(zip(levels, quantiles(df, [(scalings[i].counting, scalings[i].limits[end]) for i, end in levels]), strict=True))
    return [(found[i, 0], found[i, 1]) for i in range(len(scalings))]


def scaled_all(df: DataFrame, scalings: list[Scaling], bounds_of: DataFrame | None = None) -> DataFrame:
    """``df`` with all scalings, whose bounds are found together, in ``bounds_of`` if given."""
    ends = all_bounds(bounds_of if bounds_of is not None else df, scalings)
    missing = F.lit(None).cast("double")
    return df.withColumns({
        s.out: missing if low is None or high is None else rescale(s.value, F.lit(float(low)), F.lit(float(high)))
        for s, (low, high) in zip(scalings, ends, strict=True)
    })


def scaled(df: DataFrame, x: str, out: str, limits=(None, None), fixed=(None, None), bounds_of: DataFrame | None = None, **settings) -> DataFrame:
    """One scaling; see ``Scaling`` for the settings."""
    return scaled_all(df, [Scaling(x, out, limits, fixed, **settings)], bounds_of)


def scaled_within(df: DataFrame, x: str, out: str, by: list[str]) -> DataFrame:
    """Min-max scaling within groups; the bounds are a small grouped aggregate joined back."""
    ends = few(df.groupBy(*by).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")))
    return df.join(ends, by).withColumn(out, rescale(F.col(x), F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


#: Slices that a group's range of values is cut into, and how often.
SLICES, ROUNDS = 1024, 2


def grouped_quantile(df: DataFrame, by: list[str], x: str, level: float, out: str) -> DataFrame:
    """(by, out): the exact quantile of ``x`` in each group, between its two neighbours in order as ``percentile`` has it.

    A group's range is cut into slices whose counts, least and greatest values combine before the shuffle; the slice that
    holds the wanted places is cut again. When both places are in different slices the answer is there; otherwise the
    distinct values of what is left are counted. So no task sees a group's values, however many rows it has. ``df`` is
    read once for each round and once more: store it before.
    """
    rows = df.where(F.col(x).isNotNull()).select(*by, F.col(x).cast("double").alias("_x"))
    place = (F.col("_n") - 1) * F.lit(float(level))
    state = rows.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count("*").alias("_n"))
    state = state.select(
        *by, F.floor(place).alias("_k"), F.ceil(place).alias("_l"), (place - F.floor(place)).alias("_part"), "_lo", "_hi", F.lit(0).cast("long").alias("_before"), F.lit(False).alias("_done")
    )
    carried = ["_k", "_l", "_part", "_lo", "_hi", "_before", "_done"]
    # A group that is done keeps the rows of one value only, so that it stays in the table.
    inside = lambda state: rows.join(state, by).where("_x between _lo and _hi and (not _done or _x = _lo)")
    line = Window.partitionBy(*by)
    for _ in range(ROUNDS):
        at = F.coalesce(F.least(F.floor(F.try_divide(F.col("_x") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * SLICES), F.lit(SLICES - 1)), F.lit(0))
        sliced = inside(state).groupBy(*by, *carried, at.alias("_s")).agg(F.count("*").alias("_c"), F.min("_x").alias("_a"), F.max("_x").alias("_b"))
        end = F.col("_before") + F.sum("_c").over(line.orderBy("_s").rowsBetween(Window.unboundedPreceding, 0))
        placed = sliced.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_c"))
        holds = lambda k: F.col(k).between(F.col("_start"), F.col("_end") - 1)
        first, last = (F.max(F.when(holds(k), F.struct("_start", "_a", "_b"))).alias(name) for k, name in (("_k", "_f"), ("_l", "_g")))
        found = placed.groupBy(*by, *carried).agg(first, last)
        # Places in two slices: the last value of one and the first of the other are the answer.
        apart = F.col("_done") | (F.col("_f._start") != F.col("_g._start"))
        low = F.when(F.col("_done"), F.col("_lo")).when(apart, F.col("_f._b")).otherwise(F.col("_f._a"))
        high = F.when(F.col("_done"), F.col("_hi")).when(apart, F.col("_g._a")).otherwise(F.col("_g._b"))
        state = found.select(*by, "_k", "_l", "_part", low.alias("_lo"), high.alias("_hi"), F.coalesce("_f._start", F.col("_before")).alias("_before"), apart.alias("_done"))
    left = inside(state).groupBy(*by, *carried, "_x").agg(F.count("*").alias("_c"))
    end = F.col("_before") + F.sum("_c").over(line.orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    at = lambda k: F.min(F.when(F.col("_end") > F.col(k), F.col("_x")))
    placed = left.withColumn("_end", end).groupBy(*by, "_part", "_done", "_lo", "_hi").agg(at("_k").alias("_from"), at("_l").alias("_to"))
    low, high = (F.when(F.col("_done"), F.col(a)).otherwise(F.col(b)) for a, b in (("_lo", "_from"), ("_hi", "_to")))
    return placed.select(*by, (low + (high - low) * F.col("_part")).alias(out))


def thresholds_by_time(df: DataFrame, x: str, quantile: float, steps: int) -> DataFrame:
    """Per quarter the rolling mean, over ``steps`` quarters, of an upper quantile of ``x``.

    The level is 1 - (share of values that aren't zero) * (1 - quantile), so
    that many zeros don't hide the top. NULL in the first steps. ``df`` is read
    several times: store it before.
    """
    rows = df.select("year", "quarter", F.col(x).cast("double").alias("_x"))
    share = rows.agg(F.avg((F.col("_x") != 0).cast("double"))).first()[0] or 0.0
    quarters = rows.select("year", "quarter").distinct()
    per = quarters.join(grouped_quantile(rows, ["year", "quarter"], "_x", 1 - share * (1 - quantile), "_q"), ["year", "quarter"], "left")
    # One row a quarter: the window's single partition is as long as the calendar.
    line = Window.orderBy("year", "quarter").rowsBetween(1 - steps, 0)
    return per.withColumn("threshold", F.when(F.count("_q").over(line) >= steps, F.avg("_q").over(line))).drop("_q")


def capped_by_time(df: DataFrame, x: str, out: str, quantile: float, steps: int = 8) -> DataFrame:
    """Cap ``x`` at its quarter's threshold, then scale within each year; NULL without a threshold.

    ``df`` is computed once and stored with all its columns: leave out before what isn't needed.
    """
    df = cut(df)
    limits = few(thresholds_by_time(df, x, quantile, steps))
    capped = df.join(limits, ["year", "quarter"]).withColumn("_c", F.when(F.col("threshold").isNotNull() & F.col(x).isNotNull(), F.least(x, "threshold")))
    return scaled_within(capped, "_c", out, ["year"]).drop("_c", "threshold")


def exposure_layer(df: DataFrame, density: str, out: str, until: int) -> DataFrame:
    """Log density scaled up to its 99th percentile in the reference years."""
    return scaled(df, density, out, (None, 0.99), until=until, transform="log1p")


def exposed(df: DataFrame, x: str, exposure: str, out: str) -> DataFrame:
    """A score times exposure, logged and scaled to the 99.9th percentile of what isn't zero."""
    return exposed_all(df, {x: out}, exposure)


def exposed_all(df: DataFrame, scores: dict[str, str], exposure: str) -> DataFrame:
    """Many scores (name: name of the result) times exposure, as ``exposed``; all bounds are found together."""
    products = df.withColumns({f"_p_{out}": F.col(x) * F.col(exposure) for x, out in scores.items()})
    scalings = [Scaling(f"_p_{out}", out, (0.0, 0.999), nonzero=True, transform="log1p") for out in scores.values()]
    return scaled_all(products, scalings).drop(*[s.x for s in scalings])
