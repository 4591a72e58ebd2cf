"""How robust an index is: correlations, overlaps, leaving components out."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.combine import Aggregate, Index, evaluate
from riskweave.operators.scale import quantiles


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r, n) for every pair, on the rows that have both; one pass over the data."""
    pairs = list(combinations(columns, 2))
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    aggs = [F.corr(F.when(both(a, b), F.col(a)), F.when(both(a, b), F.col(b))).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    aggs += [F.count(F.when(both(a, b), 1)).alias(f"n{i}") for i, (a, b) in enumerate(pairs)]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(rows).alias("p")).select("p.*")


def with_t(correlated: DataFrame) -> DataFrame:
    """Adds the t statistic of each correlation."""
    return correlated.withColumn("t", F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r"))))


#: Degrees of freedom up to which the tail of t is summed term by term.
MANY = 2_000


def with_p(correlated: DataFrame) -> DataFrame:
    """Adds ``p``, the chance of a correlation as far from 0 among uncorrelated normal values; NULL below four rows.

    It is the tail of Student's t with n - 2 degrees of freedom, whose distribution for whole degrees is a finite sum of
    powers of the cosine of atan(t / sqrt(n - 2)), each term the one before times a ratio. Beyond MANY rows it is the
    tail of the normal value that Wallace's transformation makes of t, whose error there is far below the sum's rounding.
    """
    df = F.col("n") - 2
    r2 = F.least(F.col("r") * F.col("r"), F.lit(1.0))
    sin, cos2 = F.abs("r"), 1 - r2
    angle = F.asin(F.least(sin, F.lit(1.0)))
    steps = lambda start, upto: F.filter(F.sequence(F.lit(start), F.greatest(upto, F.lit(start))), lambda k: k <= upto)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(ratio):
        def step(s, k):
            term = s["term"] * cos2 * ratio(k)
            return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

        return step

    count = F.least(F.floor(df / 2) - 1, F.lit(MANY // 2)).cast("int")
    odd = F.aggregate(steps(1, count), start, add(lambda k: (2.0 * k) / (2.0 * k + 1)))["sum"]
    even = F.aggregate(steps(1, count), start, add(lambda k: (2.0 * k - 1) / (2.0 * k)))["sum"]
    inside = F.when(df % 2 == 0, sin * even).when(df == 1, 2 / math.pi * angle).otherwise(2 / math.pi * (angle + sin * F.sqrt(cos2) * odd))
    normal = F.sqrt(-df * F.log1p(-F.least(r2, F.lit(1 - 1e-16)))) * (8 * df + 1) / (8 * df + 3)  # df * ln(1 + t^2 / df) of the t of r
    tail = F.when(df <= MANY, F.greatest(1 - inside, F.lit(0.0))).otherwise(normal_tail(normal))
    return correlated.withColumn("p", F.when(df >= 2, tail))


def normal_tail(z: Column) -> Column:
    """The chance that a standard normal value lies further than z >= 0 from 0: a series below 2.8, a continued fraction from there on."""
    u = z / math.sqrt(2)
    steps = F.sequence(F.lit(1), F.lit(80))
    first = F.struct(u.alias("term"), u.alias("sum"))

    def add(s: Column, k: Column) -> Column:
        term = -s["term"] * u * u / k
        return F.struct(term.alias("term"), (s["sum"] + term / (2 * k + 1)).alias("sum"))

    series = 1 - 2 / math.sqrt(math.pi) * F.aggregate(steps, first, add)["sum"]
    fraction = F.exp(-u * u) / math.sqrt(math.pi) / (u + F.aggregate(F.reverse(steps), F.lit(0.0), lambda f, k: k / 2.0 / (u + f)))
    return F.when(u < 2, series).otherwise(fraction)


def by_size(summaries: DataFrame) -> DataFrame:
    """A summary's rows in falling order of mean absolute change; one row a part."""
    return summaries.orderBy(F.desc("mean_abs"), "left_out")

def same_group(a: str, b: str, parts: int = 1) -> bool:
    """True for component ids that share their first ``parts`` words."""
    return a.split("_")[:parts] == b.split("_")[:parts]


def overlap_classes(df: DataFrame, first: str, second: str, both: str, level: float) -> DataFrame:
    """``overlap``: 5 if all three scores are in their top share, 4 and 3 if the combined and one other are,
    2 if both others are, 1 if any is, else 0."""
    cuts = quantiles(df, [(F.col(c), level) for c in (first, second, both)])
    a, b, c = (F.coalesce(F.col(x) >= F.lit(v), F.lit(False)) for x, v in zip((first, second, both), cuts, strict=True))
    return df.withColumn("overlap", F.when(a & b & c, 5).when(a & c, 4).when(b & c, 3).when(a & b, 2).when(a | b | c, 1).otherwise(0))


def leave_one_out(df: DataFrame, spec: Aggregate, keys: list[str]) -> DataFrame:
    """(keys, left_out, delta): the change of a score when each part is left out, in one row set.

    All variants are columns of one plan, and their bounds one pass over the input.
    """
    names = list(spec.parts)
    shorter = []
    for i, part in enumerate(names):
        short = spec.without(part)
        shorter.append(Aggregate(f"_loo{i}", short.parts, short.method, short.level, short.rescale))
    full = evaluate(df, Index((spec, *shorter)))
    rows = F.array(*[F.struct(F.lit(p).alias("left_out"), (F.col(f"_loo{i}") - F.col(spec.name)).alias("delta")) for i, p in enumerate(names)])
    return full.select(*keys, F.explode(rows).alias("v")).select(*keys, "v.*")


def leave_out(df: DataFrame, index: Index, part: str) -> DataFrame:
    """All scores of an index recomputed without one component anywhere."""
    kept = tuple(a.without(part) for a in index.aggregates if a.name != part and set(a.parts) != {part})
    return evaluate(df, Index(kept))


def summary(deltas: DataFrame) -> DataFrame:
    """Per left-out part the mean and deviation of signed and absolute changes."""
    size = F.abs("delta")
    return deltas.groupBy("left_out").agg(
        F.avg("delta").alias("mean"), F.stddev_samp("delta").alias("sd"), F.avg(size).alias("mean_abs"), F.stddev_samp(size).alias("sd_abs")
    )


def impact(deltas: DataFrame, keys: list[str]) -> DataFrame:
    """Per row the least and greatest change and their deviation over all runs."""
    return deltas.groupBy(*keys).agg(F.min("delta").alias("lowest"), F.max("delta").alias("highest"), F.stddev_samp("delta").alias("sd"))


def histogram(df: DataFrame, x: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n) with bins counted from 1; the upper end belongs to the last."""
    at = F.least(F.width_bucket(F.col(x), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return df.where(F.col(x).between(low, high)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def snapshot(df: DataFrame, entity: list[str], order: list[str], columns: list[str], at) -> DataFrame:
    """One time step of a panel after filling gaps forward."""
    w = Window.partitionBy(*entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns}).where(at)
