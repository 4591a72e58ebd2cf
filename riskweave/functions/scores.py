"""Row-wise score arithmetic. NULL is the only missing marker."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, low=None, high=None) -> Column:
    """Bound ``x``; a missing value stays missing, which bare least and greatest would fill."""
    bounded = x
    if low is not None:
        bounded = F.greatest(bounded, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        bounded = F.least(bounded, high if isinstance(high, Column) else F.lit(high))
    return F.when(x.isNotNull(), bounded)


def rescale(x: Column, low, high) -> Column:
    """(x - low) / (high - low) after clipping; NULL where the bounds meet."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.try_divide(clip(x, low, high) - low, high - low)


def row_sum(*xs: Column) -> Column:
    """The sum of what is there; 0 if nothing is."""
    return reduce(lambda a, b: a + b, (F.coalesce(x, F.lit(0.0)) for x in xs))


def row_mean(*xs: Column) -> Column:
    """The mean of what is there; NULL if nothing is."""
    n = reduce(lambda a, b: a + b, (x.isNotNull().cast("int") for x in xs))
    return F.try_divide(row_sum(*xs), n)


def _present(parts: list[tuple[Column, float]], value) -> tuple[Column, Column]:
    total = reduce(lambda a, b: a + b, (F.when(x.isNotNull(), value(x) * w).otherwise(0.0) for x, w in parts))
    weight = reduce(lambda a, b: a + b, (F.when(x.isNotNull(), float(w)).otherwise(0.0) for x, w in parts))
    return total, weight


def combined(method: str, parts: list[tuple[Column, float]], missing: str = "omit") -> Column:
    """Weighted ``mean``, ``gmean`` or ``pmean`` (power 2) of (column, weight) pairs.

    ``missing`` is "omit", which averages what is there, or "propagate", which
    gives NULL if anything is missing. A zero makes the geometric mean zero.
    """
    if method not in METHODS:
        raise ValueError(f"no such mean: {method}; there are {sorted(METHODS)}")
    out = METHODS[method](parts)
    if missing == "propagate":
        there = reduce(lambda a, b: a & b, (x.isNotNull() for x, _ in parts))
        return F.when(there, out)
    return out


def _mean(parts: list[tuple[Column, float]]) -> Column:
    return F.try_divide(*_present(parts, lambda x: x))


def _gmean(parts: list[tuple[Column, float]]) -> Column:
    zero = reduce(lambda a, b: a | b, (F.coalesce(x == 0, F.lit(False)) for x, _ in parts))
    total, weight = _present(parts, lambda x: F.coalesce(F.ln(x), F.lit(0.0)))
    return F.when(zero, 0.0).otherwise(F.exp(F.try_divide(total, weight)))


def _pmean(parts: list[tuple[Column, float]]) -> Column:
    return F.sqrt(F.try_divide(*_present(parts, lambda x: x * x)))


#: Named means; users may add their own, a function from (column, weight) pairs to a column.
METHODS = {"mean": _mean, "gmean": _gmean, "pmean": _pmean}


def humidex(temperature: Column, dewpoint: Column) -> Column:
    """Felt temperature from air temperature and dew point, all in kelvin."""
    vapour = 6.11 * F.exp(5417.753 * (1 / 273.15 - 1 / dewpoint))
    return temperature - 273.15 + 0.5555 * (vapour - 10) + 273.15


def cyclone_energy(knots: Column, hours: Column) -> Column:
    return F.when(knots > 34, knots * knots * 1e-4 * hours / 6)


def storm_class(knots: Column) -> Column:
    return F.when(knots < 34, "TD").when(knots < 64, "TS").when(knots.isNotNull(), "HU")


def development(life: Column, expected: Column, mean_years: Column) -> Column:
    """The mean of health (20-85 years) and schooling (18 and 15 years) indices."""
    school = (clip(expected, high=18.0) / 18 + clip(mean_years, high=15.0) / 15) / 2
    return ((clip(life, 20.0, 85.0) - 20) / 65 + school) / 2


def zero_if_negative(x: Column) -> Column:
    return F.when(x < 0, 0.0).otherwise(x)


def reversed_negative(x: Column) -> Column:
    """Minus x below zero, else 0: dryness from an index whose low values are dry."""
    return F.when(x < 0, -x).when(x.isNotNull(), 0.0)


def without_sentinels(x: Column, *bad: float, below: float | None = None) -> Column:
    """NULL for values that stand for nothing."""
    wrong = x.isin(*bad) if bad else F.lit(False)
    return F.when(~(wrong | (x <= below) if below is not None else wrong), x)


def censored_number(text: Column) -> Column:
    """A number written with a bound, such as <2.5."""
    return F.regexp_replace(text, "[<>]", "").try_cast("double")
