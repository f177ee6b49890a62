"""Number helpers as Column expressions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.session import ship_package

SNAP_DIGITS = 12


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snap(c: Column | str) -> Column:
    """Drop the digits that depend on the order in which partitions were summed."""
    factor = 10.0**SNAP_DIGITS
    return F.round(col(c) * factor) / factor


def round_half_up(c: Column | str, digits: int) -> Column:
    """SQL rounding of a double: half away from zero after ``snap``."""
    factor = 10.0**digits
    return F.round(snap(c) * factor) / factor


def round_half_even(c: Column | str, digits: int) -> Column:
    """Rounding of the feature and scoring code: half to even."""
    factor = 10.0**digits
    return F.rint(snap(col(c)) * factor) / factor


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; null when the denominator is 0 or null."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def finite(c: Column | str) -> Column:
    """NaN and infinities become null."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def band(c: Column, steps: Sequence[tuple[float, str]], otherwise: str, above: bool = True) -> Column:
    """Label by the first step whose limit is met: ``c >= limit``, or ``c < limit`` if not above."""
    first, *rest = [((c >= limit) if above else (c < limit), label) for limit, label in steps]
    chain = F.when(first[0], F.lit(first[1]))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def as_int(condition: Column) -> Column:
    """Boolean to 0/1; null stays null."""
    return condition.cast("int")


def flag(condition: Column) -> Column:
    """Boolean to 0/1; null counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def rows() -> Column:
    return F.count(F.lit(1))


def count_if(condition: Column) -> Column:
    """Number of rows where the condition is true; 0 for an empty group."""
    return F.count(F.when(condition, F.lit(1)))


def nulls_in(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def any_missing(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def student_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t, an incomplete beta function: its continued fraction is
    evaluated from the front until a step no longer changes it."""
    if math.isnan(t) or not dof > 0:
        return math.nan
    a, b, x = dof / 2, 0.5, dof / (dof + t * t)
    if x in (0.0, 1.0):
        return x
    turned = x > (a + 1) / (a + b + 2)  # the fraction converges on the side of the mean
    if turned:
        a, b, x = b, a, 1 - x
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    fraction, upper, lower = 1.0, 1.0, 0.0
    for k in range(10_000):
        n = k // 2
        if k == 0:
            part = 1.0
        elif k % 2 == 0:
            part = n * (b - n) * x / ((a + 2 * n - 1) * (a + 2 * n))
        else:
            part = -(a + n) * (a + b + n) * x / ((a + 2 * n) * (a + 2 * n + 1))
        lower = 1 / ((1 + part * lower) or 1e-300)
        upper = (1 + part / upper) or 1e-300
        fraction *= upper * lower
        if k and abs(1 - upper * lower) < 1e-15:
            break
    share = math.exp(front) / a * (fraction - 1)
    return min(1.0, max(0.0, 1 - share if turned else share))


def with_student_p(rows: DataFrame, t: str, dof: str, name: str) -> DataFrame:
    """Add the two-sided p-value to a small table with a t statistic and its degrees of freedom."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pairs = zip(frame[t].astype(float), frame[dof].astype(float), strict=True)
            yield frame.assign(**{name: [student_p(x, d) for x, d in pairs]})

    ship_package(rows.sparkSession)
    return rows.mapInPandas(add, ", ".join(f"`{n}` {kind}" for n, kind in [*rows.dtypes, (name, "double")]))
