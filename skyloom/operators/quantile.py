"""Exact quantiles of a whole column without gathering it: a sketch brackets the rank, counts narrow the bracket."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that may reach the driver at once (half a MB).
FEW = 1 << 16
#: The sketch's ranks are off by at most 1 / ACCURACY of the values that it saw.
ACCURACY = 10_000


def _between(low: float | None, high: float | None) -> Column:
    """low < v < high, a bound of None being none."""
    out = F.lit(True)
    if low is not None:
        out = out & (F.col("v") > F.lit(low))
    return out if high is None else out & (F.col("v") < F.lit(high))


def order_statistic(values: DataFrame, rank: int, n: int, few: int = FEW) -> float:
    """The value of ``rank`` (from 0) among the ``n`` finite ones of column v.

    Each pass brackets the rank by two values from a mergeable sketch, counts the values below, at and between them,
    and goes on with those strictly between: about 4 / ACCURACY of the last ones. So 10^12 values take three passes; a
    value that many rows share is found by its count, and at most ``few`` values come to the driver.
    """
    low = high = None
    below, inside = 0, n
    while inside > few:
        part = values.where(_between(low, high))
        at, margin = (rank - below + 0.5) / inside, 2 / ACCURACY
        x, y = part.agg(F.percentile_approx("v", [max(at - margin, 0.0), min(at + margin, 1.0)], F.lit(ACCURACY))).first()[0]
        v = F.col("v")
        less, at_x, between, at_y = part.agg(F.count_if(v < x), F.count_if(v == x), F.count_if((v > x) & (v < y)), F.count_if((v == y) & (v > x))).first()
        place = rank - below
        if place < less:
            high, inside = x, less
        elif place < less + at_x:
            return float(x)
        elif place < less + at_x + between:
            low, high, below, inside = x, y, below + less + at_x, between
        elif place < less + at_x + between + at_y:
            return float(y)
        else:
            low, below, inside = y, below + less + at_x + between + at_y, inside - less - at_x - between - at_y
    return float(sorted(row.v for row in values.where(_between(low, high)).collect())[rank - below])  # at most ``few``


def exact_quantile(df: DataFrame, value: Column, p: float = 0.5, few: int = FEW) -> float | None:
    """What ``percentile(value, p)`` gives (linear between the two nearest ranks), for one column of any size.

    ``df`` is read several times: stage what is costly. Nulls are left out; nan is greater than all numbers, infinities
    are values like others; without values the result is null.
    """
    rows = df.select(value.cast("double").alias("v")).where("v is not null")
    n, number = rows.agg(F.count(F.lit(1)), F.count_if(~F.isnan("v"))).first()
    if not n:
        return None
    rows = rows.where(~F.isnan("v"))
    at = (n - 1) * p
    first = math.floor(at)
    if first >= number:
        return math.nan
    lower = order_statistic(rows, first, number, few)
    if at == first:
        return lower
    reach, above = rows.agg(F.count_if(F.col("v") <= lower), F.min(F.when(F.col("v") > lower, F.col("v")))).first()
    upper = lower if reach > first + 1 else above if above is not None else math.nan
    return lower if lower == upper else (first + 1 - at) * lower + (at - first) * upper
