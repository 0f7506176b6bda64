"""Aggregate expressions: rounding, rates, weighted means, mergeable deviation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import PASS_MARK


def round_dec(value: Column, places: int) -> Column:
    """Round half up after fixing the value to ten decimal places.

    The order in which partial aggregates merge changes the last bits of a double, and a
    value that sits on a rounding tie would flip between runs. Going through decimal(38,10)
    removes those bits. NaN, infinities and values too large for the decimal stay as they are.
    """
    fixed = F.round(value.try_cast("decimal(38,10)"), places).cast("double")
    return F.coalesce(fixed, value.cast("double"))


def pass_rate(value: Column, rows: Column | None = None) -> Column:
    """Percentage of all rows whose value reaches the pass mark, to one decimal place."""
    rows = F.count(F.lit(1)) if rows is None else rows
    return round_dec(F.count_if(value >= PASS_MARK) / rows * 100, 1)


def weighted_mean(value: Column, weight: Column, places: int = 2) -> Column:
    """Mean of ``value`` weighted by ``weight`` over the rows that have a value."""
    counted = F.when(value.isNotNull(), weight)
    return round_dec(F.sum(value * weight) / F.sum(counted), places)


def merged_stddev(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from a count, a sum and a sum of squares.

    Feed it sums of values shifted towards their middle: a shift leaves the deviation
    unchanged and keeps the subtraction below from losing digits. NULL below two values.
    """
    variance = (squares - total * total / n) / (n - 1)
    return F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))
