"""Lenient parsing that yields NULL instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_date(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a date: ``yyyy-MM-dd`` text is parsed, anything else becomes NULL."""
    if df.schema[name].dataType.typeName() == "string":
        return F.try_to_date(F.col(name), "yyyy-MM-dd")
    return F.col(name).cast("date")


def as_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a number; text that is not a number becomes NULL."""
    if df.schema[name].dataType.typeName() == "string":
        return F.col(name).try_cast("double")
    return F.col(name)
