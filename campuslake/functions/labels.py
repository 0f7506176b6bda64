"""Threshold ladders that turn a number into a label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PASS_MARK = 10

# The labels and thresholds of the published tables.
MENTIONS = ((16, "Très Bien"), (14, "Bien"), (12, "Assez Bien"), (10, "Passable"))
LOWEST_MENTION = "Insuffisant"
CATEGORIES = ((14, "Excellent"), (12, "Bon"), (10, "Passable"))
AT_RISK = "En difficulté"
BANDS = ((5, "Très faible (0-5h)"), (15, "Faible (6-15h)"), (30, "Modéré (16-30h)"))
HIGHEST_BAND = "Élevé (>30h)"


def _first_match(conditions: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    matches = [F.when(condition, F.lit(label)) for condition, label in conditions]
    return F.coalesce(*matches, F.lit(otherwise))


def mention(grade: Column) -> Column:
    """Honours label of one grade."""
    return _first_match([(grade >= low, label) for low, label in MENTIONS], LOWEST_MENTION)


def performance_category(average: Column) -> Column:
    """Category of a student's rounded average; a missing average is at risk."""
    return _first_match([(average >= low, label) for low, label in CATEGORIES], AT_RISK)


def absence_band(hours: Column, null_band: str | None = None) -> Column:
    """Absence band of a number of hours.

    A missing number of hours lands in the highest band, as in the published table;
    pass ``null_band`` to give it a label of its own.
    """
    band = _first_match([(hours <= high, label) for high, label in BANDS], HIGHEST_BAND)
    if null_band is None:
        return band
    return F.when(hours.isNull(), F.lit(null_band)).otherwise(band)
