"""Generated registrations, for trying the database source without a database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the documented seed.
PROGRAMS = ("BDCC", "CCN", "GLSID")
STATUSES = ("Inscrit", "Redoublant", "Transfert")
ACADEMIC_YEAR = "2023-2024"
FIRST_DAY = "2023-09-01"


def _pick(values: tuple[str, ...], number: str):
    position = (F.col(number) % len(values) + 1).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), position)


def registrations_from_series(series: DataFrame, number: str = "id") -> DataFrame:
    """One registration per number of ``series``, e.g. of ``spark.range(1, 359)``."""
    n = F.col(number)
    digits = n.cast("string")
    # At least four digits; lpad alone would cut longer numbers and merge their students.
    padded = F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))
    return series.select(
        n.cast("int").alias("registration_id"),
        F.concat(F.lit("STU-"), padded).alias("student_id"),
        _pick(PROGRAMS, number).alias("program_id"),
        F.lit(ACADEMIC_YEAR).alias("academic_year"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (n % 30).cast("int")).alias("registration_date"),
        _pick(STATUSES, number).alias("status"),
        (n % 2 == 0).alias("tuition_paid"),
    )
