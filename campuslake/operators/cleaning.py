"""Bronze to silver: one cleaner per source table.

Rows are de-duplicated first and filtered afterwards, because the surviving row decides
whether its key stays. Only filters on the key itself move ahead of the de-duplication,
where they cannot change the result and drop rows before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_number, iso_date, mention
from ..functions.labels import PASS_MARK
from ..sources.csv_files import CORRUPT
from ..schemas import TABLES
from .dedup import keep_one

MIN_MARK, MAX_MARK = 0, 20

#: Looks at the rows that are left of each key before others are filtered out.
Watch = Callable[[DataFrame], DataFrame]


def _with_key(df: DataFrame, table: str) -> DataFrame:
    return df.where(F.col(TABLES[table].key[0]).isNotNull())


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def _one_per_key(df: DataFrame, table: str) -> DataFrame:
    return keep_one(df, TABLES[table].key)


def _valid_mark(df: DataFrame, name: str) -> DataFrame:
    mark = as_number(df, name)
    return df.where(mark.isNotNull() & mark.between(MIN_MARK, MAX_MARK)).withColumn(name, mark)


def clean_students(df: DataFrame, watch: Watch = _as_it_is) -> DataFrame:
    """Known students with a program; names, gender and e-mail normalised."""
    kept = watch(_one_per_key(_with_key(df, "students"), "students")).where(F.col("program_id").isNotNull())
    return kept.withColumns(
        {
            "first_name": F.trim("first_name"),
            "last_name": F.trim(F.upper("last_name")),
            "gender": F.upper("gender"),
            "email": F.lower(F.trim("email")),
            "registration_date": iso_date(kept, "registration_date"),
        }
    )


def clean_programs(df: DataFrame) -> DataFrame:
    """One row per program; a NULL id survives as one row."""
    return _one_per_key(df, "programs")


def clean_modules(df: DataFrame) -> DataFrame:
    """One row per module id; rows without an id are dropped."""
    return _one_per_key(_with_key(df, "modules"), "modules")


def clean_semesters(df: DataFrame) -> DataFrame:
    """One row per (semester, academic year, cohort)."""
    # Orders repeat whole rows: these meet in tasks, without a sort of all of them.
    return _one_per_key(df.distinct(), "semesters")


def clean_grades(df: DataFrame, watch: Watch = _as_it_is) -> DataFrame:
    """Grades between 0 and 20, with their mention and pass flag."""
    valid = _valid_mark(watch(_one_per_key(df, "grades")), "grade")
    grade = F.col("grade")
    return valid.withColumns({"mention": mention(grade), "is_passed": grade >= PASS_MARK})


def clean_absences(df: DataFrame, watch: Watch = _as_it_is) -> DataFrame:
    """Absences of more than zero hours, with a parsed date and a boolean justification."""
    unique = watch(_one_per_key(df, "absences"))
    hours = as_number(unique, "hours")
    return unique.where(hours > 0).withColumns(
        {
            "hours": hours,
            "absence_date": iso_date(unique, "absence_date"),
            "is_justified": F.coalesce(F.upper("justified") == "YES", F.lit(False)),
        }
    )


def clean_activities(df: DataFrame, watch: Watch = _as_it_is) -> DataFrame:
    """Activities scored between 0 and 20, with a parsed date."""
    valid = _valid_mark(watch(_one_per_key(df, "activities")), "score")
    return valid.withColumn("activity_date", iso_date(valid, "activity_date"))


def clean_registrations(df: DataFrame) -> DataFrame:
    """Registrations of a known student id, with a parsed date."""
    kept = _one_per_key(df, "registrations").where(F.col("student_id").isNotNull())
    return kept.withColumn("registration_date", iso_date(kept, "registration_date"))


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "students": clean_students,
    "programs": clean_programs,
    "modules": clean_modules,
    "semesters": clean_semesters,
    "grades": clean_grades,
    "absences": clean_absences,
    "activities": clean_activities,
    "registrations": clean_registrations,
}


def clean(table: str, df: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Apply the cleaner of ``table``; the text of malformed lines stays in the raw table.

    ``watch`` sees one row per key of a table that is profiled.
    """
    return CLEANERS[table](df.drop(CORRUPT), *([watch] if watch else []))
