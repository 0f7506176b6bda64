"""The row-level joins between cleaned tables.

Fact tables may hold a third of their rows under one student or module, so the joins that
move fact rows go through :func:`split_join`, which spreads such keys over many tasks.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Pieces are at least this fine, so that small settings of the session do not hide hot keys.
MIN_PIECES = 500
# Counters of a summary for each key that may be hot: its counts are then off by a fraction of a
# share. Spark allows so many in all.
TRACKED_PER_HOT = 16
MOST_TRACKED = 1_000_000


def fair_share(spark: SparkSession) -> float:
    """Share of all rows that one task should get: one shuffle partition's worth."""
    return 1 / max(MIN_PIECES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(rows: DataFrame, key: str, share: float | None = None) -> dict[int, int]:
    """Into how many pieces to split the keys that may hold more than ``share`` of all rows, by their hash.

    One pass over the key column with a mergeable summary of its heavy hitters: a task hands on
    some thousands of counters however many keys there are. Every key above the share is among
    them, with its count or somewhat more; a key that is named without need is only split without
    need. At most about ``1 / share`` keys are named, which bounds what :func:`split_join` broadcasts.
    """
    share = share or fair_share(rows.sparkSession)
    tracked = min(MOST_TRACKED, ceil(TRACKED_PER_HOT / share))
    top = F.expr(f"approx_top_k(_key, {min(tracked, ceil(2 / share))}, {tracked})")
    hashes = rows.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_key"))
    found = hashes.agg(top.alias("top"), F.count("_key").alias("rows")).first()
    limit = found["rows"] * share
    return {r["item"]: ceil(r["count"] / limit) for r in found["top"] if r["count"] > limit}


def split_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread: str,
    share: float | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Inner equi-join on ``key`` that no single hot key can hold up; the result is exact.

    Rows of a hot key are dealt to numbered pieces by the hash of ``spread`` (a column that
    varies within the key, such as the fact's own id; ``facts`` must give the same rows each time), and only the dimension rows of hot
    keys are repeated, once per piece. Every other key is joined as usual, and where no key is hot
    this is a plain join. ``keys`` may name cheaper rows to look for hot keys in, such as the stored
    rows that ``facts`` are cleaned from.
    """
    known, wanted = facts.where(F.col(key).isNotNull()), dimension.where(F.col(key).isNotNull())
    pieces = hot_keys(facts if keys is None else keys, key, share)
    if not pieces:
        return known.join(wanted, key)
    hot = F.broadcast(facts.sparkSession.createDataFrame(list(pieces.items()), "_hot long, _pieces int"))
    dealt = (
        known.withColumn("_hot", F.xxhash64(key))
        .join(hot, "_hot", "left")
        .withColumn(
            "_piece",
            F.coalesce(F.pmod(F.xxhash64(spread), F.col("_pieces")).cast("int"), F.lit(0)),
        )
        .drop("_hot", "_pieces")
    )
    last_piece = F.coalesce(F.col("_pieces"), F.lit(1)) - 1
    repeated = (
        wanted.withColumn("_hot", F.xxhash64(key))
        .join(hot, "_hot", "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), last_piece)))
        .drop("_hot", "_pieces")
    )
    return dealt.join(repeated, [key, "_piece"]).drop("_piece")


# ``keys`` in the functions below: see :func:`split_join`.


def grades_with_modules(grades: DataFrame, modules: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Each grade with its module; grades of unknown modules drop out."""
    return split_join(grades, modules, "module_id", "grade_id", keys=keys)


def absences_with_students(absences: DataFrame, students: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Each absence with its student; absences of unknown students drop out."""
    return split_join(absences, students, "student_id", "absence_id", keys=keys)


def activities_with_programs(activities: DataFrame, students: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Each activity with its student's program and level."""
    slim = students.select("student_id", "program_id", "current_level")
    return split_join(activities, slim, "student_id", "activity_id", keys=keys)


def semester_grades(grades: DataFrame, modules: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Grades placed in the semester and program of their module."""
    placement = modules.select("module_id", "program_id", "semester_id")
    slim = grades.select("grade_id", "student_id", "module_id", "grade", "academic_year", "cohort_year")
    return split_join(slim, placement, "module_id", "grade_id", keys=keys).select(
        "student_id", "grade", "academic_year", "cohort_year", "program_id", "semester_id"
    )


def students_with(students: DataFrame, per_student: DataFrame) -> DataFrame:
    """Students with measures of at most one row per student, NULL where there are none."""
    return students.join(per_student, "student_id", "left")


def performance_with_hours(performance: DataFrame, absenteeism: DataFrame) -> DataFrame:
    """Students with their hours per academic year: one row per student and year."""
    yearly = absenteeism.select("student_id", F.col("total_hours_absent").alias("hours_absent"))
    return performance.join(yearly, "student_id", "left")


def semester_with_absences(grade_stats: DataFrame, absence_stats: DataFrame) -> DataFrame:
    """Semester results next to the semester's absences; unmatched measures stay NULL."""
    return grade_stats.join(absence_stats, ["semester_id", "academic_year"], "left").select(
        *grade_stats.columns, *[c for c in absence_stats.columns if c not in ("semester_id", "academic_year")]
    )
