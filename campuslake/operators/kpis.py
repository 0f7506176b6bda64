"""Silver to gold: the seven KPI tables.

Cleaned modules and students hold one row per id, so their attributes depend on the id
alone. The KPIs use that to aggregate facts by id *before* the join wherever the measures
allow it: fact rows collapse on the map side, a hot student or module shrinks to a handful
of rows, and only aggregates are shuffled to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import absence_band, merged_stddev, pass_rate, performance_category, round_dec
from ..functions.labels import AT_RISK, PASS_MARK
from . import joins

# Scores lie between 0 and 20; shifting by the middle keeps sums of squares small.
SCORE_MIDDLE = 10.0


def _rows() -> Column:
    return F.count(F.lit(1))


def success_rate(grades: DataFrame, modules: DataFrame) -> DataFrame:
    """Results per module and academic year, both exam sessions together."""
    grade = F.col("grade")
    per_module = grades.groupBy("module_id", "academic_year").agg(
        _rows().alias("nb_grades"),
        round_dec(F.avg(grade), 2).alias("moyenne"),
        round_dec(F.max(grade), 2).alias("grade_max"),
        round_dec(F.min(grade), 2).alias("grade_min"),
        round_dec(F.stddev_samp(grade), 2).alias("ecart_type"),
        pass_rate(grade).alias("taux_reussite_pct"),
    )
    attributes = modules.select("module_id", "module_name", "program_id", "difficulty", "coefficient")
    return per_module.join(attributes, "module_id").select(
        "module_id",
        "module_name",
        "program_id",
        "difficulty",
        "coefficient",
        "academic_year",
        "nb_grades",
        "moyenne",
        "grade_max",
        "grade_min",
        "ecart_type",
        "taux_reussite_pct",
    )


def absenteeism(absences: DataFrame, students: DataFrame) -> DataFrame:
    """Absence hours and counts per student and academic year."""
    justified = F.col("is_justified")
    yearly = absences.groupBy("student_id", "academic_year").agg(
        F.sum("hours").alias("total_hours_absent"),
        _rows().alias("nb_absences"),
        F.count_if(justified).alias("nb_justified"),
        F.count_if(~justified).alias("nb_unjustified"),
    )
    who = students.select("student_id", "first_name", "last_name", "program_id", "current_level")
    return yearly.join(who, "student_id").select(
        "student_id",
        "first_name",
        "last_name",
        "program_id",
        "current_level",
        "academic_year",
        "total_hours_absent",
        "nb_absences",
        "nb_justified",
        "nb_unjustified",
        round_dec(F.col("nb_justified") / F.col("nb_absences") * 100, 1).alias("justification_rate_pct"),
    )


def normal_session_results(grades: DataFrame) -> DataFrame:
    """Each student's results in the normal session; ``nb_modules_enrolled`` counts grade rows."""
    grade = F.col("grade")
    return grades.where(F.col("session") == "Normal").groupBy("student_id").agg(
        round_dec(F.avg(grade), 2).alias("average_grade"),
        _rows().alias("nb_modules_enrolled"),
        F.count_if(grade >= PASS_MARK).alias("nb_modules_passed"),
    )


def hours_per_student(absences: DataFrame) -> DataFrame:
    """Each student's absence hours over all years."""
    return absences.groupBy("student_id").agg(F.sum("hours").alias("total_hours_absent"))


def student_performance(grades: DataFrame, absences: DataFrame, students: DataFrame) -> DataFrame:
    """Each student's results, absence hours (0 if none) and category by rounded average."""
    with_results = joins.students_with(students, normal_session_results(grades))
    with_hours = joins.students_with(with_results, hours_per_student(absences))
    return with_hours.withColumns(
        {
            "total_hours_absent": F.coalesce("total_hours_absent", F.lit(0)),
            "category": performance_category(F.col("average_grade")),
        }
    )


def program_kpis(performance: DataFrame) -> DataFrame:
    """Students, averages and at-risk counts per program and level."""
    average = F.col("average_grade")
    return performance.groupBy("program_id", "current_level").agg(
        _rows().alias("nb_students"),
        round_dec(F.avg(average), 2).alias("avg_grade"),
        pass_rate(average).alias("success_rate_pct"),
        round_dec(F.avg("total_hours_absent"), 1).alias("avg_hours_absent"),
        F.count_if(F.col("category") == AT_RISK).alias("nb_at_risk"),
    )


def activity_summary(activities: DataFrame, students: DataFrame) -> DataFrame:
    """Engagement and score statistics per activity type, platform, program and year.

    Activities collapse to one row per student, type, platform and year before they meet
    the students. A student has one program, so after the join each of those rows is a
    different student of its group and the distinct count is a plain one.
    """
    score = F.col("score")
    shifted = score - SCORE_MIDDLE
    per_student = activities.groupBy("student_id", "activity_type", "platform", "academic_year").agg(
        _rows().alias("n"),
        F.count(score).alias("scored"),
        F.sum(score).alias("total"),
        F.sum(shifted).alias("shifted_total"),
        F.sum(shifted * shifted).alias("shifted_squares"),
        F.max(score).alias("best"),
        F.min(score).alias("worst"),
        F.count_if(score >= PASS_MARK).alias("passed"),
    )
    n, scored = F.sum("n"), F.sum("scored")
    deviation = merged_stddev(scored, F.sum("shifted_total"), F.sum("shifted_squares"))
    return (
        per_student.join(students.select("student_id", "program_id"), "student_id")
        .groupBy("activity_type", "platform", "program_id", "academic_year")
        .agg(
            n.alias("nb_activities"),
            F.count("student_id").alias("nb_students"),
            round_dec(F.sum("total") / F.nullif(scored, F.lit(0)), 2).alias("avg_score"),
            round_dec(F.max("best"), 2).alias("max_score"),
            round_dec(F.min("worst"), 2).alias("min_score"),
            round_dec(deviation, 2).alias("ecart_type"),
            round_dec(F.sum("passed") / n * 100, 1).alias("success_rate_pct"),
        )
    )


def correlation_abs_grades(
    performance: DataFrame, absenteeism: DataFrame, null_band: str | None = None
) -> DataFrame:
    """Results per absence band and program, counted in student-years and sorted."""
    average = F.col("average_grade")
    banded = joins.performance_with_hours(performance, absenteeism).withColumn(
        "absence_category", absence_band(F.col("hours_absent"), null_band)
    )
    return (
        banded.groupBy("absence_category", "program_id")
        .agg(
            _rows().alias("nb_students"),
            round_dec(F.avg(average), 2).alias("avg_grade"),
            pass_rate(average).alias("success_rate_pct"),
            round_dec(F.avg("hours_absent"), 1).alias("avg_hours_absent"),
        )
        .orderBy("program_id", "absence_category")
    )


def semester_absence_stats(absences: DataFrame) -> DataFrame:
    """Absence measures per semester and academic year, over all programs and cohorts."""
    return absences.groupBy("semester_id", "academic_year").agg(
        F.sum("hours").alias("total_hours_absent"),
        round_dec(F.avg("hours"), 2).alias("avg_hours_per_absence"),
        F.count_if(~F.col("is_justified")).alias("nb_unjustified"),
    )


def semester_dashboard(
    grades: DataFrame, absences: DataFrame, modules: DataFrame, keys: DataFrame | None = None
) -> DataFrame:
    """Results per semester, program, year and cohort, beside the semester's absences.

    ``keys``: rows to look for hot modules in, if not the grades themselves (see ``joins.split_join``).
    """
    grade = F.col("grade")
    grade_stats = (
        joins.semester_grades(grades, modules, keys)
        .groupBy("semester_id", "program_id", "academic_year", "cohort_year")
        .agg(
            _rows().alias("nb_grades"),
            round_dec(F.avg(grade), 2).alias("avg_grade"),
            pass_rate(grade).alias("success_rate_pct"),
            F.count_distinct("student_id").alias("nb_students_evaluated"),
        )
    )
    return joins.semester_with_absences(grade_stats, semester_absence_stats(absences))
