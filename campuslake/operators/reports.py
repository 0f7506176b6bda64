"""Ready-made reports and chart feeds over the KPI tables.

Where a report takes the first ten rows, unique columns follow the sort key so that ties
always resolve the same way. The published charts name only a column; the feeds here weight
averages and percentages by the number of rows behind them, and the category share counts
students.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import weighted_mean
from ..functions.labels import AT_RISK

TOP = 10


def program_overview(program_kpis: DataFrame) -> DataFrame:
    """KPIs per program and level."""
    return program_kpis.select(
        "program_id", "current_level", "success_rate_pct", "nb_students", "avg_grade", "nb_at_risk"
    ).orderBy("program_id", "current_level")


def weakest_at_risk(student_performance: DataFrame, top: int = TOP) -> DataFrame:
    """At-risk students with the lowest averages; students without any average come first."""
    return (
        student_performance.where(F.col("category") == AT_RISK)
        .orderBy("average_grade", "student_id")
        .select("last_name", "first_name", "program_id", "average_grade", "total_hours_absent")
        .limit(top)
    )


def absence_bands(correlation_abs_grades: DataFrame) -> DataFrame:
    """Results per absence band and program."""
    return correlation_abs_grades.select(
        "absence_category", "program_id", "nb_students", "avg_grade", "success_rate_pct"
    ).orderBy("program_id", "absence_category")


def semester_trend(semester_dashboard: DataFrame) -> DataFrame:
    """Success per program over the semesters."""
    return semester_dashboard.select(
        "semester_id", "program_id", "success_rate_pct", "nb_students_evaluated"
    ).orderBy("program_id", "semester_id")


def hardest_modules(success_rate: DataFrame, top: int = TOP) -> DataFrame:
    """Modules with the lowest success percentage."""
    return (
        success_rate.orderBy("taux_reussite_pct", "module_id", "academic_year")
        .select("module_name", "program_id", "difficulty", "taux_reussite_pct", "moyenne", "ecart_type")
        .limit(top)
    )


def module_success(success_rate: DataFrame) -> DataFrame:
    """Bar chart: success percentage per module name, weighted by grades."""
    return success_rate.groupBy("module_name").agg(
        weighted_mean(F.col("taux_reussite_pct"), F.col("nb_grades")).alias("taux_reussite_pct")
    )


def category_share(student_performance: DataFrame) -> DataFrame:
    """Pie chart: students per category."""
    return student_performance.groupBy("category").agg(F.count(F.lit(1)).alias("nb_students"))


def most_absent(absenteeism: DataFrame) -> DataFrame:
    """Table: students and years by absence hours, most absent first.

    The sort goes on to the student and year: many rows share the same hours, and a range
    exchange on the hours alone would send all of them to one task.
    """
    return absenteeism.select(
        "student_id", "first_name", "last_name", "program_id", "academic_year", "total_hours_absent"
    ).orderBy(F.desc("total_hours_absent"), "student_id", "academic_year")


def engagement(activity_summary: DataFrame) -> DataFrame:
    """Bar chart: volume, average score and success per activity type and platform."""
    weight = F.col("nb_activities")
    return activity_summary.groupBy("activity_type", "platform").agg(
        F.sum(weight).alias("nb_activities"),
        weighted_mean(F.col("avg_score"), weight).alias("avg_score"),
        weighted_mean(F.col("success_rate_pct"), weight).alias("success_rate_pct"),
    )


def grade_by_band(correlation_abs_grades: DataFrame) -> DataFrame:
    """Bar chart: average grade per absence band, weighted by students."""
    return correlation_abs_grades.groupBy("absence_category").agg(
        weighted_mean(F.col("avg_grade"), F.col("nb_students")).alias("avg_grade")
    )


def success_by_semester(semester_dashboard: DataFrame) -> DataFrame:
    """Line chart: success percentage per semester, weighted by grades."""
    return (
        semester_dashboard.groupBy("semester_id")
        .agg(weighted_mean(F.col("success_rate_pct"), F.col("nb_grades")).alias("success_rate_pct"))
        .orderBy("semester_id")
    )


def for_program(kpi: DataFrame, program_id: str) -> DataFrame:
    """Dashboard filter on one program; prunes partitions on tables laid out by program."""
    return kpi.where(F.col("program_id") == program_id)
