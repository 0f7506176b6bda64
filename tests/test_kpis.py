"""Hand-made rows and invariants for the KPI tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from campuslake.operators import kpis, reports

STUDENTS = (
    "student_id string, first_name string, last_name string, gender string, email string, "
    "program_id string, cohort_year int, current_level int, registration_date date"
)
GRADES = "grade_id int, student_id string, module_id string, grade double, session string, academic_year string, cohort_year int"
ABSENCES = "absence_id int, student_id string, hours double, is_justified boolean, academic_year string, semester_id string"
MODULES = "module_id string, module_name string, program_id string, semester_id string, hours int, coefficient int, difficulty string"


def _students(spark, *ids, program="P"):
    return spark.createDataFrame([(i, i, i, "F", i, program, 2023, 1, None) for i in ids], STUDENTS)


def _grades(spark, *rows):
    """(student, module, grade, session, year) rows."""
    return spark.createDataFrame([(i, s, m, g, e, y, 2023) for i, (s, m, g, e, y) in enumerate(rows)], GRADES)


def _absences(spark, *rows):
    """(student, hours, justified, year, semester) rows."""
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], ABSENCES)


def _modules(spark, *rows):
    """(module, program, semester) rows."""
    return spark.createDataFrame([(m, f"name {m}", p, s, 10, 2, "hard") for m, p, s in rows], MODULES)


def test_success_rate_of_one_grade_has_no_deviation(spark):
    grades = _grades(spark, ("a", "M", 12.0, "Normal", "y"), ("a", "X", 3.0, "Normal", "y"))
    (got,) = kpis.success_rate(grades, _modules(spark, ("M", None, "S1"))).collect()
    assert got.program_id is None
    assert (got.nb_grades, got.moyenne, got.ecart_type, got.taux_reussite_pct) == (1, 12.0, None, 100.0)


def test_success_rate_counts_both_sessions(spark):
    grades = _grades(spark, ("a", "M", 8.0, "Normal", "y"), ("a", "M", 11.0, "Rattrapage", "y"))
    (got,) = kpis.success_rate(grades, _modules(spark, ("M", "P", "S1"))).collect()
    assert (got.nb_grades, got.moyenne, got.grade_max, got.grade_min) == (2, 9.5, 11.0, 8.0)
    assert (got.ecart_type, got.taux_reussite_pct) == (2.12, 50.0)


def test_performance_uses_the_rounded_average_of_the_normal_session(spark):
    grades = _grades(
        spark,
        ("a", "M", 9.992, "Normal", "y"), ("a", "N", 10.0, "Normal", "y"), ("a", "N", 0.0, "Rattrapage", "y"),
        ("b", "M", 19.0, "Rattrapage", "y"),
    )
    absences = _absences(spark, ("a", 2.0, True, "y", "S1"), ("a", 3.5, False, "z", "S1"))
    got = {r.student_id: r for r in kpis.student_performance(grades, absences, _students(spark, "a", "b")).collect()}
    assert (got["a"].average_grade, got["a"].category, got["a"].nb_modules_passed) == (10.0, "Passable", 1)
    assert got["a"].total_hours_absent == 5.5
    assert (got["b"].average_grade, got["b"].category, got["b"].total_hours_absent) == (None, "En difficulté", 0)
    assert got["b"].nb_modules_enrolled is None


def test_program_kpis_count_students_without_an_average(spark):
    grades = _grades(spark, ("a", "M", 12.0, "Normal", "y"))
    performance = kpis.student_performance(grades, _absences(spark), _students(spark, "a", "b"))
    (got,) = kpis.program_kpis(performance).collect()
    assert (got.nb_students, got.avg_grade, got.success_rate_pct, got.nb_at_risk) == (2, 12.0, 50.0, 1)


def test_bands_count_student_years_and_put_missing_hours_on_top(spark):
    students = _students(spark, "a", "b")
    absences = _absences(spark, ("a", 5.0, True, "y", "S1"), ("a", 5.5, True, "z", "S1"))
    performance = kpis.student_performance(_grades(spark), absences, students)
    absent = kpis.absenteeism(absences, students)
    got = {r.absence_category: r.nb_students for r in kpis.correlation_abs_grades(performance, absent).collect()}
    assert got == {"Très faible (0-5h)": 1, "Faible (6-15h)": 1, "Élevé (>30h)": 1}
    apart = kpis.correlation_abs_grades(performance, absent, null_band="Aucune").collect()
    assert "Aucune" in {r.absence_category for r in apart}


def test_semester_absences_repeat_over_programs_and_stay_null_without_a_match(spark):
    grades = _grades(
        spark, ("a", "M", 12.0, "Normal", "y"), ("a", "N", 8.0, "Normal", "y"), ("b", "O", 8.0, "Normal", "y")
    )
    modules = _modules(spark, ("M", "P", "S1"), ("N", "Q", "S1"), ("O", "P", "S2"))
    absences = _absences(spark, ("a", 4.0, False, "y", "S1"), ("z", 1.0, True, "y", "S1"))
    got = {(r.semester_id, r.program_id): r for r in kpis.semester_dashboard(grades, absences, modules).collect()}
    for key in (("S1", "P"), ("S1", "Q")):
        assert (got[key].total_hours_absent, got[key].avg_hours_per_absence, got[key].nb_unjustified) == (5.0, 2.5, 1)
    assert got["S2", "P"].total_hours_absent is None
    assert got["S2", "P"].nb_unjustified is None


def test_activity_summary_against_the_direct_aggregation(tables):
    """Collapsing activities per student first gives what one aggregation over the join gives."""
    activities, students = tables.silvers("activities", "students")
    direct = (
        activities.join(students.select("student_id", "program_id"), "student_id")
        .groupBy("activity_type", "platform", "program_id", "academic_year")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("student_id").alias("d"),
            F.avg("score").alias("a"),
            F.stddev_samp("score").alias("s"),
        )
    )
    keys = ["activity_type", "platform", "program_id", "academic_year"]
    rows = kpis.activity_summary(activities, students).join(direct, keys).collect()
    assert len(rows) == direct.count() > 0
    for r in rows:
        assert (r.nb_activities, r.nb_students) == (r.n, r.d)
        assert r.avg_score == pytest.approx(r.a, abs=0.0051)
        assert (r.ecart_type is None) == (r.s is None)
        assert r.s is None or r.ecart_type == pytest.approx(r.s, abs=0.0051)


def test_a_hot_student_collapses_before_the_join(spark):
    """Two thirds of the activities belong to one student."""
    activities = spark.range(3_000).selectExpr(
        "case when id % 3 < 2 then 'hot' else concat('s', id) end as student_id",
        "'Quiz' as activity_type", "'Teams' as platform", "'y' as academic_year", "cast(id % 41 as double) / 2 as score",
    )
    students = _students(spark, "hot", *(f"s{i}" for i in range(2, 3_000, 3)))
    (got,) = kpis.activity_summary(activities, students).collect()
    assert (got.nb_activities, got.nb_students) == (3_000, 1_001)


def test_invariants(tables):
    absent = tables.absenteeism
    assert absent.where("nb_justified + nb_unjustified <> nb_absences").isEmpty()
    assert absent.where("justification_rate_pct not between 0 and 100").isEmpty()
    assert tables.success_rate.where("taux_reussite_pct not between 0 and 100 or grade_min > grade_max").isEmpty()
    total = tables.program_kpis.agg(F.sum("nb_students")).first()[0]
    assert total == tables.performance.count() == tables.silver("students").count()


def test_top_ten_is_stable_and_puts_missing_averages_first(tables):
    first = reports.weakest_at_risk(tables.performance).collect()
    assert first == reports.weakest_at_risk(tables.performance).collect()
    averages = [r.average_grade for r in first]
    graded = [a for a in averages if a is not None]
    assert graded == sorted(graded) and averages[: len(averages) - len(graded)] == [None] * (10 - len(graded))


def test_gold_columns_are_in_the_published_order(tables):
    assert tables.performance.columns == [
        "student_id", "first_name", "last_name", "gender", "email", "program_id", "cohort_year", "current_level",
        "registration_date", "average_grade", "nb_modules_enrolled", "nb_modules_passed", "total_hours_absent",
        "category",
    ]
    assert tables.semester_dashboard.columns == [
        "semester_id", "program_id", "academic_year", "cohort_year", "nb_grades", "avg_grade", "success_rate_pct",
        "nb_students_evaluated", "total_hours_absent", "avg_hours_per_absence", "nb_unjustified",
    ]
    assert tables.grade_bands.columns == [
        "absence_category", "program_id", "nb_students", "avg_grade", "success_rate_pct", "avg_hours_absent",
    ]
