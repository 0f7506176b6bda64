"""Hand-made rows for the corners of each cleaner."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from campuslake.operators import cleaning
from campuslake.operators.dedup import keep_one
from campuslake.schemas import TABLES


def _make(spark, table, rows):
    """Rows given as dicts; missing columns are NULL."""
    columns = TABLES[table].columns
    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


def _clean(spark, table, rows):
    return cleaning.clean(table, _make(spark, table, rows))


def test_students_are_normalised(spark):
    row = {
        "student_id": "S1", "first_name": "\t Ana ", "last_name": " de souza ", "gender": " f",
        "email": " A@B.ORG ", "program_id": "P", "registration_date": "2023-09-01",
    }
    (got,) = _clean(spark, "students", [row]).collect()
    assert got.first_name == "\t Ana"
    assert got.last_name == "DE SOUZA"
    assert got.gender == " F"
    assert got.email == "a@b.org"
    assert str(got.registration_date) == "2023-09-01"


def test_students_need_an_id_and_a_program(spark):
    rows = [{"student_id": None, "program_id": "P"}, {"student_id": "S1"}, {"student_id": "S2", "program_id": "P"}]
    assert [r.student_id for r in _clean(spark, "students", rows).collect()] == ["S2"]


def test_a_null_program_id_survives_once(spark):
    rows = [{"program_name": "a"}, {"program_name": "b"}, {"program_id": "P"}]
    assert {r.program_id for r in _clean(spark, "programs", rows).collect()} == {None, "P"}


def test_modules_need_an_id(spark):
    rows = [{"module_name": "a"}, {"module_id": "M", "module_name": "b"}]
    assert [r.module_id for r in _clean(spark, "modules", rows).collect()] == ["M"]


def test_semesters_are_unique_by_three_columns(spark):
    rows = [
        {"semester_id": "S1", "academic_year": "y", "cohort_year": 1, "level": level} for level in (2, 1, 1)
    ] + [{"semester_id": "S1", "academic_year": "y", "cohort_year": 2, "level": 9}]
    got = _clean(spark, "semesters", rows).orderBy("cohort_year").collect()
    assert [r.level for r in got] == [1, 9]


def test_grades_outside_the_scale_are_dropped(spark):
    grades = [0.0, 9.99, 10.0, 20.0, 20.01, -0.01, None, math.nan]
    rows = [{"grade_id": str(i), "grade": g} for i, g in enumerate(grades)]
    got = _clean(spark, "grades", rows).orderBy("grade").collect()
    assert [(r.grade, r.mention, r.is_passed) for r in got] == [
        (0.0, "Insuffisant", False),
        (9.99, "Insuffisant", False),
        (10.0, "Passable", True),
        (20.0, "Très Bien", True),
    ]


def test_the_survivor_decides_before_the_filter(spark):
    rows = [{"grade_id": "1", "student_id": "a", "grade": g} for g in (None, 12.0)]
    assert _clean(spark, "grades", rows).count() == 0
    rows = [{"grade_id": "1", "student_id": s, "grade": g} for s, g in (("b", None), ("a", 12.0))]
    assert [r.grade for r in _clean(spark, "grades", rows).collect()] == [12.0]


def test_absences(spark):
    flags = ["Yes", "yes", " Yes", "No", None]
    rows = [{"absence_id": f"f{i}", "hours": 0.5, "justified": f} for i, f in enumerate(flags)]
    rows += [{"absence_id": f"h{i}", "hours": h} for i, h in enumerate((None, -1.0, 0.0))]
    rows[0]["absence_date"], rows[1]["absence_date"] = "2024-03-01", "01/03/2024"
    got = _clean(spark, "absences", rows).orderBy("absence_id").collect()
    assert [r.is_justified for r in got] == [True, True, False, False, False]
    assert [str(r.absence_date) for r in got[:2]] == ["2024-03-01", "None"]


def test_activities(spark):
    rows = [{"activity_id": str(i), "score": s} for i, s in enumerate((None, -1.0, 0.0, 20.0, 20.5))]
    assert sorted(r.score for r in _clean(spark, "activities", rows).collect()) == [0.0, 20.0]


def test_registrations_need_a_student(spark):
    rows = [{"registration_id": 1}, {"registration_id": 2, "student_id": "S"}]
    assert [r.registration_id for r in _clean(spark, "registrations", rows).collect()] == [2]


def test_numbers_read_as_text_are_accepted(spark):
    df = _make(spark, "grades", [{"grade_id": "1", "grade": 12.5}])
    text = df.withColumn("grade", F.lit("12.5"))
    assert [r.grade for r in cleaning.clean_grades(text).collect()] == [12.5]


def test_cleaning_twice_changes_nothing(spark, tables):
    for name in ("programs", "modules", "semesters", "registrations"):
        once = tables.silver(name)
        assert cleaning.clean(name, once).exceptAll(once).isEmpty()
        assert once.exceptAll(cleaning.clean(name, once)).isEmpty()


def test_keep_one_takes_the_smallest_row_null_first(spark):
    df = spark.createDataFrame(
        [("k", 2, "a"), ("k", 1, "z"), ("k", 1, "b"), (None, 5, "x"), (None, None, "y")],
        "key string, n int, s string",
    )
    assert set(map(tuple, keep_one(df, "key").collect())) == {("k", 1, "b"), (None, None, "y")}


def test_keep_one_with_key_columns_only(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert keep_one(df, ["a", "b"]).count() == 2


def test_a_hot_key_is_cut_down_before_the_shuffle(spark, plan):
    """A third of all rows share one key; each task ships one of them."""
    df = spark.range(30_000, numPartitions=4).selectExpr(
        "case when id % 3 = 0 then -1 else id end as key", "id % 17 as n", "cast(id as string) as s"
    )
    unique = keep_one(df, "key")
    text = plan(unique)
    assert text.index("Final") < text.index("Exchange hashpartitioning(key") < text.index("Partial")
    assert unique.count() == 20_001
    assert tuple(unique.where("key = -1").first()) == (-1, 0, "0")


def test_repeated_semesters_meet_before_any_sort(spark, tables, plan):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(tables.silver("semesters"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert text.rindex("Sort [") < text.index("HashAggregate(")
