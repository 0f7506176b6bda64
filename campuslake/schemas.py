"""Table definitions: column types, keys and profiling rules of the eight sources."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Table:
    """One source table: its columns (name -> Spark type), its key and where it comes from."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    source: str = "csv"


@dataclass(frozen=True)
class QualityRule:
    """What to profile in one raw table."""

    key: str
    not_null: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)


STUDENTS = Table(
    "students",
    {
        "student_id": "string",
        "first_name": "string",
        "last_name": "string",
        "gender": "string",
        "email": "string",
        "program_id": "string",
        "cohort_year": "int",
        "current_level": "int",
        "registration_date": "string",
    },
    ("student_id",),
)

PROGRAMS = Table(
    "programs",
    {"program_id": "string", "program_name": "string", "department": "string", "responsible": "string"},
    ("program_id",),
)

MODULES = Table(
    "modules",
    {
        "module_id": "string",
        "module_name": "string",
        "program_id": "string",
        "semester_id": "string",
        "hours": "int",
        "coefficient": "double",
        "difficulty": "string",
    },
    ("module_id",),
)

SEMESTERS = Table(
    "semesters",
    {
        "semester_id": "string",
        "academic_year": "string",
        "cohort_year": "int",
        "level": "int",
        "period": "string",
    },
    ("semester_id", "academic_year", "cohort_year"),
)

GRADES = Table(
    "grades",
    {
        "grade_id": "string",
        "student_id": "string",
        "module_id": "string",
        "grade": "double",
        "session": "string",
        "academic_year": "string",
        "cohort_year": "int",
    },
    ("grade_id",),
)

ABSENCES = Table(
    "absences",
    {
        "absence_id": "string",
        "student_id": "string",
        "module_id": "string",
        "absence_date": "string",
        "hours": "double",
        "justified": "string",
        "academic_year": "string",
        "semester_id": "string",
    },
    ("absence_id",),
)

ACTIVITIES = Table(
    "activities",
    {
        "activity_id": "string",
        "student_id": "string",
        "module_id": "string",
        "activity_type": "string",
        "score": "double",
        "activity_date": "string",
        "platform": "string",
        "academic_year": "string",
    },
    ("activity_id",),
)

REGISTRATIONS = Table(
    "registrations",
    {
        "registration_id": "int",
        "student_id": "string",
        "program_id": "string",
        "academic_year": "string",
        "registration_date": "date",
        "status": "string",
        "tuition_paid": "boolean",
    },
    ("registration_id",),
    source="jdbc",
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (STUDENTS, PROGRAMS, MODULES, SEMESTERS, GRADES, ABSENCES, ACTIVITIES, REGISTRATIONS)
}

QUALITY_RULES: dict[str, QualityRule] = {
    "students": QualityRule("student_id", ("student_id", "program_id", "current_level")),
    "grades": QualityRule("grade_id", ("student_id", "module_id", "grade"), {"grade": (0, 20)}),
    "absences": QualityRule("absence_id", ("student_id", "hours"), {"hours": (0, 100)}),
    "activities": QualityRule("activity_id", ("student_id", "score"), {"score": (0, 20)}),
}

# Partition column of the KPI tables that are laid out by it; the others are unpartitioned.
GOLD_PARTITIONS: dict[str, tuple[str, ...]] = {
    "success_rate": ("program_id",),
    "absenteeism": ("program_id",),
    "student_performance": ("program_id",),
    "program_kpis": (),
    "activity_summary": ("program_id",),
    "correlation_abs_grades": (),
    "semester_dashboard": (),
}
