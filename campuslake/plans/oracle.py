"""The same queries as one ANSI-style SQL statement each, for an independent SQL engine.

Nothing here is used by the operators. Statements are put together from named common table
expressions: ``fx_*`` source tables, ``cl_*`` cleaned tables, ``k_*`` KPI tables.
"""

from __future__ import annotations

import re
from functools import cache

from ..schemas import TABLES
from .fixtures import SOURCES


def _round(expression: str, places: int) -> str:
    return f"cast(round(cast({expression} as decimal(38,10)), {places}) as double)"


def _cases(condition: str) -> str:
    return f"count(case when {condition} then 1 end)"


def _one_per_key(table: str) -> str:
    spec = TABLES[table]
    others = ", ".join(f"{c} nulls first" for c in spec.columns if c not in spec.key)
    return (
        f"select * from fx_{table} qualify row_number() over "
        f"(partition by {', '.join(spec.key)} order by {others}) = 1"
    )


def _date(name: str) -> str:
    return f"case when regexp_full_match({name}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') then try_cast({name} as date) end"


PASS_PCT = _round(_cases("grade >= 10") + " / count(*) * 100", 1)
AVERAGE_PASS_PCT = _round(_cases("average_grade >= 10") + " / count(*) * 100", 1)
BAND = """case when hours_absent <= 5 then 'Très faible (0-5h)' when hours_absent <= 15 then 'Faible (6-15h)'
  when hours_absent <= 30 then 'Modéré (16-30h)' else 'Élevé (>30h)' end"""

CTES: dict[str, str] = {f"fx_{name}": sql for name, sql in SOURCES.items()}
CTES |= {f"one_{name}": _one_per_key(name) for name in TABLES}
CTES |= {
    "cl_students": f"""select student_id, trim(first_name, ' ') as first_name,
        trim(upper(last_name), ' ') as last_name, upper(gender) as gender,
        lower(trim(email, ' ')) as email, program_id, cohort_year, current_level,
        {_date('registration_date')} as registration_date
      from one_students where student_id is not null and program_id is not null""",
    "cl_programs": "select * from one_programs",
    "cl_modules": "select * from one_modules where module_id is not null",
    "cl_semesters": "select * from one_semesters",
    "cl_grades": """select *,
        case when grade >= 16 then 'Très Bien' when grade >= 14 then 'Bien' when grade >= 12 then 'Assez Bien'
          when grade >= 10 then 'Passable' else 'Insuffisant' end as mention,
        grade >= 10 as is_passed
      from one_grades where grade is not null and grade >= 0 and grade <= 20""",
    "cl_absences": f"""select absence_id, student_id, module_id, {_date('absence_date')} as absence_date, hours,
        justified, academic_year, semester_id,
        case when upper(justified) = 'YES' then true else false end as is_justified
      from one_absences where hours > 0""",
    "cl_activities": f"""select activity_id, student_id, module_id, activity_type, score,
        {_date('activity_date')} as activity_date, platform, academic_year
      from one_activities where score is not null and score >= 0 and score <= 20""",
    "cl_registrations": "select * from one_registrations where student_id is not null",
    "k_success": f"""select module_id, module_name, program_id, difficulty, coefficient, academic_year,
        count(*) as nb_grades, {_round('avg(grade)', 2)} as moyenne, {_round('max(grade)', 2)} as grade_max,
        {_round('min(grade)', 2)} as grade_min, {_round('stddev_samp(grade)', 2)} as ecart_type,
        {PASS_PCT} as taux_reussite_pct
      from cl_grades join cl_modules using (module_id)
      group by module_id, module_name, program_id, difficulty, coefficient, academic_year""",
    "k_absent": f"""select s.student_id, first_name, last_name, program_id, current_level, academic_year,
        cast(sum(hours) as bigint) as total_hours_absent, count(*) as nb_absences,
        {_cases('is_justified')} as nb_justified, {_cases('not is_justified')} as nb_unjustified,
        {_round(_cases('is_justified') + ' / count(*) * 100', 1)} as justification_rate_pct
      from cl_absences a join cl_students s on a.student_id = s.student_id
      group by s.student_id, first_name, last_name, program_id, current_level, academic_year""",
    "student_results": f"""select student_id, {_round('avg(grade)', 2)} as average_grade,
        count(*) as nb_modules_enrolled, {_cases('grade >= 10')} as nb_modules_passed
      from cl_grades where session = 'Normal' group by student_id""",
    "student_hours": """select student_id, cast(sum(hours) as bigint) as total_hours_absent
      from cl_absences group by student_id""",
    "k_performance": """select s.*, average_grade, nb_modules_enrolled, nb_modules_passed,
        coalesce(total_hours_absent, 0) as total_hours_absent,
        case when average_grade >= 14 then 'Excellent' when average_grade >= 12 then 'Bon'
          when average_grade >= 10 then 'Passable' else 'En difficulté' end as category
      from cl_students s left join student_results r on s.student_id = r.student_id
      left join student_hours h on s.student_id = h.student_id""",
    "k_program": f"""select program_id, current_level, count(*) as nb_students,
        {_round('avg(average_grade)', 2)} as avg_grade, {AVERAGE_PASS_PCT} as success_rate_pct,
        {_round('avg(total_hours_absent)', 1)} as avg_hours_absent,
        {_cases("category = 'En difficulté'")} as nb_at_risk
      from k_performance group by program_id, current_level""",
    "k_activity": f"""select activity_type, platform, program_id, academic_year, count(*) as nb_activities,
        count(distinct a.student_id) as nb_students, {_round('avg(score)', 2)} as avg_score,
        {_round('max(score)', 2)} as max_score, {_round('min(score)', 2)} as min_score,
        {_round('stddev_samp(score)', 2)} as ecart_type,
        {_round(_cases('score >= 10') + ' / count(*) * 100', 1)} as success_rate_pct
      from cl_activities a join cl_students s on a.student_id = s.student_id
      group by activity_type, platform, program_id, academic_year""",
    "student_years": """select p.*, a.total_hours_absent as hours_absent
      from k_performance p left join k_absent a on p.student_id = a.student_id""",
    "k_bands": f"""select {BAND} as absence_category, program_id, count(*) as nb_students,
        {_round('avg(average_grade)', 2)} as avg_grade, {AVERAGE_PASS_PCT} as success_rate_pct,
        {_round('avg(hours_absent)', 1)} as avg_hours_absent
      from student_years group by 1, program_id""",
    "placed_grades": """select g.student_id, g.grade, g.academic_year, g.cohort_year, m.program_id, m.semester_id
      from cl_grades g join cl_modules m on g.module_id = m.module_id""",
    "semester_absences": f"""select semester_id, academic_year, cast(sum(hours) as bigint) as total_hours_absent,
        {_round('avg(hours)', 2)} as avg_hours_per_absence, {_cases('not is_justified')} as nb_unjustified
      from cl_absences group by semester_id, academic_year""",
    "semester_results": f"""select semester_id, program_id, academic_year, cohort_year, count(*) as nb_grades,
        {_round('avg(grade)', 2)} as avg_grade, {PASS_PCT} as success_rate_pct,
        count(distinct student_id) as nb_students_evaluated
      from placed_grades group by semester_id, program_id, academic_year, cohort_year""",
    "k_semester": """select r.*, total_hours_absent, avg_hours_per_absence, nb_unjustified
      from semester_results r left join semester_absences a
      on r.semester_id = a.semester_id and r.academic_year = a.academic_year""",
}


@cache
def _needs(name: str) -> tuple[str, ...]:
    return tuple(c for c in CTES if c != name and re.search(rf"\b{c}\b", CTES[name]))


def _statement(body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in _needs(name):
                visit(other)
            order.append(name)

    for name in CTES:
        if re.search(rf"\b{name}\b", body):
            visit(name)
    if not order:
        return body
    return "with " + ",\n".join(f"{name} as ({CTES[name]})" for name in order) + "\n" + body


def _quality(table: str, key: str, not_null: tuple[str, ...], ranged: dict[str, tuple[int, int]]) -> str:
    nulls = {f"nulls_{c}": _cases(f"{c} is null") for c in not_null}
    outside = {f"out_of_range_{c}": _cases(f"{c} < {lo} or {c} > {hi}") for c, (lo, hi) in ranged.items()}
    metrics = ", ".join(f"{sql} as {name}" for name, sql in (nulls | outside).items())
    clean = " and ".join(["duplicates = 0", *(f"{name} = 0" for name in nulls)])
    return (
        f"select '{table}' as \"table\", *, case when {clean} then 'OK' else 'ISSUES' end as status from ("
        f"select count(*) as total_rows, count(*) - (select count(*) from (select distinct {key} from fx_{table})) "
        f"as duplicates, {metrics} from fx_{table}) counts"
    )


QUALITY = {
    "students": _quality("students", "student_id", ("student_id", "program_id", "current_level"), {}),
    "grades": _quality("grades", "grade_id", ("student_id", "module_id", "grade"), {"grade": (0, 20)}),
    "absences": _quality("absences", "absence_id", ("student_id", "hours"), {"hours": (0, 100)}),
    "activities": _quality("activities", "activity_id", ("student_id", "score"), {"score": (0, 20)}),
}

_LONG = " union all ".join(
    f"""select "table", metric, value, status from (unpivot ({sql})
      on columns(* exclude ("table", status)) into name metric value value)"""
    for sql in QUALITY.values()
)

GOLD = {
    "success_rate": "k_success",
    "absenteeism": "k_absent",
    "student_performance": "k_performance",
    "program_kpis": "k_program",
    "activity_summary": "k_activity",
    "correlation_abs_grades": "k_bands",
    "semester_dashboard": "k_semester",
}


def _counts(stage: str, sources: dict[str, str]) -> str:
    first = f"'{stage}' as stage, " if stage else ""
    return " union all ".join(
        f"select {first}'{name}' as table_name, count(*) as num_rows from {cte}" for name, cte in sources.items()
    )


def _weighted(value: str, weight: str) -> str:
    return _round(f"sum({value} * {weight}) / sum(case when {value} is not null then {weight} end)", 2)


_HISTORY = """select 0 as version, '2024-01-01' as published_at, count(*) as num_rows from k_absent
  union all select 1, '2024-01-06', count(*) from k_absent where nb_unjustified = 0
  union all select 2, '2024-01-11', count(*) from k_absent"""

BODIES: dict[str, str] = {
    "program_kpis": "select * from k_program",
    "module_success_rate": "select * from k_success",
    "student_absenteeism": "select * from k_absent",
    "student_performance": "select * from k_performance",
    "activity_summary": "select * from k_activity",
    "absence_grade_bands": "select * from k_bands",
    "semester_dashboard": "select * from k_semester",
    "dedup_single_key": "select * from one_grades",
    "dedup_composite_key": "select * from one_semesters",
    "join_grades_modules": """select grade_id, student_id, m.module_id, module_name, program_id, grade, mention
      from cl_grades g join cl_modules m on g.module_id = m.module_id""",
    "join_absences_students": """select absence_id, s.student_id, last_name, program_id, current_level, hours,
      is_justified from cl_absences a join cl_students s on a.student_id = s.student_id""",
    "join_activities_students": """select activity_id, s.student_id, program_id, current_level, activity_type, score
      from cl_activities a join cl_students s on a.student_id = s.student_id""",
    "join_semester_modules": "select * from placed_grades",
    "join_left_performance": """select s.student_id, program_id, average_grade, nb_modules_enrolled,
      nb_modules_passed from cl_students s left join student_results r on s.student_id = r.student_id""",
    "join_left_hours": """select s.student_id, program_id, total_hours_absent
      from cl_students s left join student_hours h on s.student_id = h.student_id""",
    "join_fanout_hours": f"select student_id, program_id, hours_absent, {BAND} as absence_category from student_years",
    "join_semester_composite": """select r.*, total_hours_absent, avg_hours_per_absence, nb_unjustified from (
        select semester_id, academic_year, program_id, count(*) as nb_grades from placed_grades
        group by semester_id, academic_year, program_id) r
      left join semester_absences a on r.semester_id = a.semester_id and r.academic_year = a.academic_year""",
    "quality_report": _LONG,
    "report_program_kpis": """select program_id, current_level, success_rate_pct, nb_students, avg_grade, nb_at_risk
      from k_program""",
    "report_top_at_risk": """select last_name, first_name, program_id, average_grade, total_hours_absent
      from k_performance where category = 'En difficulté'
      order by average_grade nulls first, student_id limit 10""",
    "report_absence_bands": """select absence_category, program_id, nb_students, avg_grade, success_rate_pct
      from k_bands""",
    "report_semester_trend": """select semester_id, program_id, success_rate_pct, nb_students_evaluated
      from k_semester""",
    "report_hardest_modules": """select module_name, program_id, difficulty, taux_reussite_pct, moyenne, ecart_type
      from k_success order by taux_reussite_pct, module_id, academic_year limit 10""",
    "report_most_absent": """select student_id, first_name, last_name, program_id, academic_year,
      total_hours_absent from k_absent""",
    "report_program_filter": "select * from k_success where program_id = 'ASIA'",
    "chart_module_success": f"""select module_name, {_weighted('taux_reussite_pct', 'nb_grades')} as taux_reussite_pct
      from k_success group by module_name""",
    "chart_category_share": "select category, count(*) as nb_students from k_performance group by category",
    "chart_engagement": f"""select activity_type, platform, cast(sum(nb_activities) as bigint) as nb_activities,
      {_weighted('avg_score', 'nb_activities')} as avg_score,
      {_weighted('success_rate_pct', 'nb_activities')} as success_rate_pct
      from k_activity group by activity_type, platform""",
    "chart_grade_by_band": f"""select absence_category, {_weighted('avg_grade', 'nb_students')} as avg_grade
      from k_bands group by absence_category""",
    "chart_success_by_semester": f"""select semester_id, {_weighted('success_rate_pct', 'nb_grades')} as
      success_rate_pct from k_semester group by semester_id""",
    "ingest_csv_roundtrip": """select student_id, first_name, last_name, gender, email, program_id,
      cast(cohort_year as integer) as cohort_year, cast(current_level as integer) as current_level,
      registration_date from fx_students""",
    "ingest_csv_grades": """select cast(grade_id as varchar) as grade_id, student_id,
      cast(module_id as varchar) as module_id, grade, session, academic_year,
      cast(cohort_year as integer) as cohort_year from fx_grades""",
    "seed_registrations": """select cast(n as integer) as registration_id,
        'STU-' || case when n < 10000 then lpad(cast(n as varchar), 4, '0') else cast(n as varchar) end as student_id,
        case n % 3 when 0 then 'BDCC' when 1 then 'CCN' else 'GLSID' end as program_id,
        '2023-2024' as academic_year, date '2023-09-01' + cast(n % 30 as integer) as registration_date,
        case n % 3 when 0 then 'Inscrit' when 1 then 'Redoublant' else 'Transfert' end as status,
        n % 2 = 0 as tuition_paid
      from (select c_custkey + 1 as n from customer) numbers""",
    "load_counts": _counts("", {t: f"fx_{t}" for t in TABLES}),
    "stage_row_counts": " union all ".join(
        (
            _counts("bronze", {t: f"fx_{t}" for t in TABLES}),
            _counts("silver", {t: f"cl_{t}" for t in TABLES}),
            _counts("gold", GOLD),
        )
    ),
    "publish_overwrite": "select * from cl_grades",
    "publish_overwrite_schema": """select cast(registration_id as varchar) as registration_id, student_id, program_id,
      academic_year, registration_date, status, tuition_paid from cl_registrations""",
    "publish_partitioned_read": "select * from k_performance where program_id = 'ASIA'",
    "catalog_gold_query": """select program_id, difficulty, cast(sum(nb_grades) as bigint) as nb_grades,
      max(grade_max) as grade_max from k_success group by program_id, difficulty""",
    "catalog_listing": _counts("", {f"gold_{name}": cte for name, cte in GOLD.items()}),
    "path_sql_query": "select * from k_program",
    "snapshot_as_of": "select * from k_absent where nb_unjustified = 0",
    "snapshot_history": _HISTORY,
    "retain_snapshots": f"select version, num_rows from ({_HISTORY}) history where version > 0",
    "table_detail": """select 'parquet' as format, 3 as num_files, count(*) as num_rows, true as has_bytes
      from cl_activities""",
    "compact_files": "select * from cl_grades",
    "compact_partitioned": "select * from k_performance",
    "catalog_after_refresh": """select program_id, count(*) as nb_rows,
      cast(sum(nb_grades) as bigint) as nb_grades, max(grade_max) as best from k_success
      where program_id <> 'AFRICA' group by program_id""",
    "ingest_csv_malformed": """select cast(grade_id as varchar) as grade_id,
      case when grade < 15 then grade end as grade, coalesce(grade >= 15, false) as malformed from fx_grades""",
    "cluster_by_column": "select * from k_performance",
    "cluster_zorder": "select * from k_performance",
    "compact_bins": "select * from k_performance",
}


def _inferred(table: str, column: str) -> str:
    """The narrowest type that all values of a column fit as text."""
    ladder = (
        ("boolean", "lower(v) in ('true', 'false')"),
        ("int", r"regexp_full_match(v, '[+-]?(0|[1-9]\d*)') and try_cast(v as integer) is not null"),
        ("bigint", r"regexp_full_match(v, '[+-]?(0|[1-9]\d*)') and try_cast(v as bigint) is not null"),
        ("double", r"regexp_full_match(v, '[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?')"),
        ("date", r"regexp_full_match(v, '\d{4}-\d{2}-\d{2}') and try_cast(v as date) is not null"),
    )
    cases = " ".join(f"when bool_and({fits}) then '{kind}'" for kind, fits in ladder)
    return f"""select '{table}' as table_name, '{column}' as column_name, case {cases} else 'string' end as type_name,
        count(v) as num_values, count(distinct v) as num_distinct
      from (select cast({column} as varchar) as v from fx_{table}) cells where v is not null"""


BODIES |= {
    "ingest_csv_inferred": " union all ".join(
        _inferred(name, column) for name, table in TABLES.items() if table.source == "csv" for column in table.columns
    ),
    "quality_observed": _LONG,
    "activity_students_sketch": """select activity_type, program_id, count(distinct a.student_id) as nb_students,
        true as sketch_is_close
      from cl_activities a join cl_students s on a.student_id = s.student_id group by activity_type, program_id""",
    "sorted_publication": """select student_id, first_name, last_name, program_id, academic_year, total_hours_absent,
        row_number() over (order by total_hours_absent desc, student_id, academic_year) as position
      from k_absent""",
}
_EARLIER = ("student_performance", "absenteeism", "activity_summary", "program_kpis", "correlation_abs_grades")
BODIES |= {
    "catalog_after_swap": """select 'before' as planned, program_id, current_level, nb_students, nb_students as nb_rows
        from k_program where program_id <> 'ASIA'
      union all select 'after', program_id, current_level, nb_students, nb_students from k_program""",
    "run_history": " union all ".join(
        f"""select '{day}' as day, 'gold' as stage, '{name}' as table_name, count(*) as num_rows from {cte}
          {"where program_id <> 'ASIA'" if day == "2024-01-01" and name in _EARLIER else ""}"""
        for day in ("2024-01-01", "2024-01-02")
        for name, cte in GOLD.items()
    ),
    "run_as_of": "select *, nb_students as nb_rows from k_program where program_id <> 'ASIA'",
}
_SQL_TYPES = {"string": "varchar", "int": "integer", "double": "double", "boolean": "boolean"}
BODIES |= {
    f"ingest_csv_{name}": "select "
    + ", ".join(f"cast({c} as {_SQL_TYPES[kind]}) as {c}" for c, kind in table.columns.items())
    + f" from fx_{name}"
    for name, table in TABLES.items()
    if table.source == "csv" and name not in ("students", "grades")
}
BODIES |= {f"clean_{t}": f"select * from cl_{t}" for t in TABLES}
BODIES |= {f"quality_{t}": sql for t, sql in QUALITY.items()}


def oracle_sql() -> dict[str, str]:
    """One SQL statement per query."""
    return {name: _statement(body) for name, body in BODIES.items()}
