"""The eight source tables, derived from the order-processing test tables.

Each statement is valid in Spark SQL and in ANSI SQL engines alike, so both sides of the
correctness check start from the same rows. Duplicates, NULLs, orphans, malformed dates and
out-of-range values are part of the data. Every row of the tables takes part.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

INPUTS = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events")

# Twelve digits: lpad cuts longer numbers, which would merge students on large inputs.
_STUDENT = "concat('STU-', lpad(cast({} as varchar(20)), 12, '0'))"
_YEAR = (
    "concat(cast(2023 + {0} % 3 as varchar(20)), '-', cast(2024 + {0} % 3 as varchar(20)))"
)
_ORDER_YEAR = _YEAR.format("year(o_orderdate)")


def _order_student(unknown_every: int) -> str:
    """The ordering customer as a student; every so many are strangers no student table knows."""
    return (
        f"concat(case when o_custkey % {unknown_every} = 0 then 'EXT-' else 'STU-' end, "
        "lpad(cast(o_custkey as varchar(20)), 12, '0'))"
    )


SOURCES: dict[str, str] = {
    "programs": """
        select case when s_suppkey % 13 = 0 then null else r_name end as program_id,
          concat('Program ', r_name) as program_name, concat('Dept ', n_name) as department,
          concat('Resp ', s_name) as responsible
        from supplier join nation on s_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "students": f"""
        select case when c_custkey % 211 = 1 then null else {_STUDENT.format('c_custkey')} end as student_id,
          concat('  ', c_mktsegment, suffix) as first_name,
          concat(' ', lower(c_name), ' ') as last_name,
          case when c_custkey % 2 = 0 then 'm' else 'F' end as gender,
          concat(' ', upper(c_name), '@EXAMPLE.ORG ') as email,
          case when c_custkey % 97 = 0 then null else r_name end as program_id,
          2023 + c_custkey % 3 as cohort_year, 1 + c_custkey % 3 as current_level,
          case when c_custkey % 53 = 0 then '31/09/2023'
            else concat('2023-09-', lpad(cast(1 + c_custkey % 30 as varchar(20)), 2, '0'))
          end as registration_date
        from (
          select c_custkey, c_name, c_mktsegment, c_nationkey, ' ' as suffix from customer
          union all
          select c_custkey, c_name, c_mktsegment, c_nationkey, ' bis ' from customer
          where c_custkey % 50 = 0
        ) enrolled
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "modules": """
        select case when p_partkey % 101 = 0 then null else p_partkey end as module_id,
          p_name as module_name, r_name as program_id,
          concat('S', cast(1 + p_size % 6 as varchar(20))) as semester_id,
          p_size as hours, 1 + p_partkey % 4 as coefficient, p_type as difficulty
        from part join region on r_regionkey = p_partkey % 5""",
    "semesters": f"""
        select concat('S', cast(1 + o_orderkey % 6 as varchar(20))) as semester_id,
          {_ORDER_YEAR} as academic_year,
          2023 + o_custkey % 3 as cohort_year, 1 + o_custkey % 3 as level,
          case when o_orderkey % 2 = 0 then 'Automne' else 'Printemps' end as period
        from orders""",
    "grades": f"""
        select l_orderkey * 10 + l_linenumber as grade_id, {_order_student(41)} as student_id,
          l_partkey as module_id,
          case when l_discount = 0 and l_tax = 0 then null
            when l_linenumber = 7 and l_quantity < 5 then -1.0e0
            else l_quantity / 4 + o_custkey % 9 end as grade,
          case when l_linestatus = 'F' then 'Normal' else 'Rattrapage' end as session,
          {_ORDER_YEAR} as academic_year, 2023 + o_custkey % 3 as cohort_year
        from lineitem join orders on l_orderkey = o_orderkey""",
    "absences": f"""
        select o_orderkey as absence_id, {_order_student(7)} as student_id,
          o_orderkey % 2000 as module_id,
          case when o_orderkey % 61 = 0 then 'n/a'
            else cast(cast(o_orderdate as date) as varchar(10)) end as absence_date,
          case when o_orderkey % 89 = 0 then null when o_orderkey % 997 = 5 then 120
            when o_orderkey % 499 = 3 then -3
            else (o_orderkey % 6) * (1 + o_custkey % 5) end as hours,
          case when o_orderstatus = 'F' then 'Yes' when o_orderstatus = 'O' then 'no'
            when o_orderkey % 2 = 0 then 'YES' else null end as justified,
          {_ORDER_YEAR} as academic_year,
          concat('S', cast(1 + o_orderkey % 6 as varchar(20))) as semester_id
        from orders""",
    "activities": f"""
        select event_id as activity_id, {_STUDENT.format('user_id')} as student_id,
          event_id % 2000 as module_id, event_type as activity_type,
          case when value > 200 then null else floor(value * 2) / 8 - 0.5e0 end as score,
          cast(cast(ts as date) as varchar(10)) as activity_date,
          case user_id % 3 when 0 then 'Teams' when 1 then 'Google Classroom' else 'Moodle' end as platform,
          {_YEAR.format('event_id')} as academic_year
        from events""",
    "registrations": f"""
        select c_custkey + 1 as registration_id,
          case when c_custkey % 89 = 0 then null else {_STUDENT.format('c_custkey')} end as student_id,
          r_name as program_id, '2023-2024' as academic_year,
          cast('2023-09-15' as date) as registration_date,
          case c_custkey % 3 when 0 then 'Inscrit' when 1 then 'Redoublant' else 'Transfert' end as status,
          c_custkey % 2 = 0 as tuition_paid
        from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
}


@cache
def _inputs_of(name: str) -> tuple[str, ...]:
    return tuple(t for t in INPUTS if re.search(rf"(from|join) {t}\b", SOURCES[name]))


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def _input(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    path = f"{sf_dir}/{table}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table over the Parquet files in ``sf_dir``."""
    inputs = _inputs_of(name)
    statement = re.sub(
        rf"\b(from|join) ({'|'.join(inputs)})\b", r"\1 {\2}", SOURCES[name]
    )
    return spark.sql(statement, **{t: _input(spark, sf_dir, t) for t in inputs})


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight source tables."""
    return {name: source(spark, sf_dir, name) for name in SOURCES}
