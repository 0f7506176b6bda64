"""What Catalyst makes of the queries."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_module

LAZY = [
    "program_kpis", "module_success_rate", "student_absenteeism", "student_performance", "activity_summary",
    "absence_grade_bands", "semester_dashboard", "join_grades_modules", "quality_report", "report_most_absent",
    "report_top_at_risk",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pair_products(spark, sf_dir, plan, name):
    text = plan(entry_module.queries()[name](spark, sf_dir))
    for node in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, REPARTITION"):
        assert node not in text


def _shuffled(spark, build):
    """Build with broadcasts off, as for tables too large to broadcast."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_performance_joins_reuse_the_partitioning_of_the_aggregates(spark, tmp_path, tables, plan):
    """From stored silver: one exchange per input, none for the joins themselves."""
    from campuslake.operators import kpis

    stored = {}
    for name in ("grades", "absences", "students"):
        tables.silver(name).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))

    def text():
        return plan(kpis.student_performance(stored["grades"], stored["absences"], stored["students"]))

    assert _shuffled(spark, text).count("Exchange hashpartitioning") == 3


def test_facts_are_aggregated_before_they_meet_the_dimension(spark, tmp_path, tables, plan):
    from campuslake.operators import kpis

    stored = {}
    for name in ("grades", "modules"):
        tables.silver(name).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    text = _shuffled(spark, lambda: plan(kpis.success_rate(stored["grades"], stored["modules"])))
    facts = text[text.index("SortMergeJoin") : text.index("grade_id") if "grade_id" in text else None]
    assert facts.index("HashAggregate") < facts.index("FileScan")
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"module_id", "grade", "academic_year"}
    assert "PushedFilters: [IsNotNull(module_id)]" in text


def test_top_ten_needs_no_full_sort(spark, sf_dir, plan):
    assert "TakeOrderedAndProject" in plan(entry_module.queries()["report_top_at_risk"](spark, sf_dir))


def test_hot_keys_are_looked_for_in_raw_rows(spark, tables, plan, monkeypatch):
    """The facts are cleaned once: one window over them, and the summary reads the key column only."""
    from campuslake.operators import joins

    looked = []
    original = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda rows, key, share=None: looked.append((rows, key)) or original(rows, key, 0.0001))
    joined = joins.grades_with_modules(tables.silver("grades"), tables.silver("modules"), tables.raw("grades"))
    text = plan(joined)
    assert "_piece" in text
    assert text.count("Window [row_number() windowspecdefinition(grade_id") == 1
    (rows, key), = looked
    summary = plan(rows.select(key))
    assert "Window" not in summary
    read = re.findall(r"ReadSchema: struct<([^>]*)>", summary)
    assert {c.split(":")[0] for r in read for c in r.split(",")} == {"l_orderkey", "l_partkey", "o_orderkey"}
