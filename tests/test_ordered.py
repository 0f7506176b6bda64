"""Order that survives storage, and reports that come in order."""

from __future__ import annotations

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from campuslake.operators import sketches
from campuslake.sinks import check_sorted, publish_sorted, read_sorted
from campuslake.sinks.ordered import OrderError


@pytest.fixture
def marks(spark):
    """A third of the rows share one mark, some have none."""
    mark = "case when id % 3 = 0 then 10 when id % 50 = 1 then null else pmod(xxhash64(id), 20) end"
    return spark.range(5_000, numPartitions=4).selectExpr("id", f"{mark} as mark", "concat('n', id) as name")


def test_positions_follow_the_order(spark, marks, tmp_path):
    path = str(tmp_path / "t")
    assert publish_sorted(marks, path, [F.desc("mark"), "id"], pieces=9) == 5_000
    assert check_sorted(spark, path, ["mark", "id"], descending=["mark"]) == 9
    rows = read_sorted(spark, path).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, 5_001))
    assert [(r["mark"], r["id"]) for r in rows] == sorted(
        ((r["mark"], r["id"]) for r in marks.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_file").count().collect()]
    assert max(sizes) < 1_200  # the mark of a third of the rows lies in several files


def test_files_out_of_order_are_noticed(spark, marks, tmp_path):
    path = str(tmp_path / "t")
    publish_sorted(marks, path, ["mark", "id"], pieces=6)
    assert check_sorted(spark, path, ["mark", "id"]) == 6
    with pytest.raises(OrderError):
        check_sorted(spark, path, ["id"])
    twice = str(tmp_path / "twice")
    shutil.copytree(path, twice)
    extra = sorted(glob.glob(f"{twice}/part-*.parquet"))[2]
    shutil.copy(extra, os.path.join(twice, "part-99999.parquet"))
    with pytest.raises(OrderError, match="1 of 6"):
        check_sorted(spark, twice, ["mark", "id"])


def test_an_empty_table_is_in_order(spark, marks, tmp_path):
    path = str(tmp_path / "t")
    assert publish_sorted(marks.where("false"), path, ["id"]) == 0
    assert check_sorted(spark, path, ["id"]) == 0 and read_sorted(spark, path).count() == 0


@pytest.mark.parametrize(
    ("name", "keys"),
    [
        ("report_program_kpis", ["program_id", "current_level"]),
        ("report_absence_bands", ["program_id", "absence_category"]),
        ("absence_grade_bands", ["program_id", "absence_category"]),
        ("report_semester_trend", ["program_id", "semester_id"]),
        ("report_hardest_modules", ["taux_reussite_pct"]),
        ("report_top_at_risk", ["average_grade"]),
        ("report_most_absent", ["-total_hours_absent", "student_id", "academic_year"]),
        ("chart_success_by_semester", ["semester_id"]),
    ],
)
def test_sorted_reports_come_in_order(spark, sf_dir, name, keys):
    rows = entry_module.queries()[name](spark, sf_dir).collect()

    def key(row):
        return tuple(
            (row[k.lstrip("-")] is not None, -row[k[1:]] if k[0] == "-" else row[k] or 0 if row[k] is None else row[k])
            for k in keys
        )

    assert rows and [key(r) for r in rows] == sorted(key(r) for r in rows)


def test_sketches_merge_to_any_grouping(spark, tables):
    fine = sketches.student_sketches(tables.silver("activities"), tables.silver("students"))
    facts = tables.silver("activities").join(tables.silver("students").select("student_id", "program_id"), "student_id")
    for by in (["program_id"], ["academic_year", "platform"], []):
        merged = sketches.merged_sketches(fine, by).select(*by, sketches.estimated_students().alias("n"))
        exact = facts.groupBy(*by).agg(F.count_distinct("student_id").alias("n"))
        got, want = ({tuple(r[c] for c in by): r["n"] for r in df.collect()} for df in (merged, exact))
        assert got.keys() == want.keys()
        assert all(abs(got[k] - n) <= max(1, 0.03 * n) for k, n in want.items())


def test_merging_sketches_reads_no_facts(spark, tables, tmp_path, plan):
    path = str(tmp_path / "s")
    sketches.student_sketches(tables.silver("activities"), tables.silver("students")).write.parquet(path)
    text = plan(sketches.merged_sketches(spark.read.parquet(path), ["program_id"]))
    assert text.count("FileScan") == 1 and "students_sketch" in text
