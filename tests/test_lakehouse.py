"""The whole run through files."""

from __future__ import annotations

import pytest

from campuslake.operators import quality
from campuslake.plans import lakehouse
from campuslake.schemas import GOLD_PARTITIONS, TABLES
from campuslake.sources import read_table


@pytest.fixture(scope="module")
def finished(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    return root, lakehouse.run(spark, {n: tables.raw(n) for n in TABLES}, root)


def test_every_stage_wrote_its_tables(finished):
    _, run = finished
    stages = {stage: {t for s, t in run.counts if s == stage} for stage, _ in run.counts}
    assert stages == {"bronze": set(TABLES), "silver": set(TABLES), "gold": set(GOLD_PARTITIONS)}


def test_counts_are_what_is_on_disk(spark, finished):
    root, run = finished
    for (stage, table), rows in run.counts.items():
        assert spark.read.parquet(f"{root}/{stage}/{table}").count() == rows


def test_files_hold_what_the_lazy_plan_computes(spark, tables, finished):
    root, _ = finished
    lazy = lakehouse.gold_tables({n: tables.silver(n) for n in TABLES})
    for name, df in lazy.items():
        written = read_table(spark, f"{root}/gold/{name}", schema=df.schema)
        assert written.count() == df.count()
        assert written.exceptAll(df).isEmpty(), name


def test_quality_informs_or_fails(spark, tables, finished, tmp_path):
    _, run = finished
    assert {row["table"] for row in run.quality} == {"students", "grades", "absences", "activities"}
    with pytest.raises(lakehouse.QualityError, match="students"):
        lakehouse.run(spark, {n: tables.raw(n) for n in TABLES}, str(tmp_path), on_issue="fail")
    assert not (tmp_path / "silver").exists()


def test_duplicates_are_counted_where_they_are_removed(spark, finished, tables, tmp_path, monkeypatch):
    """No bronze table is read again for its profile, which is that of the stage on its own."""
    root, run = finished
    key = lambda row: (row["table"], row["metric"])
    assert sorted(run.quality, key=key) == sorted(lakehouse.check(spark, root), key=key)
    asked = []
    profile = quality.Observed.profile
    monkeypatch.setattr(
        quality.Observed, "profile", lambda self, written=None: asked.append(written) or profile(self, *[written] * (written is not None))
    )
    sources = {n: tables.raw(n) for n in TABLES}
    sources["students"] = sources["students"].limit(0)
    again = lakehouse.run(spark, sources, str(tmp_path))
    assert asked == [None] * 4
    assert sorted(again.quality, key=key) == sorted(lakehouse.check(spark, str(tmp_path)), key=key)
    assert {r["value"] for r in again.quality if r["table"] == "students"} == {0}


def test_command_line_runs_single_stages(spark, tables, tmp_path, capsys):
    from campuslake.__main__ import main

    for name in TABLES:
        (
            tables.raw(name)
            .write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(str(tmp_path / f"{name}.csv"))
        )
    root = str(tmp_path / "lake")
    main(["--root", root, "--csv-dir", str(tmp_path), "--stage", "bronze", "quality"])
    assert "quality ISSUES students" in capsys.readouterr().out
    main(["--root", root, "--stage", "silver", "gold"])
    assert "student_performance" in capsys.readouterr().out
    silver = spark.read.parquet(f"{root}/silver/registrations")
    assert silver.count() == tables.silver("registrations").count()
    # Ids read from CSV are text, so other survivors may win among duplicates; students stay the same.
    keys = ["program_id", "current_level", "nb_students"]
    written = spark.read.parquet(f"{root}/gold/program_kpis").select(*keys)
    assert written.exceptAll(tables.program_kpis.select(*keys)).isEmpty()
    with pytest.raises(SystemExit):
        main(["--root", root, "--stage", "bronze"])


def test_registered_tables_hold_what_gold_wrote(spark, finished):
    root, _ = finished
    spark.sql("CREATE DATABASE IF NOT EXISTS run_register")
    try:
        for _ in range(2):  # the nightly repetition finds its tables
            names = lakehouse.register(spark, root, prefix="run_register.")
        assert names == [f"run_register.{name}" for name in GOLD_PARTITIONS]
        for name, df in lakehouse.gold_tables({n: spark.read.parquet(f"{root}/silver/{n}") for n in TABLES}).items():
            table = spark.table(f"run_register.{name}").select(*df.columns)
            assert [f.dataType for f in table.schema] == [f.dataType for f in df.schema]
            assert table.count() == spark.read.parquet(f"{root}/gold/{name}").count()
    finally:
        spark.sql("DROP DATABASE run_register CASCADE")
