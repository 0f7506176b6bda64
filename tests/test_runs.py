"""Dated runs: whole sets of tables, swapped at once."""

from __future__ import annotations

import importlib
from datetime import datetime, timedelta, timezone

import pytest

from campuslake.plans import lakehouse
from campuslake.schemas import GOLD_PARTITIONS, TABLES

from campuslake.sinks import complete_runs, read_run, repoint, retain_runs, run_as_of, run_folder, run_history
from campuslake.sinks.publish import publish

DAY = datetime(2024, 1, 1, 3, tzinfo=timezone.utc)
NAMES = ("a", "b", "c", "d", "e", "f", "g")
LAYOUT = {"gold": NAMES}

@pytest.fixture
def database(spark):
    name = "runs_test"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")

def _write(spark, root: str, started: datetime, value: str, names=NAMES, columns=()) -> dict:
    """A run whose tables all hold ``value``, partitioned by it; returns their schemas."""
    df = spark.range(6).selectExpr("id", f"'{value}' as run", "concat('p', id % 2) as part", *columns)
    for name in names:
        publish(df, f"{run_folder(root, started)}/gold/{name}", partition_by=["part"] if name in "ab" else ())
    return {name: df.schema for name in NAMES}

PARTS = {"a": ("part",), "b": ("part",)}

def _seen(spark, database: str) -> set:
    return {(n, r["run"]) for n in NAMES for r in spark.sql(f"SELECT DISTINCT run FROM {database}.gold_{n} WHERE part = 'p1'").collect()}

def test_swap_moves_all_names_and_planned_queries_stay(spark, tmp_path, database, plan):
    root, prefix = str(tmp_path), f"{database}.gold_"
    schemas = _write(spark, root, DAY, "one")
    assert repoint(spark, f"{run_folder(root, DAY)}/gold", schemas, PARTS, prefix=prefix) == [prefix + n for n in NAMES]
    planned = spark.table(f"{database}.gold_a")
    assert _seen(spark, database) == {(n, "one") for n in NAMES}
    later = DAY + timedelta(days=1)
    repoint(spark, f"{run_folder(root, later)}/gold", _write(spark, root, later, "two"), PARTS, prefix=prefix)
    assert _seen(spark, database) == {(n, "two") for n in NAMES}
    assert {r["run"] for r in planned.collect()} == {"one"}
    assert "PartitionFilters: [isnotnull(part" in plan(spark.sql(f"SELECT * FROM {database}.gold_a WHERE part = 'p1'"))
    # Other columns: the name is created anew; partitions that a list in the catalog tracked as well.
    third = DAY + timedelta(days=2)
    schemas = _write(spark, root, third, "three", columns=["id * 2 as twice"])
    repoint(spark, f"{run_folder(root, third)}/gold", schemas, PARTS, prefix=prefix)
    assert spark.table(f"{database}.gold_a").columns == ["id", "run", "twice", "part"]
    assert _seen(spark, database) == {(n, "three") for n in NAMES}

def test_a_table_tracked_by_the_catalog_is_replaced(spark, tmp_path, database):
    from campuslake.sinks.catalog import register_table

    root, prefix = str(tmp_path), f"{database}.gold_"
    schemas = _write(spark, root, DAY, "one")
    register_table(spark, f"{prefix}a", f"{run_folder(root, DAY)}/gold/a", schema=schemas["a"], partition_by=["part"])
    later = DAY + timedelta(days=1)
    repoint(spark, f"{run_folder(root, later)}/gold", _write(spark, root, later, "two"), PARTS, prefix=prefix)
    assert {r["run"] for r in spark.table(f"{prefix}a").collect()} == {"two"}

def test_a_refresh_that_fails_half_way_is_not_noticed(spark, tables, tmp_path, database, monkeypatch):
    silver = {name: tables.silver(name) for name in TABLES}
    root, prefix = str(tmp_path / "lake"), f"{database}.gold_"
    some = silver | {"students": silver["students"].where("current_level = 1")}
    lakehouse.refresh_gold(spark, some, root, DAY, prefix=prefix)
    before = {n: sorted(map(repr, spark.table(prefix + n).collect())) for n in GOLD_PARTITIONS}
    written = []
    original = publish

    def failing(df, path, *args, **kwargs):
        written.append(path)
        if len(written) == 4:
            raise OSError("disk full")
        return original(df, path, *args, **kwargs)

    module = importlib.import_module("campuslake.sinks.publish")
    monkeypatch.setattr(module, "publish", failing)
    monkeypatch.setattr(module, "CONCURRENT_WRITES", 1)
    with pytest.raises(OSError, match="disk full"):
        lakehouse.refresh_gold(spark, silver, root, DAY + timedelta(days=1), prefix=prefix)
    assert {n: sorted(map(repr, spark.table(prefix + n).collect())) for n in GOLD_PARTITIONS} == before
    layout = {"gold": tuple(GOLD_PARTITIONS)}
    assert complete_runs(spark, root, layout) == [DAY]
    monkeypatch.undo()
    lakehouse.refresh_gold(spark, silver, root, DAY + timedelta(days=2), prefix=prefix)
    assert complete_runs(spark, root, layout) == [DAY, DAY + timedelta(days=2)]
    assert spark.table(f"{prefix}student_performance").count() == tables.performance.count()

def test_runs_are_found_read_counted_and_removed(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert complete_runs(spark, root, LAYOUT) == []
    assert run_history(spark, root, LAYOUT).count() == 0
    with pytest.raises(LookupError, match="no complete run"):
        run_as_of(spark, root, LAYOUT)
    days = [DAY + timedelta(days=d) for d in (0, 3, 6, 20)]
    for day, value, names in zip(days, ("one", "two", "broken", "four"), (NAMES, NAMES, NAMES[:4], NAMES)):
        _write(spark, root, day, value, names)
    (tmp_path / "lake" / "run=other").mkdir()
    whole = [days[0], days[1], days[3]]
    assert complete_runs(spark, root, LAYOUT) == whole
    assert run_as_of(spark, root, LAYOUT) == days[3]
    assert run_as_of(spark, root, LAYOUT, days[2] + timedelta(days=1)) == days[1]
    with pytest.raises(LookupError):
        run_as_of(spark, root, LAYOUT, DAY - timedelta(seconds=1))
    read = read_run(spark, root, LAYOUT, days[2])["gold"]
    assert {r["run"] for name in NAMES for r in read[name].collect()} == {"two"}
    history = run_history(spark, root, LAYOUT).collect()
    assert {(r["started_at"].day, r["table_name"], r["num_rows"]) for r in history} == {(d.day, n, 6) for d in whole for n in NAMES}
    gone = retain_runs(spark, root, LAYOUT, now=days[3], keep=timedelta(days=18))
    assert gone == [days[0]] and complete_runs(spark, root, LAYOUT) == whole[1:]
    assert retain_runs(spark, root, LAYOUT, now=days[3] + timedelta(days=99)) == days[1:3]
    assert complete_runs(spark, root, LAYOUT) == [days[3]]

def test_a_dated_run_and_its_names(spark, tables, tmp_path, database):
    sources = {n: tables.raw(n) for n in TABLES}
    root = str(tmp_path / "lake")
    done = lakehouse.run_dated(spark, sources, root, DAY, prefix=f"{database}.gold_")
    assert complete_runs(spark, root, lakehouse.LAYOUT) == [DAY]
    counted = {(r["stage"], r["table_name"]): r["num_rows"] for r in run_history(spark, root, lakehouse.LAYOUT).collect()}
    assert counted == done.counts
    assert spark.table(f"{database}.gold_program_kpis").exceptAll(tables.program_kpis).isEmpty()
