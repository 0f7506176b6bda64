"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import absence_band
from ..operators import cleaning, dedup, joins, kpis, quality, reports, sketches
from ..schemas import GOLD_PARTITIONS, TABLES
from ..sinks import (
    check_sorted,
    cluster_by,
    cluster_zorder,
    compact,
    compact_bins,
    list_tables,
    publish,
    publish_all,
    publish_snapshot,
    publish_sorted,
    read_snapshot,
    read_sorted,
    register_tables,
    retain_snapshots,
    snapshot_history,
    table_detail,
)
from ..sinks.catalog import register_table
from ..sinks.runs import read_run, run_history
from ..sinks.storage import clear_scratch, scratch_folder
from ..sources import land_inferred, read_csv, read_path_sql, read_table, registrations_from_series
from ..sources.csv_files import CORRUPT
from . import fixtures, lakehouse

Query = Callable[[SparkSession, str], DataFrame]

PROGRAM = "ASIA"
FIRST_PUBLICATION = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


class Tables:
    """Source, cleaned and KPI tables of one data set, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = fixtures.source(self.spark, self.sf_dir, name)
        return self._raw[name]

    def silver(self, name: str) -> DataFrame:
        if name not in self._silver:
            self._silver[name] = cleaning.clean(name, self.raw(name))
        return self._silver[name]

    def silvers(self, *names: str) -> list[DataFrame]:
        return [self.silver(name) for name in names]

    def stored(self, *names: str) -> Tables:
        """The same tables, with these cleaned ones written once and read from their files by all that follows."""
        folder, kept = self.scratch("silver"), Tables(self.spark, self.sf_dir)
        cleaned = {name: self.silver(name) for name in names}
        publish_all(cleaned, folder)
        written = {name: read_table(self.spark, f"{folder}/{name}", schema=df.schema) for name, df in cleaned.items()}
        kept._raw, kept._silver = dict(self._raw), self._silver | written
        return kept

    def scratch(self, label: str) -> str:
        return scratch_folder(self.spark, label)

    @cached_property
    def success_rate(self) -> DataFrame:
        return kpis.success_rate(*self.silvers("grades", "modules"))

    @cached_property
    def absenteeism(self) -> DataFrame:
        return kpis.absenteeism(*self.silvers("absences", "students"))

    @cached_property
    def performance(self) -> DataFrame:
        return kpis.student_performance(*self.silvers("grades", "absences", "students"))

    @cached_property
    def program_kpis(self) -> DataFrame:
        return kpis.program_kpis(self.performance)

    @cached_property
    def activity_summary(self) -> DataFrame:
        return kpis.activity_summary(*self.silvers("activities", "students"))

    @cached_property
    def grade_bands(self) -> DataFrame:
        return kpis.correlation_abs_grades(self.performance, self.absenteeism)

    @cached_property
    def semester_dashboard(self) -> DataFrame:
        return kpis.semester_dashboard(*self.silvers("grades", "absences", "modules"), self.raw("grades"))


def _counts(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    return spark.createDataFrame(rows, names)


# --- joins -----------------------------------------------------------------------------


def join_grades_modules(t: Tables) -> DataFrame:
    return joins.grades_with_modules(*t.silvers("grades", "modules"), t.raw("grades")).select(
        "grade_id", "student_id", "module_id", "module_name", "program_id", "grade", "mention"
    )


def join_absences_students(t: Tables) -> DataFrame:
    return joins.absences_with_students(*t.silvers("absences", "students"), t.raw("absences")).select(
        "absence_id", "student_id", "last_name", "program_id", "current_level", "hours", "is_justified"
    )


def join_activities_students(t: Tables) -> DataFrame:
    return joins.activities_with_programs(*t.silvers("activities", "students"), t.raw("activities")).select(
        "activity_id", "student_id", "program_id", "current_level", "activity_type", "score"
    )


def join_semester_modules(t: Tables) -> DataFrame:
    return joins.semester_grades(*t.silvers("grades", "modules"), t.raw("grades"))


def join_left_performance(t: Tables) -> DataFrame:
    results = kpis.normal_session_results(t.silver("grades"))
    return joins.students_with(t.silver("students"), results).select(
        "student_id", "program_id", "average_grade", "nb_modules_enrolled", "nb_modules_passed"
    )


def join_left_hours(t: Tables) -> DataFrame:
    hours = kpis.hours_per_student(t.silver("absences"))
    return joins.students_with(t.silver("students"), hours).select(
        "student_id", "program_id", "total_hours_absent"
    )


def join_fanout_hours(t: Tables) -> DataFrame:
    return joins.performance_with_hours(t.performance, t.absenteeism).select(
        "student_id",
        "program_id",
        "hours_absent",
        absence_band(F.col("hours_absent")).alias("absence_category"),
    )


def join_semester_composite(t: Tables) -> DataFrame:
    grades = t.silver("grades")
    stats = (
        joins.semester_grades(grades, t.silver("modules"), t.raw("grades"))
        .groupBy("semester_id", "academic_year", "program_id")
        .agg(F.count(F.lit(1)).alias("nb_grades"))
    )
    return joins.semester_with_absences(stats, kpis.semester_absence_stats(t.silver("absences")))


# --- sources and sinks -----------------------------------------------------------------


def _as_csv(t: Tables, name: str) -> str:
    """A source table as headered CSV."""
    folder = t.scratch(f"csv-{name}")
    (
        t.raw(name)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return folder


def _csv_roundtrip(t: Tables, name: str) -> DataFrame:
    """Write a source table as headered CSV, then ingest it."""
    return read_csv(t.spark, _as_csv(t, name), name)


def ingest_csv_inferred(t: Tables) -> DataFrame:
    """The inferred type of every column of the CSV sources, with its values and distinct values."""
    parts = []
    for name in (n for n, table in TABLES.items() if table.source == "csv"):
        landed = land_inferred(t.spark, _as_csv(t, name), t.scratch(f"landing-{name}"))
        counts = [F.struct(F.count(c).alias("num_values"), F.count_distinct(c).alias("num_distinct")).alias(c) for c in landed.columns]
        described = [
            F.struct(
                F.lit(c).alias("column_name"), F.lit(kind).alias("type_name"),
                F.col(f"{c}.num_values").alias("num_values"), F.col(f"{c}.num_distinct").alias("num_distinct"),
            )
            for c, kind in landed.dtypes
        ]
        parts.append(landed.agg(*counts).select(F.lit(name).alias("table_name"), F.inline(F.array(*described))))
    return reduce(DataFrame.unionByName, parts)


def publish_overwrite(t: Tables) -> DataFrame:
    """A second full refresh replaces the first."""
    folder, cleaned = t.scratch("grades"), t.silver("grades")
    publish(t.raw("grades"), folder)
    publish(cleaned, folder)
    return read_table(t.spark, folder, schema=cleaned.schema)


def publish_overwrite_schema(t: Tables) -> DataFrame:
    """A refresh with other columns replaces the schema as well."""
    folder = t.scratch("registrations")
    publish(t.raw("registrations").drop("tuition_paid"), folder)
    publish(
        t.silver("registrations").withColumn("registration_id", F.col("registration_id").cast("string")),
        folder,
    )
    return read_table(t.spark, folder)


def publish_partitioned_read(t: Tables) -> DataFrame:
    """A table laid out by program, read back for one program."""
    folder = t.scratch("student_performance")
    publish(t.performance, folder, partition_by=GOLD_PARTITIONS["student_performance"])
    return reports.for_program(read_table(t.spark, folder, schema=t.performance.schema), PROGRAM)


def report_program_filter(t: Tables) -> DataFrame:
    folder = t.scratch("success_rate")
    publish(t.success_rate, folder, partition_by=GOLD_PARTITIONS["success_rate"])
    return reports.for_program(read_table(t.spark, folder, schema=t.success_rate.schema), PROGRAM)


def load_counts(t: Tables) -> DataFrame:
    """Rows of each source table, counted by the job that lands it."""
    landed = publish_all({name: t.raw(name) for name in TABLES}, t.scratch("bronze"))
    return _counts(t.spark, list(landed.items()), "table_name string, num_rows long")


def stage_row_counts(t: Tables) -> DataFrame:
    """Rows written by every stage of a full run."""
    done = lakehouse.run(t.spark, {name: t.raw(name) for name in TABLES}, t.scratch("run"))
    rows = [(stage, table, n) for (stage, table), n in done.counts.items()]
    return _counts(t.spark, rows, "stage string, table_name string, num_rows long")


def _new_database(t: Tables) -> str:
    name = f"campuslake_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{t.scratch('database')}'")
    return name


def clean_up(spark: SparkSession) -> None:
    """Drop the databases of finished queries and delete their working tables."""
    for database in spark.catalog.listDatabases("campuslake_*"):
        spark.sql(f"DROP DATABASE {database.name} CASCADE")
    clear_scratch(spark)


def catalog_gold_query(t: Tables) -> DataFrame:
    """Report SQL over a registered KPI table."""
    folder, database = t.scratch("gold"), _new_database(t)
    publish(t.success_rate, folder, partition_by=GOLD_PARTITIONS["success_rate"])
    register_table(
        t.spark,
        f"{database}.gold_success_rate",
        folder,
        schema=t.success_rate.schema,
        partition_by=GOLD_PARTITIONS["success_rate"],
    )
    return t.spark.sql(
        f"""SELECT program_id, difficulty, sum(nb_grades) AS nb_grades, max(grade_max) AS grade_max
        FROM {database}.gold_success_rate GROUP BY program_id, difficulty"""
    )


def catalog_after_refresh(t: Tables) -> DataFrame:
    """A registered table follows a refresh that drops a program, adds one and renames a column."""
    folder, name = t.scratch("gold"), f"{_new_database(t)}.gold_success_rate"
    layout = GOLD_PARTITIONS["success_rate"]
    first = t.success_rate.where(F.col("program_id") != PROGRAM)
    publish(first, folder, partition_by=layout)
    register_table(t.spark, name, folder, schema=first.schema, partition_by=layout)
    second = t.success_rate.where(F.col("program_id") != "AFRICA").withColumnRenamed("grade_max", "best")
    publish(second, folder, partition_by=layout)
    register_table(t.spark, name, folder, schema=second.schema, partition_by=layout)
    return t.spark.sql(
        f"""SELECT program_id, count(*) AS nb_rows, sum(nb_grades) AS nb_grades, max(best) AS best
        FROM {name} GROUP BY program_id"""
    )


def ingest_csv_malformed(t: Tables) -> DataFrame:
    """Grades of which some are not numbers: the lines are kept beside the parsed values."""
    folder = t.scratch("csv-malformed")
    text = F.when(F.col("grade") >= 15, F.concat(F.col("grade").cast("string"), F.lit(" points")))
    grades = t.raw("grades").withColumn("grade", F.coalesce(text, F.col("grade").cast("string")))
    grades.write.option("header", True).csv(folder)
    read = read_csv(t.spark, folder, "grades", keep_malformed=True)
    return read.select("grade_id", "grade", F.col(CORRUPT).isNotNull().alias("malformed"))


def quality_observed(t: Tables) -> DataFrame:
    """The quality report from what the jobs that land the tables observe."""
    folder = t.scratch("bronze")
    observed = {name: quality.Observed(name) for name in quality.QUALITY_RULES}
    publish_all({name: seen.watch(t.raw(name)) for name, seen in observed.items()}, folder)
    written = {name: read_table(t.spark, f"{folder}/{name}") for name in observed}
    return quality.observed_report(observed, written)


def activity_students_sketch(t: Tables) -> DataFrame:
    """Students per activity type and program: counted, and whether stored sketches come within 3 percent."""
    folder, by = t.scratch("sketches"), ["activity_type", "program_id"]
    publish(sketches.student_sketches(*t.silvers("activities", "students")), folder)
    merged = sketches.merged_sketches(read_table(t.spark, folder), by)
    activities, students = t.silvers("activities", "students")
    exact = (
        activities.join(students.select("student_id", "program_id"), "student_id")
        .groupBy(*by)
        .agg(F.count_distinct("student_id").alias("nb_students"))
    )
    off = F.abs(sketches.estimated_students() - F.col("nb_students"))
    return exact.join(merged, by).select(*by, "nb_students", (off <= 0.03 * F.col("nb_students")).alias("sketch_is_close"))


def sorted_publication(t: Tables) -> DataFrame:
    """The most absent students as a stored table, with their positions."""
    folder = t.scratch("most-absent")
    order = ["total_hours_absent", "student_id", "academic_year"]
    publish_sorted(reports.most_absent(t.absenteeism), folder, [F.desc(order[0]), *order[1:]])
    check_sorted(t.spark, folder, order, descending=order[:1])
    return read_sorted(t.spark, folder)


def catalog_listing(t: Tables) -> DataFrame:
    """All seven KPI tables published, registered and listed with their row counts."""
    folder, database = t.scratch("gold"), _new_database(t)
    silver = _enrolled(t.stored(*lakehouse.GOLD_INPUTS), ALL)
    lakehouse.publish_gold(t.spark, silver, folder)
    gold = lakehouse.gold_schemas(silver)
    register_tables(t.spark, folder, gold, GOLD_PARTITIONS, prefix=f"{database}.gold_")
    counted = " UNION ALL ".join(
        f"SELECT 'gold_{name}' AS table_name, count(*) AS num_rows FROM {database}.gold_{name}"
        for name in gold
    )
    return list_tables(t.spark, database).join(t.spark.sql(counted), "table_name")


def path_sql_query(t: Tables) -> DataFrame:
    folder = t.scratch("program_kpis")
    publish(t.program_kpis, folder)
    return read_path_sql(t.spark, folder)


def seed_registrations(t: Tables) -> DataFrame:
    """One generated registration per customer number."""
    numbers = t.spark.read.parquet(f"{t.sf_dir}/customer.parquet").select(
        (F.col("c_custkey") + 1).alias("id")
    )
    return registrations_from_series(numbers)


# --- table maintenance -----------------------------------------------------------------


def _published_versions(t: Tables) -> str:
    """Absenteeism published three times: all rows, justified ones only, all rows again."""
    folder, full = t.scratch("absenteeism"), t.absenteeism
    partial = full.where(F.col("nb_unjustified") == 0)
    for days, df in ((0, full), (5, partial), (10, full)):
        publish_snapshot(df, folder, FIRST_PUBLICATION + timedelta(days=days))
    return folder


def snapshot_as_of(t: Tables) -> DataFrame:
    return read_snapshot(t.spark, _published_versions(t), 1)


def snapshot_versions(t: Tables) -> DataFrame:
    return snapshot_history(t.spark, _published_versions(t)).withColumn(
        "published_at", F.date_format("published_at", "yyyy-MM-dd")
    )


def snapshot_retention(t: Tables) -> DataFrame:
    """Versions left ten days after the first publication, keeping a week."""
    folder = _published_versions(t)
    retain_snapshots(t.spark, folder, now=FIRST_PUBLICATION + timedelta(days=10))
    return snapshot_history(t.spark, folder).select("version", "num_rows")


def compact_files(t: Tables) -> DataFrame:
    source, target = t.scratch("grades"), t.scratch("grades-compact")
    publish(t.silver("grades"), source)
    compact(t.spark, source, target)
    return read_table(t.spark, target, schema=t.silver("grades").schema)


def compact_partitioned(t: Tables) -> DataFrame:
    source, target = t.scratch("performance"), t.scratch("performance-compact")
    layout = GOLD_PARTITIONS["student_performance"]
    publish(t.performance, source, partition_by=layout)
    compact(t.spark, source, target, t.performance.schema, layout)
    return read_table(t.spark, target, schema=t.performance.schema)


def cluster_by_column(t: Tables) -> DataFrame:
    folder = t.scratch("student_performance-clustered")
    publish(cluster_by(t.performance, ["program_id", "current_level"], ["student_id"]), folder)
    return read_table(t.spark, folder, schema=t.performance.schema)


def cluster_zorder_columns(t: Tables) -> DataFrame:
    folder = t.scratch("student_performance-zorder")
    publish(cluster_zorder(t.performance, ["average_grade", "total_hours_absent"], ["student_id"]), folder)
    return read_table(t.spark, folder, schema=t.performance.schema)


def compact_small_files(t: Tables) -> DataFrame:
    """Performance laid out by program in small files, of which all but the largest are merged."""
    folder, layout = t.scratch("performance-bins"), GOLD_PARTITIONS["student_performance"]
    t.performance.repartition(6, "student_id").write.partitionBy(*layout).parquet(folder)
    schema = t.performance.schema
    largest = read_table(t.spark, folder, schema=schema).agg(F.max("_metadata.file_size")).first()[0]
    compact_bins(t.spark, folder, schema, layout, small_bytes=largest)
    return read_table(t.spark, folder, schema=schema)


def table_details(t: Tables) -> DataFrame:
    """Format, files and rows of a table stored in three files; bytes vary, so only that there are some."""
    folder = t.scratch("activities")
    publish(t.silver("activities").repartition(3, "activity_id"), folder)
    return table_detail(t.spark, folder).select(
        "format", "num_files", "num_rows", (F.col("size_in_bytes") > 0).alias("has_bytes")
    )


# --- runs ------------------------------------------------------------------------------


def _enrolled(t: Tables, programs: str) -> dict[str, DataFrame]:
    """The cleaned tables, with the students of some programs."""
    silver = {name: t.silver(name) for name in lakehouse.GOLD_INPUTS}
    return silver | {"students": silver["students"].where(programs)}


#: What the two runs of the queries below know of: all programs but one, then all programs.
EARLIER, ALL = f"program_id <> '{PROGRAM}'", "true"
GOLD_ONLY = {"gold": lakehouse.LAYOUT["gold"]}


def catalog_after_swap(t: Tables) -> DataFrame:
    """Report SQL over two registered KPI tables, planned before and after a refresh of all of them."""
    folder, database, t = t.scratch("lake"), _new_database(t), t.stored(*lakehouse.GOLD_INPUTS)
    sql = f"""SELECT '{{}}' AS planned, k.program_id, k.current_level, k.nb_students, count(p.student_id) AS nb_rows
        FROM {database}.gold_program_kpis k JOIN {database}.gold_student_performance p
        ON k.program_id = p.program_id AND k.current_level = p.current_level GROUP BY ALL"""
    lakehouse.refresh_gold(t.spark, _enrolled(t, EARLIER), folder, FIRST_PUBLICATION, prefix=f"{database}.gold_")
    before = t.spark.sql(sql.format("before"))
    later = FIRST_PUBLICATION + timedelta(days=1)
    lakehouse.refresh_gold(t.spark, _enrolled(t, ALL), folder, later, prefix=f"{database}.gold_")
    return before.unionByName(t.spark.sql(sql.format("after")))


def _two_runs(t: Tables) -> str:
    """The KPI tables of two days; a third run was begun and did not get far."""
    folder, t = t.scratch("lake"), t.stored(*lakehouse.GOLD_INPUTS)
    for days, programs in ((0, EARLIER), (1, ALL)):
        lakehouse.refresh_gold(t.spark, _enrolled(t, programs), folder, FIRST_PUBLICATION + timedelta(days=days))
    publish(t.program_kpis, f"{folder}/run=20240103T120000Z/gold/program_kpis")
    return folder


def runs_history(t: Tables) -> DataFrame:
    """Rows of each table of each whole run."""
    return run_history(t.spark, _two_runs(t), GOLD_ONLY).select(
        F.date_format("started_at", "yyyy-MM-dd").alias("day"), "stage", "table_name", "num_rows"
    )


def runs_as_of(t: Tables) -> DataFrame:
    """KPIs as they were after the first run, beside students counted in the table they were built from."""
    schemas = {"student_performance": t.performance.schema}
    gold = read_run(t.spark, _two_runs(t), GOLD_ONLY, FIRST_PUBLICATION + timedelta(hours=20), schemas=schemas)["gold"]
    counted = gold["student_performance"].groupBy("program_id", "current_level").agg(F.count(F.lit(1)).alias("nb_rows"))
    return gold["program_kpis"].join(counted, ["program_id", "current_level"])


def _registry() -> dict[str, Callable[[Tables], DataFrame]]:
    registry: dict[str, Callable[[Tables], DataFrame]] = {
        "program_kpis": lambda t: t.program_kpis,
        "module_success_rate": lambda t: t.success_rate,
        "student_absenteeism": lambda t: t.absenteeism,
        "student_performance": lambda t: t.performance,
        "activity_summary": lambda t: t.activity_summary,
        "absence_grade_bands": lambda t: t.grade_bands,
        "semester_dashboard": lambda t: t.semester_dashboard,
        "dedup_single_key": lambda t: dedup.keep_one(t.raw("grades"), "grade_id"),
        "dedup_composite_key": lambda t: dedup.keep_one(t.raw("semesters"), TABLES["semesters"].key),
        "join_grades_modules": join_grades_modules,
        "join_absences_students": join_absences_students,
        "join_activities_students": join_activities_students,
        "join_semester_modules": join_semester_modules,
        "join_left_performance": join_left_performance,
        "join_left_hours": join_left_hours,
        "join_fanout_hours": join_fanout_hours,
        "join_semester_composite": join_semester_composite,
        "quality_report": lambda t: quality.report({n: t.raw(n) for n in quality.QUALITY_RULES}),
        "report_program_kpis": lambda t: reports.program_overview(t.program_kpis),
        "report_top_at_risk": lambda t: reports.weakest_at_risk(t.performance),
        "report_absence_bands": lambda t: reports.absence_bands(t.grade_bands),
        "report_semester_trend": lambda t: reports.semester_trend(t.semester_dashboard),
        "report_hardest_modules": lambda t: reports.hardest_modules(t.success_rate),
        "report_most_absent": lambda t: reports.most_absent(t.absenteeism),
        "report_program_filter": report_program_filter,
        "chart_module_success": lambda t: reports.module_success(t.success_rate),
        "chart_category_share": lambda t: reports.category_share(t.performance),
        "chart_engagement": lambda t: reports.engagement(t.activity_summary),
        "chart_grade_by_band": lambda t: reports.grade_by_band(t.grade_bands),
        "chart_success_by_semester": lambda t: reports.success_by_semester(t.semester_dashboard),
        "ingest_csv_roundtrip": lambda t: _csv_roundtrip(t, "students"),
        "ingest_csv_grades": lambda t: _csv_roundtrip(t, "grades"),
        "seed_registrations": seed_registrations,
        "load_counts": load_counts,
        "stage_row_counts": stage_row_counts,
        "publish_overwrite": publish_overwrite,
        "publish_overwrite_schema": publish_overwrite_schema,
        "publish_partitioned_read": publish_partitioned_read,
        "catalog_gold_query": catalog_gold_query,
        "catalog_listing": catalog_listing,
        "path_sql_query": path_sql_query,
        "snapshot_as_of": snapshot_as_of,
        "snapshot_history": snapshot_versions,
        "retain_snapshots": snapshot_retention,
        "compact_files": compact_files,
        "compact_partitioned": compact_partitioned,
        "catalog_after_refresh": catalog_after_refresh,
        "ingest_csv_malformed": ingest_csv_malformed,
        "cluster_by_column": cluster_by_column,
        "table_detail": table_details,
        "ingest_csv_inferred": ingest_csv_inferred,
        "quality_observed": quality_observed,
        "activity_students_sketch": activity_students_sketch,
        "sorted_publication": sorted_publication,
        "cluster_zorder": cluster_zorder_columns,
        "compact_bins": compact_small_files,
        "catalog_after_swap": catalog_after_swap,
        "run_history": runs_history,
        "run_as_of": runs_as_of,
    }
    for name in TABLES:
        registry[f"clean_{name}"] = lambda t, name=name: t.silver(name)
        if TABLES[name].source == "csv" and name not in ("students", "grades"):
            registry[f"ingest_csv_{name}"] = lambda t, name=name: _csv_roundtrip(t, name)
    for name in quality.QUALITY_RULES:
        registry[f"quality_{name}"] = lambda t, name=name: quality.profile(t.raw(name), name)
    return registry


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return {
        name: lambda spark, sf_dir, build=build: build(Tables(spark, sf_dir))
        for name, build in _registry().items()
    }
