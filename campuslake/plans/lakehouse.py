"""The nightly run: sources to bronze, a quality report, silver, gold."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import cleaning, kpis, quality
from ..schemas import GOLD_PARTITIONS, TABLES
from ..sinks.catalog import register_tables
from ..sinks.publish import publish_all
from ..sinks.runs import repoint, run_folder
from ..sources.tables import read_table


#: The tables of a whole run by stage.
LAYOUT: dict[str, tuple[str, ...]] = {"bronze": tuple(TABLES), "silver": tuple(TABLES), "gold": tuple(GOLD_PARTITIONS)}

#: The cleaned tables that the KPI tables are computed from.
GOLD_INPUTS = ("grades", "absences", "students", "modules", "activities")


@dataclass
class Run:
    """Row counts per stage and table, and the quality rows of the bronze tables."""

    counts: dict[tuple[str, str], int] = field(default_factory=dict)
    quality: list[dict] = field(default_factory=list)

    def add(self, stage: str, counts: dict[str, int]) -> None:
        self.counts |= {(stage, table): rows for table, rows in counts.items()}


class QualityError(RuntimeError):
    """Raised by ``on_issue="fail"`` when a bronze table has duplicates or NULLs."""


def clean_tables(raw: dict[str, DataFrame], observed: dict[str, quality.Observed] | None = None) -> dict[str, DataFrame]:
    """All eight cleaned tables; ``observed`` profiles count what is left of each key."""
    watch = {name: seen.watch_unique for name, seen in (observed or {}).items()}
    return {name: cleaning.clean(name, df, watch.get(name)) for name, df in raw.items()}


def gold_from_silver(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The KPI tables that need cleaned tables only."""
    grades, absences, students = silver["grades"], silver["absences"], silver["students"]
    modules, activities = silver["modules"], silver["activities"]
    return {
        "success_rate": kpis.success_rate(grades, modules),
        "absenteeism": kpis.absenteeism(absences, students),
        "student_performance": kpis.student_performance(grades, absences, students),
        "activity_summary": kpis.activity_summary(activities, students),
        "semester_dashboard": kpis.semester_dashboard(grades, absences, modules),
    }


def gold_from_gold(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The KPI tables built from other KPI tables."""
    performance = gold["student_performance"]
    return {
        "program_kpis": kpis.program_kpis(performance),
        "correlation_abs_grades": kpis.correlation_abs_grades(performance, gold["absenteeism"]),
    }


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven KPI tables as one lazy composition."""
    base = gold_from_silver(silver)
    tables = base | gold_from_gold(base)
    return {name: tables[name] for name in GOLD_PARTITIONS}


def gold_schemas(silver: dict[str, DataFrame]) -> dict[str, StructType]:
    """The columns of the seven KPI tables, of plans over no rows: planning them reads nothing."""
    return {name: df.schema for name, df in gold_tables({name: df.limit(0) for name, df in silver.items()}).items()}


def publish_gold(
    spark: SparkSession, silver: dict[str, DataFrame], root: str, fmt: str = "parquet"
) -> dict[str, int]:
    """Write the seven KPI tables; those built on other KPI tables read the written ones.

    ``silver`` are stored tables: several KPIs read each of them, and would each clean it again.
    """
    base = gold_from_silver(silver)
    counts = publish_all(base, root, fmt, GOLD_PARTITIONS)
    written = {
        name: read_table(spark, f"{root}/{name}", fmt, base[name].schema)
        for name in ("student_performance", "absenteeism")
    }
    return counts | publish_all(gold_from_gold(written), root, fmt, GOLD_PARTITIONS)


def _read_all(spark: SparkSession, root: str, stage: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{root}/{stage}/{name}", fmt) for name in TABLES}


def ingest(sources: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Stage 1: land the sources as they are, in Parquet."""
    return publish_all(sources, f"{root}/bronze")


def ingest_observed(sources: dict[str, DataFrame], root: str) -> tuple[dict[str, int], dict[str, quality.Observed]]:
    """Stage 1, with what stage 2 needs but the duplicates observed by the jobs that write the sources."""
    observed = {name: quality.Observed(name) for name in quality.QUALITY_RULES}
    watched = {name: observed[name].watch(df) if name in observed else df for name, df in sources.items()}
    return ingest(watched, root), observed


def check(spark: SparkSession, root: str, on_issue: str = "report") -> list[dict]:
    """Stage 2: profile bronze tables; informs only, unless ``on_issue="fail"``."""
    return _judge(quality.report(_read_all(spark, root, "bronze")), on_issue)


def _judge(report: DataFrame, on_issue: str) -> list[dict]:
    rows = [row.asDict() for row in report.collect()]
    faulty = sorted({row["table"] for row in rows if row["status"] != "OK"})
    if on_issue == "fail" and faulty:
        raise QualityError("bronze tables with duplicates or NULLs: " + ", ".join(faulty))
    return rows


def to_silver(
    spark: SparkSession, root: str, fmt: str = "parquet", observed: dict[str, quality.Observed] | None = None
) -> dict[str, int]:
    """Stage 3: clean the eight bronze tables; ``observed`` profiles learn of their duplicates on the way."""
    return publish_all(clean_tables(_read_all(spark, root, "bronze"), observed), f"{root}/silver", fmt)


def to_gold(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, int]:
    """Stage 4: compute the seven KPI tables."""
    return publish_gold(spark, _read_all(spark, root, "silver", fmt), f"{root}/gold", fmt)


def register(spark: SparkSession, root: str, fmt: str = "parquet", prefix: str = "gold_") -> list[str]:
    """Stage 5: SQL tables over the seven KPI tables, brought up to date with what gold wrote."""
    # Schemas of the plans, not of the folders: those would turn partition values into numbers.
    schemas = gold_schemas(_read_all(spark, root, "silver", fmt))
    return register_tables(spark, f"{root}/gold", schemas, GOLD_PARTITIONS, fmt, prefix)


def run(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    fmt: str = "parquet",
    on_issue: str = "report",
    prefix: str | None = None,
) -> Run:
    """Run every stage through files under ``root``; with a ``prefix``, also register the KPI tables.

    Each stage reads what the one before wrote, so a stage can be started again on its own
    and no plan grows longer than one stage. Bronze is always Parquet; ``fmt`` is the format
    of silver and gold. Duplicates are counted where silver removes them, unless they are to
    stop the run before it.
    """
    result = Run()
    landed, observed = ingest_observed(sources, root)
    result.add("bronze", landed)
    if on_issue == "fail":
        written = {name: read_table(spark, f"{root}/bronze/{name}", schema=sources[name].schema) for name in observed}
        result.quality = _judge(quality.observed_report(observed, written), on_issue)
        result.add("silver", to_silver(spark, root, fmt))
    else:
        result.add("silver", to_silver(spark, root, fmt, observed))
        result.quality = _judge(quality.observed_report(observed), on_issue)
    result.add("gold", to_gold(spark, root, fmt))
    if prefix is not None:
        register(spark, root, fmt, prefix)
    return result


def refresh_gold(
    spark: SparkSession,
    silver: dict[str, DataFrame],
    root: str,
    started: datetime | None = None,
    fmt: str = "parquet",
    prefix: str | None = None,
) -> dict[str, int]:
    """Write the seven KPI tables as one dated run, then point the registered names at it.

    Readers of the names see the tables of the run before until all seven are written, and if one
    cannot be written they go on seeing those. ``silver``: see :func:`publish_gold`.
    """
    folder = f"{run_folder(root, started or datetime.now(timezone.utc))}/gold"
    counts = publish_gold(spark, silver, folder, fmt)
    if prefix is not None:
        repoint(spark, folder, gold_schemas(silver), GOLD_PARTITIONS, fmt, prefix)
    return counts


def run_dated(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    started: datetime | None = None,
    fmt: str = "parquet",
    on_issue: str = "report",
    prefix: str | None = None,
) -> Run:
    """A whole run in a dated folder of its own; with a ``prefix``, registered names move to it at the end.

    ``sinks.runs`` reads runs back, of any date, and removes old ones.
    """
    folder = run_folder(root, started or datetime.now(timezone.utc))
    result = run(spark, sources, folder, fmt, on_issue)
    if prefix is not None:
        repoint_run(spark, folder, fmt, prefix)
    return result


def repoint_run(spark: SparkSession, folder: str, fmt: str = "parquet", prefix: str = "gold_") -> list[str]:
    """Point the registered names at the KPI tables of one run's folder."""
    schemas = gold_schemas(_read_all(spark, folder, "silver", fmt))
    return repoint(spark, f"{folder}/gold", schemas, GOLD_PARTITIONS, fmt, prefix)
