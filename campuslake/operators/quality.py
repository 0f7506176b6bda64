"""Profile raw tables: one scan and one aggregation per table, whatever the number of metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import as_number
from ..schemas import QUALITY_RULES, QualityRule
from ..sources.csv_files import CORRUPT


def _distinct_keys(key: str) -> Column:
    """Number of distinct keys, NULL counting as one of them."""
    has_null = F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    return F.count_distinct(F.col(key)) + has_null


def _row_metrics(df: DataFrame, rule: QualityRule) -> dict[str, Column]:
    """The metrics that a writing job can observe: all but the duplicates."""
    metrics = {"total_rows": F.count(F.lit(1))}
    for name in rule.not_null:
        metrics[f"nulls_{name}"] = F.count_if(F.col(name).isNull())
    for name, (low, high) in rule.ranges.items():
        value = as_number(df, name)
        metrics[f"out_of_range_{name}"] = F.count_if((value < low) | (value > high))
        if df.schema[name].dataType.typeName() == "string":
            metrics[f"malformed_{name}"] = F.count_if(F.col(name).isNotNull() & value.isNull())
    if CORRUPT in df.columns:
        metrics["malformed_rows"] = F.count_if(F.col(CORRUPT).isNotNull())
    return metrics


def _judged(counts: DataFrame, table: str, rule: QualityRule) -> DataFrame:
    """Counts with the table's name before them and its status behind."""
    metrics = ["total_rows", "duplicates", *[c for c in counts.columns if c not in ("total_rows", "duplicates")]]
    faults = [F.col("duplicates")] + [F.col(f"nulls_{name}") for name in rule.not_null]
    clean = reduce(lambda left, right: left & right, [fault == 0 for fault in faults])
    return counts.select(
        F.lit(table).alias("table"),
        *metrics,
        F.when(clean, F.lit("OK")).otherwise(F.lit("ISSUES")).alias("status"),
    )


def profile(df: DataFrame, table: str, rule: QualityRule | None = None) -> DataFrame:
    """One row of counts for ``table``: rows, duplicate keys, NULLs, out-of-range values, status.

    The status is OK when there are no duplicates and no NULLs; out-of-range values are
    reported but do not change it, and neither do malformed values: text that is no number in a
    column that was read as text, and lines that were kept as malformed when they were read.
    """
    rule = rule or QUALITY_RULES[table]
    metrics = _row_metrics(df, rule)
    metrics["duplicates"] = F.count(F.lit(1)) - _distinct_keys(rule.key)
    return _judged(df.agg(*[metric.alias(name) for name, metric in metrics.items()]), table, rule)


class Observed:
    """Profiles a table while it is written: ``watch`` what is written, then ask for the ``profile``.

    NULLs, ranges and malformed values are counted by the writing tasks, and once if a task runs
    again. Only duplicates need rows to meet: they are counted where the table is de-duplicated later
    on, if ``watch_unique`` is asked to, and else the key column is read back.
    """

    def __init__(self, table: str, rule: QualityRule | None = None):
        self.table, self.rule = table, rule or QUALITY_RULES[table]
        self.seen, self.unique = Observation(), Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        metrics = _row_metrics(df, self.rule) | {"null_keys": F.count_if(F.col(self.rule.key).isNull())}
        return df.observe(self.seen, *[metric.alias(name) for name, metric in metrics.items()])

    def watch_unique(self, df: DataFrame) -> DataFrame:
        """Rows of one per key, with or without a row for NULL."""
        return df.observe(self.unique, F.count(self.rule.key).alias("keys"))

    def profile(self, written: DataFrame | None = None) -> DataFrame:
        """The profile as :func:`profile` gives it; call it after the write.

        ``written`` is what was written; without it, unique rows must have been watched and used.
        """
        counts = dict(self.seen.get)
        null_keys = counts.pop("null_keys")
        if written is None:
            keys = self.unique.get["keys"] + (null_keys > 0)
            duplicates = SparkSession.active().range(1).select(F.lit(counts["total_rows"] - keys).alias("duplicates"))
        else:
            duplicates = written.agg((F.count(F.lit(1)) - _distinct_keys(self.rule.key)).alias("duplicates"))
        known = duplicates.select(
            F.col("duplicates").cast("long"), *[F.lit(n).cast("long").alias(name) for name, n in counts.items()]
        )
        return _judged(known, self.table, self.rule)


def _long(profiles: list[DataFrame]) -> DataFrame:
    """Profiles as (table, metric, value, status) rows."""
    parts = []
    for row in profiles:
        metrics = [c for c in row.columns if c not in ("table", "status")]
        parts.append(row.unpivot(["table", "status"], metrics, "metric", "value"))
    return reduce(DataFrame.unionByName, parts).select("table", "metric", "value", "status")


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """The profiles of all tables with a rule, as (table, metric, value, status) rows."""
    return _long([profile(tables[name], name, rule) for name, rule in QUALITY_RULES.items()])


def observed_report(observed: dict[str, Observed], written: dict[str, DataFrame] | None = None) -> DataFrame:
    """The same rows as :func:`report` from what was observed while the tables were written (see ``Observed.profile``)."""
    return _long([seen.profile(written[name] if written else None) for name, seen in observed.items()])
