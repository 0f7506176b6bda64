"""Values are tested for the types that their shape leaves open, with the masks that all patterns give."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from campuslake.sources import inference
from campuslake.sources.inference import TYPES, type_mask

VALUES = (
    "", " 1", "1 ", "1\n", "0", "-0", "+0", "00", "007", "-7", "+7", "2147483647", "2147483648", "-2147483648", "-2147483649",
    "9223372036854775807", "9223372036854775808", "-9223372036854775808", "1.", ".5", "-.5", ".", "-", "+", "1e5", "1E400", "1.5e-3",
    "1.5e-33", "-1.5e-33", "123e-45", "1234-56-", "1.2.3", "1,5", "NaN", "inf", "Infinity", "1d", "0x1F", "true", "FALSE", "True ",
    "falsey", "2023-2024", "2023-09-01", "2023-02-30", "2023-09-01\n", "0000-01-01", "2023-09-01 10:00:00", "2023-09-01T10:00:00.25",
    "2023-09-01 25:00:00", "2023-9-1", "+2023-09-01", "١", "/1", ":1", "STU-1", "é",
)


def _by_all_patterns(value: F.Column) -> dict[str, F.Column]:
    whole = value.rlike(inference._WHOLE)
    return {
        "boolean": F.lower(value).isin("true", "false"),
        "int": whole & value.try_cast("int").isNotNull(),
        "bigint": whole & value.try_cast("bigint").isNotNull(),
        "double": value.rlike(inference._DECIMAL) & value.try_cast("double").isNotNull(),
        "date": value.rlike(inference._DAY) & value.try_cast("date").isNotNull(),
        "timestamp": value.rlike(inference._MOMENT) & value.try_cast("timestamp").isNotNull(),
    }


def test_masks_are_those_of_all_patterns(spark):
    frame = spark.createDataFrame([(v,) for v in VALUES], "v string")
    fits = [F.coalesce(c, F.lit(False)).alias(k) for k, c in _by_all_patterns(F.col("v")).items()]
    expected = {r["v"]: sum(1 << k for k, kind in enumerate(TYPES) if r[kind]) for r in frame.select("v", *fits).collect()}
    masks = {r["v"]: r["m"] for r in frame.groupBy("v").agg(type_mask("v").alias("m")).collect()}
    assert masks == expected


def test_few_patterns_per_column(spark):
    masked = spark.createDataFrame([("1",)], "v string").repartition(1).agg(type_mask("v").alias("m"))
    assert len(re.findall(r"RLIKE", masked._jdf.queryExecution().analyzed().toString())) <= 4
