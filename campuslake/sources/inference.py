"""Column types of text files, found while the text is landed and not by a pass of its own.

Every value fits a set of types; a column fits those that all its values fit. Sets are bit masks and
are met by ``bit_and``, which does not care in what order or in how many parts it is done: the
same files give the same types however they are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Types from narrow to wide, each with the values that fit. Numbers that begin with a zero are codes.
#: A whole number fits double as well and a date timestamp, so columns that mix them get the wider one.
_WHOLE = r"^[+-]?(0|[1-9]\d*)$"
_DECIMAL = r"^[+-]?(0|[1-9]\d*|(?=\.\d))(\.\d*)?([eE][+-]?\d+)?$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_MOMENT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"


TYPES = ("boolean", "int", "bigint", "double", "date", "timestamp")
ALL = (1 << len(TYPES)) - 1


def _bits(*kinds: str) -> Column:
    return F.lit(sum(1 << TYPES.index(kind) for kind in kinds))


def _value_mask(value: Column) -> Column:
    """The types that one value fits; NULL for NULL.

    Patterns cost most, so a value meets only those that its shape leaves open: numbers and days begin
    with a sign, a point or a digit; days have two hyphens where no number has both; whole numbers
    have no point. Short ones fit without a cast, and a cast that fails costs more than any pattern.
    """

    def fits(kind: str) -> Column:
        return value.try_cast(kind).isNotNull()

    none = F.lit(0)
    length = F.length(value)
    whole = (
        F.when(length <= 9, _bits("int", "bigint", "double"))
        .when((length <= 12) & fits("int"), _bits("int", "bigint", "double"))
        .when(length <= 18, _bits("bigint", "double"))
        .when((length <= 21) & fits("bigint"), _bits("bigint", "double"))
        .otherwise(F.when(fits("double"), _bits("double")).otherwise(none))
    )
    real = F.when(fits("double"), _bits("double")).otherwise(none)
    day = F.when(value.rlike(_DAY) & fits("date"), _bits("date")).otherwise(none)
    moment = F.when(fits("timestamp"), _bits("timestamp")).otherwise(none)
    hyphens = (F.substring(value, 5, 1) == "-") & (F.substring(value, 8, 1) == "-")
    digits = (
        F.when(hyphens, F.when(value.rlike(_MOMENT), day.bitwiseOR(moment)).otherwise(none))
        .when(~value.contains(".") & value.rlike(_WHOLE), whole)
        .when(value.rlike(_DECIMAL), real)
        .otherwise(none)
    )
    return (
        F.when((value >= "+") & (value < ":"), digits)
        .when(F.lower(value).isin("true", "false"), _bits("boolean"))
        .when(value.isNotNull(), none)
    )


def type_mask(name: str) -> Column:
    """Aggregate: the types that all values of a text column fit, as a bit mask; NULL without values."""
    return F.bit_and(_value_mask(F.col(f"`{name}`")))


def narrowest(mask: int | None) -> str:
    """The narrowest type of a mask; text where there is none or no value."""
    return next((kind for bit, kind in enumerate(TYPES) if mask is not None and mask >> bit & 1), "string")


def land_inferred(spark: SparkSession, path: str, landing: str) -> DataFrame:
    """Land a headered CSV file or folder as text under ``landing`` and return it with inferred types.

    The text is read once: the tasks that write it observe the type masks. What is returned reads
    the landed Parquet and casts there. Empty cells are NULL and fit every type.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    names = reader.csv(path).columns
    text = reader.schema(", ".join(f"`{n}` string" for n in names)).option("enforceSchema", False).csv(path)
    seen = Observation()
    # Observed under plain names; the columns may be called anything.
    masks = [type_mask(name).alias(f"c{k}") for k, name in enumerate(names)]
    text.observe(seen, F.count(F.lit(1)).alias("rows"), *masks).write.mode("overwrite").parquet(landing)
    kinds = [narrowest(seen.get[f"c{k}"]) for k in range(len(names))]
    landed = spark.read.schema(text.schema).parquet(landing)
    return landed.select(*[F.col(f"`{n}`").cast(kind).alias(n) for n, kind in zip(names, kinds)])
