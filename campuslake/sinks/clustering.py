"""Row order for skipping files: by one list of columns, or by several columns on equal terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that range boundaries are taken from, whatever the size of the table.
SAMPLE_ROWS = 20_000
#: A column is cut into 2**RANK_BITS ranges at most.
RANK_BITS = 6


def cluster_by(
    df: DataFrame, columns: Sequence[str], spread: Sequence[str] = (), pieces: int | None = None
) -> DataFrame:
    """Order rows so that each file covers a narrow range of ``columns``.

    Filters on these columns then skip files by their min/max statistics. ``spread`` names
    columns that vary within equal values, normally the key: they take part in the range
    cuts, so a value that holds a third of the table is cut into several files instead of
    landing in one task.
    """
    keys = [*columns, *spread]
    ranged = df.repartitionByRange(pieces, *keys) if pieces else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def range_boundaries(
    df: DataFrame, columns: Sequence[str], spread: Sequence[str] = (), ranges: int = 1 << RANK_BITS
) -> dict[str, list]:
    """Per column the values that cut it into ``ranges`` of about equal numbers of rows, ascending.

    Taken in one pass from the rows with the smallest hashes, which are the same rows in every run;
    each task hands on ``SAMPLE_ROWS`` at most. A value that fills several ranges is named once.
    """
    names = list(dict.fromkeys([*columns, *spread]))
    rows = (
        df.select(*names, F.xxhash64(*names).alias("_hash")).orderBy("_hash").limit(SAMPLE_ROWS).select(*columns).collect()
    )
    cuts = {}
    for name in columns:
        values = sorted(v for v in (r[name] for r in rows) if v is not None)
        picked = [values[len(values) * k // ranges] for k in range(1, ranges)] if values else []
        cuts[name] = list(dict.fromkeys(picked))
    return cuts


def range_rank(name: str, cuts: list) -> Column:
    """How many of the ascending ``cuts`` are not above the value, by halving; NULL has rank 0."""
    value = F.col(name)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("long")
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(value.isNull(), F.lit(0).cast("long")).otherwise(between(0, len(cuts)))


def morton(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of all ranks in turn, highest first, as one number."""
    places = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(ranks) + len(ranks) - 1 - k)
        for bit in range(bits)
        for k, rank in enumerate(ranks)
    ]
    total = places[0]
    for place in places[1:]:
        total = total.bitwiseOR(place)
    return total


def cluster_zorder(
    df: DataFrame,
    columns: Sequence[str],
    spread: Sequence[str] = (),
    pieces: int | None = None,
    bits: int = RANK_BITS,
) -> DataFrame:
    """Order rows so that each file covers a narrow range of every one of ``columns``.

    Unlike ``cluster_by``, where only the first column helps much, filters on any of the columns
    skip files: rows lie along a Morton curve over the ranges that the columns are cut into. As
    there, ``spread`` lets files part a range that holds much of the table.
    """
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit one number")
    cuts = range_boundaries(df, columns, spread, 1 << bits)
    ranked = df.select("*", *[range_rank(name, cuts[name]).alias(f"_rank_{k}") for k, name in enumerate(columns)])
    curve = morton([F.col(f"_rank_{k}") for k in range(len(columns))], bits)
    placed = ranked.withColumn("_place", curve).drop(*[f"_rank_{k}" for k in range(len(columns))])
    return cluster_by(placed, ["_place"], spread, pieces).drop("_place")
