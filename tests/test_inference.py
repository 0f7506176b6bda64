"""Types found while text is landed."""

from __future__ import annotations

import datetime as dt

import pytest

from campuslake.sources import land_inferred
from campuslake.sources.inference import narrowest, type_mask
from campuslake.sources.jdbc import Database, equal_depth_bounds, histogram_query, range_predicates


def _write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


COLUMNS = {
    "flag": ("true", "FALSE", ""), "small": ("1", "-7", "+0"), "wide": ("1", "9999999999", "-2"),
    "real": ("1", "2.5", "-1e3"), "half": (".5", "3.", "0.25"), "day": ("2023-09-01", "", "2024-02-29"),
    "moment": ("2023-09-01 10:00:00", "2023-09-01", "2023-09-01T10:00:00.25"), "code": ("007", "12", "3"),
    "mixed": ("1", "x", "2"), "bad_day": ("2023-09-01", "01/09/2023", ""), "no_day": ("2023-02-30", "", ""),
    "empty": ("", "", ""), "a.b": ("1", "2", "3"), "huge": ("99999999999999999999", "1", "2"), "word": ("NaN", "inf", "1"),
}
KINDS = {
    "flag": "boolean", "small": "int", "wide": "bigint", "real": "double", "half": "double", "day": "date",
    "moment": "timestamp", "code": "string", "mixed": "string", "bad_day": "string", "no_day": "string",
    "empty": "string", "a.b": "int", "huge": "double", "word": "string",
}


@pytest.mark.parametrize("files", [[[0, 1, 2]], [[0], [1], [2]], [[2], [], [1, 0]]])
def test_types_do_not_depend_on_the_split(spark, tmp_path, files):
    folder = tmp_path / "csv"
    for k, rows in enumerate(files):
        _write(folder, f"{k}.csv", ",".join(COLUMNS), *[",".join(v[r] for v in COLUMNS.values()) for r in rows])
    df = land_inferred(spark, str(folder), str(tmp_path / "landed"))
    assert dict(df.dtypes) == KINDS
    rows = {r["small"]: r for r in df.collect()}
    assert rows[1]["wide"] == 1 and rows[-7]["wide"] == 9999999999 and rows[0]["real"] == -1000.0
    assert rows[1]["day"] == dt.date(2023, 9, 1) and rows[-7]["day"] is None and rows[0]["code"] == "3"
    assert [rows[k]["flag"] for k in (1, -7, 0)] == [True, False, None]


def test_masks_merge_in_any_order(spark):
    values = ["1", "2.5", "2023-01-01", None, "true", "x", "10000000000"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")

    def mask(*some):
        return frame.where(frame["v"].isin(*some)).agg(type_mask("v")).first()[0]

    for a in values[:3]:
        for b in values[4:]:
            assert mask(a, b) == mask(a) & mask(b) == mask(b, a)
    assert frame.where("v is null").agg(type_mask("v")).first()[0] is None
    assert narrowest(None) == narrowest(0) == "string"


def test_text_is_read_once(spark, tmp_path):
    folder = tmp_path / "csv"
    _write(folder, "a.csv", "x,y", *[f"{k},{k / 4}" for k in range(100)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("inference", "inference")
    try:
        df = land_inferred(spark, str(folder), str(tmp_path / "landed"))
        jobs = tracker.getJobIdsForGroup("inference")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 2  # the header line of one file, and the landing
    assert df.dtypes == [("x", "int"), ("y", "double")]


def test_equal_depth_bounds_follow_the_rows(spark):
    # A crowd at the start, a gap, then few; equal steps would give one query nearly all rows.
    keys = [*range(1, 9_001), *range(5_000_000, 5_001_000), None, None]
    rows = spark.createDataFrame([(k,) for k in keys], "id long")
    rows.createOrReplaceTempView("crowded")
    cells = 100_000
    counted = spark.sql(f"SELECT * FROM {histogram_query('crowded', 'id', 1, 5_000_999, cells)}").collect()
    counts = {int(r["cell"]): r["n"] for r in counted if r["cell"] is not None}
    assert sum(counts.values()) == 10_000
    bounds = equal_depth_bounds(counts, 1, 5_000_999, 8, cells)
    predicates = range_predicates("id", bounds)
    assert len(predicates) == 8
    sizes = [rows.where(p).count() for p in predicates]
    assert sum(sizes) == len(keys) and max(sizes) < 1.2 * len(keys) / 8


def test_bounds_of_odd_ranges(spark):
    assert equal_depth_bounds({0: 5}, 1, 5, 4) == []
    assert range_predicates("id", []) == ["1 = 1"]
    # One cell with all shares but a few: fewer cuts, nothing lost.
    bounds = equal_depth_bounds({0: 1, 1: 98, 2: 1}, 10, 12, 4, cells=3)
    rows = spark.createDataFrame([(10,)] + [(11,)] * 98 + [(12,), (None,)], "id long")
    assert bounds == [12] and sum(rows.where(p).count() for p in range_predicates("id", bounds)) == 101
    assert Database("jdbc:x").options == {}
