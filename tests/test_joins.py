from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from campuslake.operators import joins


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key, a tenth another, some have none."""
    key = "case when id % 3 = 0 then -1 when id % 10 = 1 then -2 when id % 97 = 5 then null else id % 700 end"
    return spark.range(9_000, numPartitions=3).selectExpr("id", f"{key} as key", "id * 2 as v")


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(-2, 600).selectExpr("id as key", "concat('name ', id) as name")


def _named(spark, hot: dict, values) -> dict:
    """Pieces by key, for the keys among ``values`` that are hot."""
    keys = spark.createDataFrame([(v,) for v in values], "key long").select("key", F.xxhash64("key").alias("h"))
    return {r["key"]: hot[r["h"]] for r in keys.collect() if r["h"] in hot}


def test_all_hot_keys_are_named(spark, facts):
    counts = {r.key: r["count"] for r in facts.where("key is not null").groupBy("key").count().collect()}
    limit = sum(counts.values()) * 0.01
    expected = {k: -(-n // limit) for k, n in counts.items() if n > limit}
    hot = joins.hot_keys(facts, "key", 0.01)
    assert set(expected) == {-1, -2} and len(hot) == 2
    assert _named(spark, hot, counts) == expected


@pytest.mark.parametrize("parts", [1, 7])
def test_the_summary_names_every_key_above_the_share(spark, parts):
    """Zipf-like keys, far more of them than counters, whatever the split of the rows."""
    rows = spark.range(400_000).selectExpr("cast(200000 / (1 + pmod(xxhash64(id), 200000)) as long) as key").repartition(parts)
    counts = {r.key: r["count"] for r in rows.groupBy("key").count().collect()}
    share = 0.002
    above = {k: n for k, n in counts.items() if n > share * 400_000}
    hot = joins.hot_keys(rows, "key", share)
    named = _named(spark, hot, counts)
    assert set(above) <= set(named) and len(hot) <= 1.5 / share
    assert all(named[k] >= n / (share * 400_000) for k, n in above.items())


def test_no_hot_keys_on_even_data(spark, plan):
    assert joins.hot_keys(spark.range(1000), "id", 0.01) == {}
    assert joins.hot_keys(spark.range(0), "id", 0.01) == {}
    assert joins.hot_keys(spark.range(9).selectExpr("cast(null as string) as id"), "id") == {}
    even = spark.range(100_000)
    assert "_piece" not in plan(joins.split_join(even, even.selectExpr("id", "id * 2 as twice"), "id", "id"))


def test_keys_of_several_types_are_split(spark):
    for key in ("cast(pmod(id, 2) as string)", "cast(cast(pmod(id, 2) as string) as binary)", "date_add(date'2024-01-01', cast(pmod(id, 2) as int))"):
        rows = spark.range(100).selectExpr("id", f"{key} as key")
        assert sorted(joins.hot_keys(rows, "key", 0.1).values()) == [5, 5]
        assert joins.split_join(rows, rows.select("key").distinct(), "key", "id", 0.1).count() == 100


@pytest.mark.parametrize("share", [0.5, 0.01, 0.0001, None])
def test_split_join_equals_the_plain_join(facts, dimension, share):
    plain = facts.join(dimension, "key").select("id", "key", "v", "name")
    split = joins.split_join(facts, dimension, "key", "id", share).select(*plain.columns)
    assert split.count() == plain.count()
    assert split.exceptAll(plain).isEmpty()


def test_the_hot_key_is_spread_over_many_pieces(spark, facts, dimension):
    hot = _named(spark, joins.hot_keys(facts, "key", 0.01), [-1])[-1]
    dealt = facts.where("key = -1").select(F.pmod(F.xxhash64("id"), F.lit(hot)).alias("piece"))
    sizes = [r["count"] for r in dealt.groupBy("piece").count().collect()]
    assert len(sizes) == hot
    assert max(sizes) < 2 * sum(sizes) / hot


@pytest.fixture
def shuffled(spark):
    """No broadcasts and no adaptive help, as on tables too large for the one and to show the other is not needed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_shuffled_split_join_shuffles_by_key_and_piece(facts, dimension, plan, shuffled):
    split = joins.split_join(facts, dimension, "key", "id", 0.01)
    text = plan(split)
    assert text.count("SortMergeJoin") == 1
    assert "SortMergeJoin [key" in text and "_piece" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    plain = facts.join(dimension, "key").select("id", "key", "v", "name")
    assert split.select(*plain.columns).exceptAll(plain).isEmpty()
    assert split.count() == plain.count()


def test_no_task_joins_more_than_a_small_share(facts, dimension, shuffled):
    def largest_share(joined):
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        return max(sizes) / sum(sizes)

    assert largest_share(facts.join(dimension, "key")) > 0.33
    assert largest_share(joins.split_join(facts, dimension, "key", "id")) < 0.06


def test_unmatched_semester_measures_stay_null(spark):
    grades = spark.createDataFrame([("S1", "y1", 3), ("S2", "y1", 4)], "semester_id string, academic_year string, n int")
    absences = spark.createDataFrame(
        [("S1", "y1", 7)], "semester_id string, academic_year string, total_hours_absent int"
    )
    got = joins.semester_with_absences(grades, absences).orderBy("semester_id").collect()
    assert [(r.semester_id, r.total_hours_absent) for r in got] == [("S1", 7), ("S2", None)]
