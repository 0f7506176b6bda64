from __future__ import annotations

import pytest

from campuslake.operators import quality
from campuslake.schemas import QualityRule


def _profile(spark, rows, rule):
    df = spark.createDataFrame(rows, "key string, v double")
    return quality.profile(df, "t", rule).first()


def test_null_keys_count_as_one_key(spark):
    rows = [(None, 1.0), (None, 1.0), ("a", 1.0), ("a", 1.0), ("b", 1.0)]
    got = _profile(spark, rows, QualityRule("key"))
    assert (got.total_rows, got.duplicates, got.status) == (5, 2, "ISSUES")


def test_out_of_range_does_not_change_the_status(spark):
    got = _profile(spark, [("a", 21.0), ("b", -1.0), ("c", None)], QualityRule("key", (), {"v": (0, 20)}))
    assert (got.out_of_range_v, got.status) == (2, "OK")


def test_nulls_change_the_status(spark):
    got = _profile(spark, [("a", None), ("b", 2.0)], QualityRule("key", ("key", "v")))
    assert (got.nulls_key, got.nulls_v, got.status) == (0, 1, "ISSUES")


def test_an_empty_table_is_clean(spark):
    got = _profile(spark, [], QualityRule("key", ("v",)))
    assert (got.total_rows, got.duplicates, got.nulls_v, got.status) == (0, 0, 0, "OK")


def test_one_scan_whatever_the_number_of_metrics(spark, sf_dir, plan):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rule = QualityRule("o_orderkey", ("o_custkey", "o_orderstatus"), {"o_totalprice": (0, 1000)})
    text = plan(quality.profile(orders, "orders", rule))
    assert text.count("FileScan") == 1
    assert "o_orderpriority" not in text


def test_observed_counts_equal_the_profile(spark, tmp_path):
    rule = QualityRule("key", ("key", "v"), {"v": (0, 20), "w": (0, 5)})
    rows = [(None, 1.0, "x"), (None, None, "9"), ("a", 30.0, "2"), ("a", 1.0, None), ("b", -1.0, "1")]
    df = spark.createDataFrame(rows, "key string, v double, w string").repartition(3)
    seen = quality.Observed("t", rule)
    seen.watch(df).write.parquet(str(tmp_path / "t"))
    got = seen.profile(spark.read.parquet(str(tmp_path / "t")))
    want = quality.profile(df, "t", rule)
    assert got.columns == want.columns and got.collect() == want.collect()
    assert want.first()["malformed_w"] == 1 and want.first()["duplicates"] == 2


def test_observed_counts_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "key string, v double")
    seen = quality.Observed("t", QualityRule("key", ("v",), {"v": (0, 1)}))
    seen.watch(df).write.parquet(str(tmp_path / "t"))
    assert seen.profile(spark.read.parquet(str(tmp_path / "t"))).first().status == "OK"


def test_only_the_key_is_read_again(spark, tmp_path, plan):
    df = spark.createDataFrame([("a", 1.0), ("a", 30.0)], "key string, v double")
    seen = quality.Observed("t", QualityRule("key", ("v",), {"v": (0, 20)}))
    seen.watch(df).write.parquet(str(tmp_path / "t"))
    text = plan(seen.profile(spark.read.parquet(str(tmp_path / "t"))))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<key:string>" in text


@pytest.mark.parametrize("with_null", [True, False])
def test_duplicates_observed_behind_the_de_duplication(spark, with_null):
    rule = QualityRule("key", ("v",), {"v": (0, 20)})
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), (None, 3.0), (None, 4.0)], "key string, v double")
    seen = quality.Observed("t", rule)
    seen.watch(df).count()
    # A NULL counts as one key, whether the de-duplication keeps a row for it or not.
    unique = df.dropDuplicates(["key"])
    seen.watch_unique(unique if with_null else unique.where("key is not null")).where("v > 100").count()
    want = quality.profile(df, "t", rule)
    got = seen.profile()
    assert got.columns == want.columns and got.collect() == want.collect()
