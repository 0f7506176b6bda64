"""KPI tables are computed from stored tables, so that none of them cleans a source table again."""

from __future__ import annotations

import pytest

from campuslake.operators import joins
from campuslake.plans import lakehouse, workload
from campuslake.plans.workload import Tables


@pytest.mark.parametrize("name", ["catalog_listing", "catalog_after_swap", "run_history", "run_as_of"])
def test_refreshes_read_cleaned_tables_from_files(spark, sf_dir, plan, monkeypatch, name):
    seen = []
    publish_gold = lakehouse.publish_gold

    def watched(spark, silver, *args):
        seen.extend(silver.values())
        return publish_gold(spark, silver, *args)

    monkeypatch.setattr(lakehouse, "publish_gold", watched)
    try:
        assert not workload.queries()[name](spark, sf_dir).isEmpty()
    finally:
        for database in spark.catalog.listDatabases("campuslake_*"):
            spark.sql(f"DROP DATABASE {database.name} CASCADE")
    assert seen
    assert not [df for df in seen if "Exchange" in plan(df) or "Window" in plan(df)]


def test_schemas_of_kpi_tables_need_no_rows(spark, sf_dir, plan, monkeypatch):
    looked_at = []
    hot_keys = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda rows, *args: looked_at.append(rows) or hot_keys(rows, *args))
    tables = Tables(spark, sf_dir)
    silver = {name: tables.silver(name) for name in lakehouse.GOLD_INPUTS}
    schemas = lakehouse.gold_schemas(silver)
    assert looked_at and not [df for df in looked_at if "FileScan" in plan(df)]
    assert {n: [(f.name, f.dataType) for f in s] for n, s in schemas.items()} == {
        n: [(f.name, f.dataType) for f in df.schema] for n, df in lakehouse.gold_tables(silver).items()
    }
