"""Every query against its SQL counterpart on an independent engine."""

from __future__ import annotations

import checks
import pytest

import __spark_entry__ as entry_module
from campuslake.plans import oracle, workload

QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return checks.database(sf_dir)


def test_every_statement_has_a_query():
    assert set(oracle.oracle_sql()) == set(workload.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, sf_dir, con, name):
    assert checks.differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == ""


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_two_runs_give_the_same_rows(spark, sf_dir):
    query = QUERIES["student_performance"]
    first = query(spark, sf_dir).orderBy("student_id").collect()
    second = query(spark, sf_dir).orderBy("student_id").collect()
    assert first == second
