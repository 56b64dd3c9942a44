"""Every registered query against DuckDB over the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from checks.compare import connect, differences
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    optional = set(__spark_entry__.LLM_QUERIES)
    assert not optional & set(QUERIES)
    assert set(__spark_entry__.queries()) == set(QUERIES) | optional
    assert set(__spark_entry__.oracle_sql()) == set(ORACLE_SQL) | set(__spark_entry__.LLM_SQL)
    assert set(__spark_entry__.LLM_SQL) <= optional


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "queries")
    for build in QUERIES.values():
        build(spark, "/root/testdata/sf0.001")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not tracker.getJobIdsForGroup("building")
