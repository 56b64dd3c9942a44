"""Joins with keys that hold a large share of the rows: the same rows, from several tasks."""

from __future__ import annotations

import pytest
from builders import plain
from pyspark.sql import functions as F

from scholaudit.functions.copies import count_copies, expand_copies
from scholaudit.operators import hot_keys
from scholaudit.operators.hot_keys import deal, join_dealt, meet


@pytest.fixture(scope="module", autouse=True)
def shuffled_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def sides(spark):
    """A third of the left rows has one key, a third has none; a key of the right has many copies."""
    left = [("hot", n) for n in range(300)] + [(None, n) for n in range(300)] + [(f"k{n}", n) for n in range(300)]
    left += [("many", n) for n in range(40)]
    right = [("hot", "x"), ("hot", "y"), ("hot", "y"), ("k1", "z"), ("gone", "z")]
    right += [("many", "p")] * 1003 + [("many", "q")] * 5 + [("k2", "r")] * 30
    left = spark.createDataFrame(left, "doi_key string, place int").repartition(20)
    return left, spark.createDataFrame(right, "doi_key string, value string").repartition(8)


def dealt_join(left, right, how="left", n=None, divided=()):
    hot = hot_keys.hot_table("doi_key", [left.select("doi_key")], [one.select("doi_key") for one in divided])
    first = deal(left, hot, "doi_key")
    if n is None:
        first = first.where("_part = 0").drop("_part")
    return join_dealt(first, meet(right, hot, "doi_key", n), ["doi_key"], how).drop("_salt")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_same_rows_as_a_plain_join(spark, how):
    left, right = sides(spark)
    counted = count_copies(right, "doi_key", "value", n="n")
    expected = left.join(right, "doi_key", how).select("doi_key", "place", "value")
    found = dealt_join(left, counted, how, "n", [right])
    expanded = expand_copies(found, F.col("n")).select(expected.columns)
    assert plain(expanded.collect()) == plain(expected.collect())
    # Without numbers of copies, and without keys to divide.
    assert plain(dealt_join(left, right, how).select(expected.columns).collect()) == plain(expected.collect())
    found = dealt_join(left, counted, how, "n")
    assert plain(found.collect()) == plain(left.join(counted, "doi_key", how).collect())


def test_several_tables_are_joined_where_the_rows_are(spark):
    left, right = sides(spark)
    hot = hot_keys.hot_table("doi_key", [left.select("doi_key")])
    once, twice = right.distinct(), right.distinct().withColumnRenamed("value", "other")
    joined = deal(left, hot, "doi_key").drop("_part")
    for table in (once, twice):
        joined = join_dealt(joined, meet(table, hot, "doi_key"), ["doi_key"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(doi_key" in line and "_salt" in line]
    assert len(wide) == 3  # the rows once, and each table
    expected = left.join(once, "doi_key", "left").join(twice, "doi_key", "left")
    assert plain(joined.drop("_salt").select(expected.columns).collect()) == plain(expected.collect())


def tasks(df, condition):
    return df.where(condition).select(F.spark_partition_id().alias("task")).distinct().count()


def test_hot_keys_and_missing_keys_are_in_several_tasks(spark):
    left, right = sides(spark)
    counted = count_copies(right, "doi_key", "value", n="n")
    found = dealt_join(left, counted, "left", "n", [right])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert tasks(found, "doi_key = 'hot'") >= 8
    assert tasks(found, "doi_key IS NULL") >= 8
    # The copies of one joined row, too.
    assert tasks(found, "doi_key = 'many' AND place = 7 AND value = 'p'") >= 8
    assert found.where("doi_key = 'many' AND place = 7 AND value = 'p'").agg(F.sum("n")).first()[0] == 1003
    plain_join = left.join(counted, "doi_key", "left")
    assert tasks(plain_join, "doi_key = 'hot'") == 1


def test_the_sketch(spark):
    left, right = sides(spark)
    assert {row.doi_key for row in hot_keys.hot_keys(left, "doi_key").collect()} == {"hot", "many"}
    assert {row.doi_key for row in hot_keys.hot_keys(right, "doi_key").collect()} == {"many", "k2"}
    assert hot_keys.hot_keys(left.limit(0), "doi_key").count() == 0
    assert hot_keys.hot_keys(left.where("doi_key IS NULL"), "doi_key").count() == 0
    alike = spark.range(5000).selectExpr("concat('d', id) as doi_key")
    assert hot_keys.hot_keys(alike, "doi_key").count() == 0


def test_operators_deal_hot_keys(spark):
    """Each join of the enriched works, of publications and of the checks."""
    from builders import dois, oddpub, unpaywall, work, works

    from scholaudit.config import Provenance
    from scholaudit.operators import publications
    from scholaudit.plans.alltrials import alltrials
    from scholaudit.plans.pubs import audit_publications
    provenance = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")

    rows = [work("10.1/HOT", pubmed=("10.1/hot", "x", []))] * 60 + [work(None)] * 60
    rows += [work(f"10.1/{n}") for n in range(60)]
    many = works(spark, *rows).repartition(12)
    access = unpaywall(spark, *[("10.1/5", [], "mit")] * 200, ("10.1/hot", [], "pd"), ("10.1/6", [], None))
    found = alltrials(many.where("doi <> '10.1/HOT'"), 1, provenance)
    enriched = publications.enriched_doi(many, access, found)
    assert tasks(enriched, "work_doi = '10.1/HOT'") > 3 and tasks(enriched, "work_doi IS NULL") > 3
    assert tasks(enriched, "work_doi = '10.1/5'") > 3 and enriched.where("work_doi = '10.1/5'").count() == 200
    checks = oddpub(spark, *[("10.1/7", True, None)] * 300, ("10.1/hot", True, True))
    listed = dois(spark, "10.1/hot", "10.1/5", "10.1/7", "none")
    joined = publications.open_data_code(listed, checks)
    assert tasks(joined, "doi = '10.1/7'") > 3 and joined.where("doi = '10.1/7'").count() == 300
    audited = audit_publications(listed, many, access, found, checks)
    assert audited.where("doi = '10.1/hot'").count() == 60 and audited.where("doi = '10.1/5'").count() == 200
    assert audited.where("doi = '10.1/7'").count() == 300 and audited.count() == 561
