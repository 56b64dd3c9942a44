"""Exports whose files are in order."""

from __future__ import annotations

import random

import pytest

from scholaudit.operators.publications import EXPORT_ORDER, for_export
from scholaudit.sources.sorted import rows_out_of_order, write_sorted


@pytest.fixture
def pubs(spark):
    rnd = random.Random(1)
    rows = [
        (rnd.choice([None, 2019, 2020, 2021, 2021, 2021]), rnd.choice([None, f"10.1/{rnd.randrange(400)}"]), number)
        for number in range(3000)
    ]
    return spark.createDataFrame(rows, "published_year int, doi_academicobservatory string, n int").repartition(7)


def test_files_read_by_name_are_in_order(spark, pubs, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted(pubs, str(tmp_path / "out"), EXPORT_ORDER)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) > 2
    rows = [tuple(row) for file in files for row in spark.read.parquet(str(file)).collect()]
    assert len(rows) == 3000
    keys = [(year is None, -(year or 0), doi is not None, doi or "") for year, doi, _ in rows]
    assert keys == sorted(keys)
    assert rows_out_of_order(spark, str(tmp_path / "out"), EXPORT_ORDER) == 0
    assert [tuple(row)[:2] for row in for_export(pubs).collect()] == [row[:2] for row in rows]


def test_disorder_is_found(spark, pubs, tmp_path):
    pubs.write.parquet(str(tmp_path / "unsorted"))
    assert rows_out_of_order(spark, str(tmp_path / "unsorted"), EXPORT_ORDER) > 100
    # Each file in order, but not the files among each other.
    pubs.sortWithinPartitions("published_year").write.parquet(str(tmp_path / "parts"))
    assert rows_out_of_order(spark, str(tmp_path / "parts"), (("published_year", False),)) == 6
    pubs.limit(0).write.parquet(str(tmp_path / "empty"))
    assert rows_out_of_order(spark, str(tmp_path / "empty"), EXPORT_ORDER) == 0
