"""Replacing published tables: what readers find, during and after, and what is left over."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from scholaudit.sources import versions
from scholaudit.sources.tables import create_database, create_only, create_or_replace
from scholaudit.sources.versions import read_state, remove_orphans, replace_partitions


@pytest.fixture(scope="module")
def database(spark):
    create_database(spark, "versions")
    return "versions"


def generation(spark, number, rows=200):
    return spark.range(rows).withColumn("generation", F.lit(number)).repartition(4)


def failing(spark, number):
    """Some tasks have written their rows when one fails."""
    return generation(spark, number).withColumn("checked", F.expr("if(id = 150, raise_error('lost'), 1)")).drop("checked_")


def folders(spark, database, name):
    root = spark._jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(database).locationUri)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return sorted(one.getPath().getName() for one in listed if one.getPath().getName().startswith(f"{name}__v"))


class Reader(threading.Thread):
    """Reads a table again and again and keeps what it saw."""

    def __init__(self, spark, name, grouping="generation"):
        super().__init__()
        self.spark, self.name_read, self.grouping = spark, name, grouping
        self.seen, self.errors, self.over = [], [], threading.Event()

    def run(self):
        while not self.over.is_set():
            try:
                rows = self.spark.table(self.name_read).groupBy(self.grouping).count().collect()
                self.seen.append(sorted((row[0], row["count"]) for row in rows))
            except Exception as error:
                self.errors.append(error)

    def __exit__(self, *_):
        self.over.set()
        self.join()

    def __enter__(self):
        self.start()
        return self


def test_a_reader_finds_whole_old_or_whole_new_rows(spark, database):
    create_or_replace(generation(spark, 0), "versions.polled")
    with Reader(spark, "versions.polled") as reader:
        for number in range(1, 9):
            assert create_or_replace(generation(spark, number), "versions.polled") == 200
    assert not reader.errors
    assert len(reader.seen) > 8
    assert all(len(seen) == 1 and seen[0][1] == 200 for seen in reader.seen)
    numbers = [seen[0][0] for seen in reader.seen]
    assert numbers == sorted(numbers) and len(set(numbers)) > 2
    # The tables of this state and of the one before are all that is left.
    assert len(folders(spark, database, "polled")) == 2


def test_a_reader_of_the_old_state_can_go_on(spark, database):
    create_or_replace(generation(spark, 0), "versions.slow")
    old = spark.table("versions.slow")
    create_or_replace(generation(spark, 1), "versions.slow")
    assert old.where("generation = 0").count() == 200
    assert spark.table("versions.slow").where("generation = 1").count() == 200


def test_a_failed_write_changes_nothing(spark, database):
    create_or_replace(generation(spark, 0), "versions.failed")
    with Reader(spark, "versions.failed") as reader:
        with pytest.raises(Exception, match="lost"):
            create_or_replace(failing(spark, 1), "versions.failed")
    assert not reader.errors and {tuple(seen) for seen in reader.seen} == {((0, 200),)}
    assert len(folders(spark, database, "failed")) == 1
    with pytest.raises(Exception, match="lost"):
        create_or_replace(failing(spark, 1), "versions.never")
    assert not spark.catalog.tableExists("versions.never") and not folders(spark, database, "never")


def test_a_killed_write_changes_nothing_and_can_be_cleared(spark, database):
    create_or_replace(generation(spark, 0), "versions.killed")
    create_or_replace(generation(spark, 1), "versions.killed")
    # A writer that died: one after its table was written, one while it wrote files.
    table, _ = versions.write_version(generation(spark, 2), "versions.killed")
    generation(spark, 3).write.parquet(versions.version_folder(spark, versions.version_name("versions.killed")))
    assert spark.table("versions.killed").select("generation").distinct().collect() == [(1,)]
    assert len(remove_orphans(spark, "versions.killed")) == 2
    assert not spark.catalog.tableExists(table) and len(folders(spark, database, "killed")) == 2
    assert spark.table("versions.killed").count() == 200
    create_or_replace(generation(spark, 4), "versions.killed")
    assert spark.table("versions.killed").select("generation").distinct().collect() == [(4,)]


def test_a_plain_table_becomes_the_first_version(spark, database):
    generation(spark, 0).write.saveAsTable("versions.plain")
    assert read_state(spark, "versions.plain") is None
    create_or_replace(generation(spark, 1), "versions.plain")
    assert spark.table("versions.plain").select("generation").distinct().collect() == [(1,)]
    assert len(read_state(spark, "versions.plain").before) == 1


def test_created_once(spark, database):
    assert create_only(generation(spark, 0, rows=3), "versions.once") == 3
    with pytest.raises(Exception, match="already exists"):
        create_only(generation(spark, 1), "versions.once")
    assert len(folders(spark, database, "once")) == 1
    assert create_or_replace(generation(spark, 1, rows=0), "versions.once") == 0
    assert spark.table("versions.once").count() == 0


def owned(spark, number, *owners):
    rows = [(owner, number, n) for owner in owners for n in range(50)]
    return spark.createDataFrame(rows, "owner string, generation int, n int")


def state_of(spark, name):
    rows = spark.table(name).groupBy("owner", "generation").count().collect()
    return sorted((row["owner"], row["generation"], row["count"]) for row in rows)


def test_only_the_given_partitions_are_replaced(spark, database):
    name, odd = "versions.owned", "it's */ \\ odd"
    replace_partitions(owned(spark, 0, "a", "b", odd, "007"), name, "owner", ["a", "b", odd, "007"])
    assert state_of(spark, name) == sorted((owner, 0, 50) for owner in ("a", "b", odd, "007"))
    replace_partitions(owned(spark, 1, "b", "c"), name, "owner", ["b", "c"])
    assert state_of(spark, name) == sorted([("a", 0, 50), ("b", 1, 50), ("c", 1, 50), (odd, 0, 50), ("007", 0, 50)])
    # No rows of its own: nothing is left of the old ones.
    replace_partitions(owned(spark, 2, "c"), name, "owner", ["a", "c", odd])
    assert state_of(spark, name) == [("007", 0, 50), ("b", 1, 50), ("c", 2, 50)]
    with pytest.raises(Exception, match="lost"):
        replace_partitions(owned(spark, 3, "b").withColumn("n", F.expr("raise_error('lost')")), name, "owner", ["b"])
    assert state_of(spark, name) == [("007", 0, 50), ("b", 1, 50), ("c", 2, 50)]
    plan = spark.table(name).where("owner = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    with pytest.raises(ValueError, match="not kept by"):
        replace_partitions(owned(spark, 4, "b"), name, "generation", [4])


def test_partitions_are_replaced_in_one_step(spark, database):
    name = "versions.pairs"
    replace_partitions(owned(spark, 0, "a", "b", "c"), name, "owner", ["a", "b", "c"])
    with Reader(spark, name, "generation") as reader:
        for number in range(1, 6):
            replace_partitions(owned(spark, number, "a", "b"), name, "owner", ["a", "b"])
    assert not reader.errors
    # Both replaced owners are always of the same state.
    assert all(seen[0] == (0, 50) and seen[1][1] == 100 or seen == [(0, 150)] for seen in reader.seen)


def test_many_versions_are_written_as_one(spark, database, monkeypatch):
    monkeypatch.setattr(versions, "MOST_VERSIONS", 3)
    name = "versions.merged"
    for number, owner in enumerate("abcdef"):
        replace_partitions(owned(spark, number, owner), name, "owner", [owner])
        assert len(read_state(spark, name).parts) <= 3
    assert state_of(spark, name) == [(owner, number, 50) for number, owner in enumerate("abcdef")]
