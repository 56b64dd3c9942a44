"""Catalog tables: versioned reads, the input and output gates, sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaudit.config import Institution, Run
from scholaudit.sources.versions import Part, drop_version, switch, write_version

WORKS_DATABASE = "observatory"
ACCESS_TABLE = "unpaywall.unpaywall"
BY_DOI = "_by_doi"


class MissingTables(RuntimeError):
    """All the tables that were expected and not found."""

    def __init__(self, names: Iterable[str]):
        self.names = tuple(names)
        super().__init__("These tables do not exist: " + ", ".join(self.names))


class ExistingTable(RuntimeError):
    def __init__(self, name: str):
        super().__init__(f"The table {name} already exists")


def read_works(spark: SparkSession, run: Run) -> DataFrame:
    """The run's works, as stored by ``store_works_by_doi`` if they are; a version of works doesn't change."""
    name = f"{WORKS_DATABASE}.{run.works_table}"
    stored = f"{name}{BY_DOI}"
    return spark.table(stored if spark.catalog.tableExists(stored) else name)


def read_access(spark: SparkSession) -> DataFrame:
    return spark.table(ACCESS_TABLE)


def read_input(spark: SparkSession, institution: Institution, table: str) -> DataFrame:
    return spark.table(f"{institution.input_database}.{table}")


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """One error that lists every missing table."""
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise MissingTables(missing)


def input_names(institution: Institution) -> list[str]:
    tables = (institution.trials_table, institution.dois_table, institution.oddpub_table)
    return [f"{institution.input_database}.{table}" for table in tables]


def output_names(run: Run, institution: Institution) -> list[str]:
    return [f"{institution.output_database}.{run.output_table(kind)}" for kind in ("alltrials", "trials", "pubs")]


def create_or_replace(df: DataFrame, name: str) -> int:
    """Publish the rows in the place of what the name holds, in one step; the number of rows."""
    version, rows = write_version(df, name)
    switch(df.sparkSession, name, [Part(version)])
    return rows


def create_only(df: DataFrame, name: str) -> int:
    """Fails when the name is already there; the number of rows."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        raise ExistingTable(name)
    version, rows = write_version(df, name)
    try:
        switch(spark, name, [Part(version)], replace=False)
    except Exception:  # another writer was first
        drop_version(spark, version)
        raise
    return rows


def copy_table(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> int:
    """Copy a table; without ``overwrite`` the target must not exist. The number of rows."""
    require_tables(spark, [source])
    write = create_or_replace if overwrite else create_only
    return write(spark.table(source), target)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def write_bucketed_by_doi(df: DataFrame, name: str, buckets: int) -> int:
    """Publish a big table clustered by its lowered DOI, in the column ``doi_key``; the number of rows.

    Jobs that join it on ``doi_key`` then read it without a shuffle. The
    number of buckets should give files of a few hundred MB. Rows without a DOI
    get keys that no DOI has, by their content, so that they don't share a bucket.
    """
    none = F.concat(F.lit("\u0000"), F.hex(F.xxhash64(*[F.col(f"`{column}`") for column in df.columns])))
    keyed = df.withColumn("doi_key", F.coalesce(F.lower("doi"), none)).repartition(buckets, "doi_key")
    version, rows = write_version(keyed, name, buckets=(buckets, "doi_key"))
    switch(df.sparkSession, name, [Part(version)])
    return rows


def store_works_by_doi(spark: SparkSession, run: Run, buckets: int) -> int:
    """Store the run's works clustered by DOI; from then on its jobs read them there."""
    name = f"{WORKS_DATABASE}.{run.works_table}"
    require_tables(spark, [name])
    return write_bucketed_by_doi(spark.table(name), f"{name}{BY_DOI}", buckets)
