"""Published tables: written versions behind a view that is switched in one step.

A published name is a view over one or more written tables, its versions. A
replacement is written whole, under a name of its own, before the view is
changed, and the view is changed by one alteration in the catalog. Readers
therefore find all of the old rows or all of the new ones, at any moment and
after any failure. Those that resolved the old view may go on reading: the
tables of the state before the last are kept until the next replacement.

The view's text carries its state as a comment: the versions in use with the
partition values taken from each, and the versions of the state before.
``replace_partitions`` puts new values in the place of old ones in the same
way, by taking them from the new version and the other values from the
versions that hold them. (Spark's own dynamic overwrite removes and renames
folders one by one, so a reader can see some partitions old and some new.)
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Versions that one view may unite before they are written as one.
MOST_VERSIONS = 16

_MARK = re.compile(r"/\* state (\{.*?\}) \*/", re.DOTALL)
_VERSION = re.compile(r"__v[0-9a-f]{32}")


@dataclass(frozen=True)
class Part:
    """A version, and the values of its partition column that are taken from it (None: all rows).

    With ``lateral`` each row is repeated for what a lateral view adds;
    ``computed`` gives the columns that take another expression, by name.
    """

    table: str
    column: str | None = None
    values: tuple[str | int, ...] | None = None
    lateral: str | None = None
    computed: tuple[tuple[str, str], ...] = ()

    def without(self, values: Sequence[str | int]) -> Part:
        return Part(self.table, self.column, tuple(value for value in self.values or () if value not in values))


@dataclass(frozen=True)
class State:
    parts: tuple[Part, ...] = ()
    before: tuple[str, ...] = ()

    @property
    def tables(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(part.table for part in self.parts))


def read_state(spark: SparkSession, name: str) -> State | None:
    """The state of a published view; None for other tables and unknown names."""
    if not spark.catalog.tableExists(name):
        return None
    # Only views have a text that could carry the mark.
    if spark.catalog.getTable(name).tableType != "VIEW":
        return None
    found = _MARK.search(spark.sql(f"SHOW CREATE TABLE {name}").first()[0])
    if not found:
        return None
    stored = json.loads(found.group(1))
    parts = tuple(
        Part(
            part["table"],
            part["column"],
            None if part["values"] is None else tuple(part["values"]),
            part["lateral"],
            tuple((column, text) for column, text in part["computed"]),
        )
        for part in stored["parts"]
    )
    return State(parts, tuple(stored["before"]))


def _value(value: str | int) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text(spark: SparkSession, state: State) -> str:
    columns = spark.table(state.parts[-1].table).columns
    # A comment ends at the first "*/", which a value may hold.
    mark = f"/* state {json.dumps(asdict(state)).replace('*/', '*\\u002f')} */"
    selects = []
    for part in state.parts:
        computed = dict(part.computed)
        shown = ", ".join(
            f"{computed[column]} AS `{column}`" if column in computed else f"`{column}`" for column in columns
        )
        source = f"{part.table} {part.lateral}" if part.lateral else part.table
        taken = "" if part.values is None else f" WHERE `{part.column}` IN ({', '.join(map(_value, part.values))})"
        selects.append(f"{shown} FROM {source}{taken}")
    return f"SELECT {mark} " + " UNION ALL SELECT ".join(selects)


def switch(spark: SparkSession, name: str, parts: Sequence[Part], replace: bool = True) -> None:
    """Point the view at the parts in one step, and drop what two states ago was in use.

    Without ``replace`` the name must be new. A plain table of that name, from
    a time before versions, becomes the first version; this once, the name is
    missing for a moment.
    """
    old = read_state(spark, name) if replace else None
    if replace and old is None and spark.catalog.tableExists(name):
        first = version_name(name)
        spark.sql(f"ALTER TABLE {name} RENAME TO {first}")
        old = State((Part(first),))
        spark.sql(f"CREATE VIEW {name} AS {_text(spark, old)}")
    used = {part.table for part in parts}
    before = tuple(table for table in (old.tables if old else ()) if table not in used)
    text = _text(spark, State(tuple(parts), before))
    spark.sql(f"ALTER VIEW {name} AS {text}" if old else f"CREATE VIEW {name} AS {text}")
    for table in old.before if old else ():
        if table not in used and table not in before:
            drop_version(spark, table)


def version_name(name: str) -> str:
    return f"{name}__v{uuid.uuid4().hex}"


def version_folder(spark: SparkSession, version: str) -> str:
    """The folder of a version's own in its database's location."""
    database, table = version.rsplit(".", 1) if "." in version else (spark.catalog.currentDatabase(), version)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_version(spark: SparkSession, version: str) -> None:
    if not _VERSION.search(version):
        raise ValueError(f"{version} is no version")
    folder = version_folder(spark, version)
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    remove_folder(spark, folder)


def write_version(
    df: DataFrame, name: str, column: str | None = None, buckets: tuple[int, str] | None = None
) -> tuple[str, int]:
    """A new version with the rows, and their number; partitioned by a column, or clustered by one in buckets.

    Rows are counted by the tasks that write them. A version that could not
    be written is removed; the published name never saw it.
    """
    spark, version, written = df.sparkSession, version_name(name), Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("n")).write
    if column:
        writer = writer.partitionBy(column)
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    try:
        writer.saveAsTable(version)
    except BaseException:
        drop_version(spark, version)
        raise
    return version, written.get["n"]


@dataclass(frozen=True)
class Together:
    """Rows of several kinds, written by one job into a folder for each kind."""

    folder: str
    tag: str
    rows: dict[str, int]

    def path(self, kind: str) -> str:
        return f"{self.folder}/{self.tag}={kind}"

    def read(self, spark: SparkSession, kind: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(self.path(kind))


def write_together(
    df: DataFrame, version: str, tag: str, kinds: Sequence[str], counted: Mapping[str, Column] | None = None
) -> Together:
    """Write the rows into the version's folder by their kind, and count them on the way.

    ``counted`` may give what a row of a kind counts for, where that is not one.

    The tasks keep a file open for each kind instead of sorting wide rows.
    """
    spark, written = df.sparkSession, Observation()
    folder = version_folder(spark, version)
    one = F.lit(1).cast("bigint")
    counts = [
        F.coalesce(F.sum(F.when(F.col(tag) == kind, (counted or {}).get(kind, one))), F.lit(0)).alias(kind)
        for kind in kinds
    ]
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(len(kinds)))
    try:
        df.observe(written, *counts).write.partitionBy(tag).parquet(folder)
    except BaseException:
        remove_folder(spark, folder)
        raise
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    found = Together(folder, tag, written.get)
    for kind in kinds:  # a kind without rows has no folder yet
        path = spark._jvm.org.apache.hadoop.fs.Path(found.path(kind))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return found


def register_version(spark: SparkSession, version: str, path: str, schema: StructType) -> None:
    """A version over files that are already written."""
    spark.catalog.createTable(version, path=path, source="parquet", schema=schema)


def replace_partitions(df: DataFrame, name: str, column: str, values: Sequence[str | int]) -> int:
    """Publish rows that hold the given values of the column, instead of all rows that hold them now.

    Rows with other values stay as they are. The number of rows written.
    """
    spark = df.sparkSession
    old = read_state(spark, name)
    if old is not None and any(part.column != column or part.lateral for part in old.parts):
        raise ValueError(f"{name} is not kept by {column}")
    version, rows = write_version(df, name, column)
    parts = [part.without(values) for part in old.parts] if old else []
    parts = [part for part in parts if part.values] + [Part(version, column, tuple(values))]
    if len(parts) > MOST_VERSIONS:
        every = [value for part in parts for value in part.values]
        merged, _ = write_version(spark.sql(_text(spark, State(tuple(parts)))), name, column)
        drop_version(spark, version)
        parts = [Part(merged, column, tuple(every))]
    switch(spark, name, parts)
    return rows


def remove_orphans(spark: SparkSession, name: str) -> list[str]:
    """Drop versions of the name that neither its state nor the one before uses.

    They are left by writers that were killed; none may be at work.
    """
    state = read_state(spark, name) or State()
    database, table = name.rsplit(".", 1) if "." in name else (spark.catalog.currentDatabase(), name)
    own = re.compile(re.escape(table) + _VERSION.pattern)
    known = {one.name for one in spark.catalog.listTables(database) if own.fullmatch(one.name)}
    root = spark._jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(database).locationUri)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(root):
        known |= {one.getPath().getName() for one in files.listStatus(root) if own.fullmatch(one.getPath().getName())}
    unused = sorted({f"{database}.{one}" for one in known} - {*state.tables, *state.before})
    for version in unused:
        drop_version(spark, version)
    return unused
