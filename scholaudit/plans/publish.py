"""Jobs: check the inputs, write the versioned tables, publish the latest copies."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scholaudit.config import Institution, Provenance, Run
from scholaudit.functions.sql import inline_table
from scholaudit.operators.audit import audit_tables, utility_years, written_audit
from scholaudit.plans.alltrials import COLUMNS, CUTOFF, passed_cutoffs, provenance_columns
from scholaudit.plans.many import INSTITUTION, all_facts_audited, all_trials_linked
from scholaudit.plans.pubs import audit_facts, with_provenance
from scholaudit.plans.search import EDITION, EXTRACT, FACTS, KIND, TABLE, extract_of, facts_of, search_works, work_keys
from scholaudit.plans.trials import trials
from scholaudit.sources.staging import staging
from scholaudit.sources.tables import (
    ACCESS_TABLE,
    WORKS_DATABASE,
    MissingTables,
    copy_table,
    create_database,
    create_or_replace,
    input_names,
    output_names,
    read_access,
    read_input,
    read_works,
    require_tables,
)
from scholaudit.sources.versions import (
    Part,
    drop_version,
    register_version,
    remove_folder,
    replace_partitions,
    switch,
    version_name,
    write_together,
)

# Tables that have a latest copy; ``alltrials`` has none.
LATEST = ("trials", "pubs")
YEARS = "utility_years"
AUDIT = "table_audit"
# The column that each audited table is counted by.
COUNTED = {"alltrials": "doi", "trials": "nct_id", "pubs": "doi", "unpaywall": "doi"}


@dataclass(frozen=True)
class Searched:
    """What one pass over the texts of works wrote: ``alltrials``, and the rows that publications take over."""

    rows: int
    facts: DataFrame
    extract: DataFrame
    folders: tuple[str, ...]


@contextmanager
def _searched(
    spark: SparkSession, found: DataFrame, name: str, cutoffs: Sequence[int], added: Mapping[str, Column]
) -> Iterator[Searched]:
    """Write the rows of ``search_works``, publish ``alltrials`` and give the rest until the end of the block.

    With several cutoffs the table is a view: rows that don't depend on the
    cutoff are stored once and repeated when they are read.
    """
    several = len(set(cutoffs)) > 1
    version = version_name(name)
    passed = passed_cutoffs(cutoffs)
    kinds = (TABLE, EDITION, EXTRACT, FACTS) if several else (TABLE, EXTRACT, FACTS)
    columns = [CUTOFF, *COLUMNS, *added] if several else [*COLUMNS, *added]
    complete = found.withColumns(dict(added))
    schema = complete.schema
    together = write_together(
        complete, version, KIND, kinds, {TABLE: F.expr(f"size({passed})")} if several else {}
    )
    try:
        parts = [Part(version)]
        register_version(
            spark, version, together.path(TABLE), StructType([schema[c] for c in columns if c != CUTOFF])
        )
        if several:
            edition = version_name(name)
            register_version(spark, edition, together.path(EDITION), StructType([schema[c] for c in columns]))
            shown = (("var_SQL_year_cutoff", CUTOFF),)
            lateral = f"LATERAL VIEW explode({passed}) AS {CUTOFF}"
            parts = [Part(version, lateral=lateral, computed=shown), Part(edition, computed=shown)]
        switch(spark, name, parts)
    except BaseException:
        drop_version(spark, version)
        raise
    keys = [schema[CUTOFF], schema["doi_key"], schema["abstract_PUBMED"]]
    facts = together.read(spark, FACTS, StructType([schema["doi_key"], schema["facts"], schema["abstract_CROSSREF"]]))
    extract = together.read(spark, EXTRACT, StructType(keys if several else keys[1:]))
    folders = together.path(FACTS), together.path(EXTRACT)
    rows = together.rows[TABLE] + (together.rows[EDITION] if several else 0)
    try:
        yield Searched(rows, facts_of(facts), extract_of(extract, (CUTOFF,) if several else ()), folders)
    finally:
        for folder in folders:
            remove_folder(spark, folder)


def publish_run(spark: SparkSession, run: Run, institution: Institution) -> None:
    """One institution: ``alltrials``, ``trials`` and ``pubs``, then the latest copies.

    Works are read twice: a narrow pass for keys and entries, and one pass for
    texts and facts.
    """
    common = [f"{WORKS_DATABASE}.{run.works_table}", ACCESS_TABLE]
    require_tables(spark, [*input_names(institution), *common])
    create_database(spark, institution.output_database)
    create_database(spark, institution.latest_database)

    provenance = Provenance.of(run, institution)
    works, dois = read_works(spark, run), read_input(spark, institution, institution.dois_table)
    names = dict(zip(("alltrials", "trials", "pubs"), output_names(run, institution), strict=True))
    cutoffs, rows = [institution.year_cutoff], {}

    with staging(spark, f"{institution.institution_id}_{run.run_version}") as keep:
        found = search_works(works, work_keys(works, dois, cutoffs, keep), cutoffs)
        added = provenance_columns(institution.year_cutoff, provenance)
        with _searched(spark, found, names["alltrials"], cutoffs, added) as searched:
            rows["alltrials"] = searched.rows
            listed = read_input(spark, institution, institution.trials_table)
            alltrials = spark.table(names["alltrials"])
            rows["trials"] = create_or_replace(trials(listed, alltrials, dois, provenance, keep), names["trials"])

            oddpub = read_input(spark, institution, institution.oddpub_table)
            access = read_access(spark)
            audited = audit_facts(dois, searched.facts, searched.extract, access, oddpub, keep=keep)
            rows["pubs"] = create_or_replace(with_provenance(audited, provenance), names["pubs"])

    require_tables(spark, names.values())
    for kind in LATEST:
        copy_table(spark, names[kind], f"{institution.latest_database}.{kind}", overwrite=True)
    create_or_replace(utility_years(spark.table(names["pubs"])), f"{institution.latest_database}.{YEARS}")
    create_or_replace(_audit(spark, names, rows), f"{institution.latest_database}.{AUDIT}")


def _audit(spark: SparkSession, names: Mapping[str, str], rows: Mapping[str, int]) -> DataFrame:
    """Counts of the written tables, whose rows were counted by their writers, and of the open-access locations."""
    written = [
        written_audit(spark.table(names[kind]), COUNTED[kind], kind, rows[kind]) for kind in names if kind in rows
    ]
    scanned = {kind: (spark.table(names[kind]), COUNTED[kind]) for kind in names if kind not in rows}
    scanned["unpaywall"] = (spark.table(ACCESS_TABLE), COUNTED["unpaywall"])
    return reduce(DataFrame.unionByName, written, audit_tables(scanned))


class FailedInstitutions(RuntimeError):
    """What went wrong, by institution."""

    def __init__(self, errors: dict[str, Exception]):
        self.errors = dict(errors)
        super().__init__("\n".join(f"{name}: {error}" for name, error in errors.items()))


def publish_each(spark: SparkSession, run: Run) -> None:
    """``publish_run`` for every institution; those that fail are reported together at the end."""
    errors: dict[str, Exception] = {}
    for institution in run.institutions:
        try:
            publish_run(spark, run, institution)
        except Exception as error:  # the others still run
            errors[institution.institution_id] = error
    if errors:
        raise FailedInstitutions(errors)


def _together(spark: SparkSession, run: Run, table_of) -> DataFrame:
    """The same kind of input of every institution, with its id."""
    parts = [
        read_input(spark, institution, table_of(institution)).withColumn(
            INSTITUTION, F.lit(institution.institution_id)
        )
        for institution in run.institutions
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def _provenance(spark: SparkSession, run: Run, *fields: str) -> DataFrame:
    """Input-table names per institution, from the configuration."""
    columns = [INSTITUTION, *[f"var_data_{field}" for field in fields]]
    rows = [
        (one.institution_id, *[getattr(one, f"{field}_table") for field in fields]) for one in run.institutions
    ]
    return inline_table(spark, columns, rows)


def _by_institution(df: DataFrame) -> DataFrame:
    """Few files per institution, and several tasks for one that holds a large share of the rows."""
    return df.hint("rebalance", F.col(INSTITUTION))


def _complete(spark: SparkSession, run: Run) -> tuple[list[Institution], dict[str, Exception]]:
    """The institutions whose input tables are there, and what the others lack."""
    ready, errors = [], {}
    for institution in run.institutions:
        try:
            require_tables(spark, input_names(institution))
            ready.append(institution)
        except MissingTables as error:
            errors[institution.institution_id] = error
    return ready, errors


def publish_all(spark: SparkSession, run: Run, database: str) -> None:
    """Every institution of the run in one pass.

    Works are searched once instead of once per institution. ``trials`` and
    ``pubs`` are partitioned by institution, and a run replaces the partitions
    of its institutions only; ``alltrials`` holds the cutoffs of the last run,
    with rows that don't depend on the cutoff stored once. Institutions that
    lack an input are left out and reported at the end.
    """
    require_tables(spark, [f"{WORKS_DATABASE}.{run.works_table}", ACCESS_TABLE])
    ready, errors = _complete(spark, run)
    if ready:
        _publish_together(spark, replace(run, institutions=tuple(ready)), database)
    if errors:
        raise FailedInstitutions(errors)


def _publish_together(spark: SparkSession, run: Run, database: str) -> None:
    latest = f"{database}_latest"
    create_database(spark, database)
    create_database(spark, latest)
    names = {kind: f"{database}.{run.output_table(kind)}" for kind in ("alltrials", "trials", "pubs")}

    works = read_works(spark, run)
    cutoffs = {one.institution_id: one.year_cutoff for one in run.institutions}
    ids = list(cutoffs)
    dois = _together(spark, run, lambda one: one.dois_table)
    version = F.lit(run.workflow_version).alias("var_SQL_workflow_version")
    with staging(spark, f"{database}_{run.run_version}") as keep:
        years = sorted(set(cutoffs.values()))
        found = search_works(works, work_keys(works, dois, years, keep), years)
        added = {
            "var_AcademicObservatory_doi": F.lit(run.works_table),
            "var_SQL_year_cutoff": F.col(CUTOFF) if len(years) > 1 else F.lit(years[0]).cast("bigint"),
            "var_SQL_workflow_version": F.lit(run.workflow_version),
        }
        with _searched(spark, found, names["alltrials"], years, added) as searched:
            one = F.lit(years[0]).cast("bigint")
            alltrials, extract = (
                df if CUTOFF in df.columns else df.withColumn(CUTOFF, one)
                for df in (spark.table(names["alltrials"]), searched.extract)
            )
            listed = _together(spark, run, lambda one: one.trials_table)
            linked = all_trials_linked(listed, alltrials, dois, cutoffs, keep)
            owner = F.col(INSTITUTION).alias("var_institution_id")
            trial_names = _provenance(spark, run, "trials", "dois")
            linked = _by_institution(linked.join(trial_names, INSTITUTION).select("*", version, owner))
            replace_partitions(linked, names["trials"], INSTITUTION, ids)

            oddpub = _together(spark, run, lambda one: one.oddpub_table)
            access = read_access(spark)
            audited = all_facts_audited(dois, searched.facts, extract, access, oddpub, cutoffs, keep)
            # Rows come rebalanced by institution.
            pub_names = _provenance(spark, run, "dois", "oddpub")
            audited = audited.join(pub_names, INSTITUTION).select("*", version, owner)
            replace_partitions(audited, names["pubs"], INSTITUTION, ids)

    require_tables(spark, names.values())
    own = F.col(INSTITUTION).isin(ids)
    for kind in LATEST:
        copied = _by_institution(spark.table(names[kind]).where(own))
        replace_partitions(copied, f"{latest}.{kind}", INSTITUTION, ids)
    years_found = utility_years(spark.table(names["pubs"]).where(own), (INSTITUTION,))
    replace_partitions(years_found, f"{latest}.{YEARS}", INSTITUTION, ids)
    # Partitions of earlier runs count as well, so only ``alltrials`` has its number of rows at hand.
    create_or_replace(_audit(spark, names, {"alltrials": searched.rows}), f"{latest}.{AUDIT}")
