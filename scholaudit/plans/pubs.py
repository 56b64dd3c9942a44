"""The ``pubs`` table: an institution's publications with open-science labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.config import Provenance
from scholaudit.functions.copies import CHUNK, expand_copies
from scholaudit.operators.hot_keys import PART, SALT, deal, hot_table, join_dealt, meet
from scholaudit.operators.publications import (
    access_facts,
    add_labels,
    extract_facts,
    oddpub_facts,
    work_facts,
)
from scholaudit.sources.staging import Keep, lazily

# Output columns in order.
COLUMNS = (
    "doi",
    "doi_academicobservatory",
    "doi_in_academicobservatory_PRETTY",
    "published_year",
    "published_year_PRETTY",
    "container_title_concat",
    "title_concat",
    "crossref_type",
    "crossref_type_PRETTY",
    "coki",
    "oa_coki_PRETTY",
    "oa_coki_GRAPHORDER",
    "oa_coki_open_PRETTY",
    "oa_coki_OA_open",
    "oa_coki_OA_closed",
    "first_green_oa_date",
    "cr_published_date",
    "embargo",
    "embargo_PRETTY",
    "embargo_GRAPHORDER",
    "license",
    "license_PRETTY",
    "license_GRAPHORDER",
    "license_GROUP",
    "has_publisher_orcid",
    "has_publisher_orcid_PRETTY",
    "in_orcid_record",
    "in_orcid_record_PRETTY",
    "has_cr_funder_record",
    "has_cr_funder_record_PRETTY",
    "has_preprint",
    "has_preprint_PRETTY",
    "has_oddpub_processing",
    "has_open_data_oddpub",
    "has_open_data_oddpub_PRETTY",
    "has_open_code_oddpub",
    "has_open_code_oddpub_PRETTY",
    "crossref_fulltext_URL_CONCAT",
    "abstract_crossref",
    "abstract_pubmed",
)


def audit_publications(
    dois: DataFrame,
    works: DataFrame,
    unpaywall: DataFrame,
    alltrials: DataFrame,
    oddpub: DataFrame,
    scope: Sequence[str] = (),
    edition: Sequence[str] = (),
    extra: Sequence[str] = (),
    keep: Keep = lazily,
) -> DataFrame:
    """Distinct listed DOIs with everything known about them, and ``doi_key``.

    The big tables are cut down to the listed DOIs before they meet. The list
    is the small side; when it fits the broadcast threshold none of the big
    tables is shuffled, else each is once, and a text again only where its row
    has many copies. Works join the list inner, so a DOI with very many rows
    can be split on either side; listed DOIs without a work are added after.
    """
    facts = work_facts(works)
    extract = extract_facts(alltrials, extra, edition)
    return audit_facts(dois, facts, extract, unpaywall, oddpub, scope, edition, keep)


def audit_facts(
    dois: DataFrame,
    facts: DataFrame,
    extract: DataFrame,
    unpaywall: DataFrame,
    oddpub: DataFrame,
    scope: Sequence[str] = (),
    edition: Sequence[str] = (),
    keep: Keep = lazily,
    together: bool = False,
) -> DataFrame:
    """The same from facts (``work_facts``) and extracts (``extract_facts``) that hold the listed DOIs.

    With ``together`` the rows of a scope come rebalanced, for files by scope,
    which takes another shuffle of the texts.
    """
    listed = dois.select(*scope, *edition, "doi").distinct().withColumn("doi_key", F.lower("doi"))
    listed = keep(listed, "listed")
    keys = listed.select("doi_key").where("doi_key IS NOT NULL").distinct()

    # A DOI that many works hold, and works without one, are dealt over several tasks in all joins.
    hot = hot_table("doi_key", [facts.select("doi_key")])

    def met(rows: DataFrame) -> DataFrame:
        return meet(rows, hot, "doi_key")

    # Reduced to the listed DOIs and to counted facts, row by row of the key.
    access = keep(access_facts(unpaywall, keys), "access")
    extract = extract.join(keys, "doi_key", "left_semi")
    checks = keep(oddpub_facts(oddpub, scope), "checks")

    known = facts.select("doi_key").join(keys, "doi_key", "left_semi").distinct()
    copies = F.coalesce(F.col("n_access"), F.lit(1)) * F.coalesce(F.col("n_oddpub"), F.lit(1))
    dealt = deal(facts, hot, "doi_key").drop(PART)
    met_access, met_extract, met_checks = met(access), met(extract), met(checks)

    # Texts leave their scans for one join by key and salt, and all further joins find them there.
    def complete(rows: DataFrame) -> DataFrame:
        matched = join_dealt(dealt, met(rows), ["doi_key"], "inner")
        with_access = join_dealt(matched, met_access, ["doi_key"])
        return _join_within(_join_within(with_access, met_extract, edition), met_checks, scope).drop(SALT)

    missing = listed.join(known, "doi_key", "left_anti").join(checks, [*scope, "doi_key"], "left")
    missing = missing.withColumn("n_access", F.lit(None).cast("bigint"))
    if together:
        parts = [expand_copies(complete(listed).unionByName(missing, allowMissingColumns=True), copies, spread=scope)]
    else:
        # Only rows of many copies are worth another shuffle with their texts.
        counts = access.select("doi_key", "n_access", F.lit(1).alias("n_oddpub")).unionByName(
            checks.select("doi_key", F.lit(1).alias("n_access"), "n_oddpub")
        )
        most = counts.groupBy("doi_key").agg(F.max("n_access").alias("n_access"), F.max("n_oddpub").alias("n_oddpub"))
        many = most.where(f"n_access * n_oddpub > {CHUNK}").select("doi_key")
        parts = [
            expand_copies(complete(listed.join(many, "doi_key", "left_anti")), copies),
            expand_copies(complete(listed.join(many, "doi_key", "left_semi")), copies, spread=scope),
            expand_copies(missing, copies, spread=scope),
        ]
    found = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    return add_labels(found).withColumn("doi", F.lower("doi"))


def _join_within(rows: DataFrame, met: DataFrame, within: Sequence[str]) -> DataFrame:
    """Dealt rows joined by key and salt, and by further columns.

    Spark moves both sides of a join by all the columns that it compares as
    keys, so these are compared among the rows of a key, where they are.
    """
    if not within:
        return join_dealt(rows, met, ["doi_key"])
    own = ("doi_key", SALT, *within)
    other = met.withColumnsRenamed({name: f"_of_{name}" for name in own})
    same = (F.col("doi_key") == F.col("_of_doi_key")) & (F.col(SALT) == F.col(f"_of_{SALT}"))
    for name in within:
        same &= F.array_contains(F.array(f"_of_{name}"), F.col(name))
    return rows.join(other, same, "left").drop(*[f"_of_{name}" for name in own])


def pubs(
    dois: DataFrame,
    works: DataFrame,
    unpaywall: DataFrame,
    alltrials: DataFrame,
    oddpub: DataFrame,
    provenance: Provenance,
    keep: Keep = lazily,
) -> DataFrame:
    """One institution's table."""
    return with_provenance(audit_publications(dois, works, unpaywall, alltrials, oddpub, keep=keep), provenance)


def with_provenance(audited: DataFrame, provenance: Provenance) -> DataFrame:
    return audited.select(
        *COLUMNS,
        F.lit(provenance.workflow_version).alias("var_SQL_workflow_version"),
        F.lit(provenance.dois_table).alias("var_data_dois"),
        F.lit(provenance.oddpub_table).alias("var_data_oddpub"),
        F.lit(provenance.institution_id).alias("var_institution_id"),
    )
