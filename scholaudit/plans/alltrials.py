"""The ``alltrials`` table: trial identifiers per publication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaudit.config import Provenance
from scholaudit.operators.trial_ids import (
    any_source_trials,
    attach_entries,
    attach_evidence,
    entries_of,
    evidence_rows,
    group_evidence,
    id_list_strings,
    narrow_works,
    published_after,
    shared_evidence,
    text_evidence,
    trial_evidence,
)
from scholaudit.sources.staging import Keep

# Output columns in order.
SOURCES = (
    "CROSSREF_clintrial_fromabstract",
    "CROSSREF_clintrial_fromfield",
    "PUBMED_clintrial_fromabstract",
    "PUBMED_clintrial_fromfield",
    "PUBMED_opendata_fromfield",
)
COLUMNS = (
    "doi",
    "published_year",
    "abstract_CROSSREF",
    "abstract_PUBMED",
    *[f"{source}{part}" for source in SOURCES for part in ("_found", "", "_idlist")],
    "ANYSOURCE_clintrial_found",
    "ANYSOURCE_clintrial_idlist",
)

# Years of cutoff as a column, where one job serves several cutoffs.
CUTOFF = "year_cutoff"


def with_cutoffs(df: DataFrame, cutoffs: Iterable[int]) -> DataFrame:
    """Rows once per cutoff that their ``published_year`` passes.

    Lists are grouped after the cutoff, so a build at the lowest cutoff could
    not be filtered down to a higher one.
    """
    return df.withColumn(CUTOFF, F.expr(f"explode({passed_cutoffs(cutoffs)})"))


def passed_cutoffs(cutoffs: Iterable[int]) -> str:
    """The cutoffs that a row's ``published_year`` passes."""
    known = ", ".join(f"{int(cutoff)}L" for cutoff in sorted(set(cutoffs)))
    return f"filter(array({known}), cutoff -> published_year > cutoff)"


def combine(searched: DataFrame, evidence: DataFrame, edition: tuple[str, ...] = ()) -> DataFrame:
    """All columns but provenance, from works whose texts have been searched."""
    return complete(attach_evidence(searched, evidence, edition), edition)


def complete(attached: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The same from works whose evidence is attached."""
    return any_source_trials(id_list_strings(attached)).select(*more, *COLUMNS)


def alltrials(works: DataFrame, cutoff: int, provenance: Provenance, shared: DataFrame | None = None) -> DataFrame:
    """One institution's table.

    ``shared`` is the evidence of shared keys, read from a written table
    (``shared_evidence``). Its size is then known before the join; when it
    fits the broadcast threshold the wide works table is not shuffled at all.
    Without it all evidence is grouped and joined within the plan.
    """
    recent = published_after(works, cutoff)
    evidence = trial_evidence(recent) if shared is None else shared
    combined = combine(text_evidence(recent, own=shared is not None), evidence)
    return combined.withColumns(provenance_columns(cutoff, provenance))


def provenance_columns(cutoff: int, provenance: Provenance) -> dict[str, Column]:
    return {
        "var_AcademicObservatory_doi": F.lit(provenance.works_table),
        "var_SQL_year_cutoff": F.lit(cutoff).cast("bigint"),
        "var_SQL_workflow_version": F.lit(provenance.workflow_version),
        "var_institution_id": F.lit(provenance.institution_id),
    }


def shared_by_cutoff(works: DataFrame, cutoffs: Iterable[int], keep: Keep) -> DataFrame:
    """Evidence of shared keys per cutoff; only entries are repeated for the cutoffs."""
    years = sorted(set(cutoffs))
    narrow = narrow_works(published_after(works, years[0]))
    return shared_evidence(narrow, keep, with_cutoffs(entries_of(narrow), years), (CUTOFF,))


def alltrials_by_cutoff(
    works: DataFrame, cutoffs: Iterable[int], shared: DataFrame | None = None, key: tuple[str, ...] = ()
) -> DataFrame:
    """One table for all institutions, with a row set per distinct cutoff.

    Texts are searched and shuffled once, before the rows are repeated for the
    cutoffs. With ``key=("doi_key",)`` the rows keep their key, and a join on
    it finds them in place.
    """
    years = sorted(set(cutoffs))
    recent = published_after(works, years[0])
    evidence = shared
    if evidence is None:
        evidence = group_evidence(with_cutoffs(evidence_rows(recent), years), (CUTOFF,))
    # Works meet the evidence of all cutoffs by one row of their key, and are repeated where they are then.
    edition = F.struct(CUTOFF, "entries")
    editions = evidence.groupBy("doi_key").agg(F.collect_list(edition).alias("editions"))  # one for each cutoff
    searched = text_evidence(recent, own=shared is not None).join(editions, "doi_key", "left")
    own = f"get(filter(editions, one -> one.{CUTOFF} = {CUTOFF}), 0).entries"
    return complete(attach_entries(with_cutoffs(searched, years), own, ("editions",)), (CUTOFF, *key))
