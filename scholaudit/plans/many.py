"""All institutions in one pass.

Trial identifiers depend on an institution only through its year cutoff, so
they are worked out once per distinct cutoff. Lists and tables of several
institutions are held together with an ``institution_id`` column, and results
equal those of one run per institution.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from scholaudit.functions.sql import inline_table
from scholaudit.plans.alltrials import CUTOFF
from scholaudit.plans.pubs import COLUMNS, audit_facts, audit_publications
from scholaudit.plans.trials import link_trials
from scholaudit.sources.staging import Keep, lazily

INSTITUTION = "institution_id"


def with_cutoff(lists: DataFrame, cutoffs: Mapping[str, int]) -> DataFrame:
    """Add each institution's cutoff; the mapping comes from the run's configuration."""
    known = inline_table(lists.sparkSession, (INSTITUTION, CUTOFF), cutoffs.items())
    return lists.join(known, INSTITUTION, "inner")


def all_trials_linked(
    trials_raw: DataFrame,
    alltrials: DataFrame,
    dois: DataFrame,
    cutoffs: Mapping[str, int],
    keep: Keep = lazily,
) -> DataFrame:
    """``trials`` of every institution. ``alltrials`` carries the cutoff column."""
    return link_trials(trials_raw, alltrials, with_cutoff(dois, cutoffs), (INSTITUTION,), (CUTOFF,), keep)


def all_publications_audited(
    dois: DataFrame,
    works: DataFrame,
    unpaywall: DataFrame,
    alltrials: DataFrame,
    oddpub: DataFrame,
    cutoffs: Mapping[str, int],
    keep: Keep = lazily,
) -> DataFrame:
    """``pubs`` of every institution. ``alltrials`` carries the cutoff column."""
    audited = audit_publications(
        with_cutoff(dois, cutoffs), works, unpaywall, alltrials, oddpub, (INSTITUTION,), (CUTOFF,), keep=keep
    )
    return audited.select(INSTITUTION, *COLUMNS)


def all_facts_audited(
    dois: DataFrame,
    facts: DataFrame,
    extract: DataFrame,
    unpaywall: DataFrame,
    oddpub: DataFrame,
    cutoffs: Mapping[str, int],
    keep: Keep,
) -> DataFrame:
    """The same from facts and extracts that hold the listed DOIs; extracts carry the cutoff column.

    Rows come rebalanced by institution.
    """
    audited = audit_facts(
        with_cutoff(dois, cutoffs), facts, extract, unpaywall, oddpub, (INSTITUTION,), (CUTOFF,), keep, together=True
    )
    return audited.select(INSTITUTION, *COLUMNS)
