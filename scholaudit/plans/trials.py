"""The ``trials`` table: registered trials linked to publications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.config import Provenance
from scholaudit.functions.sql import either
from scholaudit.operators.trial_ids import flatten_trial_pairs
from scholaudit.operators.trial_links import attach_links, clean_trials, trials_in_publications
from scholaudit.sources.staging import Keep, lazily


def link_trials(
    trials_raw: DataFrame,
    alltrials: DataFrame,
    dois: DataFrame,
    scope: Sequence[str] = (),
    edition: Sequence[str] = (),
    keep: Keep = lazily,
) -> DataFrame:
    """Cleaned trials with the DOIs of the institution's publications naming them."""
    cleaned = clean_trials(trials_raw, scope)
    pairs = flatten_trial_pairs(alltrials, edition)
    links = trials_in_publications(pairs, dois, cleaned, scope, edition, keep)
    # Fixed value: the label's text.
    tail = "Trial-IDs from the institution's trial dataset found in a publication from the institution"
    return attach_links(cleaned, links, scope).withColumns(
        {
            "PUBSDATA_doi_found": F.col("PUBSDATA_doi").isNotNull(),
            "PUBSDATA_doi_found_PRETTY": F.expr(either("PUBSDATA_doi IS NOT NULL", tail, f"No {tail}")),
        }
    )


def trials(
    trials_raw: DataFrame,
    alltrials: DataFrame,
    dois: DataFrame,
    provenance: Provenance,
    keep: Keep = lazily,
) -> DataFrame:
    """One institution's table: a row per row of its trial list."""
    return link_trials(trials_raw, alltrials, dois, keep=keep).select(
        "*",
        F.lit(provenance.workflow_version).alias("var_SQL_workflow_version"),
        F.lit(provenance.trials_table).alias("var_data_trials"),
        F.lit(provenance.dois_table).alias("var_data_dois"),
        F.lit(provenance.institution_id).alias("var_institution_id"),
    )
