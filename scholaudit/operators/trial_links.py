"""Registered trials: cleaning, labels and links to publications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.functions.arrays import repeat_items
from scholaudit.functions.casts import cast_boolean, cast_date, cast_datetime, cast_string
from scholaudit.functions.copies import count_copies
from scholaudit.functions.labels import RESULTS_REPORTING
from scholaudit.functions.sql import case, either, lookup
from scholaudit.functions.text import split_on, trim_ws
from scholaudit.sources.staging import Keep, lazily

# Column groups, as output name to SQL expression over the raw columns. The names and the label
# texts stated in these groups, as the output contract has them.

# The flag and label look at the raw value, so "NA" counts as found.
TRIAL_ID_COLUMNS = {
    "nct_id": f"upper({cast_string('nct_id')})",
    "nct_id_found": "nct_id IS NOT NULL",
    "nct_id_found_PRETTY": either("nct_id IS NULL", "No Trial-ID", "Has Trial-ID"),
}

DATE_COLUMNS = {
    "registry_query_date": cast_date("registry_query_date"),
    "registration_date": cast_date("registration_date"),
    "start_date": cast_datetime("start_date"),
    "completion_date": cast_datetime("completion_date"),
}

# An unknown value counts as registered after enrollment.
PROSPECTIVE_COLUMNS = {
    "is_prospective": cast_boolean("is_prospective"),
    "is_prospective_PRETTY": either(
        cast_boolean("is_prospective"),
        "Registered before enrollment started",
        "Registered after enrollment started",
    ),
}

# The label and rank match the raw code exactly; the code itself is lowered.
REPORTING_COLUMNS = {
    "summary_results_reporting": f"lower({cast_string('summary_results_reporting')})",
    "summary_results_reporting_PRETTY": lookup(
        "summary_results_reporting", [(code, text) for code, text, _ in RESULTS_REPORTING], ""
    ),
    "summary_results_reporting_GRAPHORDER": lookup(
        "summary_results_reporting", [(code, rank) for code, _, rank in RESULTS_REPORTING], 99
    ),
}

REFERENCE_COLUMNS = {
    "has_linked_reference": cast_boolean("has_linked_reference"),
    "has_linked_reference_PRETTY": either(
        cast_boolean("has_linked_reference"),
        "Trial has a linked reference",
        "Trial does not have a linked reference",
    ),
}

# Earlier form of the results label, with three cases.
WITHIN_1Y_COLUMNS = {
    "is_summary_results_1y_cd": cast_boolean("is_summary_results_1y_cd"),
    "is_summary_results_1y_cd_PRETTY": case(
        [
            (
                cast_boolean("is_summary_results_1y_cd"),
                "Summary results reported within 1 year of trial completion",
            ),
            (
                f"NOT {cast_boolean('is_summary_results_1y_cd')}",
                "Summary results not reported within 1 year of trial completion",
            ),
        ],
        "No information about reporting of summary results",
    ),
}


def _select(df: DataFrame, columns: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    # One projection: every expression reads the raw column, not a cleaned namesake.
    return df.select(*keep, *[F.expr(text).alias(name) for name, text in columns.items()])


def clean_trials(trials_raw: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Typed trial table with all labels."""
    columns = TRIAL_ID_COLUMNS | DATE_COLUMNS | PROSPECTIVE_COLUMNS | REPORTING_COLUMNS | REFERENCE_COLUMNS
    return _select(trials_raw, columns, scope)


def prospective_label(trials_raw: DataFrame) -> DataFrame:
    return _select(trials_raw, TRIAL_ID_COLUMNS | PROSPECTIVE_COLUMNS)


def results_reporting_label(trials_raw: DataFrame) -> DataFrame:
    return _select(trials_raw, TRIAL_ID_COLUMNS | REPORTING_COLUMNS)


def linked_reference_label(trials_raw: DataFrame) -> DataFrame:
    return _select(trials_raw, TRIAL_ID_COLUMNS | REFERENCE_COLUMNS)


def results_within_1y_label(trials_raw: DataFrame) -> DataFrame:
    return _select(trials_raw, TRIAL_ID_COLUMNS | WITHIN_1Y_COLUMNS)


def _trial_counts(trials: DataFrame, scope: Sequence[str]) -> DataFrame:
    """How many rows each trial id has, so that the join to pairs adds no rows."""
    known = trials.where(F.col("nct_id").isNotNull())
    return count_copies(known, *scope, "nct_id", n="n_trials").withColumn("trial_key", F.lower("nct_id"))


def _joined_list(counted: DataFrame, by: Sequence[str], item: str, name: str) -> DataFrame:
    """Sorted, space-separated list of the items per group, repeats kept.

    The input holds each (group, item) once with its number, so what a group
    gathers is its distinct items only.
    """
    listed = counted.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(F.col(item).alias("item"), "n"))).alias("items")
    )
    text = trim_ws(f"array_join({repeat_items('items', 'item.item')}, ' ')")
    return listed.select(*by, F.expr(text).alias(name))


def trials_in_publications(
    pairs: DataFrame,
    dois: DataFrame,
    trials: DataFrame,
    scope: Sequence[str] = (),
    edition: Sequence[str] = (),
    keep: Keep = lazily,
) -> DataFrame:
    """DOIs of the institution's publications per trial of the institution.

    A DOI listed, or a trial registered, several times appears as often in
    the list; both sides are counted first and multiplied after the joins.
    """
    wanted = dois.where(F.col("doi").isNotNull()).withColumn("doi_key", F.lower("doi"))
    doi_counts = keep(count_copies(wanted, *scope, *edition, "doi_key", n="n_dois"), "doi_counts")
    trial_counts = keep(_trial_counts(trials, scope), "trial_counts")
    found = pairs.withColumns(
        {"doi_key": F.col("ANYSOURCE_doi"), "trial_key": F.lower("ANYSOURCE_clintrial_id_flat")}
    )
    linked = (
        found.join(doi_counts, [*edition, "doi_key"], "inner")
        .join(trial_counts, [*scope, "trial_key"], "inner")
        .groupBy(*scope, "nct_id", F.expr(trim_ws("doi_key")).alias("PUBSDATA_doi"))
        .agg(F.sum(F.col("n_dois") * F.col("n_trials")).alias("n"))
    )
    return keep(_joined_list(linked, [*scope, "nct_id"], "PUBSDATA_doi", "PUBSDATA_doi"), "links")


def attach_links(trials: DataFrame, links: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Left join of per-trial lists; trials without an id match nothing."""
    keyed = links.withColumn("trial_key", F.lower("nct_id")).drop("nct_id")
    keyed_trials = trials.withColumn("trial_key", F.lower("nct_id"))
    return keyed_trials.join(keyed, [*scope, "trial_key"], "left").drop("trial_key")


def any_source_links(trials: DataFrame, pairs: DataFrame, owner: str = "the institution") -> DataFrame:
    """Trials with the DOIs of any publication that names them (earlier form)."""
    name = "ANYSOURCE_dois_matching_trialid"
    linked = (
        pairs.where(F.col("ANYSOURCE_doi").isNotNull())
        .withColumn("trial_key", F.lower("ANYSOURCE_clintrial_id_flat"))
        .join(_trial_counts(trials, ()), "trial_key", "inner")
        .groupBy("nct_id", F.lower("ANYSOURCE_doi").alias("ANYSOURCE_doi"))
        .agg(F.sum("n_trials").alias("n"))
    )
    joined = attach_links(trials, _joined_list(linked, ["nct_id"], "ANYSOURCE_doi", name))
    tail = f"Trial-IDs from {owner}'s trial dataset found in a Crossref or Pubmed publication"
    return joined.withColumns(
        {
            "ANYSOURCE_doi_found": F.col(name).isNotNull(),
            "ANYSOURCE_doi_found_PRETTY": F.expr(either(f"{name} IS NOT NULL", tail, f"No {tail}")),
        }
    )


def trials_matching_publication(pubs: DataFrame, trials: DataFrame, owner: str = "the institution") -> DataFrame:
    """Publications with the institution's trials that they report (earlier form)."""
    name = "TRIALSDATA_matching_doi_CONCAT"
    dois = split_on(trim_ws("PUBSDATA_doi"), " ")
    # Equal rows carry equal lists, so they are counted before the lists are split.
    rows = count_copies(trials.where("PUBSDATA_doi_found"), "nct_id", "PUBSDATA_doi", n="n_rows")
    flat = rows.select("nct_id", "n_rows", F.expr(f"explode({dois})").alias("PUBSDATA_doi_flat"))
    counted = flat.groupBy("PUBSDATA_doi_flat", "nct_id").agg(F.sum("n_rows").alias("n"))
    listed = _joined_list(counted, ["PUBSDATA_doi_flat"], "nct_id", name)
    matched = listed.select(F.lower("PUBSDATA_doi_flat").alias("work_key"), name, F.lit(True).alias("_hit"))
    joined = pubs.withColumn("work_key", F.lower("doi_academicobservatory")).join(matched, "work_key", "left")
    # Fixed values, worded as the audience of the earlier form knows them.
    label = either(
        "_hit",
        f"Trial dataset Trial-IDs found {owner}'s publications",
        f"Trial dataset Trial-IDs not found in {owner}'s publications",
    )
    return joined.withColumns(
        {
            "TRIALDATA_trialids_found_in_pubs": F.expr("coalesce(_hit, FALSE)"),
            "TRIALDATA_trialids_found_in_pubs_PRETTY": F.expr(label),
        }
    ).drop("work_key", "_hit")
