"""Publications: facts taken from each work, joins to other sources, and labels.

Facts are worked out next to the scan, so arrays of authors, funders, links
and locations never reach a shuffle. Labels are added after the joins, where
a publication without a matching work has NULL facts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaudit.functions import labels as texts
from scholaudit.functions.arrays import any_item, first_green_date
from scholaudit.functions.copies import count_copies, expand_copies
from scholaudit.functions.dates import first_of_month, month_boundary_diff
from scholaudit.functions.keys import doi_key
from scholaudit.functions.sql import case, either, lookup
from scholaudit.functions.text import string_agg
from scholaudit.operators.hot_keys import SALT, deal, hot_table, join_dealt, meet
from scholaudit.sources.sorted import sort_columns

WORK_FACTS = {
    "work_doi": "doi",
    "published_year": "crossref.published_year",
    "cr_published_date": first_of_month("crossref.published_year", "crossref.published_month"),
    "container_title_concat": "array_join(crossref.container_title, ' ')",
    "title_concat": "array_join(crossref.title, ' ')",
    "crossref_type": "crossref.type",
    "coki": "coki.oa.coki",
    "publisher_orcid": any_item("crossref.author", "ORCID"),
    "author_orcid": any_item("affiliations.authors", "identifier"),
    "funder": any_item("affiliations.funders", "identifier"),
    "crossref_fulltext_URL_CONCAT": string_agg("crossref.link.URL"),
    "abstract_crossref": "crossref.abstract",
}


def _as_columns(group: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in group.items()}


def work_facts(works: DataFrame) -> DataFrame:
    """One narrow row per work."""
    return works.select(doi_key(works), *[F.expr(text).alias(name) for name, text in WORK_FACTS.items()])


def access_facts(unpaywall: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """First green date and licence per DOI (of the given keys), repeats counted."""
    facts = unpaywall.select(
        doi_key(unpaywall),
        F.expr(first_green_date("oa_locations")).alias("first_green_oa_date"),
        F.col("best_oa_location.license").alias("license"),
    ).where("doi_key IS NOT NULL")
    if keys is not None:
        facts = facts.join(keys, "doi_key", "left_semi")
    return count_copies(facts, "doi_key", "first_green_oa_date", "license", n="n_access")


def oddpub_facts(oddpub: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Open-data and open-code results per DOI, repeats counted."""
    facts = oddpub.select(*scope, doi_key(oddpub), "is_open_data", "is_open_code").where("doi_key IS NOT NULL")
    return count_copies(facts, *scope, "doi_key", "is_open_data", "is_open_code", n="n_oddpub")


# Columns of ``alltrials`` that the earlier publication table also carried.
TRIAL_COLUMNS = (
    "CROSSREF_clintrial_fromfield_found",
    "CROSSREF_clintrial_fromfield_idlist",
    "CROSSREF_clintrial_fromabstract_found",
    "CROSSREF_clintrial_fromabstract_idlist",
    "PUBMED_clintrial_fromfield_found",
    "PUBMED_clintrial_fromfield_idlist",
    "PUBMED_clintrial_fromabstract_found",
    "PUBMED_clintrial_fromabstract_idlist",
    "ANYSOURCE_clintrial_found",
    "ANYSOURCE_clintrial_idlist",
    "PUBMED_opendata_fromfield_found",
    "PUBMED_opendata_fromfield_idlist",
)


def extract_facts(alltrials: DataFrame, columns: Sequence[str] = (), edition: Sequence[str] = ()) -> DataFrame:
    """What publications take over from ``alltrials``."""
    return alltrials.select(
        *edition, doi_key(alltrials), F.col("abstract_PUBMED").alias("abstract_pubmed"), *columns
    ).where("doi_key IS NOT NULL")


def enriched_doi(
    works: DataFrame, unpaywall: DataFrame, alltrials: DataFrame, columns: Sequence[str] = ()
) -> DataFrame:
    """Works with their open-access facts and PubMed extract, repeats multiplied.

    A DOI that many works, or many locations, hold is joined in several tasks.
    """
    hot = hot_table("doi_key", [works.select(doi_key(works))], [unpaywall.select(doi_key(unpaywall))])
    extract = meet(extract_facts(alltrials, columns), hot, "doi_key")
    with_extract = join_dealt(deal(work_facts(works), hot, "doi_key"), extract, ["doi_key"])
    # Last, as divided copies are written out where they are joined.
    joined = join_dealt(with_extract, meet(access_facts(unpaywall), hot, "doi_key", "n_access"), ["doi_key"]).drop(SALT)
    return expand_copies(joined, F.col("n_access")).drop("n_access")


# Output columns by group, as name to SQL expression over the facts. The names and the label
# texts stated in these groups, as the output contract has them.

DOI_MATCH = {
    "doi_academicobservatory": "lower(work_doi)",
    "doi_in_academicobservatory_PRETTY": either("work_doi IS NULL", "No", "Yes"),
}

# The joined titles come with the work facts.
BIBLIOGRAPHIC = {"published_year_PRETTY": "bigint(published_year)"}

PUBLICATION_TYPE = {"crossref_type_PRETTY": lookup("crossref_type", texts.WORK_TYPES, None)}

# First route that applies; unknown and unmatched count as closed.
OA_CATEGORY = {
    "oa_coki_PRETTY": case(
        [(f"coki.{flag}", text) for flag, text, _ in texts.ACCESS_ROUTES], texts.CLOSED_ACCESS[0]
    ),
    "oa_coki_GRAPHORDER": case(
        [(f"coki.{flag}", rank) for flag, _, rank in texts.ACCESS_ROUTES], texts.CLOSED_ACCESS[1]
    ),
}

OA_OPEN_STATUS = {
    "oa_coki_open_PRETTY": case([("coki.open", "Open Access"), ("NOT coki.open", "Closed Access")], "Unknown"),
    "oa_coki_OA_open": case([("coki.open", 1)], 0),
    "oa_coki_OA_closed": case([("NOT coki.open", 1)], 0),
}

EMBARGO = {"embargo": month_boundary_diff("first_green_oa_date", "cr_published_date")}

_EMBARGO_STEPS = [(f"embargo < {limit}", text, rank) for limit, text, rank in texts.EMBARGO_STEPS] + [
    ("embargo IS NOT NULL", *texts.EMBARGO_BEYOND)
]
EMBARGO_LABEL = {
    "embargo_PRETTY": case([(test, text) for test, text, _ in _EMBARGO_STEPS], texts.EMBARGO_UNKNOWN[0]),
    "embargo_GRAPHORDER": case([(test, rank) for test, _, rank in _EMBARGO_STEPS], texts.EMBARGO_UNKNOWN[1]),
}

LICENSE = {
    "license_PRETTY": lookup("license", [(code, text) for code, text, _ in texts.LICENSES], texts.LICENSE_UNKNOWN[0]),
    "license_GRAPHORDER": lookup(
        "license",
        [(code, place) for place, (code, _, _) in enumerate(texts.LICENSES, start=1)],
        texts.LICENSE_UNKNOWN[1],
    ),
    "license_GROUP": lookup("license", [(code, group) for code, _, group in texts.LICENSES], texts.LICENSE_UNKNOWN[0]),
}


def _flag(fact: str, name: str, yes: str, no: str) -> dict[str, str]:
    return {name: f"coalesce({fact}, FALSE)", f"{name}_PRETTY": either(fact, yes, no)}


PUBLISHER_ORCID = _flag(
    "publisher_orcid", "has_publisher_orcid", "Has publisher ORCID", "Does not have publisher ORCID"
)
AUTHOR_ORCID = _flag("author_orcid", "in_orcid_record", "In an ORCID record", "Not in any ORCID record")
FUNDER = _flag("funder", "has_cr_funder_record", "Has funder acknowledgement", "No funder acknowledgement")

# The flag keeps its NULL; the label does not.
_PREPRINT = "coki.other_platform_categories.preprint"
PREPRINT = {
    "has_preprint": _PREPRINT,
    "has_preprint_PRETTY": either(_PREPRINT, "Has a preprint", "No preprint identified"),
}

OPEN_DATA_CODE = {
    "has_oddpub_processing": "n_oddpub IS NOT NULL",
    **_flag(
        "is_open_data",
        "has_open_data_oddpub",
        "Contains reference to Open data",
        "No reference to Open data found",
    ),
    **_flag(
        "is_open_code",
        "has_open_code_oddpub",
        "Contains reference to Open code",
        "No reference to Open code found",
    ),
}

# Earlier form's rule over open status, licence, route and embargo. An unknown
# status or licence is not refused.
_PLAN_S_CASES = (
    ("NOT coki.open", False),
    ("license != 'cc-by'", False),
    ("coki.publisher", True),
    ("embargo < 1", True),
)
PLAN_S = {
    "plans_compliant": case(_PLAN_S_CASES, False),
    "plans_compliant_PRETTY": either(case(_PLAN_S_CASES, False), "PlanS Compliant", "Not PlanS Compliant"),
}

# Labels of the trial and data-bank flags carried over from ``alltrials``.
TRIAL_FLAGS = {
    "ANYSOURCE_clintrial_found_PRETTY": either(
        "ANYSOURCE_clintrial_found",
        "Trial-ID found in any publication in Pubmed or Crossref",
        "No Trial-ID found in any publication in Pubmed or Crossref",
    ),
    "PUBMED_opendata_fromfield_found_PRETTY": either(
        "PUBMED_opendata_fromfield_found",
        "Databank-ID found in Pubmed",
        "No Databank-ID number found in Pubmed",
    ),
}


def adding(group: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """The operator that adds a group of columns."""
    return lambda df: df.withColumns(_as_columns(group))


doi_match_label = adding(DOI_MATCH)
bibliographic_fields = adding(BIBLIOGRAPHIC)
publication_type_label = adding(PUBLICATION_TYPE)
oa_category = adding(OA_CATEGORY)
oa_open_status = adding(OA_OPEN_STATUS)
embargo_months = adding(EMBARGO)
embargo_label = adding(EMBARGO_LABEL)  # over ``embargo``
license_label = adding(LICENSE)
orcid_publisher = adding(PUBLISHER_ORCID)
orcid_author_record = adding(AUTHOR_ORCID)
funder_record = adding(FUNDER)
preprint_label = adding(PREPRINT)
plan_s_compliance = adding(PLAN_S)  # over ``embargo``
publication_trial_columns = adding(TRIAL_FLAGS)


def add_labels(df: DataFrame) -> DataFrame:
    """All column groups of the publication table; the embargo is needed first."""
    groups = (
        DOI_MATCH,
        BIBLIOGRAPHIC,
        PUBLICATION_TYPE,
        OA_CATEGORY,
        OA_OPEN_STATUS,
        EMBARGO_LABEL,
        LICENSE,
        PUBLISHER_ORCID,
        AUTHOR_ORCID,
        FUNDER,
        PREPRINT,
        OPEN_DATA_CODE,
    )
    every = {name: text for group in groups for name, text in group.items()}
    return embargo_months(df).withColumns(_as_columns(every))


def open_data_code(pubs: DataFrame, oddpub: DataFrame) -> DataFrame:
    """Publications (with a ``doi``) and the result of the open data and code check."""
    keyed = pubs.withColumn("doi_key", F.lower("doi"))
    hot = hot_table("doi_key", [keyed.select("doi_key")], [oddpub.select(doi_key(oddpub))])
    checks = meet(oddpub_facts(oddpub), hot, "doi_key", "n_oddpub")
    joined = join_dealt(deal(keyed, hot, "doi_key"), checks, ["doi_key"]).drop(SALT)
    labelled = expand_copies(joined, F.col("n_oddpub")).withColumns(_as_columns(OPEN_DATA_CODE))
    return labelled.drop("doi_key", "n_oddpub", "is_open_data", "is_open_code")


# Newest first, then by DOI.
EXPORT_ORDER = (("published_year", True), ("doi_academicobservatory", False))


def for_export(pubs: DataFrame) -> DataFrame:
    """Newest first, then by DOI. Only for files read in order (``write_sorted``); tables are not sorted."""
    return pubs.orderBy(*sort_columns(EXPORT_ORDER))
