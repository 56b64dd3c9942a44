"""Registered queries: each operator over the tables of ``sample_tables``.

Results hold scalars only; lists are joined into text the same way in
``oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sample_tables as tables
from checks.sample_tables import CUTOFF
from scholaudit.config import Provenance
from scholaudit.functions import casts
from scholaudit.functions.arrays import first_green_date
from scholaudit.functions.dates import month_boundary_diff
from scholaudit.functions.keys import left_join_any_case
from scholaudit.functions.text import dedupe_string, string_agg, trim_ws
from scholaudit.operators import publications, trial_ids, trial_links
from scholaudit.operators.audit import TRIAL_METRICS, audit_tables, metric_rollup, utility_years
from scholaudit.operators.extract import pubmed_extract
from scholaudit.operators.researchers import researcher_orcid
from scholaudit.operators.trial_ids import narrow_works, published_after, shared_evidence
from scholaudit.plans.alltrials import alltrials, alltrials_by_cutoff, shared_by_cutoff
from scholaudit.plans.many import all_publications_audited, all_trials_linked
from scholaudit.plans.pubs import pubs
from scholaudit.plans.trials import trials
from scholaudit.sources.staging import lazily

PROVENANCE = Provenance(
    workflow_version="v1",
    works_table="doi20240512",
    dois_table="dois_20230217",
    oddpub_table="oddpub_20230217",
    trials_table="trials_aact_20250221",
    institution_id="inst",
)
# Every brand of the parts table stands for an institution.
INSTITUTION_CUTOFFS = {f"Brand#{number}": tables.INSTITUTION_CUTOFFS[number % 3] for number in range(1, 26)}

Query = Callable[[SparkSession, str], DataFrame]


def _ids_text(ids: str) -> str:
    return f"array_join(sort_array(transform({ids}, one -> one.id)), ' ')"


def _sorted_parts(text: str) -> str:
    return f"array_join(sort_array(split({text}, ' ')), ' ')"


def _bank_text(entries: str) -> str:
    """Entries with an id list as text, in their order."""
    one = "concat(coalesce(one.registry, '-'), ':', coalesce(array_join(one.id, '+'), '-'))"
    return f"array_join(transform({entries}, one -> {one}), ';')"


def _field_text(entries: str) -> str:
    one = "concat(coalesce(one.type, '-'), ':', coalesce(one.id, ''))"
    return f"array_join(transform({entries}, one -> {one}), ';')"


def _shown(df: DataFrame) -> DataFrame:
    """Scalar forms of the array and list columns of ``alltrials``."""
    shown = {}
    for name in df.columns:
        if name.endswith("_fromabstract"):
            shown[f"{name}_ids"] = _ids_text(name)
        elif name == "CROSSREF_clintrial_fromfield":
            shown[f"{name}_entries"] = _field_text(name)
        elif name.endswith("_fromfield"):
            shown[f"{name}_entries"] = _bank_text(name)
        elif name.endswith("_fromabstract_idlist") or name == "ANYSOURCE_clintrial_idlist":
            shown[name] = _sorted_parts(name)
        else:
            shown[name] = name
    return df.selectExpr(*[f"{text} AS {name}" for name, text in shown.items()])


def _alltrials(works: DataFrame) -> DataFrame:
    shared = shared_evidence(narrow_works(published_after(works, CUTOFF)), lazily)
    return alltrials(works, CUTOFF, PROVENANCE, shared)


def _q_trial_ids_in_text(spark, sf_dir):
    works = tables.works(spark, sf_dir).select(
        "doi",
        F.col("crossref.abstract").alias("crossref_abstract"),
        F.col(trial_ids.PUBMED_ABSTRACT).alias("pubmed_abstract"),
    )
    found = trial_ids.trial_ids_in_text(
        works,
        {
            "CROSSREF_clintrial_fromabstract": "crossref_abstract",
            "PUBMED_clintrial_fromabstract": "pubmed_abstract",
        },
    )
    return _shown(found.drop("crossref_abstract", "pubmed_abstract"))


def _q_trial_ids_in_field(spark, sf_dir):
    return _shown(trial_ids.trial_ids_in_field(tables.works(spark, sf_dir)))


def _q_registry_entries(spark, sf_dir):
    return _shown(trial_ids.registry_entries(tables.works(spark, sf_dir), CUTOFF))


def _q_databank_entries(spark, sf_dir):
    return _shown(trial_ids.databank_entries(tables.works(spark, sf_dir), CUTOFF))


def _q_entry_pages(spark, sf_dir):
    """Short pages, so that repeated DOIs have several; their sums are the lists'."""
    kinds = (trial_ids.REGISTRY, trial_ids.DATABANK, trial_ids.CROSSREF)
    works = tables.works(spark, sf_dir)
    parts = []
    for kind in kinds:
        pages = trial_ids.entry_pages(works, CUTOFF, kind, page=2)
        text = "one.type" if kind == trial_ids.CROSSREF else "one.registry"
        parts.append(
            pages.groupBy("doi").agg(
                F.lit(kind).alias("kind"),
                F.sum(F.size("entries")).alias("n_entries"),
                F.min(F.expr(f"array_min(transform(entries, one -> coalesce({text}, '-')))")).alias("first_label"),
                F.max(F.expr(f"array_max(transform(entries, one -> coalesce({text}, '-')))")).alias("last_label"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _q_id_list_strings(spark, sf_dir):
    found = _alltrials(tables.works(spark, sf_dir))
    return _shown(found.select("doi", *[c for c in found.columns if c.endswith("_idlist") and "ANYSOURCE" not in c]))


def _q_any_source_trials(spark, sf_dir):
    return _shown(
        _alltrials(tables.works(spark, sf_dir)).select("doi", "ANYSOURCE_clintrial_found", "ANYSOURCE_clintrial_idlist")
    )


def _q_alltrials(spark, sf_dir):
    return _shown(_alltrials(tables.works(spark, sf_dir)))


def _q_flatten_trial_pairs(spark, sf_dir):
    return trial_ids.flatten_trial_pairs(_alltrials(tables.works(spark, sf_dir)))


def _of_raw_trials(operator) -> Query:
    return lambda spark, sf_dir: operator(tables.trials_raw(spark, sf_dir))


def _q_trials_in_publications(spark, sf_dir):
    pairs = _q_flatten_trial_pairs(spark, sf_dir)
    cleaned = trial_links.clean_trials(tables.trials_raw(spark, sf_dir))
    return trial_links.trials_in_publications(pairs, tables.dois(spark, sf_dir), cleaned, keep=lazily)


def _q_trials(spark, sf_dir):
    found = _alltrials(tables.works(spark, sf_dir))
    return trials(tables.trials_raw(spark, sf_dir), found, tables.dois(spark, sf_dir), PROVENANCE, lazily)


def _q_any_source_links(spark, sf_dir):
    cleaned = trial_links.clean_trials(tables.trials_raw(spark, sf_dir))
    return trial_links.any_source_links(cleaned, _q_flatten_trial_pairs(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str, columns=()) -> DataFrame:
    works = tables.works(spark, sf_dir)
    return publications.enriched_doi(works, tables.unpaywall(spark, sf_dir), _alltrials(works), columns)


def _q_enriched_doi(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        F.col("work_doi").alias("doi"),
        "published_year",
        "cr_published_date",
        "first_green_oa_date",
        "license",
        "abstract_pubmed",
    )


def _of_enriched(operator, *columns: str) -> Query:
    """The DOI and the operator's columns for every enriched work."""
    return lambda spark, sf_dir: operator(_enriched(spark, sf_dir)).select("work_doi", *columns)


def _q_embargo_label(spark, sf_dir):
    months = publications.embargo_months(_enriched(spark, sf_dir))
    return publications.embargo_label(months).select("work_doi", "embargo", "embargo_PRETTY", "embargo_GRAPHORDER")


def _q_plan_s_compliance(spark, sf_dir):
    months = publications.embargo_months(_enriched(spark, sf_dir))
    return publications.plan_s_compliance(months).select("work_doi", "plans_compliant", "plans_compliant_PRETTY")


def _q_publication_trial_columns(spark, sf_dir):
    names = [
        name for name in publications.TRIAL_COLUMNS if not name.endswith("abstract_idlist") and "ANYSOURCE" not in name
    ]
    labelled = publications.publication_trial_columns(_enriched(spark, sf_dir, publications.TRIAL_COLUMNS))
    return labelled.select(
        "work_doi",
        *names,
        "ANYSOURCE_clintrial_found",
        "ANYSOURCE_clintrial_found_PRETTY",
        "PUBMED_opendata_fromfield_found_PRETTY",
    )


def _q_open_data_code(spark, sf_dir):
    listed = tables.dois(spark, sf_dir).select("doi").distinct()
    return publications.open_data_code(listed, tables.oddpub(spark, sf_dir))


def _pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    works = tables.works(spark, sf_dir)
    return pubs(
        tables.dois(spark, sf_dir),
        works,
        tables.unpaywall(spark, sf_dir),
        _alltrials(works),
        tables.oddpub(spark, sf_dir),
        PROVENANCE,
        lazily,
    )


def _flat_open_access(df: DataFrame) -> DataFrame:
    """The open-access struct field by field; the preprint flag has its own column."""
    flags = ("open", "publisher", "publisher_only", "both", "other_platform_only")
    return df.select("*", *[F.col(f"coki.{flag}").alias(f"coki_{flag}") for flag in flags]).drop("coki")


def _q_pubs(spark, sf_dir):
    return _flat_open_access(_pubs(spark, sf_dir))


def _q_export_order(spark, sf_dir):
    return publications.for_export(_pubs(spark, sf_dir)).select("doi", "doi_academicobservatory", "published_year")


def _q_trials_matching_publication(spark, sf_dir):
    matched = trial_links.trials_matching_publication(_pubs(spark, sf_dir), _q_trials(spark, sf_dir))
    return matched.select(
        "doi",
        "doi_academicobservatory",
        "TRIALSDATA_matching_doi_CONCAT",
        "TRIALDATA_trialids_found_in_pubs",
        "TRIALDATA_trialids_found_in_pubs_PRETTY",
    )


def _q_researcher_orcid(spark, sf_dir):
    return researcher_orcid(tables.orcids(spark, sf_dir), "orcid_query", "orcids", "orcids_out")


def _q_pubmed_extract(spark, sf_dir):
    found = pubmed_extract(tables.articles(spark, sf_dir), tables.dois(spark, sf_dir))
    entries = "sort_array(transform(pubmed_DataBankList, one -> concat(one.name, ':', one.id)))"
    return found.withColumn("pubmed_DataBankList", F.expr(f"array_join({entries}, ';')"))


def _q_table_audit(spark, sf_dir):
    return audit_tables(
        {
            "works": (tables.works(spark, sf_dir), "doi"),
            "dois": (tables.dois(spark, sf_dir), "doi"),
            "oddpub": (tables.oddpub(spark, sf_dir), "doi"),
            "trials_aact": (tables.trials_raw(spark, sf_dir), "nct_id"),
            "orcids": (tables.orcids(spark, sf_dir), "orcid_id"),
            "trials": (_q_trials(spark, sf_dir), "nct_id"),
        }
    )


def _q_output_audit(spark, sf_dir):
    return audit_tables(
        {
            "alltrials": (_alltrials(tables.works(spark, sf_dir)), "doi"),
            "pubs": (_pubs(spark, sf_dir), "doi"),
            "researchers": (_q_researcher_orcid(spark, sf_dir), "orcid_id"),
            "unpaywall": (tables.unpaywall(spark, sf_dir), "doi"),
        }
    )


def _q_metric_rollup(spark, sf_dir):
    return metric_rollup(_q_trials(spark, sf_dir), TRIAL_METRICS)


def _q_utility_years(spark, sf_dir):
    return utility_years(_pubs(spark, sf_dir))


def _q_dedupe_string(spark, sf_dir):
    texts = tables.table(spark, sf_dir, "documents")
    return texts.select("doc_id", F.expr(dedupe_string("text")).alias("deduped"))


def _q_na_cast(spark, sf_dir):
    raw = tables.trials_raw(spark, sf_dir)
    return raw.select(
        F.col("nct_id").alias("raw_id"),
        F.expr(casts.cast_string("nct_id")).alias("as_string"),
        F.expr(casts.cast_date("registry_query_date")).alias("as_date"),
        F.expr(casts.cast_datetime("completion_date")).alias("as_datetime"),
        F.expr(casts.cast_boolean("is_prospective")).alias("as_boolean"),
        F.expr(casts.cast_int("length(is_prospective)")).alias("as_int"),
    )


def _q_first_green_date(spark, sf_dir):
    return tables.unpaywall(spark, sf_dir).select(
        "doi", F.expr(first_green_date("oa_locations")).alias("first_green_oa_date")
    )


def _q_month_boundary_diff(spark, sf_dir):
    items = tables.table(spark, sf_dir, "lineitem")
    orders = tables.table(spark, sf_dir, "orders")
    months = F.expr(month_boundary_diff("l_shipdate", "o_orderdate"))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "l_linenumber", months.alias("months")
    )


def _q_array_string_agg(spark, sf_dir):
    numbers = f"transform({trial_ids.FIELD}, number -> {trim_ws('number.clinical_trial_number')})"
    return tables.works(spark, sf_dir).select("doi", F.expr(string_agg(numbers)).alias("joined"))


def _q_case_insensitive_left_join(spark, sf_dir):
    listed = tables.dois(spark, sf_dir).select(F.col("doi").alias("listed_doi"))
    works = tables.works(spark, sf_dir).select(F.col("doi").alias("work_doi"))
    return left_join_any_case(listed, works, "listed_doi", "work_doi")


def _by_cutoff(works: DataFrame, *key: str) -> DataFrame:
    cutoffs = INSTITUTION_CUTOFFS.values()
    return alltrials_by_cutoff(works, cutoffs, shared_by_cutoff(works, cutoffs, lazily), key)


def _q_many_institutions_trials(spark, sf_dir):
    found = _by_cutoff(tables.works(spark, sf_dir))
    linked = all_trials_linked(
        tables.trials_raw(spark, sf_dir), found, tables.dois(spark, sf_dir), INSTITUTION_CUTOFFS, lazily
    )
    return linked.drop("PUBSDATA_doi_found_PRETTY")


def _q_many_institutions_pubs(spark, sf_dir):
    works = tables.works(spark, sf_dir)
    audited = all_publications_audited(
        tables.dois(spark, sf_dir),
        works,
        tables.unpaywall(spark, sf_dir),
        _by_cutoff(works, "doi_key"),
        tables.oddpub(spark, sf_dir),
        INSTITUTION_CUTOFFS,
        lazily,
    )
    return _flat_open_access(audited)


QUERIES: dict[str, Query] = {
    # Trial identifiers per publication.
    "trial_ids_in_text": _q_trial_ids_in_text,
    "trial_ids_in_field": _q_trial_ids_in_field,
    "registry_entries": _q_registry_entries,
    "databank_entries": _q_databank_entries,
    "entry_pages": _q_entry_pages,
    "id_list_strings": _q_id_list_strings,
    "any_source_trials": _q_any_source_trials,
    "alltrials": _q_alltrials,
    # Registered trials.
    "clean_trials": _of_raw_trials(trial_links.clean_trials),
    "prospective_label": _of_raw_trials(trial_links.prospective_label),
    "results_reporting_label": _of_raw_trials(trial_links.results_reporting_label),
    "linked_reference_label": _of_raw_trials(trial_links.linked_reference_label),
    "flatten_trial_pairs": _q_flatten_trial_pairs,
    "trials_in_publications": _q_trials_in_publications,
    "trials": _q_trials,
    # Publications.
    "enriched_doi": _q_enriched_doi,
    "doi_match_label": _of_enriched(
        publications.doi_match_label, "doi_academicobservatory", "doi_in_academicobservatory_PRETTY"
    ),
    "bibliographic_fields": _of_enriched(
        publications.bibliographic_fields,
        "published_year",
        "published_year_PRETTY",
        "container_title_concat",
        "title_concat",
    ),
    "publication_type_label": _of_enriched(
        publications.publication_type_label, "crossref_type", "crossref_type_PRETTY"
    ),
    "oa_category": _of_enriched(publications.oa_category, "oa_coki_PRETTY", "oa_coki_GRAPHORDER"),
    "oa_open_status": _of_enriched(
        publications.oa_open_status, "oa_coki_open_PRETTY", "oa_coki_OA_open", "oa_coki_OA_closed"
    ),
    "embargo_months": _of_enriched(
        publications.embargo_months, "first_green_oa_date", "cr_published_date", "embargo"
    ),
    "embargo_label": _q_embargo_label,
    "license_label": _of_enriched(
        publications.license_label, "license", "license_PRETTY", "license_GRAPHORDER", "license_GROUP"
    ),
    "orcid_publisher": _of_enriched(
        publications.orcid_publisher, "has_publisher_orcid", "has_publisher_orcid_PRETTY"
    ),
    "orcid_author_record": _of_enriched(
        publications.orcid_author_record, "in_orcid_record", "in_orcid_record_PRETTY"
    ),
    "funder_record": _of_enriched(
        publications.funder_record, "has_cr_funder_record", "has_cr_funder_record_PRETTY"
    ),
    "preprint_label": _of_enriched(publications.preprint_label, "has_preprint", "has_preprint_PRETTY"),
    "open_data_code": _q_open_data_code,
    "fulltext_urls": _of_enriched(lambda df: df, "crossref_fulltext_URL_CONCAT"),
    "abstracts": _of_enriched(lambda df: df, "abstract_crossref", "abstract_pubmed"),
    "pubs": _q_pubs,
    "export_order": _q_export_order,
    # All institutions in one job.
    "many_institutions_trials": _q_many_institutions_trials,
    "many_institutions_pubs": _q_many_institutions_pubs,
    # Counts and years.
    "table_audit": _q_table_audit,
    "output_audit": _q_output_audit,
    "metric_rollup": _q_metric_rollup,
    "utility_years": _q_utility_years,
    # Earlier forms.
    "any_source_links": _q_any_source_links,
    "results_within_1y_label": _of_raw_trials(trial_links.results_within_1y_label),
    "plan_s_compliance": _q_plan_s_compliance,
    "publication_trial_columns": _q_publication_trial_columns,
    "trials_matching_publication": _q_trials_matching_publication,
    "researcher_orcid": _q_researcher_orcid,
    "pubmed_extract": _q_pubmed_extract,
    # Functions.
    "dedupe_string": _q_dedupe_string,
    "na_cast": _q_na_cast,
    "first_green_date": _q_first_green_date,
    "month_boundary_diff": _q_month_boundary_diff,
    "array_string_agg": _q_array_string_agg,
    "case_insensitive_left_join": _q_case_insensitive_left_join,
}
