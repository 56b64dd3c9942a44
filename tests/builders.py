"""Hand-made input rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WORKS_DDL = """
    doi string,
    crossref struct<published_year:bigint, published_month:bigint, abstract:string,
        clinical_trial_number:array<struct<clinical_trial_number:string,type:string>>,
        title:array<string>, container_title:array<string>, type:string,
        author:array<struct<ORCID:string>>, link:array<struct<URL:string>>>,
    pubmed struct<doi:string, MedlineCitation:struct<Article:struct<
        Abstract:struct<AbstractText:string>,
        DataBankList:array<struct<DataBankName:string,AccessionNumberList:array<string>>>>>>,
    coki struct<oa:struct<coki:struct<open:boolean,publisher:boolean,publisher_only:boolean,both:boolean,
        other_platform_only:boolean,other_platform_categories:struct<preprint:boolean>>>>,
    affiliations struct<authors:array<struct<identifier:string>>,funders:array<struct<identifier:string>>>
"""
UNPAYWALL_DDL = """
    doi string, oa_locations array<struct<host_type:string,oa_date:date>>, best_oa_location struct<license:string>
"""
TRIALS_DDL = """
    nct_id string, registry_query_date string, registration_date string, start_date string, completion_date string,
    is_prospective string, summary_results_reporting string, has_linked_reference string,
    is_summary_results_1y_cd string
"""


def work(doi, year=2020, month=1, abstract=None, numbers=None, **more):
    """One work. ``pubmed`` is (doi, abstract, [(bank, ids), ...]) or None."""
    pubmed = more.get("pubmed")
    nested = None
    if pubmed:
        pubmed_doi, pubmed_abstract, banks = pubmed
        nested = (pubmed_doi, (((pubmed_abstract,), banks),))
    return (
        doi,
        (
            year, month, abstract, numbers, more.get("title"), more.get("container"), more.get("type"),
            more.get("author"), more.get("link"),
        ),
        nested,
        more.get("coki"),
        more.get("affiliations"),
    )


def open_access(**flags):
    """The nested open-access record."""
    names = ("open", "publisher", "publisher_only", "both", "other_platform_only")
    return (((*[flags.get(name) for name in names], (flags.get("preprint"),)),),)


def works(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), WORKS_DDL)


def unpaywall(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(
        [(doi, locations, (license,)) for doi, locations, license in rows], UNPAYWALL_DDL
    )


def trial(nct_id, **more):
    names = (
        "registry_query_date", "registration_date", "start_date", "completion_date", "is_prospective",
        "summary_results_reporting", "has_linked_reference", "is_summary_results_1y_cd",
    )
    return (nct_id, *[more.get(name) for name in names])


def trials_raw(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), TRIALS_DDL)


def dois(spark: SparkSession, *values) -> DataFrame:
    return spark.createDataFrame([(value,) for value in values], "doi string")


def oddpub(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), "doi string, is_open_data boolean, is_open_code boolean")


def plain(rows) -> list:
    """Rows as sorted plain tuples."""
    return sorted((tuple(row) for row in rows), key=repr)
