from __future__ import annotations

import datetime

import pytest
from builders import dois, oddpub, open_access, plain, unpaywall, work, works
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scholaudit.config import Provenance
from scholaudit.functions import labels
from scholaudit.operators import publications
from scholaudit.plans.alltrials import alltrials
from scholaudit.plans.pubs import COLUMNS, audit_publications, pubs

PROVENANCE = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")


def audited(spark, listed, work_rows, access_rows=(), odd_rows=(), cutoff=1):
    own_works = works(spark, *work_rows)
    found = alltrials(own_works, cutoff, PROVENANCE)
    return pubs(
        dois(spark, *listed), own_works, unpaywall(spark, *access_rows), found, oddpub(spark, *odd_rows), PROVENANCE
    )


def test_columns(spark):
    df = audited(spark, ["a"], [work("a")])
    tail = ["var_SQL_workflow_version", "var_data_dois", "var_data_oddpub", "var_institution_id"]
    assert df.columns == [*COLUMNS, *tail]
    assert len(df.columns) == 44
    row = df.first()
    assert [row[name] for name in tail] == ["v1", "dois_1", "oddpub_1", "inst"]


def test_unmatched_doi_gets_the_negative_labels(spark):
    row = audited(spark, ["10.1/Gone"], [work("a")], odd_rows=[("10.1/gone", True, None)]).first()
    assert row.doi == "10.1/gone"
    assert row.doi_academicobservatory is None
    assert row.doi_in_academicobservatory_PRETTY == "No"
    assert row.published_year is None
    assert row.oa_coki_PRETTY == "Closed Access"
    assert row.oa_coki_GRAPHORDER == 3
    assert row.oa_coki_open_PRETTY == "Unknown"
    assert (row.oa_coki_OA_open, row.oa_coki_OA_closed) == (0, 0)
    assert row.embargo_PRETTY == "Insufficient Data"
    assert row.license_PRETTY == row.license_GROUP == "No licence info"
    assert row.license_GRAPHORDER == 99
    assert row.has_publisher_orcid is False
    assert row.has_publisher_orcid_PRETTY == "Does not have publisher ORCID"
    assert row.in_orcid_record is False
    assert row.has_cr_funder_record is False
    assert row.has_preprint is None
    assert row.has_preprint_PRETTY == "No preprint identified"
    # The check list is matched on the listed DOI, so it holds without a work.
    assert row.has_oddpub_processing is True
    assert row.has_open_data_oddpub is True
    assert row.has_open_code_oddpub is False


def test_distinct_dois_are_case_sensitive_and_joins_are_not(spark):
    df = audited(spark, ["10.1/A", "10.1/a", "10.1/a", None], [work("10.1/A"), work("10.1/b"), work(None)])
    rows = df.select("doi", "doi_academicobservatory", "doi_in_academicobservatory_PRETTY").collect()
    assert plain(rows) == sorted(
        [("10.1/a", "10.1/a", "Yes"), ("10.1/a", "10.1/a", "Yes"), (None, None, "No")], key=repr
    )


def test_repeats_multiply(spark):
    day = datetime.date(2021, 1, 1)
    df = audited(
        spark,
        ["a"],
        [work("a"), work("A")],
        [("A", [("repository", day)], "mit")] * 3,
        [("a", True, True), ("a", True, True), ("A", False, None)],
    )
    # two works x three locations x two extract rows (each work meets both) x three checks
    assert df.count() == 2 * 3 * 2 * 3
    assert df.where("has_open_data_oddpub").count() == 24


def test_bibliographic_fields_and_types(spark):
    kinds = [
        "journal-article", "book-chapter", "posted-content", "book", "mongraphs", "proceedings-article", "monograph", None,
    ]
    rows = [
        work(str(n), year=2000 + n, type=kind, title=["A", None, "B"], container=[]) for n, kind in enumerate(kinds)
    ]
    found = {row.doi: row for row in audited(spark, [str(n) for n in range(len(kinds))], rows).collect()}
    assert [found[str(n)].crossref_type_PRETTY for n in range(len(kinds))] == [
        "Journal articles", "Book chapter", "Preprint", "Book", "Book", "Conference proceedings", None, None,
    ]
    assert found["3"].published_year_PRETTY == 2003
    assert found["0"].title_concat == "A B"
    assert found["0"].container_title_concat == ""


def test_open_access_labels(spark):
    cases = {
        "publisher": (
            open_access(open=True, publisher_only=True, both=True),
            ("Publisher Open Access", 0, "Open Access", 1, 0),
        ),
        "both": (open_access(open=True, both=True), ("Both", 1, "Open Access", 1, 0)),
        "other": (
            open_access(open=True, other_platform_only=True),
            ("Other Platform Open Access", 2, "Open Access", 1, 0),
        ),
        "closed": (open_access(open=False), ("Closed Access", 3, "Closed Access", 0, 1)),
        "unknown": (open_access(), ("Closed Access", 3, "Unknown", 0, 0)),
        "absent": (None, ("Closed Access", 3, "Unknown", 0, 0)),
    }
    df = audited(spark, list(cases), [work(doi, coki=coki) for doi, (coki, _) in cases.items()])
    names = ("oa_coki_PRETTY", "oa_coki_GRAPHORDER", "oa_coki_open_PRETTY", "oa_coki_OA_open", "oa_coki_OA_closed")
    assert {row.doi: tuple(row[name] for name in names) for row in df.collect()} == {
        doi: expected for doi, (_, expected) in cases.items()
    }


@pytest.mark.parametrize(
    ("months", "label", "rank"),
    [
        (-1, "Green Open Access prior to published date", 6),
        (0, "Immediately available", 1),
        (2, "Immediately available", 1),
        (3, "Open Access before six months", 2),
        (8, "Open Access before twelve months", 3),
        (14, "Open Access before two years", 4),
        (25, "Open Access before two years", 4),
        (26, "Open Access after two years", 5),
        (None, "Insufficient Data", 99),
    ],
)
def test_embargo_steps(spark, months, label, rank):
    df = spark.createDataFrame([(months,)], "embargo bigint")
    row = publications.embargo_label(df).first()
    assert (row.embargo_PRETTY, row.embargo_GRAPHORDER) == (label, rank)


def test_embargo_counts_month_boundaries(spark):
    day = datetime.date(2020, 3, 31)
    access = [("a", [("repository", day)], None), ("b", [("repository", day), ("repository", None)], None)]
    rows = [work("a", year=2020, month=4), work("b", year=2020, month=4), work("c", year=2020, month=13)]
    found = {row.doi: row for row in audited(spark, ["a", "b", "c"], rows, access).collect()}
    assert (found["a"].embargo, found["a"].embargo_GRAPHORDER) == (-1, 6)
    assert found["a"].cr_published_date == datetime.date(2020, 4, 1)
    assert found["b"].first_green_oa_date is None
    assert found["c"].cr_published_date is None


def test_month_zero_is_an_error(spark):
    with pytest.raises(PySparkException):
        audited(spark, ["a"], [work("a", month=0)]).collect()


def test_licenses(spark):
    codes = [code for code, _, _ in labels.LICENSES] + ["weird", None]
    df = spark.createDataFrame([(code,) for code in codes], "license string")
    rows = publications.license_label(df).collect()
    assert [row.license_GRAPHORDER for row in rows] == [*range(1, 17), 99, 99]
    assert rows[9].license_PRETTY == "ACS-specific: Author-choice/Editor's-choice Usage Agreement"
    assert rows[15].license_GROUP == "Software/open-source license"
    assert [row.license_GROUP for row in rows[-2:]] == ["No licence info"] * 2


def test_people_flags(spark):
    cases = {"null": None, "empty": [], "without": [(None,)], "with": [(None,), ("x",)]}
    rows = [work(doi, author=people, affiliations=(people, people)) for doi, people in cases.items()]
    found = {row.doi: row for row in audited(spark, list(cases), rows).collect()}
    for doi in cases:
        expected = doi == "with"
        row = found[doi]
        assert row.has_publisher_orcid is row.in_orcid_record is row.has_cr_funder_record is expected
    assert found["with"].in_orcid_record_PRETTY == "In an ORCID record"
    assert found["null"].has_cr_funder_record_PRETTY == "No funder acknowledgement"


def test_preprint_urls_and_checks(spark):
    rows = [
        work("a", coki=open_access(preprint=True), link=[("u1",), (None,), ("u2",)]),
        work("b", coki=open_access(preprint=False), link=[(None,)]),
        work("c", coki=open_access(), link=[]),
    ]
    odd = [("A", None, True), ("b", False, False)]
    found = {row.doi: row for row in audited(spark, ["a", "b", "c"], rows, odd_rows=odd).collect()}
    assert [found[doi].has_preprint for doi in "abc"] == [True, False, None]
    assert [found[doi].has_preprint_PRETTY == "Has a preprint" for doi in "abc"] == [True, False, False]
    assert [found[doi].crossref_fulltext_URL_CONCAT for doi in "abc"] == ["u1 u2", None, None]
    assert [found[doi].has_oddpub_processing for doi in "abc"] == [True, True, False]
    assert [found[doi].has_open_data_oddpub for doi in "abc"] == [False, False, False]
    assert [found[doi].has_open_code_oddpub for doi in "abc"] == [True, False, False]


def test_pubmed_abstract_follows_the_cutoff_and_the_rest_does_not(spark):
    rows = [
        work("old", year=2000, abstract="x", pubmed=("old", "old text", [])),
        work("new", year=2020, abstract="y", pubmed=("new", "new text", [])),
    ]
    found = {row.doi: row for row in audited(spark, ["old", "new"], rows, cutoff=2010).collect()}
    assert (found["old"].abstract_crossref, found["old"].abstract_pubmed) == ("x", None)
    assert (found["new"].abstract_crossref, found["new"].abstract_pubmed) == ("y", "new text")
    assert found["old"].published_year == 2000


def test_plan_s(spark):
    rows = [
        (False, "cc-by", True, 0, False),
        (True, "cc0", True, 0, False),
        (True, None, True, None, True),
        (None, None, False, 0, True),
        (None, None, None, 1, False),
        (True, "cc-by", False, None, False),
    ]
    df = spark.createDataFrame(
        [(place, (row[0], row[2]), row[1], row[3]) for place, row in enumerate(rows)],
        "place int, coki struct<open:boolean,publisher:boolean>, license string, embargo bigint",
    )
    found = publications.plan_s_compliance(df).orderBy("place").collect()
    assert [row.plans_compliant for row in found] == [expected for *_, expected in rows]
    assert [row.plans_compliant_PRETTY == "PlanS Compliant" for row in found] == [expected for *_, expected in rows]


def test_trial_flag_labels(spark):
    df = spark.createDataFrame(
        [(True, None), (False, True), (None, False)],
        "ANYSOURCE_clintrial_found boolean, PUBMED_opendata_fromfield_found boolean",
    )
    rows = publications.publication_trial_columns(df).collect()
    assert [row.ANYSOURCE_clintrial_found_PRETTY.startswith("No ") for row in rows] == [False, True, True]
    assert [row.PUBMED_opendata_fromfield_found_PRETTY.startswith("No ") for row in rows] == [True, False, True]


def naive(listed, own_works, access, found, odd):
    """The whole works table joined first and cut down afterwards."""
    enriched = publications.enriched_doi(own_works, access, found).withColumn("k", F.lower("work_doi")).drop("doi_key")
    start = listed.select("doi").distinct().withColumn("k", F.lower("doi"))
    checks = odd.select(F.lower("doi").alias("k"), "is_open_data", "is_open_code", F.lit(1).alias("n_oddpub"))
    joined = start.join(enriched, "k", "left").join(checks, "k", "left")
    return publications.add_labels(joined).withColumn("doi", F.lower("doi")).select(*COLUMNS)


def test_cutting_down_first_equals_joining_first(spark):
    sf_dir = "/root/testdata/sf0.001"
    from checks import sample_tables as tables

    own_works = tables.works(spark, sf_dir)
    inputs = (
        tables.dois(spark, sf_dir),
        own_works,
        tables.unpaywall(spark, sf_dir),
        alltrials(own_works, tables.CUTOFF, PROVENANCE),
        tables.oddpub(spark, sf_dir),
    )
    first = audit_publications(*inputs).select(*COLUMNS)
    second = naive(inputs[0], *inputs[1:])
    assert first.exceptAll(second).count() == 0
    assert second.exceptAll(first).count() == 0


def test_export_order(spark):
    df = spark.createDataFrame(
        [(None, "a"), (2020, "b"), (2021, "z"), (2020, None), (2020, "a")],
        "published_year int, doi_academicobservatory string",
    )
    assert [tuple(row) for row in publications.for_export(df).collect()] == [
        (2021, "z"), (2020, None), (2020, "a"), (2020, "b"), (None, "a"),
    ]
