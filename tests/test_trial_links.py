from __future__ import annotations

import datetime

import pytest
from builders import dois, plain, trial, trials_raw
from pyspark.errors import PySparkException

from scholaudit.config import Provenance
from scholaudit.operators import trial_links
from scholaudit.plans.trials import link_trials, trials

PROVENANCE = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")


def test_na_id_is_found_but_null(spark):
    rows = trial_links.clean_trials(trials_raw(spark, trial("NA"), trial(None), trial("nct1"))).collect()
    assert [(row.nct_id, row.nct_id_found, row.nct_id_found_PRETTY) for row in rows] == [
        (None, True, "Has Trial-ID"),
        (None, False, "No Trial-ID"),
        ("NCT1", True, "Has Trial-ID"),
    ]


def test_dates(spark):
    row = trial_links.clean_trials(
        trials_raw(
            spark,
            trial(
                "x",
                registry_query_date="2020-01-02",
                registration_date="NA",
                start_date="2020-03-04 23:59:59",
                completion_date="2021-05-06",
            ),
        )
    ).first()
    assert row.registry_query_date == datetime.date(2020, 1, 2)
    assert row.registration_date is None
    assert row.start_date == datetime.date(2020, 3, 4)
    assert row.completion_date == datetime.date(2021, 5, 6)
    with pytest.raises(PySparkException):
        trial_links.clean_trials(trials_raw(spark, trial("x", start_date="soon"))).collect()


def test_unknown_flags_take_the_second_label(spark):
    raw = trials_raw(
        spark,
        *[trial("x", is_prospective=value, has_linked_reference=value) for value in ("TRUE", "false", "NA", None)],
    )
    rows = trial_links.clean_trials(raw).collect()
    assert [row.is_prospective for row in rows] == [True, False, None, None]
    before, after = "Registered before enrollment started", "Registered after enrollment started"
    assert [row.is_prospective_PRETTY for row in rows] == [before, after, after, after]
    linked, unlinked = "Trial has a linked reference", "Trial does not have a linked reference"
    assert [row.has_linked_reference_PRETTY for row in rows] == [linked, unlinked, unlinked, unlinked]


def test_reporting_labels_match_the_raw_code(spark):
    known = ["results_timely", "results_due_late", "results_due_missing", "results_not_due"]
    codes = [*known, "Results_Timely", "NA", None]
    rows = trial_links.results_reporting_label(
        trials_raw(spark, *[trial("x", summary_results_reporting=code) for code in codes])
    ).collect()
    assert [row.summary_results_reporting_GRAPHORDER for row in rows] == [1, 2, 3, 4, 99, 99, 99]
    assert [row.summary_results_reporting for row in rows] == [*codes[:4], "results_timely", None, None]
    assert rows[0].summary_results_reporting_PRETTY == "Trial reported summary results on time"
    assert rows[4].summary_results_reporting_PRETTY == ""


def test_results_within_a_year(spark):
    raw = trials_raw(spark, *[trial("x", is_summary_results_1y_cd=value) for value in ("TRUE", "FALSE", "NA", None)])
    labels = [row.is_summary_results_1y_cd_PRETTY for row in trial_links.results_within_1y_label(raw).collect()]
    assert labels == [
        "Summary results reported within 1 year of trial completion",
        "Summary results not reported within 1 year of trial completion",
        "No information about reporting of summary results",
        "No information about reporting of summary results",
    ]


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "ANYSOURCE_doi string, ANYSOURCE_clintrial_id_flat string")


def test_links_keep_repeats(spark):
    cleaned = trial_links.clean_trials(
        trials_raw(spark, trial("nct1"), trial("NCT1"), trial("NCT2"), trial(None), trial("NA"), trial("NCT9"))
    )
    found = trial_links.trials_in_publications(
        pairs(
            spark,
            *[("a", "NCT1"), ("a", "NCT1"), ("b", "NCT1"), ("b", "NCT2")],
            *[("c", "NCT2"), (None, "NCT2"), ("a", "")],
        ),
        dois(spark, "A", "a", "B", "zz", None, " c"),
        cleaned,
    )
    # (two listings of a) x (two pairs) x (two rows of the trial) = 8; b: 1 x 1 x 2 = 2.
    assert plain(found.collect()) == [("NCT1", " ".join(["a"] * 8 + ["b"] * 2)), ("NCT2", "b")]


def test_doi_is_trimmed_in_the_list_but_not_in_the_key(spark):
    found = trial_links.trials_in_publications(
        pairs(spark, (" c", "NCT2"), ("c", "NCT2")),
        dois(spark, " C"),
        trial_links.clean_trials(trials_raw(spark, trial("NCT2"))),
    )
    assert plain(found.collect()) == [("NCT2", "c")]


def alltrials_rows(spark, *rows):
    return spark.createDataFrame(
        list(rows), "doi string, ANYSOURCE_clintrial_found boolean, ANYSOURCE_clintrial_idlist string"
    )


def test_trials_table(spark):
    raw = trials_raw(spark, trial("nct1"), trial("NCT1"), trial("NCT5"), trial(None), trial("NA"))
    found = trials(
        raw, alltrials_rows(spark, ("10.1/A", True, "NCT1 I1"), ("10.1/b", True, "")), dois(spark, "10.1/a"), PROVENANCE
    )
    assert found.columns[-7:] == [
        "PUBSDATA_doi", "PUBSDATA_doi_found", "PUBSDATA_doi_found_PRETTY", "var_SQL_workflow_version",
        "var_data_trials", "var_data_dois", "var_institution_id",
    ]
    assert plain(found.select("nct_id", "PUBSDATA_doi", "PUBSDATA_doi_found").collect()) == sorted(
        [
            ("NCT1", "10.1/a 10.1/a", True),
            ("NCT1", "10.1/a 10.1/a", True),
            ("NCT5", None, False),
            (None, None, False),
            (None, None, False),
        ],
        key=repr,
    )
    assert found.count() == raw.count()


def test_any_source_links(spark):
    cleaned = trial_links.clean_trials(trials_raw(spark, trial("nct1"), trial("NCT2"), trial(None)))
    found = trial_links.any_source_links(
        cleaned, pairs(spark, ("b", "NCT1"), ("a", "NCT1"), (None, "NCT2"), ("a", "NCT3")), owner="the Institute"
    )
    rows = found.select(
        "nct_id", "ANYSOURCE_dois_matching_trialid", "ANYSOURCE_doi_found", "ANYSOURCE_doi_found_PRETTY"
    )
    tail = "Trial-IDs from the Institute's trial dataset found in a Crossref or Pubmed publication"
    assert plain(rows.collect()) == sorted(
        [("NCT1", "a b", True, tail), ("NCT2", None, False, f"No {tail}"), (None, None, False, f"No {tail}")], key=repr
    )


def test_trials_matching_publication(spark):
    pubs = spark.createDataFrame([("a", "a"), ("b", "b"), ("c", None)], "doi string, doi_academicobservatory string")
    linked = spark.createDataFrame(
        [("NCT1", "a b", True), ("NCT1", "a b", True), ("NCT2", "A", True), ("NCT3", None, False)],
        "nct_id string, PUBSDATA_doi string, PUBSDATA_doi_found boolean",
    )
    found = trial_links.trials_matching_publication(pubs, linked)
    rows = found.select("doi", "TRIALSDATA_matching_doi_CONCAT", "TRIALDATA_trialids_found_in_pubs")
    # Listed DOIs group as spelled, so the two spellings of "a" repeat the publication.
    assert plain(rows.collect()) == [
        ("a", "NCT1 NCT1", True),
        ("a", "NCT2", True),
        ("b", "NCT1 NCT1", True),
        ("c", None, False),
    ]


def test_institutions_together_equal_single_runs(spark):
    found = alltrials_rows(spark, ("x", True, "NCT1 NCT2"), ("y", True, "NCT1"))
    both_dois = spark.createDataFrame(
        [("i", "X"), ("i", "y"), ("j", "y"), ("j", "y")], "institution_id string, doi string"
    )
    both_raw = {"i": [trial("nct1"), trial("NCT2")], "j": [trial("NCT1"), trial("NCT1"), trial(None)]}
    ddl = "institution_id string, " + trials_raw(spark, trial("x")).schema.simpleString()[7:-1]
    everything = spark.createDataFrame([(name, *row) for name, rows in both_raw.items() for row in rows], ddl)
    together = link_trials(everything, found, both_dois, ("institution_id",))
    for name, rows in both_raw.items():
        own_dois = both_dois.where(f"institution_id = '{name}'").select("doi")
        single = link_trials(trials_raw(spark, *rows), found, own_dois)
        own = together.where(f"institution_id = '{name}'").select(single.columns)
        assert plain(own.collect()) == plain(single.collect())
