from __future__ import annotations

import pytest

from scholaudit.config import ConfigError, Institution, Run

ONE = {
    "institution_id": "one",
    "dois_table_name": "dois_20230217",
    "oddpub_table_name": "oddpub_20230217",
    "trials_aact_table_name": "trials_aact_20250221",
}


def test_run():
    context = {"run_version": 20250310, "doi_version": "20240512"}
    two = {**ONE, "institution_id": "two", "year_cutoff": 2020}
    run = Run.from_mapping({"context": context, "partners": [ONE, two]}, "v1")
    assert run.works_table == "doi20240512"
    assert run.output_table("pubs") == "pubs20250310"
    assert [one.year_cutoff for one in run.institutions] == [1, 2020]
    one = run.institutions[0]
    assert one.input_database == "one_from_partners"
    assert (one.output_database, one.latest_database) == ("one_data", "one_data_latest")


def test_all_problems_are_reported_together():
    with pytest.raises(ConfigError) as error:
        Run.from_mapping({"context": {"run_version": "2025-03"}, "partners": [{"institution_id": "x"}]}, "v1")
    text = str(error.value)
    versions = ("run_version is not", "doi_version is missing")
    for part in (*versions, "dois_table_name", "oddpub_table_name", "trials_aact_table_name"):
        assert part in text
    with pytest.raises(ConfigError, match="no institutions"):
        Run.from_mapping({"context": {"run_version": 20250310, "doi_version": 20240512}}, "v1")


def test_institution_needs_its_tables():
    with pytest.raises(ConfigError, match="institution_id"):
        Institution.from_mapping({**ONE, "institution_id": ""})


@pytest.mark.parametrize("cutoff", [None, "soon"])
def test_bad_cutoff_is_a_config_error(cutoff):
    with pytest.raises(ConfigError, match="year_cutoff"):
        Institution.from_mapping({**ONE, "year_cutoff": cutoff})
