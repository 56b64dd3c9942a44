"""Physical plans: what is read, what is shuffled, and what must not occur."""

from __future__ import annotations

import re

import pytest

from checks import sample_tables as tables
from checks.queries import PROVENANCE, QUERIES
from scholaudit.operators.trial_ids import narrow_works, published_after, shared_evidence, shared_keys, trial_evidence
from scholaudit.plans.alltrials import alltrials
from scholaudit.plans.pubs import pubs
from scholaudit.sources.staging import stager

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scans(df) -> list[str]:
    """What each scan of a table of works reads."""
    return [line for line in formatted(df).splitlines() if line.startswith("ReadSchema")]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The sample tables as Parquet files with their nested columns."""
    root = str(tmp_path_factory.mktemp("stored"))
    found = {}
    for name in ("works", "unpaywall", "dois", "oddpub"):
        getattr(tables, name)(spark, SF_DIR).write.parquet(f"{root}/{name}")
        found[name] = spark.read.parquet(f"{root}/{name}")
    alltrials(found["works"], tables.CUTOFF, PROVENANCE).write.parquet(f"{root}/alltrials")
    found["alltrials"] = spark.read.parquet(f"{root}/alltrials")
    return found


@pytest.fixture(scope="module")
def audited(stored):
    return pubs(
        stored["dois"], stored["works"], stored["unpaywall"], stored["alltrials"], stored["oddpub"], PROVENANCE
    )


def test_evidence_reads_no_texts(stored):
    evidence = trial_evidence(published_after(stored["works"], tables.CUTOFF))
    (scan,) = scans(evidence)
    assert "AbstractText" not in scan
    assert "abstract" not in scan
    assert "title" not in scan
    assert "GreaterThan(crossref.published_year,2012)" in formatted(evidence)


def test_alltrials_reads_only_its_fields(stored):
    df = alltrials(stored["works"], tables.CUTOFF, PROVENANCE)
    assert len(scans(df)) == 2
    for scan in scans(df):
        for field in ("title", "author", "link", "affiliations", "coki"):
            assert field not in scan
    assert formatted(df).count("GreaterThan(crossref.published_year,2012)") == 2


def test_publications_read_only_their_fields(audited):
    for scan in scans(audited):
        assert "clinical_trial_number" not in scan
        assert "DataBankList" not in scan


def test_small_lists_leave_the_big_tables_in_place(audited):
    """Every shuffle is of grouped rows or of the result; works are joined where they are read."""
    plan = plan_of(audited)
    assert "SortMergeJoin" not in plan
    lines = plan.splitlines()
    for place, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[place + 1]


def test_shared_evidence_under_the_threshold_is_broadcast(stored):
    """With staged evidence the wide works are read once and never shuffled."""
    recent = published_after(stored["works"], tables.CUTOFF)
    shared = shared_evidence(narrow_works(recent), stager("plans"))
    df = alltrials(stored["works"], tables.CUTOFF, PROVENANCE, shared)
    plan = plan_of(df)
    assert "Exchange hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan
    assert sum("AbstractText" in scan for scan in scans(df)) == 1
    keys = shared_keys(narrow_works(recent))
    assert not any("abstract" in scan or "AbstractText" in scan for scan in scans(keys))
    # The repeated DOIs of the sample, and none of its other works.
    assert 0 < keys.count() < recent.count() / 20


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search("Cartesian|NestedLoop|Python|ArrowEval|MapInPandas|Window", plan)
