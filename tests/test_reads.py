"""What the publishing jobs read of works, and what they move."""

from __future__ import annotations

import re

import pytest
from builders import plain

from checks import sample_tables as tables
from scholaudit.config import Institution, Run
from scholaudit.plans import publish
from scholaudit.sources import staging, versions
from scholaudit.sources import tables as sources

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def institutions():
    return [Institution("read1", "dois", "oddpub", "trials", 2012), Institution("read2", "dois", "oddpub", "trials", 2016)]


@pytest.fixture(scope="module")
def run(spark, institutions):
    run = Run("20250311", "20240513", "v1", tuple(institutions))
    for database in ("observatory", "unpaywall"):
        sources.create_database(spark, database)
    sources.create_or_replace(tables.works(spark, SF_DIR), f"observatory.{run.works_table}")
    sources.create_or_replace(tables.unpaywall(spark, SF_DIR), "unpaywall.unpaywall")
    lists = {"dois": tables.dois(spark, SF_DIR), "oddpub": tables.oddpub(spark, SF_DIR), "trials": tables.trials_raw(spark, SF_DIR)}
    for institution in institutions:
        sources.create_database(spark, institution.input_database)
        for name, df in lists.items():
            sources.create_or_replace(df.drop("institution_id"), f"{institution.input_database}.{name}")
    return run


@pytest.fixture
def written(monkeypatch):
    """The plan of everything that the jobs write, staged tables included."""
    plans = []

    def recorded(function):
        def call(df, *arguments, **named):
            plans.append(df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"))
            return function(df, *arguments, **named)

        return call

    monkeypatch.setattr(staging, "stage", recorded(staging.stage))
    monkeypatch.setattr(publish, "write_together", recorded(versions.write_together))
    monkeypatch.setattr(publish, "replace_partitions", recorded(versions.replace_partitions))
    monkeypatch.setattr(sources, "write_version", recorded(versions.write_version))
    return plans


def scans_of_works(plans):
    """What is read by each scan of the works; a reused exchange has none of its own."""
    found = []
    for plan in plans:
        for node in re.split(r"\n\n(?=\(\d+\) )", plan):
            if re.match(r"\(\d+\) Scan", node) and "/observatory.db/" in node:
                found.append(re.search(r"ReadSchema: (.*)", node).group(1))
    return found


@pytest.mark.parametrize("all_at_once", [False, True])
def test_works_are_read_twice_and_their_texts_once(spark, run, institutions, written, all_at_once):
    if all_at_once:
        publish.publish_all(spark, run, "read_together")
    else:
        publish.publish_run(spark, run, institutions[0])
    scans = scans_of_works(written)
    assert len(scans) == 2
    assert sum("AbstractText" in scan or "abstract:" in scan for scan in scans) == 1
    narrow = next(scan for scan in scans if "AbstractText" not in scan)
    assert not any(field in narrow for field in ("title", "author", "link", "affiliations", "coki"))


def test_stored_works_are_not_moved(spark, run, institutions, written):
    """Without broadcasts the wide pass joins works where their buckets are."""
    one = institutions[0]
    names = [f"{one.output_database}.{kind}{run.run_version}" for kind in ("alltrials", "trials", "pubs")]
    publish.publish_run(spark, run, one)
    before = [plain(spark.table(name).collect()) for name in names]
    assert sources.store_works_by_doi(spark, run, 4) == spark.table(f"observatory.{run.works_table}").count()
    written.clear()
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    kept = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        publish.publish_run(spark, run, one)
        plan = next(plan for plan in written if "AbstractText" in plan and "/observatory.db/" in plan and "Scan parquet" in plan)
        tree = plan.split("\n\n")[0].splitlines()
        scan = next(place for place, line in enumerate(tree) if "observatory" in line and "Scan" in line)
        depth = len(tree[scan]) - len(tree[scan].lstrip(" :+-"))
        above = []
        for line in reversed(tree[:scan]):
            own = len(line) - len(line.lstrip(" :+-"))
            if own < depth:
                above.append(line)
                depth = own
            if above and "Join" in above[-1]:
                break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above)
        assert [plain(spark.table(name).collect()) for name in names] == before
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        for name in (f"observatory.{run.works_table}_by_doi",):
            spark.sql(f"DROP VIEW IF EXISTS {name}")
