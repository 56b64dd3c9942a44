from __future__ import annotations

import re

import pytest
from builders import plain
from pyspark.sql import functions as F

from checks import sample_tables as tables
from scholaudit.config import Institution, Run
from scholaudit.plans import publish
from scholaudit.plans.publish import publish_all, publish_run
from scholaudit.sources.staging import staging_root
from scholaudit.sources.tables import (
    MissingTables,
    copy_table,
    create_database,
    create_only,
    create_or_replace,
    require_tables,
    write_bucketed_by_doi,
)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def institutions():
    """Database names without the sign that the sample institutions carry."""
    return [
        Institution("brand3", "dois_1", "oddpub_1", "trials_1", 2012),
        Institution("brand7", "dois_2", "oddpub_2", "trials_2", 2016),
    ]


@pytest.fixture(scope="module")
def run(spark, institutions):
    run = Run("20250310", "20240512", "v1", tuple(institutions))
    for database in ("observatory", "unpaywall"):
        create_database(spark, database)
    create_or_replace(tables.works(spark, SF_DIR), f"observatory.{run.works_table}")
    create_or_replace(tables.unpaywall(spark, SF_DIR), "unpaywall.unpaywall")
    sources = {
        "dois_table": tables.dois(spark, SF_DIR),
        "oddpub_table": tables.oddpub(spark, SF_DIR),
        "trials_table": tables.trials_raw(spark, SF_DIR),
    }
    for place, institution in enumerate(institutions):
        create_database(spark, institution.input_database)
        for field, df in sources.items():
            # Each institution holds about half of the sample lists.
            own = df.where(f"abs(hash(institution_id)) % 2 = {place}").drop("institution_id")
            create_or_replace(own, f"{institution.input_database}.{getattr(institution, field)}")
    return run


def table(spark, name):
    return plain(spark.table(name).collect())


def test_publish_run(spark, run, institutions):
    one = institutions[0]
    publish_run(spark, run, one)
    first = {kind: table(spark, f"{one.output_database}.{kind}20250310") for kind in ("alltrials", "trials", "pubs")}
    assert all(first.values())
    for kind in ("trials", "pubs"):
        assert table(spark, f"{one.latest_database}.{kind}") == first[kind]
    assert not spark.catalog.tableExists(f"{one.latest_database}.alltrials")
    years = [row[0] for row in table(spark, f"{one.latest_database}.utility_years")]
    known = [row.published_year for row in spark.table(f"{one.latest_database}.pubs").collect() if row.published_year]
    assert sorted(years) == list(range(min(known), max(known) + 1))
    audit = {row.table_name: row for row in spark.table(f"{one.latest_database}.table_audit").collect()}
    assert set(audit) == {"alltrials", "trials", "pubs", "unpaywall"}
    assert audit["pubs"].n_rows == len(first["pubs"])
    listed = {row.doi for row in spark.table(f"{one.latest_database}.pubs").collect()} - {None}
    assert audit["pubs"].n_distinct_notnull == len(listed)

    publish_run(spark, run, one)
    for kind, rows in first.items():
        assert table(spark, f"{one.output_database}.{kind}20250310") == rows


def test_all_institutions_at_once_equal_single_runs(spark, run, institutions):
    publish_all(spark, run, "together_data")
    for one in institutions:
        publish_run(spark, run, one)
        for kind in ("trials", "pubs"):
            single = spark.table(f"{one.output_database}.{kind}20250310")
            own = spark.table(f"together_data.{kind}20250310").where(f"institution_id = '{one.institution_id}'")
            assert plain(own.select(single.columns).collect()) == plain(single.collect())
            latest = spark.table(f"together_data_latest.{kind}").where(f"institution_id = '{one.institution_id}'")
            assert latest.count() == single.count()
        years = spark.table("together_data_latest.utility_years").where(f"institution_id = '{one.institution_id}'")
        assert plain(years.select("year").collect()) == table(spark, f"{one.latest_database}.utility_years")
        found = spark.table(f"{one.output_database}.alltrials20250310")
        names = [name for name in found.columns if name != "var_institution_id"]
        shared = spark.table("together_data.alltrials20250310").where(f"year_cutoff = {one.year_cutoff}")
        assert plain(shared.select(names).collect()) == plain(found.select(names).collect())


def test_other_institutions_keep_their_rows(spark, run, institutions):
    """A run replaces the rows of its institutions; one without inputs is left out and reported."""
    one, other = institutions
    publish_all(spark, run, "partly_data")
    before = {kind: spark.table(f"partly_data.{kind}20250310") for kind in ("trials", "pubs")}
    rows = {kind: plain(df.where(f"institution_id = '{other.institution_id}'").collect()) for kind, df in before.items()}
    absent = Institution("gone", "dois_x", "oddpub_x", "trials_x")
    later = Run(run.run_version, run.doi_version, "v2", (one, absent))
    with pytest.raises(publish.FailedInstitutions) as error:
        publish_all(spark, later, "partly_data")
    assert list(error.value.errors) == ["gone"]
    for kind, own in rows.items():
        for name in (f"partly_data.{kind}20250310", f"partly_data_latest.{kind}"):
            found = spark.table(name)
            assert plain(found.where(f"institution_id = '{other.institution_id}'").collect()) == own
            versions = found.groupBy("institution_id").agg(F.collect_set("var_SQL_workflow_version").alias("v")).collect()
            assert {row.institution_id: row.v for row in versions} == {one.institution_id: ["v2"], other.institution_id: ["v1"]}
    audit = {row.table_name: row.n_rows for row in spark.table("partly_data_latest.table_audit").collect()}
    for kind in ("alltrials", "trials", "pubs"):
        assert audit[kind] == spark.table(f"partly_data.{kind}20250310").count()


def test_rows_of_several_cutoffs_are_stored_once(spark, run, institutions):
    """More cutoffs make the table longer, but not its files."""
    sizes = {}
    for cutoffs in ((2012, 2016), (2011, 2012, 2013, 2014, 2015, 2016)):
        stored = search_rows(spark, run, cutoffs).where("kind IN ('table', 'edition')")
        texts = F.sum(F.coalesce(F.length("abstract_CROSSREF"), F.lit(0)))
        own = stored.where("kind = 'table'" if len(cutoffs) > 1 else "TRUE")
        sizes[len(cutoffs)] = own.where("published_year > 2012").agg(texts).first()[0], stored.agg(texts).first()[0]
        passed = sum(spark.table(f"observatory.{run.works_table}").where(f"crossref.published_year > {c}").count() for c in cutoffs)
        assert stored.count() < (0.8 if len(cutoffs) == 2 else 0.4) * passed
    # The rows that don't depend on the cutoff are the same; those of shared keys alone are repeated.
    assert sizes[6][0] == sizes[2][0]


def search_rows(spark, run, cutoffs):
    from scholaudit.plans.search import search_works, work_keys
    from scholaudit.sources.staging import stager

    works = spark.table(f"observatory.{run.works_table}")
    dois = spark.createDataFrame([], "doi string")
    return search_works(works, work_keys(works, dois, cutoffs, stager("cutoffs")), cutoffs)


def test_missing_inputs_are_listed_together(spark, run, institutions):
    absent = Institution("brand3", "dois_x", "oddpub_1", "trials_x")
    with pytest.raises(MissingTables) as error:
        publish_run(spark, run, absent)
    assert error.value.names == ("brand3_from_partners.trials_x", "brand3_from_partners.dois_x")


def test_sinks(spark, run):
    create_database(spark, "sinks")
    df = spark.range(3)
    create_only(df, "sinks.t")
    with pytest.raises(Exception, match="already exists"):
        create_only(df, "sinks.t")
    create_or_replace(spark.range(2), "sinks.t")
    assert spark.table("sinks.t").count() == 2
    copy_table(spark, "sinks.t", "sinks.copy")
    with pytest.raises(Exception, match="already exists"):
        copy_table(spark, "sinks.t", "sinks.copy")
    copy_table(spark, "sinks.t", "sinks.copy", overwrite=True)
    with pytest.raises(MissingTables):
        copy_table(spark, "sinks.none", "sinks.copy")
    require_tables(spark, ["sinks.t"])


def test_staging_uses_the_named_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_bucketed_works_are_joined_without_moving_them(spark, run):
    from scholaudit.config import Provenance
    from scholaudit.plans.alltrials import alltrials

    write_bucketed_by_doi(spark.table(f"observatory.{run.works_table}"), "observatory.works_bucketed", 4)
    works = spark.table("observatory.works_bucketed")
    provenance = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = alltrials(works, 1, provenance)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        left = plan.split("SortMergeJoin")[1].split("ObjectHashAggregate")[0]
        assert "Exchange" not in left.split("Sort [")[1]
        same = alltrials(spark.table(f"observatory.{run.works_table}"), 1, provenance)
        assert joined.exceptAll(same).count() == 0
        assert joined.agg(F.count("*")).first()[0] == same.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_works_meet_a_long_list_without_moving(spark, run):
    from scholaudit.config import Provenance
    from scholaudit.plans.alltrials import alltrials
    from scholaudit.plans.pubs import pubs

    provenance = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")
    write_bucketed_by_doi(spark.table(f"observatory.{run.works_table}"), "observatory.works_bucketed", 4)
    inputs = (tables.unpaywall(spark, SF_DIR), tables.oddpub(spark, SF_DIR))

    def audited(works):
        found = alltrials(works, 2012, provenance)
        return pubs(tables.dois(spark, SF_DIR), works, inputs[0], found, inputs[1], provenance)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = audited(spark.table("observatory.works_bucketed"))
        lines = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        scans = [place for place, line in enumerate(lines) if "works_bucketed" in line and "abstract" in line]
        assert scans
        for scan in scans:
            depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
            above = next(
                line for line in reversed(lines[:scan])
                if len(line) - len(line.lstrip(" :+-")) < depth and not re.search("Project|Filter|ColumnarToRow", line)
            )
            assert "Exchange" not in above
        assert joined.exceptAll(audited(spark.table(f"observatory.{run.works_table}"))).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_institutions_fail_alone(monkeypatch):
    ran = []

    def one(spark, run, institution):
        ran.append(institution)
        if institution != "c":
            raise ValueError(f"no {institution}")

    monkeypatch.setattr(publish, "publish_run", one)
    names = {letter: letter for letter in "abc"}

    class Named(str):
        institution_id = property(lambda self: str(self))

    run = type("Run", (), {"institutions": [Named(letter) for letter in names]})
    with pytest.raises(publish.FailedInstitutions) as error:
        publish.publish_each(None, run)
    assert ran == ["a", "b", "c"] and sorted(error.value.errors) == ["a", "b"]
