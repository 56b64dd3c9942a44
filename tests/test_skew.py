"""A third of the rows shares one key, or none; results equal the plain way of writing them."""

from __future__ import annotations

import datetime

import pytest
from builders import dois, oddpub, plain, trial, trials_raw, unpaywall, work, works
from pyspark.sql import functions as F

from scholaudit.config import Provenance
from scholaudit.operators import publications, trial_ids, trial_links
from scholaudit.plans.alltrials import alltrials, alltrials_by_cutoff, shared_by_cutoff
from scholaudit.plans.pubs import COLUMNS, audit_publications
from scholaudit.sources.staging import stager

PROVENANCE = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")
HOT = 30


@pytest.fixture(scope="module", autouse=True)
def small_limits(spark):
    """Shuffled joins whose skewed partitions are split even at this size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="module")
def hot_works(spark):
    banks = [("ISRCTN", ["I1", "I2"]), ("GEO", ["G1"])]
    rows = [
        work("10.1/HOT", abstract="nct00000001", numbers=[("nct00000002", "t")], pubmed=("10.1/hot", "x", banks))
    ] * HOT
    rows += [work(None, numbers=[("nct00000003", "t")], pubmed=(None, "y", banks))] * HOT
    rows += [work(f"10.1/{n}", numbers=[], pubmed=(f"10.1/{n}", "z", banks[:1])) for n in range(HOT)]
    return works(spark, *rows).repartition(4).cache()


def exploded(works_df, names, bank_names):
    """Lists by explode, group and no counting."""
    flat = works_df.select(F.col("pubmed.doi").alias("d"), F.explode(trial_ids.PUBMED_BANKS).alias("b"))
    entry = F.struct(F.col("b.AccessionNumberList").alias("id"), F.col("b.DataBankName").alias("registry"))
    return (
        flat.where(F.col("b.DataBankName").rlike(bank_names))
        .groupBy("d")
        .agg(F.sort_array(F.collect_list(entry)).alias(names))
        .withColumn("k", F.lower("d"))
        .drop("d")
    )


def test_alltrials(spark, hot_works):
    found = alltrials(hot_works, 1, PROVENANCE).select("doi", "PUBMED_clintrial_fromfield", "PUBMED_opendata_fromfield")
    expected = (
        hot_works.select("doi", F.lower("doi").alias("k"))
        .join(exploded(hot_works, "registry", trial_ids.REGISTRIES), "k", "left")
        .join(exploded(hot_works, "databank", trial_ids.DATABANKS), "k", "left")
        .select("doi", "registry", "databank")
    )
    assert found.count() == 3 * HOT
    assert plain(found.collect()) == plain(expected.collect())


def test_pubs(spark, hot_works):
    day = datetime.date(2021, 1, 1)
    access = unpaywall(
        spark,
        *[("10.1/hot", [("repository", day)], "mit")] * HOT,
        *[(None, [], None)] * HOT,
        *[(f"10.1/{n}", None, "pd") for n in range(HOT)],
    )
    checks = oddpub(spark, *[("10.1/3", True, None)] * HOT, *[(None, True, True)] * HOT, ("10.1/4", False, True))
    listed = dois(spark, "10.1/Hot", "10.1/3", "10.1/4", "gone", None, *["10.1/5"] * HOT)
    # The extract holds one row of the hot DOI, so that repeats stay testable.
    found = alltrials(hot_works.dropDuplicates(["doi"]), 1, PROVENANCE)
    audited = audit_publications(listed, hot_works, access, found, checks).select(*COLUMNS)

    enriched = publications.work_facts(hot_works).join(
        access.select(
            F.lower("doi").alias("doi_key"),
            F.expr("if(size(oa_locations) > 0, oa_locations[0].oa_date, NULL)").alias("first_green_oa_date"),
            F.col("best_oa_location.license").alias("license"),
        ),
        "doi_key",
        "left",
    ).join(publications.extract_facts(found), "doi_key", "left")
    plain_join = (
        listed.distinct()
        .withColumn("doi_key", F.lower("doi"))
        .join(enriched, "doi_key", "left")
        .join(
            checks.select(F.lower("doi").alias("doi_key"), "is_open_data", "is_open_code", F.lit(1).alias("n_oddpub")),
            "doi_key",
            "left",
        )
    )
    expected = publications.add_labels(plain_join).withColumn("doi", F.lower("doi")).select(*COLUMNS)
    assert audited.count() == HOT * HOT + HOT + 1 + 1 + 1 + 1
    assert plain(audited.collect()) == plain(expected.collect())


def test_links(spark):
    raw = trials_raw(spark, *[trial("NCT1")] * HOT, *[trial(None)] * HOT, *[trial(f"NCT{n}") for n in range(2, HOT)])
    cleaned = trial_links.clean_trials(raw)
    pairs = spark.createDataFrame(
        [("a", "NCT1")] * HOT + [(None, "NCT1")] * HOT + [(f"d{n}", f"NCT{n % 7}") for n in range(HOT)],
        "ANYSOURCE_doi string, ANYSOURCE_clintrial_id_flat string",
    )
    listed = dois(spark, *["A"] * 3, *[None] * HOT, *[f"D{n}" for n in range(HOT)])
    found = trial_links.trials_in_publications(pairs, listed, cleaned)
    expected = (
        listed.join(pairs, F.lower("doi") == F.lower("ANYSOURCE_doi"))
        .join(cleaned, F.lower("ANYSOURCE_clintrial_id_flat") == F.lower("nct_id"))
        .groupBy("nct_id")
        .agg(F.array_join(F.sort_array(F.collect_list(F.lower("doi"))), " ").alias("PUBSDATA_doi"))
    )
    assert plain(found.collect()) == plain(expected.collect())
    attached = trial_links.attach_links(cleaned, found)
    assert attached.count() == raw.count()


def test_a_placeholder_doi_gathers_nothing(spark):
    """A third of the works carry the same PubMed DOI, which is no work's; others name another work."""
    rows = [work(f"10.1/{n}", pubmed=("n/a", None, [("ISRCTN", [f"I{n}"])])) for n in range(HOT)]
    rows += [work(f"10.2/{n}", pubmed=(f"10.2/{n}".upper(), None, [("ISRCTN", [f"J{n}"])])) for n in range(HOT)]
    rows += [work(f"10.3/{n}", pubmed=(f"10.1/{n % 5}", None, [("GEO", [f"G{n}"])])) for n in range(HOT)]
    rows += [work("10.2/1", numbers=[("N", "t")])]
    df = works(spark, *rows)
    shared = trial_ids.shared_evidence(trial_ids.narrow_works(df), stager("placeholder"))
    assert {row.doi_key for row in shared.collect()} == {"10.2/1"} | {f"10.1/{n}" for n in range(5)}
    assert "n/a" in {row.doi_key for row in trial_ids.trial_evidence(df).collect()}
    split, whole = alltrials(df, 1, PROVENANCE, shared), alltrials(df, 1, PROVENANCE)
    assert plain(split.collect()) == plain(whole.collect())


def test_own_entries_equal_grouped_ones(spark, hot_works):
    """Works take their own entries where no other work is concerned, and the result is the same."""
    extra = [
        work("10.9/a", numbers=[("n2", None), (None, "t"), ("n2", None)], pubmed=("10.9/A", "x", [("DRKS", None)])),
        work("10.9/B", numbers=[("n3", "t")], pubmed=("10.9/b", None, [("GEO", ["G"]), ("GEO", ["G"]), ("x", [])])),
        work("10.9/c", pubmed=("10.9/a", None, [("CTRI", ["C"])])),
        work("10.9/d", year=2000, pubmed=("10.9/d", None, [("CTRI", ["D"])])),
        work("10.9/D", year=2020, numbers=[("n4", None)]),
    ]
    df = hot_works.unionByName(works(spark, *extra))
    for cutoff in (1, 2010):
        recent = trial_ids.published_after(df, cutoff)
        shared = trial_ids.shared_evidence(trial_ids.narrow_works(recent), stager(f"own{cutoff}"))
        split, whole = alltrials(df, cutoff, PROVENANCE, shared), alltrials(df, cutoff, PROVENANCE)
        assert plain(split.collect()) == plain(whole.collect())
    shared = shared_by_cutoff(df, (1, 2010), stager("own"))
    split, whole = alltrials_by_cutoff(df, (1, 2010), shared), alltrials_by_cutoff(df, (1, 2010))
    assert plain(split.collect()) == plain(whole.collect())


def test_skewed_partitions_are_split(spark, hot_works):
    """A hot key of the works is divided among tasks in their join with staged evidence.

    Spark splits only joins that read both sides straight from a shuffle, so
    the grouped evidence is written first, as the publishing jobs do.
    """
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        many = hot_works.where("doi IS NULL").withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("_")
        skewed = many.unionByName(hot_works).repartition(40)
        shared = trial_ids.shared_evidence(trial_ids.narrow_works(skewed), stager("skewed"))
        df = alltrials(skewed, 1, PROVENANCE, shared)
        assert df.count() == HOT * 203
        df.collect()
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
