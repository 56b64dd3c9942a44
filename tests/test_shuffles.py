"""What the joins of publications move, in bytes of their exchanges."""

from __future__ import annotations

import pytest
from builders import dois, oddpub, plain, unpaywall, work, works
from pyspark.sql import functions as F

from scholaudit.plans.alltrials import alltrials_by_cutoff, shared_by_cutoff
from scholaudit.plans.many import all_publications_audited
from scholaudit.sources.staging import lazily

CUTOFFS = {"one": 1, "two": 2010}
TEXT, WORKS = 5_000, 40


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def moved(plan) -> int:
    """Bytes of all exchanges of a plan that has run; a reused one counts once."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return moved(plan.executedPlan())
    if name.endswith("QueryStage"):
        return moved(plan.plan())
    if name == "ReusedExchange":
        return 0
    own = plan.metrics().apply("dataSize").value() if name == "Exchange" else 0
    return own + sum(moved(plan.children().apply(place)) for place in range(plan.children().size()))


def audited(spark, copies):
    text = "x" * TEXT
    rows = [work(f"10.1/{n}", year=2015, abstract=f"{n}{text}", pubmed=(f"10.1/{n}", f"p{n}{text}", [])) for n in range(WORKS)]
    many = works(spark, *rows)
    listed = dois(spark, *[f"10.1/{n}" for n in range(WORKS)], "gone", None)
    lists = listed.withColumn("institution_id", F.explode(F.array(*map(F.lit, CUTOFFS))))
    access = unpaywall(spark, *[("10.1/3", [], "mit")] * copies, ("10.1/4", [], "pd"), ("gone", [], "mit"))
    checks = oddpub(spark, *[("10.1/4", True, None)] * copies, *[("gone", None, True)] * 2).withColumn("institution_id", F.lit("one"))
    found = alltrials_by_cutoff(many, CUTOFFS.values(), shared_by_cutoff(many, CUTOFFS.values(), lazily))
    return all_publications_audited(lists, many, access, found, checks, CUTOFFS)


@pytest.mark.parametrize("copies", [1, 250])
def test_texts_of_publications_are_shuffled_once(spark, copies):
    df = audited(spark, copies)
    rows = df.collect()
    # Both abstracts to the listed rows, the extract by cutoff, and with many copies again.
    texts = 2 * WORKS * TEXT
    assert 2 * texts < moved(df._jdf.queryExecution().executedPlan()) < 4 * texts
    # Counted by hand: two lists, copies of two DOIs, twice the check of the DOI without a work.
    assert len(rows) == 2 * (WORKS + 2) + 3 * (copies - 1) + 1
    gone = [(row.institution_id, row.license, row.has_oddpub_processing) for row in rows if row.doi == "gone"]
    assert plain(gone) == [("one", None, True), ("one", None, True), ("two", None, False)]
    assert sum(row.license == "mit" for row in rows) == 2 * copies
    assert sum(row.has_open_data_oddpub for row in rows) == copies
    assert all(len(row.abstract_pubmed) > TEXT and len(row.abstract_crossref) > TEXT for row in rows if row.doi_academicobservatory)
