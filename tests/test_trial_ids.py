from __future__ import annotations

from builders import plain, work, works
from pyspark.sql import functions as F

from scholaudit.config import Provenance
from scholaudit.operators import trial_ids
from scholaudit.operators.trial_ids import entry_pages, registry_entries
from scholaudit.plans.alltrials import COLUMNS, alltrials, alltrials_by_cutoff

PROVENANCE = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")


def combine(df):
    return alltrials(df, 1, PROVENANCE)


ID1, ID2, ID3 = "NCT00000001", "NCT00000002", "NCT00000003"


def ids_of(spark, texts):
    df = spark.createDataFrame([(place, text) for place, text in enumerate(texts)], "place int, text string")
    found = trial_ids.trial_ids_in_text(df, {"found_ids": "text"}).orderBy("place").collect()
    return [
        (row.found_ids_found, None if row.found_ids is None else [one.id for one in row.found_ids]) for row in found
    ]


def test_ids_in_text(spark):
    texts = [
        None, "", "{}", "no id", "NCT0000001", "nct00000001", "xNcT000000019", f"{ID2} {ID1} nct00000002",
        "ŉct00000001", "NCT 00000001",
    ]
    assert ids_of(spark, texts) == [
        (False, None), (False, None), (False, None), (False, None), (False, None),
        (True, [ID1]), (True, [ID1]), (True, [ID2, ID1]), (True, [ID1]), (False, None),
    ]


def test_ids_in_text_equal_those_of_the_upper_cased_text(spark):
    texts = ["ªnct12345678", "ıNCT12345678nCt87654321", "ß nct00000000 ﬆ", "ncẗ00000000", "NCTNCT11111111"]
    expected = spark.createDataFrame([(text,) for text in texts], "t string").selectExpr(
        f"array_distinct(regexp_extract_all(upper(t), '{trial_ids.TRIAL_ID}', 0)) AS ids"
    )
    assert [ids or [] for _, ids in ids_of(spark, texts)] == [row.ids for row in expected.collect()]


def test_cutoff_is_strict_and_drops_unknown_years(spark):
    df = works(spark, work("a", year=2012), work("b", year=2013), work("c", year=None))
    assert [row.doi for row in trial_ids.published_after(df, 2012).collect()] == ["b"]


def test_field_entries_join_without_regard_to_case(spark):
    df = works(
        spark,
        work("10.1/A", numbers=[(" nct1", "results"), (None, None)]),
        work("10.1/a", numbers=[]),
        work("10.1/b", numbers=None),
        work(None, numbers=[("x", None)]),
    )
    rows = plain(trial_ids.trial_ids_in_field(df).collect())
    upper = [(None, None), (" NCT1", "results")]
    found = {row[0]: (row[1], row[2] and [tuple(one) for one in row[2]]) for row in rows}
    assert found == {"10.1/A": (True, upper), "10.1/a": (False, upper), "10.1/b": (False, None), None: (True, None)}


def test_bank_entries_are_split_by_name_and_grouped_by_spelling(spark):
    df = works(
        spark,
        work("a", pubmed=("A", None, [("ISRCTN", ["I1"]), ("GEO", ["G1"]), ("Other", ["O1"])])),
        work("b", pubmed=("A", None, [("DRKS", None)])),
        work("c", pubmed=("a", None, [("UMIN CTR", ["U1"])])),
        work("d", pubmed=(None, None, [("CTRI", ["C1"])])),
        work("e", pubmed=("E", None, [])),
        work("f"),
        work("g", pubmed=("G", None, [("ClinicalTrials-gov", ["x"]), (None, ["y"])])),
    )
    registry = {row.doi: [tuple(one) for one in row[1]] for row in trial_ids.registry_entries(df, 1).collect()}
    assert registry == {"A": [(None, "DRKS"), (["I1"], "ISRCTN")], "a": [(["U1"], "UMIN CTR")]}
    databank = {row.doi: [tuple(one) for one in row[1]] for row in trial_ids.databank_entries(df, 1).collect()}
    assert databank == {"A": [(["G1"], "GEO")]}


def test_works_repeat_for_every_spelling_of_each_list(spark):
    df = works(
        spark,
        work("10.1/x", numbers=[("n1", None)], pubmed=("10.1/X", None, [("ISRCTN", ["I1"]), ("GEO", ["G1"])])),
        work("10.1/X", numbers=[("n2", None)], pubmed=("10.1/x", None, [("ISRCTN", ["I2"])])),
    )
    rows = combine(df).select(
        "doi",
        "PUBMED_clintrial_fromfield_idlist",
        "PUBMED_opendata_fromfield_idlist",
        "CROSSREF_clintrial_fromfield_idlist",
    )
    assert plain(rows.collect()) == sorted(
        (doi, registry, "G1", field)
        for doi in ("10.1/x", "10.1/X")
        for registry in ("I1", "I2")
        for field in ("N1", "N2")
    )


def lists_of(spark, *rows):
    return {row.doi: row for row in combine(works(spark, *rows)).collect()}


def test_id_lists(spark):
    rows = lists_of(
        spark,
        work("none"),
        work("nulls", numbers=[(None, "t")], pubmed=("nulls", None, [("ISRCTN", None), ("GEO", None)])),
        work("empty", numbers=[], pubmed=("empty", "", [])),
        work(
            "full",
            abstract=f"{ID1} nct00000002",
            numbers=[("\tnct00000003 ", None)],
            pubmed=("FULL", f"see {ID1}", [("ISRCTN", [" I1\n", None, "I2"]), ("SRA", ["S1", " S2 "])]),
        ),
    )
    none = rows["none"]
    assert none.CROSSREF_clintrial_fromabstract_idlist == ""
    assert none.CROSSREF_clintrial_fromfield_idlist == ""
    assert none.PUBMED_clintrial_fromabstract_idlist == ""
    assert none.PUBMED_clintrial_fromfield_idlist == ""
    assert none.PUBMED_opendata_fromfield_idlist is None
    assert none.ANYSOURCE_clintrial_found is False
    assert none.ANYSOURCE_clintrial_idlist == ""

    nulls = rows["nulls"]
    assert nulls.CROSSREF_clintrial_fromfield_idlist is None
    assert nulls.PUBMED_clintrial_fromfield_idlist is None
    assert nulls.PUBMED_opendata_fromfield_idlist is None
    assert nulls.PUBMED_opendata_fromfield_found is True
    assert nulls.ANYSOURCE_clintrial_found is True
    # A NULL part makes the combined text NULL, and de-duplicating NULL gives ''.
    assert nulls.ANYSOURCE_clintrial_idlist == ""

    empty = rows["empty"]
    assert empty.CROSSREF_clintrial_fromfield is None
    assert empty.CROSSREF_clintrial_fromfield_idlist == ""
    assert empty.CROSSREF_clintrial_fromfield_found is False

    full = rows["full"]
    assert full.CROSSREF_clintrial_fromabstract_idlist == f"{ID1} {ID2}"
    assert full.CROSSREF_clintrial_fromfield_idlist == ID3
    assert full.PUBMED_clintrial_fromabstract_idlist == ID1
    assert full.PUBMED_clintrial_fromfield_idlist == "I1 I2"
    assert full.PUBMED_opendata_fromfield_idlist == "S1 S2"
    assert full.ANYSOURCE_clintrial_idlist == f"{ID1} {ID2} {ID3} I1 I2"


def test_two_empty_sources_leave_an_empty_part(spark):
    rows = lists_of(
        spark,
        work("gap", abstract=ID1, pubmed=("gap", None, [("ISRCTN", ["I1"])])),
        work("one", abstract=ID1, pubmed=("one", ID2, [])),
    )
    assert rows["gap"].ANYSOURCE_clintrial_idlist == f"{ID1}  I1"
    assert rows["one"].ANYSOURCE_clintrial_idlist == f"{ID1} {ID2}"


def test_pairs(spark):
    df = spark.createDataFrame(
        [("10.1/A", True, "nct1  I1"), ("10.1/b", True, ""), ("10.1/c", False, "x"), (None, True, "y")],
        "doi string, ANYSOURCE_clintrial_found boolean, ANYSOURCE_clintrial_idlist string",
    )
    assert plain(trial_ids.flatten_trial_pairs(df).collect()) == sorted(
        [("10.1/a", "NCT1"), ("10.1/a", ""), ("10.1/a", "I1"), ("10.1/b", ""), (None, "Y")], key=repr
    )


def test_output_columns_and_provenance(spark):
    df = alltrials(works(spark, work("a"), work("b", year=2000)), 2010, PROVENANCE)
    tail = ["var_AcademicObservatory_doi", "var_SQL_year_cutoff", "var_SQL_workflow_version", "var_institution_id"]
    assert df.columns == [*COLUMNS, *tail]
    assert [(row.doi, *[row[name] for name in tail]) for row in df.collect()] == [("a", "doi1", 2010, "v1", "inst")]


def test_one_pass_over_cutoffs_equals_single_runs(spark):
    """A list grouped from years on both sides of a cutoff depends on it."""
    df = works(
        spark,
        work("a", year=2005, pubmed=("A", None, [("ISRCTN", ["I1"])])),
        work("b", year=2015, pubmed=("A", None, [("ISRCTN", ["I2"])])),
        work("a", year=2016, numbers=[("n", None)]),
    )
    together = alltrials_by_cutoff(df, [2000, 2010, 2000])
    for cutoff in (2000, 2010):
        single = alltrials(df, cutoff, PROVENANCE).select(*COLUMNS)
        own = together.where(f"year_cutoff = {cutoff}").drop("year_cutoff")
        assert plain(own.collect()) == plain(single.collect())
    assert together.where("year_cutoff = 2010 and doi = 'a'").first().PUBMED_clintrial_fromfield_idlist == "I2"


def test_found_flag_of_abstracts_goes_with_their_ids(spark):
    df = works(spark, *[work(str(n), abstract=text) for n, text in enumerate([None, "", "{}", ID1, "x"])])
    wrong = combine(df).where("CROSSREF_clintrial_fromabstract_found != (CROSSREF_clintrial_fromabstract IS NOT NULL)")
    assert wrong.count() == 0


def test_entry_pages(spark):
    """A placeholder's entries are dealt to many bounded pages, which together are its list."""
    rows = [work(f"10.1/{n}", pubmed=("n/a", None, [("ISRCTN", [f"I{n}"])])) for n in range(300)]
    rows += [work(f"10.2/{n}", pubmed=("copies", None, [("ISRCTN", ["I"])])) for n in range(95)]
    rows += [work("10.3/1", pubmed=("10.3/1", None, [("DRKS", ["D2"]), ("DRKS", None), ("ISRCTN", ["D1"])]))]
    df = works(spark, *rows).repartition(5)
    pages = entry_pages(df, 1, trial_ids.REGISTRY, page=10)
    lists = {row.doi: row.PUBMED_clintrial_fromfield for row in registry_entries(df, 1).collect()}
    found = {}
    for row in pages.collect():
        assert row.entries == sorted(row.entries, key=lambda one: (one.id is not None, one.id, one.registry))
        assert len(row.entries) <= 40
        found.setdefault(row.doi, []).append((row.page, row.entries))
    assert len(found["n/a"]) > 20 and len(found["copies"]) > 4 and [page for page, _ in found["10.3/1"]] == [0]
    assert max(page for page, _ in found["n/a"]) < 30
    for doi, own in found.items():
        assert plain(one for _, entries in own for one in entries) == plain(lists[doi])
    # Pages of one DOI come from several tasks.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = pages.where("doi = 'n/a'").select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 2
