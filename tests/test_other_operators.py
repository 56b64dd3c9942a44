from __future__ import annotations

from builders import dois, plain

from scholaudit.functions.keys import left_join_any_case
from scholaudit.operators.audit import Metric, audit_tables, metric_rollup, table_audit, utility_years
from scholaudit.operators.extract import pubmed_extract
from scholaudit.operators.researchers import researcher_orcid

ARTICLES_DDL = """
    PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<value:string,IdType:string>>>>,
    MedlineCitation struct<Article:struct<Abstract:struct<AbstractText:string>,
        DataBankList:struct<DataBank:array<struct<DataBankName:string,
            AccessionNumberList:struct<AccessionNumber:array<string>>>>>>>
"""


def article(ids, abstract, banks):
    return (((ids,),), (((abstract,), ([(name, (numbers,)) for name, numbers in banks],)),))


def test_researcher_orcid(spark):
    df = spark.createDataFrame(
        [
            ("0000-1", True, False, None),
            ("NA", True, True, True),
            ("0000-2", False, None, False),
            ("0000-3", None, None, None),
        ],
        "orcid_id string, is_orcid boolean, orcid_verified boolean, is_affiliation boolean",
    )
    rows = researcher_orcid(df, "script", "list", "out").collect()
    assert [row.orcid_id_raw for row in rows] == ["0000-1", None, "0000-2", "0000-3"]
    assert [row.orcid_id for row in rows] == ["0000-1", None, None, None]
    assert [row.is_orcid_PRETTY == "ORCID found for researcher" for row in rows] == [True, True, False, False]
    assert [row.orcid_verified for row in rows] == [False, True, None, None]
    assert rows[1].is_affiliation_PRETTY == "ORCID affiliation found for researcher"
    assert rows[0].var_SQL_script_name == "script"
    assert (rows[0].var_ORCID_Dataset_name, rows[0].var_output_table) == ("list", "out")


def test_pubmed_extract(spark):
    df = spark.createDataFrame(
        [
            article([("10.1/A", "doi"), ("1", "pubmed")], "second", [("GEO", ["G1", "G2"]), ("SRA", None)]),
            article([("10.1/A", "doi")], "first", [("GEO", ["G1"])]),
            article([("10.1/A", "doi")], "first", [("GEO", ["G1"])]),
            article([("10.1/a", "doi")], None, [("PDB", ["P1"])]),
            article([("10.1/b", "doi")], "no numbers", [("PDB", [])]),
            article([("10.1/c", "doi")], "not listed", [("PDB", ["P2"])]),
        ],
        ARTICLES_DDL,
    )
    rows = pubmed_extract(df, dois(spark, "10.1/a", "10.1/a", "10.1/b")).collect()
    found = [(row.pubmed_doi, row.pubmed_Abstract, row[2] and sorted(map(tuple, row[2]))) for row in rows]
    assert plain(found) == sorted(
        [
            ("10.1/A", "first", [("GEO", "G1"), ("GEO", "G1"), ("GEO", "G1"), ("GEO", "G2")]),
            ("10.1/a", None, [("PDB", "P1")]),
            (None, None, None),
        ],
        key=repr,
    )


def test_table_audit(spark):
    df = dois(spark, "a", "A", "a", None)
    assert tuple(table_audit(df, "doi", "t").first()) == ("t", "doi", 4, 2, 2)
    assert audit_tables({"t": (df, "doi"), "u": (df.limit(0), "doi")}).where("table_name = 'u'").first().n_rows == 0


def test_utility_years(spark):
    df = spark.createDataFrame([(2018,), (None,), (2021,)], "published_year bigint")
    assert sorted(row.year for row in utility_years(df).collect()) == [2018, 2019, 2020, 2021]
    assert utility_years(df.where("published_year IS NULL")).count() == 0


def test_metric_rollup(spark):
    rows = [("a", "Yes", 1), ("a", "Yes", 1), ("a", "No", 2), ("b", None, None), ("b", "Yes", 1)]
    df = spark.createDataFrame(rows, "institution_id string, x_PRETTY string, x_GRAPHORDER int")
    metrics = {"x": Metric("x_PRETTY", "x_GRAPHORDER = 1", "x_GRAPHORDER"), "plain": Metric("x_PRETTY", "x_PRETTY = 'No'")}
    found = metric_rollup(df, metrics, ("institution_id",)).collect()
    ranked = {(row.institution_id, row.label): row for row in found if row.metric == "x" and row.level == "label"}
    assert {key: (row.graph_order, row.n_rows, row.n_counted) for key, row in ranked.items()} == {
        ("a", "Yes"): (1, 2, 2), ("a", "No"): (2, 1, 0), ("b", None): (None, 1, 0), ("b", "Yes"): (1, 1, 1)
    }
    assert ranked["a", "Yes"].share == 2 / 3
    by_metric = {(row.institution_id, row.metric): row for row in found if row.level == "metric"}
    assert {key: (row.n_rows, row.n_counted, row.share) for key, row in by_metric.items()} == {
        ("a", "x"): (3, 2, 1.0), ("b", "x"): (2, 1, 1.0), ("a", "plain"): (3, 1, 1.0), ("b", "plain"): (2, 0, 1.0)
    }
    totals = [(row.institution_id, row.metric, row.label, row.n_rows) for row in found if row.level == "total"]
    assert sorted(totals) == [("a", None, None, 3), ("b", None, None, 2)]
    whole = metric_rollup(df, metrics).collect()
    assert [(row.n_rows, row.share) for row in whole if row.level == "total"] == [(5, None)]
    assert metric_rollup(df.limit(0), metrics).count() == 0


def test_left_join_any_case(spark):
    left = spark.createDataFrame([("A",), ("b",), (None,), ("a",)], "left_doi string")
    right = spark.createDataFrame([("a",), (None,), ("c",)], "right_doi string")
    found = left_join_any_case(left, right, "left_doi", "right_doi")
    pairs = sorted(found.collect(), key=str)
    assert pairs == sorted([("A", "a"), ("a", "a"), ("b", None), (None, None)], key=str)
