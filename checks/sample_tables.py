"""Bibliographic input tables derived from the provided star-schema tables.

Every table uses all rows and whole texts of its source table, so the work of
each query grows with the given data. The row number of a document decides
which case of a nested field it shows; ``sample_sql`` states the same rules
for DuckDB.

    works       documents   one row per document; repeats and case variants
    unpaywall   customer    DOI number = c_custkey + c_nationkey: repeats and gaps
    dois        part        DOI number = p_partkey div 2 + p_size: repeats, strangers
    oddpub      labels      DOI number = doc_id, shifted by one where doc_id % 7 = 0
    trials      customer    three rows per trial number
    orcids      customer
    articles    documents   PubMed's own, deeper nesting
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CUTOFF = 2012
# Cutoffs of the institutions, by the remainder of their number divided by three.
INSTITUTION_CUTOFFS = (CUTOFF, 1, 2018)

# The licence codes shown in turn, with one unknown code and one missing.
LICENSE_CODES = (
    "pd",
    "cc0",
    "cc-by",
    "cc-by-sa",
    "cc-by-nd",
    "cc-by-nc",
    "cc-by-nc-sa",
    "cc-by-nc-nd",
    "publisher-specific-oa",
    "acs-specific: authorchoice/editors choice usage agreement",
    "elsevier-specific: oa user license",
    "publisher-specific, author manuscript",
    "other-oa",
    "implied-oa",
    "unspecified-oa",
    "mit",
    "weird",
    None,
)
WORK_TYPES = (
    "journal-article",
    "book-chapter",
    "posted-content",
    "book",
    "mongraphs",
    "proceedings-article",
    "monograph",
    None,
)


# Columns read from each source table.
SOURCES = {
    "documents": "doc_id bigint, text string, lang string, source string",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_size int",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, read without a job to infer its schema."""
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _array(values) -> str:
    return "array(" + ", ".join(_literal(value) for value in values) + ")"


def _trial(number: str) -> str:
    return f"lpad(cast({number} as string), 8, '0')"


_WORK_DOI = """
    case when k % 50 = 49 then concat('10.5555/w', k - 1)
         when k % 4 = 0 then concat('10.5555/W', k)
         else concat('10.5555/w', k) end
"""


def _bank(name: str, numbers: str) -> str:
    return (
        f"named_struct('DataBankName', '{name}', "
        f"'AccessionNumberList', cast({numbers} as array<string>))"
    )


def _banks() -> str:
    one = f"concat('NCT', {_trial('k div 4 + 3')})"
    other = f"concat(' isrctn', {_trial('k div 4')}, ' ')"
    return f"""
        case k % 8
          when 1 then cast(array() as array<struct<DataBankName:string,AccessionNumberList:array<string>>>)
          when 2 then array({_bank("ClinicalTrials.gov", f"array({one})")})
          when 3 then array({_bank("ISRCTN", f"array({other})")},
                            {_bank("GENBANK", "array(concat('G', k), concat('H', k))")})
          when 4 then array({_bank("GEO", "array(concat('GSE', k))")})
          when 5 then array({_bank("Unlisted", "array(concat('U', k))")})
          when 6 then array({_bank("ClinicalTrials-gov", "array('no')")},
                            {_bank("DRKS", "NULL")})
        end
    """


def _people(field: str, step: int) -> str:
    empty = f"cast(array() as array<struct<{field}:string>>)"
    none = f"named_struct('{field}', cast(NULL as string))"
    some = f"named_struct('{field}', concat('id-', k))"
    return f"case (k + {step}) % 4 when 1 then {empty} when 2 then array({none}) when 3 then array({some}, {none}) end"


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    trial = "k div 4"
    spelled = (
        f"concat(text, ' nct', {_trial(trial)}, ' NCT', {_trial(trial)}, ' NCT', {_trial(trial + ' + 1')}, '9')"
    )
    numbers = "array<struct<clinical_trial_number:string,type:string>>"
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "k").selectExpr(
        f"{_WORK_DOI} as doi",
        f"""named_struct(
            'published_year', case when k % 23 <> 0 then 2010 + k % 15 end,
            'published_month', case when k % 13 = 0 then 13L when k % 11 <> 0 then 1 + k % 12 end,
            'abstract', case k % 10 when 0 then NULL when 1 then '' when 2 then '{{}}'
                        when 3 then {spelled} else text end,
            'clinical_trial_number', cast(case k % 7
                when 1 then array()
                when 2 then array(named_struct('clinical_trial_number', concat(' nct', {_trial(trial)}),
                                               'type', 'results'))
                when 3 then array(named_struct('clinical_trial_number', cast(NULL as string), 'type', 'preResults'))
                when 4 then array(
                    named_struct('clinical_trial_number', concat('NCT', {_trial(trial)}), 'type', 'results'),
                    named_struct('clinical_trial_number', concat('ISRCTN', {_trial(trial)}),
                                 'type', cast(NULL as string)))
                end as {numbers}),
            'title', array('A study of', source, concat('no. ', k)),
            'container_title', cast(case when k % 5 = 0 then NULL when k % 5 = 1 then array()
                                    else array('Journal', concat('of ', lang)) end as array<string>),
            'type', {_array(WORK_TYPES)}[cast(k % 8 as int)],
            'author', {_people("ORCID", 0)},
            'link', case k % 3 when 1 then array(named_struct('URL', concat('https://example.org/', k)))
                    when 2 then array(named_struct('URL', concat('https://example.org/', k)),
                                      named_struct('URL', concat('https://example.org/', k, '.pdf'))) end
        ) as crossref""",
        f"""named_struct(
            'doi', case when k % 6 <> 0 then upper({_WORK_DOI}) end,
            'MedlineCitation', named_struct('Article', named_struct(
                'Abstract', named_struct('AbstractText', case when k % 6 = 0 then NULL when k % 9 = 0 then NULL
                    when k % 9 = 1 then '' when k % 9 = 2 then concat(text, ' see nct', {_trial(trial + ' + 2')})
                    else text end),
                'DataBankList', case when k % 6 <> 0 then {_banks()} end))) as pubmed""",
        """named_struct('oa', named_struct('coki', case when k % 17 <> 0 then named_struct(
            'open', case when k % 19 <> 0 then k % 5 <> 4 end,
            'publisher', k % 5 < 2,
            'publisher_only', k % 5 = 0,
            'both', k % 5 = 1,
            'other_platform_only', k % 5 = 2,
            'other_platform_categories', named_struct('preprint', case when k % 12 <> 0 then k % 6 = 1 end)
            ) end)) as coki""",
        f"""named_struct('authors', {_people("identifier", 1)},
                         'funders', {_people("identifier", 2)}) as affiliations""",
    )


def unpaywall(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "date_add(make_date(cast(2010 + k % 15 as int), 1, 15), cast((k * 37) % 1200 - 200 as int))"

    def place(host: str, when: str) -> str:
        return f"named_struct('host_type', '{host}', 'oa_date', {when})"

    return (
        table(spark, sf_dir, "customer")
        .selectExpr("c_custkey as c", "c_custkey + c_nationkey as k")
        .selectExpr(
            "concat('10.5555/W', k) as doi",
            f"""case k % 7
                when 1 then cast(array() as array<struct<host_type:string,oa_date:date>>)
                when 2 then array({place("publisher", day)})
                when 3 then array({place("repository", day)})
                when 4 then array({place("repository", f"date_add({day}, 30)")}, {place("repository", day)})
                when 5 then array({place("repository", day)}, {place("repository", "cast(NULL as date)")})
                when 6 then array({place("repository", day)}, {place("publisher", f"date_add({day}, -400)")})
                end as oa_locations""",
            f"named_struct('license', {_array(LICENSE_CODES)}[cast((k div 3) % 18 as int)]) as best_oa_location",
        )
    )


def dois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the owning institution, for jobs over many institutions."""
    return (
        table(spark, sf_dir, "part")
        .selectExpr("p_partkey div 2 + p_size as k", "p_size", "p_brand")
        .selectExpr(
            "p_brand as institution_id",
            """case when p_size % 49 = 0 then NULL
                    when p_size % 10 = 0 then concat('10.5555/W', k)
                    when p_size % 10 = 1 then concat('10.9999/none', k)
                    else concat('10.5555/w', k) end as doi""",
        )
    )


def oddpub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "labels")
        .selectExpr("doc_id", "quality", "toxic", "case when doc_id % 7 = 0 then doc_id - 1 else doc_id end as k")
        .selectExpr(
            "concat('Brand#', 1 + k % 25) as institution_id",
            "concat('10.5555/w', k) as doi",
            "case when doc_id % 5 <> 0 then quality = 1 end as is_open_data",
            "case when doc_id % 11 <> 0 then toxic = 1 end as is_open_code",
        )
    )


def trials_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "date_add(date'2014-01-01', cast(c % 900 as int))"

    def dated(shift: int) -> str:
        return f"case when c % 9 = {shift} then 'NA' else cast(date_add({day}, {shift * 31}) as string) end"

    def flag(step: int) -> str:
        return f"array('TRUE', 'FALSE', 'NA', NULL)[cast((c + {step}) % 4 as int)]"

    return (
        table(spark, sf_dir, "customer")
        .selectExpr("c_custkey as c", "c_nationkey")
        .selectExpr(
            "concat('Brand#', 1 + c_nationkey) as institution_id",
            f"""case when c % 20 = 0 then NULL when c % 20 = 1 then 'NA'
                     when c % 2 = 0 then concat('nct', {_trial('c div 3')})
                     else concat('NCT', {_trial('c div 3')}) end as nct_id""",
            f"{dated(0)} as registry_query_date",
            f"{dated(1)} as registration_date",
            f"{dated(2)} as start_date",
            f"case when c % 9 = 3 then 'NA' else concat(cast({day} as string), ' 23:30:00') end as completion_date",
            f"{flag(0)} as is_prospective",
            """array('results_timely', 'results_due_late', 'results_due_missing', 'results_not_due',
                     'Results_Timely', 'NA', NULL)[cast(c % 7 as int)] as summary_results_reporting""",
            f"{flag(1)} as has_linked_reference",
            f"{flag(2)} as is_summary_results_1y_cd",
        )
    )


def orcids(spark: SparkSession, sf_dir: str) -> DataFrame:
    def flag(base: int) -> str:
        return f"case c % {base} when 0 then true when 1 then false end"

    return (
        table(spark, sf_dir, "customer")
        .selectExpr("c_custkey as c")
        .selectExpr(
            f"case when c % 10 = 0 then 'NA' else concat('0000-0001-', {_trial('c')}) end as orcid_id",
            f"{flag(3)} as is_orcid",
            f"{flag(4)} as orcid_verified",
            f"{flag(5)} as is_affiliation",
        )
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PubMed articles: the works' banks and abstracts in PubMed's own nesting."""
    return works(spark, sf_dir).selectExpr(
        """named_struct('ArticleIdList', named_struct('ArticleId', filter(array(
            named_struct('value', concat('pm', coalesce(pubmed.doi, doi)), 'IdType', 'pubmed'),
            named_struct('value', pubmed.doi, 'IdType', 'doi')), id -> id.value is not null))) as PubmedData""",
        """named_struct('Article', named_struct(
            'Abstract', pubmed.MedlineCitation.Article.Abstract,
            'DataBankList', named_struct('DataBank', transform(pubmed.MedlineCitation.Article.DataBankList,
                bank -> named_struct('DataBankName', bank.DataBankName,
                    'AccessionNumberList', named_struct('AccessionNumber', bank.AccessionNumberList))))
            )) as MedlineCitation""",
    )
