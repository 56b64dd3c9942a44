"""The registered queries in SQL for DuckDB.

Input tables follow the rules of ``sample_tables``. Logic is written the
plain way: lists are exploded, grouped and joined back, whole tables are
joined before they are cut down, and repeats are multiplied by the joins.
"""

from __future__ import annotations

from checks.sample_tables import CUTOFF, INSTITUTION_CUTOFFS, LICENSE_CODES, WORK_TYPES
from scholaudit.functions import labels
from scholaudit.operators.researchers import FLAGS
from scholaudit.operators.trial_ids import DATABANKS, REGISTRIES, TRIAL_ID


def _q(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _list(values) -> str:
    return "[" + ", ".join(_q(value) for value in values) + "]"


def _case(column: str, pairs, default, cast: str = "VARCHAR") -> str:
    whens = " ".join(f"WHEN {column} = {_q(match)} THEN {_q(result)}" for match, result in pairs)
    return f"CAST(CASE {whens} ELSE {_q(default)} END AS {cast})"


def _trial(number: str) -> str:
    return f"lpad(CAST({number} AS VARCHAR), 8, '0')"


def _bank(name: str, numbers: str) -> str:
    return f"{{'name': '{name}', 'ids': CAST({numbers} AS VARCHAR[])}}"


def _people(step: int) -> str:
    """How many identifiers of a work's people are given."""
    return f"(CASE (k + {step}) % 4 WHEN 3 THEN 1 ELSE 0 END)"


# --- input tables -----------------------------------------------------------

_WORK_DOI = """CASE WHEN k % 50 = 49 THEN '10.5555/w' || (k - 1)
    WHEN k % 4 = 0 THEN '10.5555/W' || k ELSE '10.5555/w' || k END"""

_INPUTS = {
    "works": f"""
    SELECT k, doi, CASE WHEN k % 23 <> 0 THEN 2010 + k % 15 END AS published_year,
        CASE WHEN k % 13 = 0 THEN 13 WHEN k % 11 <> 0 THEN 1 + k % 12 END AS published_month,
        CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '{{}}'
            WHEN 3 THEN text || ' nct' || {_trial('k // 4')} || ' NCT' || {_trial('k // 4')}
                || ' NCT' || {_trial('k // 4 + 1')} || '9'
            ELSE text END AS abstract,
        CASE k % 7 WHEN 1 THEN [] WHEN 2 THEN [{{'number': ' nct' || {_trial('k // 4')}, 'type': 'results'}}]
            WHEN 3 THEN [{{'number': NULL, 'type': 'preResults'}}]
            WHEN 4 THEN [{{'number': 'NCT' || {_trial('k // 4')}, 'type': 'results'}},
                         {{'number': 'ISRCTN' || {_trial('k // 4')}, 'type': NULL}}]
            END AS field_numbers,
        'A study of ' || source || ' no. ' || k AS title,
        CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN '' ELSE 'Journal of ' || lang END AS container_title,
        {_list(WORK_TYPES)}[k % 8 + 1] AS type,
        {_people(0)} > 0 AS has_author_orcid, {_people(1)} > 0 AS has_author_id, {_people(2)} > 0 AS has_funder_id,
        CASE k % 3 WHEN 1 THEN 'https://example.org/' || k
            WHEN 2 THEN 'https://example.org/' || k || ' https://example.org/' || k || '.pdf' END AS urls,
        CASE WHEN k % 6 <> 0 THEN upper(doi) END AS pubmed_doi,
        CASE WHEN k % 6 <> 0 THEN CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN ''
            WHEN 2 THEN text || ' see nct' || {_trial('k // 4 + 2')} ELSE text END END AS pubmed_abstract,
        CASE WHEN k % 6 <> 0 THEN CASE k % 8
            WHEN 1 THEN []
            WHEN 2 THEN [{_bank("ClinicalTrials.gov", f"['NCT' || {_trial('k // 4 + 3')}]")}]
            WHEN 3 THEN [{_bank("ISRCTN", f"[' isrctn' || {_trial('k // 4')} || ' ']")},
                         {_bank("GENBANK", "['G' || k, 'H' || k]")}]
            WHEN 4 THEN [{_bank("GEO", "['GSE' || k]")}]
            WHEN 5 THEN [{_bank("Unlisted", "['U' || k]")}]
            WHEN 6 THEN [{_bank("ClinicalTrials-gov", "['no']")}, {_bank("DRKS", "NULL")}]
            END END AS banks,
        CASE WHEN k % 17 <> 0 AND k % 19 <> 0 THEN k % 5 <> 4 END AS is_open,
        CASE WHEN k % 17 <> 0 THEN k % 5 < 2 END AS publisher,
        CASE WHEN k % 17 <> 0 THEN k % 5 = 0 END AS publisher_only,
        CASE WHEN k % 17 <> 0 THEN k % 5 = 1 END AS both_routes,
        CASE WHEN k % 17 <> 0 THEN k % 5 = 2 END AS other_platform_only,
        CASE WHEN k % 17 <> 0 AND k % 12 <> 0 THEN k % 6 = 1 END AS preprint
    FROM (SELECT doc_id AS k, text, lang, source, {_WORK_DOI.replace('k', 'doc_id')} AS doi FROM documents)""",
    "access": f"""
    SELECT '10.5555/W' || k AS doi,
        CASE k % 7 WHEN 1 THEN [] WHEN 2 THEN [{{'host': 'publisher', 'day': d}}]
            WHEN 3 THEN [{{'host': 'repository', 'day': d}}]
            WHEN 4 THEN [{{'host': 'repository', 'day': d + 30}}, {{'host': 'repository', 'day': d}}]
            WHEN 5 THEN [{{'host': 'repository', 'day': d}}, {{'host': 'repository', 'day': NULL}}]
            WHEN 6 THEN [{{'host': 'repository', 'day': d}}, {{'host': 'publisher', 'day': d - 400}}]
            END AS locations,
        {_list(LICENSE_CODES)}[(k // 3) % 18 + 1] AS license
    FROM (SELECT k, make_date(2010 + k % 15, 1, 15) + CAST((k * 37) % 1200 - 200 AS INTEGER) AS d
          FROM (SELECT c_custkey + c_nationkey AS k FROM customer))""",
    "listed_dois": """
    SELECT p_brand AS institution_id, CASE WHEN p_size % 49 = 0 THEN NULL
        WHEN p_size % 10 = 0 THEN '10.5555/W' || k WHEN p_size % 10 = 1 THEN '10.9999/none' || k
        ELSE '10.5555/w' || k END AS doi
    FROM (SELECT p_brand, p_size, p_partkey // 2 + p_size AS k FROM part)""",
    "odd": """
    SELECT 'Brand#' || (1 + k % 25) AS institution_id, '10.5555/w' || k AS doi,
        CASE WHEN doc_id % 5 <> 0 THEN quality = 1 END AS is_open_data,
        CASE WHEN doc_id % 11 <> 0 THEN toxic = 1 END AS is_open_code
    FROM (SELECT *, CASE WHEN doc_id % 7 = 0 THEN doc_id - 1 ELSE doc_id END AS k FROM labels)""",
    "raw_trials": f"""
    SELECT 'Brand#' || (1 + c_nationkey) AS institution_id,
        CASE WHEN c % 20 = 0 THEN NULL WHEN c % 20 = 1 THEN 'NA' WHEN c % 2 = 0 THEN 'nct' || {_trial('c // 3')}
            ELSE 'NCT' || {_trial('c // 3')} END AS nct_id,
        CASE WHEN c % 9 <> 0 THEN d END AS registry_query_date,
        CASE WHEN c % 9 <> 1 THEN d + 31 END AS registration_date,
        CASE WHEN c % 9 <> 2 THEN d + 62 END AS start_date,
        CASE WHEN c % 9 <> 3 THEN d END AS completion_date,
        {_list(["TRUE", "FALSE", "NA", None])}[c % 4 + 1] AS is_prospective,
        {_list(["results_timely", "results_due_late", "results_due_missing", "results_not_due",
                "Results_Timely", "NA", None])}[c % 7 + 1] AS reporting,
        {_list(["TRUE", "FALSE", "NA", None])}[(c + 1) % 4 + 1] AS has_linked_reference,
        {_list(["TRUE", "FALSE", "NA", None])}[(c + 2) % 4 + 1] AS is_summary_results_1y_cd
    FROM (SELECT c_custkey AS c, c_nationkey, DATE '2014-01-01' + CAST(c_custkey % 900 AS INTEGER) AS d
          FROM customer)""",
    "orcid_list": f"""
    SELECT CASE WHEN c % 10 = 0 THEN 'NA' ELSE '0000-0001-' || {_trial('c')} END AS orcid_id,
        CASE c % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_orcid,
        CASE c % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS orcid_verified,
        CASE c % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_affiliation
    FROM (SELECT c_custkey AS c FROM customer)""",
}

# --- trial identifiers -------------------------------------------------------


def _ids(text: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all(upper({text}), '{TRIAL_ID}')))"


def _found(text: str) -> str:
    return (
        f"CASE WHEN {text} IS NULL OR {text} IN ('', '{{}}') THEN FALSE "
        f"ELSE regexp_matches(upper({text}), '{TRIAL_ID}') END"
    )


def _text_ids(text: str) -> str:
    return f"CASE WHEN {_found(text)} THEN {_ids(text)} END"


def _joined(items: str) -> str:
    """Join the non-null items; NULL when there are none."""
    present = f"list_filter({items}, lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({present}) > 0 THEN array_to_string({present}, ' ') END"


def _id_list(items: str, ids: str) -> str:
    return f"CASE WHEN {items} IS NULL THEN '' ELSE trim({_joined(ids)}) END"


def _dedupe(text: str) -> str:
    """First occurrences of the parts, in order."""
    parts = f"string_split({text}, ' ')"
    return (
        f"coalesce(array_to_string(list_filter({parts}, lambda x, i: list_position({parts}, x) = i), ' '), '')"
    )


def _entries(items: str, name: str) -> str:
    """Entries as text, in their sorted order."""
    blank = "''" if name == "type" else "'-'"
    one = f"coalesce(x.{name}, '-') || ':' || coalesce(array_to_string(x.id, '+'), {blank})"
    return f"array_to_string(list_transform({items}, lambda x: {one}), ';')"


_GROUPED_BANKS = """
    SELECT pubmed_doi AS doi,
        list({{'id': b.ids, 'registry': b.name}} ORDER BY b.ids NULLS FIRST, b.name NULLS FIRST) AS items
    FROM (SELECT pubmed_doi, unnest(banks) AS b FROM works WHERE published_year > {cutoff})
    WHERE regexp_matches(b.name, '{names}') GROUP BY pubmed_doi"""

_TRIALS_COLUMNS = ("fa", "ff", "pa", "pf")

_IDENTIFIERS = {
    "registry_groups": _GROUPED_BANKS.format(cutoff=CUTOFF, names=REGISTRIES),
    "databank_groups": _GROUPED_BANKS.format(cutoff=CUTOFF, names=DATABANKS),
    "field_groups": f"""
    SELECT doi, list({{'id': [upper(n.number)], 'type': n.type}}
                     ORDER BY upper(n.number) NULLS FIRST, n.type NULLS FIRST) AS items
    FROM (SELECT doi, unnest(field_numbers) AS n FROM works WHERE published_year > {CUTOFF})
    GROUP BY doi""",
    "gathered": f"""
    SELECT w.*, {_found('w.abstract')} AS fa_found, {_text_ids('w.abstract')} AS fa,
        coalesce(len(w.field_numbers) > 0, FALSE) AS ff_found, f.items AS ff,
        {_found('w.pubmed_abstract')} AS pa_found, {_text_ids('w.pubmed_abstract')} AS pa,
        r.items IS NOT NULL AS pf_found, r.items AS pf, d.items IS NOT NULL AS od_found, d.items AS od
    FROM works w
    LEFT JOIN registry_groups r ON lower(w.doi) = lower(r.doi)
    LEFT JOIN databank_groups d ON lower(w.doi) = lower(d.doi)
    LEFT JOIN field_groups f ON lower(w.doi) = lower(f.doi)
    WHERE w.published_year > {CUTOFF}""",
    "listed": f"""
    SELECT *, {_id_list('fa', 'list_transform(fa, lambda x: trim(x))')} AS fa_list,
        {_id_list('ff', 'list_transform(ff, lambda x: trim(x.id[1]))')} AS ff_list,
        {_id_list('pa', 'list_transform(pa, lambda x: trim(x))')} AS pa_list,
        {_id_list('pf', 'list_transform(flatten(list_transform(pf, lambda x: coalesce(x.id, []))), lambda y: trim(y))')}
            AS pf_list,
        {_joined('list_transform(flatten(list_transform(od, lambda x: coalesce(x.id, []))), lambda y: trim(y))')}
            AS od_list
    FROM gathered""",
    "combined": f"""
    SELECT *, ff_found OR fa_found OR pf_found OR pa_found AS any_found,
        {_dedupe("trim(replace(fa_list || ' ' || ff_list || ' ' || pa_list || ' ' || pf_list, '  ', ' '))")} AS any_list
    FROM listed""",
    "pairs": """
    SELECT lower(doi) AS pair_doi, upper(trim(one)) AS pair_id
    FROM (SELECT doi, unnest(string_split(trim(any_list), ' ')) AS one FROM combined WHERE any_found)""",
}

# --- trials ------------------------------------------------------------------


def _na(column: str, kind: str = "VARCHAR") -> str:
    return f"CAST(nullif({column}, 'NA') AS {kind})"


_ID_COLUMNS = f"""upper({_na('nct_id')}) AS nct_id, nct_id IS NOT NULL AS nct_id_found,
    CASE WHEN nct_id IS NULL THEN 'No Trial-ID' ELSE 'Has Trial-ID' END AS "nct_id_found_PRETTY" """
_PROSPECTIVE = f"""{_na('is_prospective', 'BOOLEAN')} AS is_prospective,
    CASE WHEN {_na('is_prospective', 'BOOLEAN')} IS TRUE THEN 'Registered before enrollment started'
        ELSE 'Registered after enrollment started' END AS "is_prospective_PRETTY" """
_REPORTING = f"""lower({_na('reporting')}) AS summary_results_reporting,
    {_case('reporting', [(code, text) for code, text, _ in labels.RESULTS_REPORTING], '')}
        AS "summary_results_reporting_PRETTY",
    {_case('reporting', [(code, rank) for code, _, rank in labels.RESULTS_REPORTING], 99, 'BIGINT')}
        AS "summary_results_reporting_GRAPHORDER" """
_REFERENCE = f"""{_na('has_linked_reference', 'BOOLEAN')} AS has_linked_reference,
    CASE WHEN {_na('has_linked_reference', 'BOOLEAN')} IS TRUE THEN 'Trial has a linked reference'
        ELSE 'Trial does not have a linked reference' END AS "has_linked_reference_PRETTY" """
_LINK_TEXT = "Trial-IDs from the institution''s trial dataset found in a publication from the institution"
_ANY_TEXT = "Trial-IDs from the institution''s trial dataset found in a Crossref or Pubmed publication"

_TRIALS = {
    "cleaned": f"""
    SELECT institution_id, {_ID_COLUMNS}, registry_query_date, registration_date, start_date, completion_date,
        {_PROSPECTIVE}, {_REPORTING}, {_REFERENCE}
    FROM raw_trials""",
    "publication_pairs": """
    SELECT institution_id, trim(lower(l.doi)) AS pub_doi, p.pair_id
    FROM listed_dois l JOIN pairs p ON lower(l.doi) = lower(p.pair_doi)""",
    "links": """
    SELECT c.nct_id, trim(string_agg(p.pub_doi, ' ' ORDER BY p.pub_doi)) AS "PUBSDATA_doi"
    FROM publication_pairs p JOIN cleaned c ON lower(p.pair_id) = lower(c.nct_id) GROUP BY c.nct_id""",
    "linked": f"""
    SELECT c.*, k."PUBSDATA_doi", k."PUBSDATA_doi" IS NOT NULL AS "PUBSDATA_doi_found",
        CASE WHEN k."PUBSDATA_doi" IS NOT NULL THEN '{_LINK_TEXT}' ELSE 'No {_LINK_TEXT}' END
            AS "PUBSDATA_doi_found_PRETTY"
    FROM cleaned c LEFT JOIN links k ON lower(c.nct_id) = lower(k.nct_id)""",
    "institution_links": """
    SELECT p.institution_id, c.nct_id, trim(string_agg(p.pub_doi, ' ' ORDER BY p.pub_doi)) AS "PUBSDATA_doi"
    FROM publication_pairs p
    JOIN cleaned c ON lower(p.pair_id) = lower(c.nct_id) AND p.institution_id = c.institution_id
    GROUP BY p.institution_id, c.nct_id""",
}

# --- publications -------------------------------------------------------------

_MONTHS = "CAST(date_diff('month', published, green) AS BIGINT)"
_STEPS = [f"WHEN {_MONTHS} < {limit} THEN {{}}" for limit, _, _ in labels.EMBARGO_STEPS] + [
    f"WHEN {_MONTHS} >= {labels.EMBARGO_STEPS[-1][0]} THEN {{}}"
]


def _embargo(place: int) -> str:
    results = [step[place] for step in labels.EMBARGO_STEPS] + [labels.EMBARGO_BEYOND[place - 1]]
    whens = " ".join(step.format(_q(result)) for step, result in zip(_STEPS, results, strict=True))
    return f"CASE {whens} ELSE {_q(labels.EMBARGO_UNKNOWN[place - 1])} END"


_FLAG = "coalesce({fact}, FALSE) AS {name}, CASE WHEN {fact} THEN '{yes}' ELSE '{no}' END AS \"{name}_PRETTY\""

# Output columns by group; each is computed from a row of ``enriched``.
_GROUPS = {
    "doi_match_label": """lower(work_doi) AS doi_academicobservatory,
        CASE WHEN work_doi IS NULL THEN 'No' ELSE 'Yes' END AS "doi_in_academicobservatory_PRETTY" """,
    "bibliographic_fields": """CAST(published_year AS BIGINT) AS published_year,
        CAST(published_year AS BIGINT) AS "published_year_PRETTY",
        container_title AS container_title_concat, title AS title_concat""",
    "publication_type_label": f"""type AS crossref_type,
        {_case('type', labels.WORK_TYPES, None)} AS "crossref_type_PRETTY" """,
    "oa_category": """
        CASE WHEN publisher_only THEN 'Publisher Open Access' WHEN both_routes THEN 'Both'
            WHEN other_platform_only THEN 'Other Platform Open Access' ELSE 'Closed Access' END AS "oa_coki_PRETTY",
        CAST(CASE WHEN publisher_only THEN 0 WHEN both_routes THEN 1 WHEN other_platform_only THEN 2 ELSE 3 END
            AS BIGINT) AS "oa_coki_GRAPHORDER" """,
    "oa_open_status": """
        CASE WHEN is_open THEN 'Open Access' WHEN NOT is_open THEN 'Closed Access' ELSE 'Unknown' END
            AS "oa_coki_open_PRETTY",
        CAST(CASE WHEN is_open THEN 1 ELSE 0 END AS BIGINT) AS "oa_coki_OA_open",
        CAST(CASE WHEN NOT is_open THEN 1 ELSE 0 END AS BIGINT) AS "oa_coki_OA_closed" """,
    "embargo_months": f"green AS first_green_oa_date, published AS cr_published_date, {_MONTHS} AS embargo",
    "embargo_label": f"""{_embargo(1)} AS "embargo_PRETTY", CAST({_embargo(2)} AS BIGINT) AS "embargo_GRAPHORDER" """,
    "license_label": f"""license,
        {_case('license', [(code, text) for code, text, _ in labels.LICENSES], 'No licence info')} AS "license_PRETTY",
        {_case('license', [(row[0], place) for place, row in enumerate(labels.LICENSES, 1)], 99, 'BIGINT')}
            AS "license_GRAPHORDER",
        {_case('license', [(code, group) for code, _, group in labels.LICENSES], 'No licence info')}
            AS "license_GROUP" """,
    "orcid_publisher": _FLAG.format(
        fact="has_author_orcid", name="has_publisher_orcid",
        yes="Has publisher ORCID", no="Does not have publisher ORCID",
    ),
    "orcid_author_record": _FLAG.format(
        fact="has_author_id", name="in_orcid_record", yes="In an ORCID record", no="Not in any ORCID record"
    ),
    "funder_record": _FLAG.format(
        fact="has_funder_id", name="has_cr_funder_record",
        yes="Has funder acknowledgement", no="No funder acknowledgement",
    ),
    "preprint_label": """preprint AS has_preprint,
        CASE WHEN preprint THEN 'Has a preprint' ELSE 'No preprint identified' END AS "has_preprint_PRETTY" """,
    "fulltext_urls": 'urls AS "crossref_fulltext_URL_CONCAT"',
    "abstracts": "abstract AS abstract_crossref, extract_abstract AS abstract_pubmed",
    "plan_s_compliance": f"""
        CASE WHEN NOT is_open THEN FALSE WHEN license != 'cc-by' THEN FALSE WHEN publisher THEN TRUE
            WHEN {_MONTHS} < 1 THEN TRUE ELSE FALSE END AS plans_compliant,
        CASE WHEN NOT is_open THEN 'Not PlanS Compliant' WHEN license != 'cc-by' THEN 'Not PlanS Compliant'
            WHEN publisher THEN 'PlanS Compliant' WHEN {_MONTHS} < 1 THEN 'PlanS Compliant'
            ELSE 'Not PlanS Compliant' END AS "plans_compliant_PRETTY" """,
    "publication_trial_columns": """
        x_ff_found AS "CROSSREF_clintrial_fromfield_found", x_ff_list AS "CROSSREF_clintrial_fromfield_idlist",
        x_fa_found AS "CROSSREF_clintrial_fromabstract_found",
        x_pf_found AS "PUBMED_clintrial_fromfield_found", x_pf_list AS "PUBMED_clintrial_fromfield_idlist",
        x_pa_found AS "PUBMED_clintrial_fromabstract_found",
        x_any_found AS "ANYSOURCE_clintrial_found",
        CASE WHEN x_any_found THEN 'Trial-ID found in any publication in Pubmed or Crossref'
            ELSE 'No Trial-ID found in any publication in Pubmed or Crossref' END
            AS "ANYSOURCE_clintrial_found_PRETTY",
        x_od_found AS "PUBMED_opendata_fromfield_found", x_od_list AS "PUBMED_opendata_fromfield_idlist",
        CASE WHEN x_od_found THEN 'Databank-ID found in Pubmed'
            ELSE 'No Databank-ID number found in Pubmed' END AS "PUBMED_opendata_fromfield_found_PRETTY" """,
    "open_data_code": """odd_doi IS NOT NULL AS has_oddpub_processing,
        coalesce(is_open_data, FALSE) AS has_open_data_oddpub,
        CASE WHEN coalesce(is_open_data, FALSE) THEN 'Contains reference to Open data'
            ELSE 'No reference to Open data found' END AS "has_open_data_oddpub_PRETTY",
        coalesce(is_open_code, FALSE) AS has_open_code_oddpub,
        CASE WHEN coalesce(is_open_code, FALSE) THEN 'Contains reference to Open code'
            ELSE 'No reference to Open code found' END AS "has_open_code_oddpub_PRETTY" """,
}
_OPEN_FLAGS = """is_open AS coki_open, publisher AS coki_publisher, publisher_only AS coki_publisher_only,
    both_routes AS coki_both, other_platform_only AS coki_other_platform_only"""
_PUB_GROUPS = [name for name in _GROUPS if name not in ("plan_s_compliance", "publication_trial_columns")]
_PUB_COLUMNS = f"lower(listed_doi) AS doi, {_OPEN_FLAGS}, " + ", ".join(_GROUPS[name] for name in _PUB_GROUPS)

_PUBLICATIONS = {
    "enriched": f"""
    SELECT w.*, w.doi AS work_doi, a.license,
        CASE WHEN w.published_month > 12 THEN NULL ELSE make_date(w.published_year, w.published_month, 1) END
            AS published,
        list_sort(list_transform(list_filter(a.locations, lambda x: x.host = 'repository'), lambda y: y.day),
                  'ASC', 'NULLS FIRST')[1] AS green,
        x.pubmed_abstract AS extract_abstract, x.ff_found AS x_ff_found, x.ff_list AS x_ff_list,
        x.fa_found AS x_fa_found, x.pa_found AS x_pa_found, x.pf_found AS x_pf_found, x.pf_list AS x_pf_list,
        x.od_found AS x_od_found, x.od_list AS x_od_list, x.any_found AS x_any_found
    FROM works w
    LEFT JOIN access a ON lower(w.doi) = lower(a.doi)
    LEFT JOIN combined x ON lower(w.doi) = lower(x.doi)""",
    "audited": """
    SELECT l.doi AS listed_doi, e.*, o.doi AS odd_doi, o.is_open_data, o.is_open_code
    FROM (SELECT DISTINCT doi FROM listed_dois) l
    LEFT JOIN enriched e ON lower(l.doi) = lower(e.doi)
    LEFT JOIN odd o ON lower(l.doi) = lower(o.doi)""",
    "institution_audited": """
    SELECT l.institution_id, l.doi AS listed_doi, e.*, o.doi AS odd_doi, o.is_open_data, o.is_open_code
    FROM (SELECT DISTINCT institution_id, doi FROM listed_dois) l
    LEFT JOIN enriched e ON lower(l.doi) = lower(e.doi)
    LEFT JOIN odd o ON lower(l.doi) = lower(o.doi) AND l.institution_id = o.institution_id""",
}

_CTES = {**_INPUTS, **_IDENTIFIERS, **_TRIALS, **_PUBLICATIONS}
_FOR_IDENTIFIERS = ("works", *_IDENTIFIERS)
_FOR_TRIALS = (*_FOR_IDENTIFIERS, "listed_dois", "raw_trials", "cleaned", "publication_pairs", "links", "linked")
_FOR_WORKS = (*_FOR_IDENTIFIERS, "access", "enriched")
_FOR_PUBS = (*_FOR_WORKS, "listed_dois", "odd", "audited")


def _sql(final: str, *names: str) -> str:
    used = list(dict.fromkeys(names))
    head = ",\n".join(f"{name} AS ({_CTES[name]})" for name in used)
    return f"WITH {head}\n{final}" if head else final


def _by_institution(final: str, *names: str) -> str:
    """The same statement for the institutions of each cutoff, put together."""
    parts = []
    for place, cutoff in enumerate(INSTITUTION_CUTOFFS):
        whole = _sql(final, *names).replace(f"published_year > {CUTOFF}", f"published_year > {cutoff}")
        number = "CAST(substr(institution_id, 7) AS INTEGER)"
        parts.append(f"SELECT * FROM ({whole}) WHERE {number} % {len(INSTITUTION_CUTOFFS)} = {place}")
    return "\nUNION ALL ".join(parts)


def _audit(*tables: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{column}' AS column_name, count(*) AS n_rows,
        count(DISTINCT {column}) AS n_distinct,
        count(DISTINCT {column}) FILTER (WHERE {column} IS NOT NULL) AS n_distinct_notnull FROM {source}"""
        for name, source, column in tables
    )


_METRICS = (
    ("trials", '"nct_id_found_PRETTY"', "NULL", "nct_id_found"),
    ("prospective_registrations", '"is_prospective_PRETTY"', "NULL", "is_prospective"),
    (
        "results_within_1y",
        '"summary_results_reporting_PRETTY"',
        '"summary_results_reporting_GRAPHORDER"',
        '"summary_results_reporting_GRAPHORDER" = 1',
    ),
    ("linked_references", '"has_linked_reference_PRETTY"', "NULL", "has_linked_reference"),
    ("trial_id_in_publications", '"PUBSDATA_doi_found_PRETTY"', "NULL", '"PUBSDATA_doi_found"'),
)


def _rollup() -> str:
    """Labels and metrics of each, and one row for the table."""
    every = " UNION ALL ".join(
        f"""SELECT '{metric}' AS metric, {label} AS label, CAST({rank} AS BIGINT) AS graph_order,
        coalesce({counts}, FALSE) AS counted FROM linked"""
        for metric, label, rank, counts in _METRICS
    )
    return f"""SELECT CASE WHEN grouping(label) = 0 THEN 'label' ELSE 'metric' END AS level, metric, label, graph_order,
        count(*) AS n_rows, CAST(count(*) FILTER (counted) AS BIGINT) AS n_counted,
        CAST(count(*) AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM linked) AS share
        FROM ({every}) GROUP BY GROUPING SETS ((metric, label, graph_order), (metric))
        UNION ALL SELECT 'total', NULL, NULL, NULL, count(*), NULL, NULL FROM linked"""


_TEXT_COLUMNS = """fa_found AS "CROSSREF_clintrial_fromabstract_found",
    array_to_string(fa, ' ') AS "CROSSREF_clintrial_fromabstract_ids",
    pa_found AS "PUBMED_clintrial_fromabstract_found",
    array_to_string(pa, ' ') AS "PUBMED_clintrial_fromabstract_ids" """
# The order of ids within a text is the order of appearance in Spark and sorted here, so lists that
# start with them are compared as sorted parts.
_SORTED = "array_to_string(list_sort(string_split({}, ' ')), ' ')"
_LIST_COLUMNS = f"""{_SORTED.format('fa_list')} AS "CROSSREF_clintrial_fromabstract_idlist",
    ff_list AS "CROSSREF_clintrial_fromfield_idlist",
    {_SORTED.format('pa_list')} AS "PUBMED_clintrial_fromabstract_idlist",
    pf_list AS "PUBMED_clintrial_fromfield_idlist", od_list AS "PUBMED_opendata_fromfield_idlist" """
_ANY_COLUMNS = f"""any_found AS "ANYSOURCE_clintrial_found",
    {_SORTED.format('any_list')} AS "ANYSOURCE_clintrial_idlist" """
_ALLTRIALS_COLUMNS = f"""doi, CAST(published_year AS BIGINT) AS published_year, abstract AS "abstract_CROSSREF",
    pubmed_abstract AS "abstract_PUBMED", {_TEXT_COLUMNS}, ff_found AS "CROSSREF_clintrial_fromfield_found",
    {_entries('ff', 'type')} AS "CROSSREF_clintrial_fromfield_entries",
    pf_found AS "PUBMED_clintrial_fromfield_found",
    {_entries('pf', 'registry')} AS "PUBMED_clintrial_fromfield_entries",
    od_found AS "PUBMED_opendata_fromfield_found", {_entries('od', 'registry')} AS "PUBMED_opendata_fromfield_entries",
    {_LIST_COLUMNS}, {_ANY_COLUMNS}, 'doi20240512' AS "var_AcademicObservatory_doi",
    CAST({CUTOFF} AS BIGINT) AS "var_SQL_year_cutoff", 'v1' AS "var_SQL_workflow_version",
    'inst' AS "var_institution_id" """
_TRIALS_TAIL = """'v1' AS "var_SQL_workflow_version", 'trials_aact_20250221' AS var_data_trials,
    'dois_20230217' AS var_data_dois, 'inst' AS var_institution_id"""
_PUBS_TAIL = """'v1' AS "var_SQL_workflow_version", 'dois_20230217' AS var_data_dois,
    'oddpub_20230217' AS var_data_oddpub, 'inst' AS var_institution_id"""


def _oracles() -> dict[str, str]:
    text_from = (
        f"(SELECT doi, {_found('abstract')} AS fa_found, {_text_ids('abstract')} AS fa, "
        f"{_found('pubmed_abstract')} AS pa_found, {_text_ids('pubmed_abstract')} AS pa FROM works)"
    )
    all_field_groups = _IDENTIFIERS["field_groups"].replace(f"WHERE published_year > {CUTOFF}", "")
    found = {
        "trial_ids_in_text": _sql(f"SELECT doi, {_TEXT_COLUMNS} FROM {text_from}", "works"),
        "trial_ids_in_field": _sql(
            f"""SELECT w.doi, coalesce(len(field_numbers) > 0, FALSE) AS "CROSSREF_clintrial_fromfield_found",
            {_entries('f.items', 'type')} AS "CROSSREF_clintrial_fromfield_entries"
            FROM works w LEFT JOIN ({all_field_groups}) f ON lower(w.doi) = lower(f.doi)""",
            "works",
        ),
        "registry_entries": _sql(
            f"""SELECT doi, {_entries('items', 'registry')} AS "PUBMED_clintrial_fromfield_entries"
            FROM registry_groups WHERE doi IS NOT NULL""",
            "works", "registry_groups",
        ),
        "databank_entries": _sql(
            f"""SELECT doi, {_entries('items', 'registry')} AS "PUBMED_opendata_fromfield_entries"
            FROM databank_groups WHERE doi IS NOT NULL""",
            "works", "databank_groups",
        ),
        "entry_pages": _sql(
            " UNION ALL ".join(
                f"""SELECT doi, '{kind}' AS kind, len(items) AS n_entries,
                list_min(list_transform(items, lambda x: coalesce(x.{label}, '-'))) AS first_label,
                list_max(list_transform(items, lambda x: coalesce(x.{label}, '-'))) AS last_label
                FROM {groups} WHERE doi IS NOT NULL"""
                for kind, groups, label in (
                    ("registry", "registry_groups", "registry"),
                    ("databank", "databank_groups", "registry"),
                    ("crossref", "field_groups", "type"),
                )
            ),
            "works", "registry_groups", "databank_groups", "field_groups",
        ),
        "id_list_strings": _sql(f"SELECT doi, {_LIST_COLUMNS} FROM listed", *_FOR_IDENTIFIERS),
        "any_source_trials": _sql(f"SELECT doi, {_ANY_COLUMNS} FROM combined", *_FOR_IDENTIFIERS),
        "alltrials": _sql(f"SELECT {_ALLTRIALS_COLUMNS} FROM combined", *_FOR_IDENTIFIERS),
        "flatten_trial_pairs": _sql(
            """SELECT pair_doi AS "ANYSOURCE_doi", pair_id AS "ANYSOURCE_clintrial_id_flat" FROM pairs""",
            *_FOR_IDENTIFIERS,
        ),
        "clean_trials": _sql("SELECT * EXCLUDE (institution_id) FROM cleaned", "raw_trials", "cleaned"),
        "prospective_label": _sql(f"SELECT {_ID_COLUMNS}, {_PROSPECTIVE} FROM raw_trials", "raw_trials"),
        "results_reporting_label": _sql(f"SELECT {_ID_COLUMNS}, {_REPORTING} FROM raw_trials", "raw_trials"),
        "linked_reference_label": _sql(f"SELECT {_ID_COLUMNS}, {_REFERENCE} FROM raw_trials", "raw_trials"),
        "results_within_1y_label": _sql(
            f"""SELECT {_ID_COLUMNS}, {_na('is_summary_results_1y_cd', 'BOOLEAN')} AS is_summary_results_1y_cd,
            CASE WHEN {_na('is_summary_results_1y_cd', 'BOOLEAN')} IS TRUE
                THEN 'Summary results reported within 1 year of trial completion'
                WHEN {_na('is_summary_results_1y_cd', 'BOOLEAN')} IS FALSE
                THEN 'Summary results not reported within 1 year of trial completion'
                ELSE 'No information about reporting of summary results' END AS "is_summary_results_1y_cd_PRETTY"
            FROM raw_trials""",
            "raw_trials",
        ),
        "trials_in_publications": _sql("SELECT * FROM links", *_FOR_TRIALS),
        "trials": _sql(f"SELECT * EXCLUDE (institution_id), {_TRIALS_TAIL} FROM linked", *_FOR_TRIALS),
        "any_source_links": _sql(
            f"""SELECT c.* EXCLUDE (institution_id), a.dois AS "ANYSOURCE_dois_matching_trialid",
            a.dois IS NOT NULL AS "ANYSOURCE_doi_found",
            CASE WHEN a.dois IS NOT NULL THEN '{_ANY_TEXT}' ELSE 'No {_ANY_TEXT}' END AS "ANYSOURCE_doi_found_PRETTY"
            FROM cleaned c LEFT JOIN (
                SELECT c.nct_id, trim(string_agg(lower(p.pair_doi), ' ' ORDER BY lower(p.pair_doi))) AS dois
                FROM cleaned c JOIN pairs p ON lower(c.nct_id) = lower(p.pair_id) GROUP BY c.nct_id) a
            ON lower(c.nct_id) = lower(a.nct_id)""",
            *_FOR_TRIALS,
        ),
        "enriched_doi": _sql(
            """SELECT doi, CAST(published_year AS BIGINT) AS published_year, published AS cr_published_date,
            green AS first_green_oa_date, license, extract_abstract AS abstract_pubmed FROM enriched""",
            *_FOR_WORKS,
        ),
        "pubs": _sql(f"SELECT {_PUB_COLUMNS}, {_PUBS_TAIL} FROM audited", *_FOR_PUBS),
        "export_order": _sql(
            """SELECT lower(listed_doi) AS doi, lower(work_doi) AS doi_academicobservatory,
            CAST(published_year AS BIGINT) AS published_year
            FROM audited ORDER BY published_year DESC NULLS LAST, work_doi ASC NULLS FIRST""",
            *_FOR_PUBS,
        ),
        "trials_matching_publication": _sql(
            """SELECT lower(p.listed_doi) AS doi, lower(p.work_doi) AS doi_academicobservatory,
            t.trial_list AS "TRIALSDATA_matching_doi_CONCAT",
            t.doi IS NOT NULL AS "TRIALDATA_trialids_found_in_pubs",
            CASE WHEN t.doi IS NOT NULL THEN 'Trial dataset Trial-IDs found the institution''s publications'
                ELSE 'Trial dataset Trial-IDs not found in the institution''s publications' END
                AS "TRIALDATA_trialids_found_in_pubs_PRETTY"
            FROM audited p LEFT JOIN (
                SELECT doi, trim(string_agg(nct_id, ' ' ORDER BY nct_id)) AS trial_list
                FROM (SELECT nct_id, unnest(string_split(trim("PUBSDATA_doi"), ' ')) AS doi
                      FROM linked WHERE "PUBSDATA_doi_found") GROUP BY doi) t
            ON lower(p.work_doi) = lower(t.doi)""",
            *_FOR_TRIALS, *_FOR_PUBS,
        ),
        "researcher_orcid": _sql(
            "SELECT nullif(orcid_id, 'NA') AS orcid_id_raw, "
            "CASE WHEN is_orcid THEN nullif(orcid_id, 'NA') END AS orcid_id, "
            + ", ".join(
                f"{flag}, CASE WHEN {flag} THEN '{yes}' ELSE '{no}' END AS \"{flag}_PRETTY\""
                for flag, yes, no in FLAGS
            )
            + """, 'orcid_query' AS "var_SQL_script_name", 'orcids' AS "var_ORCID_Dataset_name",
            'orcids_out' AS var_output_table FROM orcid_list""",
            "orcid_list",
        ),
        "pubmed_extract": _sql(
            """SELECT x.doi AS pubmed_doi, x.abstract AS "pubmed_Abstract", x.entries AS "pubmed_DataBankList"
            FROM (SELECT DISTINCT doi FROM listed_dois) l LEFT JOIN (
                SELECT pubmed_doi AS doi, min(pubmed_abstract) AS abstract,
                    string_agg(name || ':' || id, ';' ORDER BY name || ':' || id) AS entries
                FROM (SELECT pubmed_doi, pubmed_abstract, b.name AS name, unnest(b.ids) AS id
                      FROM (SELECT pubmed_doi, pubmed_abstract, unnest(banks) AS b FROM works
                            WHERE pubmed_doi IS NOT NULL))
                GROUP BY pubmed_doi) x ON lower(l.doi) = lower(x.doi)""",
            "works", "listed_dois",
        ),
        "table_audit": _sql(
            _audit(
                ("works", "works", "doi"),
                ("dois", "listed_dois", "doi"),
                ("oddpub", "odd", "doi"),
                ("trials_aact", "raw_trials", "nct_id"),
                ("orcids", "orcid_list", "orcid_id"),
                ("trials", "linked", "nct_id"),
            ),
            *_FOR_TRIALS, "odd", "orcid_list",
        ),
        "output_audit": _sql(
            _audit(
                ("alltrials", "combined", "doi"),
                ("pubs", "(SELECT lower(listed_doi) AS doi FROM audited)", "doi"),
                (
                    "researchers",
                    "(SELECT CASE WHEN is_orcid IS TRUE THEN nullif(orcid_id, 'NA') END AS orcid_id FROM orcid_list)",
                    "orcid_id",
                ),
                ("unpaywall", "access", "doi"),
            ),
            *_FOR_PUBS, "orcid_list",
        ),
        "metric_rollup": _sql(_rollup(), *_FOR_TRIALS),
        "utility_years": _sql(
            """SELECT CAST(unnest(generate_series(min(published_year), max(published_year))) AS BIGINT) AS year
            FROM audited""",
            *_FOR_PUBS,
        ),
        "dedupe_string": _sql(f"SELECT doc_id, {_dedupe('text')} AS deduped FROM documents"),
        "na_cast": _sql(
            f"""SELECT nct_id AS raw_id, {_na('nct_id')} AS as_string, registry_query_date AS as_date,
            completion_date AS as_datetime, {_na('is_prospective', 'BOOLEAN')} AS as_boolean,
            CASE WHEN is_prospective IS NOT NULL THEN length(is_prospective) END AS as_int FROM raw_trials""",
            "raw_trials",
        ),
        "first_green_date": _sql(
            """SELECT doi, list_sort(list_transform(list_filter(locations, lambda x: x.host = 'repository'),
            lambda y: y.day), 'ASC', 'NULLS FIRST')[1] AS first_green_oa_date FROM access""",
            "access",
        ),
        "month_boundary_diff": _sql(
            """SELECT o_orderkey, l_linenumber, CAST(date_diff('month', CAST(o_orderdate AS DATE),
            CAST(l_shipdate AS DATE)) AS BIGINT) AS months
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
        ),
        "array_string_agg": _sql(
            f"""SELECT doi, {_joined("list_transform(field_numbers, lambda x: trim(x.number))")} AS joined
            FROM works""",
            "works",
        ),
        "case_insensitive_left_join": _sql(
            """SELECT l.doi AS listed_doi, w.doi AS work_doi FROM listed_dois l
            LEFT JOIN works w ON lower(l.doi) = lower(w.doi)""",
            "works", "listed_dois",
        ),
        "many_institutions_trials": _by_institution(
            """SELECT c.*, k."PUBSDATA_doi", k."PUBSDATA_doi" IS NOT NULL AS "PUBSDATA_doi_found"
            FROM cleaned c LEFT JOIN institution_links k
            ON lower(c.nct_id) = lower(k.nct_id) AND c.institution_id = k.institution_id""",
            *_FOR_TRIALS, "institution_links",
        ),
        "many_institutions_pubs": _by_institution(
            f"SELECT institution_id, {_PUB_COLUMNS} FROM institution_audited",
            *_FOR_WORKS, "listed_dois", "odd", "institution_audited",
        ),
    }
    for name, columns in _GROUPS.items():
        if name == "open_data_code":
            final = f"""SELECT listed_doi AS doi, {columns} FROM (
                SELECT l.doi AS listed_doi, o.doi AS odd_doi, is_open_data, is_open_code
                FROM (SELECT DISTINCT doi FROM listed_dois) l LEFT JOIN odd o ON lower(l.doi) = lower(o.doi))"""
            found[name] = _sql(final, "listed_dois", "odd")
        elif name == "embargo_label":
            found[name] = _sql(f"SELECT doi AS work_doi, {_MONTHS} AS embargo, {columns} FROM enriched", *_FOR_WORKS)
        else:
            found[name] = _sql(f"SELECT doi AS work_doi, {columns} FROM enriched", *_FOR_WORKS)
    return found


ORACLE_SQL = _oracles()
