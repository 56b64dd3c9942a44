"""Trial and data-bank identifiers found in works.

Sources per work: the two abstracts (row-local search), the Crossref
trial-number field and the PubMed data-bank list (both grouped by DOI).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaudit.functions.arrays import has_items, repeat_items
from scholaudit.functions.copies import count_copies
from scholaudit.functions.keys import doi_key
from scholaudit.functions.sql import literal
from scholaudit.functions.text import dedupe_string, split_on, string_agg, trim_ws
from scholaudit.sources.staging import Keep

# One registry's identifier form, and the names looked for in data-bank lists.
TRIAL_ID = "NCT[0-9][0-9][0-9][0-9][0-9][0-9][0-9][0-9]"
REGISTRIES = (
    "ANZCTR|ChiCTR|CRiS|ClinicalTrials\\.gov|CTRI|DRKS|EudraCT|IRCT|ISRCTN|JapicCTI|JMACCT|JPRN|NTR|PACTR|"
    "ReBec|REPEC|RPCEC|SLCTR|TCTR|UMIN CTR|UMIN-CTR"
)
DATABANKS = (
    "BioProject|dbGaP|dbSNP|dbVar|Dryad|figshare|GDB|GENBANK|GEO|OMIM|PIR|PubChem-BioAssay|PubChem-Compound|"
    "PubChem-Substance|RefSeq|SRA|SWISSPROT|UniMES|UniParc|UniProtKB|UniRef|PDB|Protein"
)

# The identifier form before upper-casing. The third N is the one other letter
# whose upper case ends in N.
TRIAL_ID_ANY_CASE = "[Nn\u0149][Cc][Tt]([0-9]{8})"
# What every identifier holds; a quicker search that most texts do not pass.
TRIAL_ID_TAIL = "(?i)ct[0-9]{8}"

PUBMED_ABSTRACT = "pubmed.MedlineCitation.Article.Abstract.AbstractText"
PUBMED_BANKS = "pubmed.MedlineCitation.Article.DataBankList"
FIELD = "crossref.clinical_trial_number"

# Kinds of grouped evidence.
REGISTRY, DATABANK, CROSSREF = "registry", "databank", "crossref"

# How an entry of each kind is shown in the output arrays.
_AS_BANK = "named_struct('id', item.ids, 'registry', item.label)"
_AS_FIELD = "named_struct('id', item.ids[0], 'type', item.label)"


def published_after(works: DataFrame, cutoff: int) -> DataFrame:
    """Works published strictly after the cutoff; an unknown year is dropped."""
    return works.where(F.col("crossref.published_year") > F.lit(cutoff))


def trial_ids_in_text(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Add ``<name>_found`` and ``<name>`` for each text (name to column).

    The ids are the distinct ones of the upper-cased text in order of
    appearance, as an array of structs, NULL when there are none; only the
    matches are looked at, so the text itself is never upper-cased. Empty and
    '{}' abstracts hold no id and need no case of their own.
    """
    form, tail = literal(TRIAL_ID_ANY_CASE), literal(TRIAL_ID_TAIL)
    # A projection of its own, so that each text is searched once.
    searched = df.withColumns(
        {
            f"_{name}": F.expr(
                f"if({text} RLIKE {tail}, array_distinct(regexp_extract_all({text}, {form}, 1)), NULL)"
            )
            for name, text in texts.items()
        }
    )
    found: dict[str, object] = {}
    for name in texts:
        ids = f"transform(_{name}, digits -> named_struct('id', concat('NCT', digits)))"
        found[f"{name}_found"] = F.expr(has_items(f"_{name}"))
        found[name] = F.expr(f"if(size(_{name}) > 0, {ids}, NULL)")
    return searched.withColumns(found).drop(*[f"_{name}" for name in texts])


def _bank_entries(names: str, kind: str) -> str:
    """One row's data-bank entries whose name matches, tagged with the kind."""
    matching = f"filter({PUBMED_BANKS}, bank -> bank.DataBankName RLIKE {literal(names)})"
    return (
        f"transform({matching}, bank -> named_struct('kind', {literal(kind)}, 'doi', pubmed.doi, "
        "'ids', bank.AccessionNumberList, 'label', bank.DataBankName))"
    )


_FIELD_ENTRIES = (
    f"transform({FIELD}, number -> named_struct('kind', {literal(CROSSREF)}, 'doi', doi, "
    "'ids', array(upper(number.clinical_trial_number)), 'label', number.type))"
)
_ENTRIES = {
    REGISTRY: _bank_entries(REGISTRIES, REGISTRY),
    DATABANK: _bank_entries(DATABANKS, DATABANK),
    CROSSREF: _FIELD_ENTRIES,
}


# One work's entries under its own DOI, in the form of grouped evidence.
_OWN_ENTRIES = (
    "sort_array(transform(filter(concat("
    + ", ".join(f"coalesce({entries}, array())" for entries in _ENTRIES.values())
    + "), item -> lower(item.doi) = lower(doi)), "
    "item -> named_struct('kind', item.kind, 'doi', item.doi, 'ids', item.ids, 'label', item.label, 'n', 1L)))"
)


def narrow_works(works: DataFrame, kinds: Sequence[str] = tuple(_ENTRIES)) -> DataFrame:
    """(published_year, work_key, entries) of works that have a key or entries, from one narrow scan.

    Entries are those of the asked kinds; ``own`` tells that an entry carries
    the DOI of its own work. Entries without a DOI are left out: they match no
    work.
    """
    lists = ", ".join(f"coalesce({_ENTRIES[kind]}, array())" for kind in kinds)
    marked = (
        f"transform(filter(concat({lists}), item -> item.doi IS NOT NULL), item -> named_struct('kind', item.kind, "
        "'doi', item.doi, 'ids', item.ids, 'label', item.label, 'own', coalesce(lower(item.doi) = lower(doi), FALSE)))"
    )
    return works.select(
        F.col("crossref.published_year").alias("published_year"),
        F.lower("doi").alias("work_key"),
        F.expr(marked).alias("entries"),
    )


def entries_of(narrow: DataFrame) -> DataFrame:
    """(published_year, kind, doi, ids, label, own): a row per entry."""
    return narrow.select("published_year", F.expr("inline(entries)"))


def evidence_rows(works: DataFrame, kinds: Sequence[str] = tuple(_ENTRIES)) -> DataFrame:
    """The entries of the asked kinds of all works."""
    return entries_of(narrow_works(works, kinds))


def _entries_by_doi(works: DataFrame, kind: str, shown: str, name: str) -> DataFrame:
    """One kind's entries per DOI as spelled, sorted, repeats kept."""
    grouped = (
        count_copies(evidence_rows(works, [kind]), "doi", "ids", "label")
        .groupBy("doi")
        .agg(F.sort_array(F.collect_list(F.struct("ids", "label", "n"))).alias("entries"))
    )
    return grouped.select("doi", F.expr(repeat_items("entries", shown)).alias(name))


# Entries of a page, about.
PAGE = 10_000


def entry_pages(works: DataFrame, cutoff: int, kind: str, page: int = PAGE) -> DataFrame:
    """(doi, page, entries): the entries of a kind per DOI in lists of bounded length, repeats kept.

    Beside the list form, for DOIs that very many entries name. Equal entries
    are counted first, and more copies than a page holds are several entries.
    A DOI has as many pages as its number of entries asks for; entries are
    dealt to them by hash, so a page is found without the others and no group
    gathers more than about a page. Each page is sorted. Pages of one DOI
    together are its list.
    """
    counted = count_copies(evidence_rows(published_after(works, cutoff), [kind]), "doi", "ids", "label")
    # A DOI with one page, as nearly all have, is not in this table, so it is short beside the entries.
    long = (
        counted.groupBy("doi").agg(F.sum("n").alias("_n")).where(F.col("_n") > page)
        .selectExpr("doi", f"(_n + {page} - 1) div {page} AS _pages")
    )
    parts = counted.selectExpr("doi", "ids", "label", "n", f"explode(sequence(0L, (n - 1) div {page})) AS _part")
    paged = parts.join(long, "doi", "left").selectExpr(
        "doi",
        "coalesce(pmod(xxhash64(ids, label, _part), _pages), 0L) AS page",
        "ids",
        "label",
        f"least(n - _part * {page}, {page}L) AS n",
    )
    grouped = paged.groupBy("doi", "page").agg(F.sort_array(F.collect_list(F.struct("ids", "label", "n"))).alias("entries"))
    shown = _AS_FIELD if kind == CROSSREF else _AS_BANK
    return grouped.select("doi", "page", F.expr(repeat_items("entries", shown)).alias("entries"))


def registry_entries(works: DataFrame, cutoff: int) -> DataFrame:
    """Trial-registry entries per PubMed DOI."""
    return _entries_by_doi(published_after(works, cutoff), REGISTRY, _AS_BANK, "PUBMED_clintrial_fromfield")


def databank_entries(works: DataFrame, cutoff: int) -> DataFrame:
    """Open-data bank entries per PubMed DOI."""
    return _entries_by_doi(published_after(works, cutoff), DATABANK, _AS_BANK, "PUBMED_opendata_fromfield")


def trial_ids_in_field(works: DataFrame) -> DataFrame:
    """(doi, found flag, entries) of the Crossref trial-number field.

    The flag looks at the work's own field; the upper-cased entries are those
    of every work with the DOI so spelled, matched without regard to case.
    """
    entries = _entries_by_doi(works, CROSSREF, _AS_FIELD, "CROSSREF_clintrial_fromfield")
    flagged = works.select(
        "doi", doi_key(works), F.expr(has_items(FIELD)).alias("CROSSREF_clintrial_fromfield_found")
    )
    return flagged.join(entries.select(doi_key(entries), "CROSSREF_clintrial_fromfield"), "doi_key", "left").drop(
        "doi_key"
    )


def group_evidence(rows: DataFrame, edition: Sequence[str] = ()) -> DataFrame:
    """Entries with their numbers, sorted, one row per join key.

    Equal entries are counted first, so a group gathers distinct ones only.
    """
    entry = F.struct("kind", "doi", "ids", "label", "n")
    return (
        count_copies(rows, *edition, "kind", "doi", "ids", "label")
        .groupBy(*edition, F.lower("doi").alias("doi_key"))
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )


def trial_evidence(works: DataFrame) -> DataFrame:
    """All grouped evidence of the works."""
    return group_evidence(evidence_rows(works))


def shared_keys(narrow: DataFrame) -> DataFrame:
    """Keys whose evidence does not come from one work alone.

    These are DOIs of several works, and DOIs of a work that entries of
    another work name. Keys that no work has, such as a placeholder, are not
    among them. One narrow scan and shuffle, with repeats combined before it.
    """
    own = "named_struct('doi_key', work_key, 'n_works', 1, 'is_named', FALSE)"
    named = "named_struct('doi_key', lower(item.doi), 'n_works', 0, 'is_named', TRUE)"
    marks = narrow.select(
        F.expr(f"inline(concat(array({own}), transform(filter(entries, item -> NOT item.own), item -> {named})))")
    )
    return (
        marks.where("doi_key IS NOT NULL")
        .groupBy("doi_key")
        .agg(F.sum("n_works").alias("n_works"), F.max("is_named").alias("is_named"))
        .where("n_works > 1 OR (n_works = 1 AND is_named)")
        .select("doi_key")
    )


def shared_evidence(
    narrow: DataFrame, keep: Keep, rows: DataFrame | None = None, edition: Sequence[str] = ()
) -> DataFrame:
    """Grouped evidence for the shared keys only.

    Every other work has its own entries at hand (``text_evidence`` with
    ``own``). In a table of one row per DOI the shared keys are few, so the
    works meet a small table and stay where they are. ``rows`` may hold the
    entries with their edition.
    """
    entries = (entries_of(narrow) if rows is None else rows).withColumn("doi_key", F.lower("doi"))
    shared = keep(shared_keys(narrow), "shared")
    return keep(group_evidence(entries.join(shared, "doi_key", "left_semi"), edition), "evidence")


def text_columns(works: DataFrame, own: bool = False) -> list[Column]:
    """What ``alltrials`` takes from a work before its texts are searched.

    With ``own`` also the entries that the work holds under its own DOI.
    """
    return [
        F.col("doi"),
        doi_key(works),
        F.col("crossref.published_year").alias("published_year"),
        F.col("crossref.abstract").alias("abstract_CROSSREF"),
        F.col(PUBMED_ABSTRACT).alias("abstract_PUBMED"),
        F.expr(has_items(FIELD)).alias("CROSSREF_clintrial_fromfield_found"),
        *([F.expr(_OWN_ENTRIES).alias("own_entries")] if own else []),
    ]


def search_texts(base: DataFrame) -> DataFrame:
    return trial_ids_in_text(
        base,
        {
            "CROSSREF_clintrial_fromabstract": "abstract_CROSSREF",
            "PUBMED_clintrial_fromabstract": "abstract_PUBMED",
        },
    )


def text_evidence(works: DataFrame, own: bool = False) -> DataFrame:
    """The row-local part of ``alltrials``: abstracts and the ids found in them."""
    return search_texts(works.select(*text_columns(works, own)))


def _by_spelling(kind: str) -> str:
    """One kind's entries as a list per spelling of the DOI.

    Lists belong to a DOI as spelled but are matched without regard to case,
    so a work is repeated for every spelling that has a list of the kind.
    """
    own = f"filter(entries, item -> item.kind = {literal(kind)})"
    spellings = f"array_distinct(transform({own}, item -> item.doi))"
    return f"transform({spellings}, spelling -> filter({own}, item -> item.doi = spelling))"


def attach_evidence(works: DataFrame, evidence: DataFrame, edition: Sequence[str] = ()) -> DataFrame:
    """Join the grouped evidence to the works and write out its entries.

    Works that carry their own entries use them where no evidence is joined;
    evidence of a shared key includes them.
    """
    return attach_entries(works.join(evidence, [*edition, "doi_key"], "left"), "entries")


def attach_entries(joined: DataFrame, entries: str, drop: Sequence[str] = ()) -> DataFrame:
    """The same where a work's grouped evidence is at hand as an expression."""
    own = ", own_entries" if "own_entries" in joined.columns else ""
    left_out = {"entries", "own_entries", *drop}
    met = joined.withColumn("entries", F.expr(f"coalesce({entries}{own})"))
    return write_out_entries(met, [name for name in joined.columns if name not in left_out])


def write_out_entries(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns, and the lists that ``entries`` hold by kind; a row per spelling of the DOI that has a list."""
    for kind in (REGISTRY, DATABANK, CROSSREF):
        joined = joined.withColumn(kind, F.expr(f"explode_outer({_by_spelling(kind)})"))
    return joined.select(
        *columns,
        F.expr(repeat_items(REGISTRY, _AS_BANK)).alias("PUBMED_clintrial_fromfield"),
        F.col(REGISTRY).isNotNull().alias("PUBMED_clintrial_fromfield_found"),
        F.expr(repeat_items(DATABANK, _AS_BANK)).alias("PUBMED_opendata_fromfield"),
        F.col(DATABANK).isNotNull().alias("PUBMED_opendata_fromfield_found"),
        F.expr(repeat_items(CROSSREF, _AS_FIELD)).alias("CROSSREF_clintrial_fromfield"),
    )


def _flat_ids(entries: str) -> str:
    """Trimmed ids of entries that each hold one id."""
    return f"transform({entries}, entry -> {trim_ws('entry.id')})"


def _nested_ids(entries: str) -> str:
    """Trimmed ids of entries that each hold a list of ids, which may be NULL."""
    lists = f"transform({entries}, entry -> coalesce(entry.id, array()))"
    return f"transform(flatten({lists}), one -> {trim_ws('one')})"


def _list_or_blank(entries: str, ids: str) -> str:
    """'' without entries; NULL when there are entries but no id among them."""
    return f"if({entries} IS NULL, '', {trim_ws(string_agg(ids))})"


def id_list_strings(df: DataFrame) -> DataFrame:
    """Add the space-separated id list of each source."""
    flat = ("CROSSREF_clintrial_fromabstract", "CROSSREF_clintrial_fromfield", "PUBMED_clintrial_fromabstract")
    lists = {f"{name}_idlist": _list_or_blank(name, _flat_ids(name)) for name in flat}
    registry, databank = "PUBMED_clintrial_fromfield", "PUBMED_opendata_fromfield"
    lists[f"{registry}_idlist"] = _list_or_blank(registry, _nested_ids(registry))
    lists[f"{databank}_idlist"] = string_agg(_nested_ids(databank))
    return df.withColumns({name: F.expr(text) for name, text in lists.items()})


# Sources of trial ids, in the order of the combined list.
TRIAL_SOURCES = (
    "CROSSREF_clintrial_fromabstract",
    "CROSSREF_clintrial_fromfield",
    "PUBMED_clintrial_fromabstract",
    "PUBMED_clintrial_fromfield",
)


def any_source_trials(df: DataFrame) -> DataFrame:
    """Add the any-source flag and the combined, de-duplicated id list.

    Double spaces are squeezed in one pass only, so sources that are empty in
    between can leave an empty part in the list. A NULL list of one source
    makes the combined list empty.
    """
    found = " OR ".join(f"{source}_found" for source in TRIAL_SOURCES)
    combined = "concat(" + ", ' ', ".join(f"{source}_idlist" for source in TRIAL_SOURCES) + ")"
    squeezed = trim_ws(f"replace({combined}, '  ', ' ')")
    return df.withColumns(
        {
            "ANYSOURCE_clintrial_found": F.expr(f"coalesce({found}, FALSE)"),
            "ANYSOURCE_clintrial_idlist": F.expr(dedupe_string(squeezed)),
        }
    )


def flatten_trial_pairs(alltrials: DataFrame, edition: Sequence[str] = ()) -> DataFrame:
    """(DOI, trial id) pairs of the works with a trial id from any source."""
    ids = split_on(trim_ws("ANYSOURCE_clintrial_idlist"), " ")
    return (
        alltrials.where("ANYSOURCE_clintrial_found")
        .select(*edition, F.lower("doi").alias("ANYSOURCE_doi"), F.expr(f"explode({ids})").alias("one"))
        .select(*edition, "ANYSOURCE_doi", F.expr(f"upper({trim_ws('one')})").alias("ANYSOURCE_clintrial_id_flat"))
    )
