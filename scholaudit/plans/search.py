"""Everything that the outputs need of works, from one scan with texts.

The jobs read works twice. The first pass is narrow: the DOI, the year and the
entries of each work, written aside, from which the shared keys and their
evidence come. The second reads texts and facts once, meets one table of keys,
and yields rows of several kinds, which are written together:

    table      a work's row of ``alltrials``; where the work's key is not
               shared, one row that holds for every cutoff its year passes
    edition    the rows of works with shared keys, per cutoff, if there are several
    extract    what publications take over from ``alltrials``, for listed DOIs
    facts      what publications take from a work, for listed DOIs
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaudit.operators.publications import WORK_FACTS
from scholaudit.operators.trial_ids import (
    any_source_trials,
    entries_of,
    group_evidence,
    id_list_strings,
    narrow_works,
    search_texts,
    shared_keys,
    text_columns,
    write_out_entries,
)
from scholaudit.plans.alltrials import COLUMNS, CUTOFF, passed_cutoffs, with_cutoffs
from scholaudit.sources.staging import Keep

KIND = "kind"
TABLE, EDITION, EXTRACT, FACTS = "table", "edition", "extract", "facts"

# The crossref abstract comes with the texts.
_FACTS = {name: text for name, text in WORK_FACTS.items() if name != "abstract_crossref"}


def work_keys(works: DataFrame, dois: DataFrame, cutoffs: Iterable[int], keep: Keep) -> DataFrame:
    """(doi_key, is_listed, is_shared, editions): the keys that need more than the work itself.

    ``editions`` holds the evidence of a shared key per cutoff. The only pass
    over works is narrow; a written table of few rows comes out of it.
    """
    years = sorted(set(cutoffs))
    narrow = keep(narrow_works(works), "narrow")
    recent = narrow.where(F.col("published_year") > F.lit(years[0]))
    shared = keep(shared_keys(recent), "shared")
    entries = with_cutoffs(entries_of(recent), years).withColumn("doi_key", F.lower("doi"))
    evidence = group_evidence(entries.join(shared, "doi_key", "left_semi"), (CUTOFF,))
    edition = F.struct(CUTOFF, "entries")
    grouped = evidence.groupBy("doi_key").agg(F.collect_list(edition).alias("editions"))  # one for each cutoff
    listed = dois.select(F.lower("doi").alias("doi_key")).where("doi_key IS NOT NULL").distinct()
    marks = (
        listed.select("doi_key", F.lit(True).alias("is_listed"), F.lit(False).alias("is_shared"))
        .unionByName(shared.select("doi_key", F.lit(False).alias("is_listed"), F.lit(True).alias("is_shared")))
        .groupBy("doi_key")
        .agg(F.max("is_listed").alias("is_listed"), F.max("is_shared").alias("is_shared"))
    )
    return keep(marks.join(grouped, "doi_key", "left"), "keys")


def search_works(works: DataFrame, keys: DataFrame, cutoffs: Iterable[int]) -> DataFrame:
    """Rows of all kinds: kind, cutoff, the columns of ``alltrials``, ``facts`` and the key."""
    years = sorted(set(cutoffs))
    passed = passed_cutoffs(years)
    shared_as = EDITION if len(years) > 1 else TABLE
    base = works.select(
        *text_columns(works, own=True),
        F.struct(*[F.expr(text).alias(name) for name, text in _FACTS.items()]).alias("facts"),
    )
    met = base.join(keys, "doi_key", "left").withColumns(
        {"is_listed": F.expr("coalesce(is_listed, FALSE)"), "is_shared": F.expr("coalesce(is_shared, FALSE)")}
    )

    def out(kind: str, cutoff: str) -> str:
        return f"named_struct('{KIND}', '{kind}', '{CUTOFF}', {cutoff})"

    own = f"if(size({passed}) > 0 AND NOT is_shared, array({out(TABLE, 'CAST(NULL AS BIGINT)')}), array())"
    editions = f"if(is_shared, transform({passed}, cutoff -> {out(shared_as, 'cutoff')}), array())"
    facts = f"if(is_listed, array({out(FACTS, 'CAST(NULL AS BIGINT)')}), array())"
    wanted = met.withColumn("outs", F.expr(f"concat({own}, {editions}, {facts})")).where("size(outs) > 0")
    tagged = search_texts(wanted).withColumn("out", F.explode("outs")).drop("outs")

    is_facts = F.col(f"out.{KIND}") == FACTS
    edition = f"get(filter(editions, one -> one.{CUTOFF} = out.{CUTOFF}), 0).entries"
    entries = F.when(~is_facts, F.coalesce(F.expr(edition), "own_entries"))
    joined = tagged.withColumn("entries", entries).drop("own_entries", "editions")
    complete = any_source_trials(
        id_list_strings(write_out_entries(joined, [name for name in joined.columns if name != "entries"]))
    )

    # After the rows of several spellings are written out, so that publications meet each of them.
    of_publications = f"transform(if(out.{CUTOFF} IS NULL, {passed}, array(out.{CUTOFF})), cutoff -> {out(EXTRACT, 'cutoff')})"
    outs = f"concat(array(out), if(is_listed AND out.{KIND} <> '{FACTS}', {of_publications}, array()))"
    rows = complete.withColumn("row", F.explode(F.expr(outs)))
    kind = F.col(f"row.{KIND}")
    of_table, of_facts, of_extract = kind.isin(TABLE, EDITION), kind == FACTS, kind == EXTRACT

    def kept(name: str) -> Column:
        used = of_table
        if name == "abstract_CROSSREF":
            used = used | of_facts
        if name == "abstract_PUBMED":
            used = used | of_extract
        return F.when(used, F.col(name)).alias(name)

    return rows.select(
        kind.alias(KIND),
        F.col(f"row.{CUTOFF}").alias(CUTOFF),
        *[kept(name) for name in COLUMNS],
        F.when(of_facts, F.col("facts")).alias("facts"),
        F.when(of_facts | of_extract, F.col("doi_key")).alias("doi_key"),
    )


def facts_of(found: DataFrame) -> DataFrame:
    """The rows of kind ``facts`` in the form of ``work_facts``."""
    return found.select("doi_key", "facts.*", F.col("abstract_CROSSREF").alias("abstract_crossref"))


def extract_of(found: DataFrame, edition: tuple[str, ...] = ()) -> DataFrame:
    """The rows of kind ``extract`` in the form of ``extract_facts``."""
    return found.select(*edition, "doi_key", F.col("abstract_PUBMED").alias("abstract_pubmed"))
