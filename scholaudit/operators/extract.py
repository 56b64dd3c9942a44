"""Data-bank extract straight from PubMed articles (superseded form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.functions.arrays import repeat_items


def pubmed_extract(articles: DataFrame, dois: DataFrame) -> DataFrame:
    """Abstract and (bank, accession number) entries per listed DOI.

    Articles without an accession number count as not found. Of several
    abstracts the smallest is taken, so that the result is stable.
    """
    targets = dois.select("doi").distinct().withColumn("doi_key", F.lower("doi"))
    keys = targets.select("doi_key").where(F.col("doi_key").isNotNull()).distinct()

    own_ids = "filter(PubmedData.ArticleIdList.ArticleId, one -> one.IdType = 'doi')"
    banks = (
        "filter(MedlineCitation.Article.DataBankList.DataBank, "
        "bank -> bank.AccessionNumberList.AccessionNumber IS NOT NULL)"
    )
    numbers = (
        f"flatten(transform({banks}, bank -> transform(bank.AccessionNumberList.AccessionNumber, "
        "number -> named_struct('name', bank.DataBankName, 'id', number))))"
    )
    flat = (
        articles.select(
            F.expr(f"explode({own_ids})").alias("article_id"),
            F.col("MedlineCitation.Article.Abstract.AbstractText").alias("abstract"),
            F.expr(numbers).alias("entries"),
        )
        .where(F.size("entries") > 0)
        .select(F.col("article_id.value").alias("pubmed_doi"), "abstract", "entries")
        .withColumn("doi_key", F.lower("pubmed_doi"))
        .join(keys, "doi_key", "left_semi")
    )
    # Equal articles of a DOI are counted first, so copies are gathered once.
    counted = flat.groupBy("doi_key", "pubmed_doi", "entries").agg(
        F.min("abstract").alias("abstract"), F.count(F.lit(1)).alias("n")
    )
    gathered = counted.groupBy("doi_key", "pubmed_doi").agg(
        F.min("abstract").alias("pubmed_Abstract"),
        F.sort_array(F.collect_list(F.struct("entries", "n"))).alias("lists"),
    )
    found = gathered.select(
        "doi_key",
        "pubmed_doi",
        "pubmed_Abstract",
        F.expr(f"flatten({repeat_items('lists', 'item.entries')})").alias("pubmed_DataBankList"),
    )
    return targets.join(found, "doi_key", "left").select("pubmed_doi", "pubmed_Abstract", "pubmed_DataBankList")
