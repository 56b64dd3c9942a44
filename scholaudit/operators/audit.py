"""Counts used to check inputs and outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_audit(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows, distinct values and distinct non-null values of a column."""
    value = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(value).alias("n_distinct"),
    ).select(
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        "n_rows",
        "n_distinct",
        # count(distinct) skips NULL already, so both reports agree.
        F.col("n_distinct").alias("n_distinct_notnull"),
    )


def written_audit(df: DataFrame, column: str, name: str, rows: int) -> DataFrame:
    """The same for a table whose rows were counted while it was written; only the column is read."""
    distinct = df.agg(F.count_distinct(F.col(column)).alias("n_distinct"))
    return distinct.select(
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(rows).cast("bigint").alias("n_rows"),
        "n_distinct",
        F.col("n_distinct").alias("n_distinct_notnull"),
    )


def audit_tables(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table."""
    rows = [table_audit(df, column, name) for name, (df, column) in tables.items()]
    return reduce(DataFrame.unionByName, rows)


@dataclass(frozen=True)
class Metric:
    """What a dashboard number counts, and the labels and ranks that it is broken down by."""

    label: str
    counts: str
    rank: str | None = None


# The rank of results that came in time.
_IN_TIME = 1

# Metrics of the trials table. The first four are the numbers that the table's columns are named after.
TRIAL_METRICS = {
    "trials": Metric("nct_id_found_PRETTY", "nct_id_found"),
    "prospective_registrations": Metric("is_prospective_PRETTY", "is_prospective"),
    "results_within_1y": Metric(
        "summary_results_reporting_PRETTY",
        f"summary_results_reporting_GRAPHORDER = {_IN_TIME}",
        "summary_results_reporting_GRAPHORDER",
    ),
    "linked_references": Metric("has_linked_reference_PRETTY", "has_linked_reference"),
    "trial_id_in_publications": Metric("PUBSDATA_doi_found_PRETTY", "PUBSDATA_doi_found"),
}

LABEL, METRIC, TOTAL = "label", "metric", "total"


def metric_rollup(df: DataFrame, metrics: Mapping[str, Metric], scope: Sequence[str] = ()) -> DataFrame:
    """Rows, counted rows and share by label, by metric and in total (of each institution).

    ``level`` tells the three apart. ``n_counted`` is the metric's number,
    ``share`` the part of the metric's rows that have the label. Rows are
    counted by label on the map side; grouping sets over these few rows give
    metrics and totals, and a metric's labels are written out beside its sum.
    """
    shown = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(one.label).alias("label"),
            (F.col(one.rank) if one.rank else F.lit(None)).cast("bigint").alias("graph_order"),
            F.expr(f"bigint(coalesce({one.counts}, FALSE))").alias("counted"),
            F.lit(int(place == 0)).cast("bigint").alias("once"),  # a row of the table counts once in total
        )
        for place, (name, one) in enumerate(metrics.items())
    ]
    rows = df.select(*scope, F.inline(F.array(*shown)))
    by_label = rows.groupBy(*scope, "metric", "label", "graph_order").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("counted").alias("n_counted"), F.sum("once").alias("n_table")
    )
    label = F.struct("label", "graph_order", "n_rows", "n_counted")
    sets = by_label.groupingSets([[*scope, "metric"], list(scope)], *scope, "metric").agg(
        F.grouping("metric").alias("is_total"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_counted").alias("n_counted"),
        F.sum("n_table").alias("n_table"),
        F.collect_list(label).alias("labels"),  # one entry for each label of the metric
    )

    def row(level: str, label: str, order: str, rows: str, counted: str, share: str) -> str:
        return (
            f"named_struct('level', '{level}', 'label', {label}, 'graph_order', {order}, 'n_rows', {rows}, "
            f"'n_counted', {counted}, 'share', {share})"
        )

    no_label, no_order, no_count, no_share = (f"CAST(NULL AS {kind})" for kind in ("STRING", "BIGINT", "BIGINT", "DOUBLE"))
    total = row(TOTAL, no_label, no_order, "n_table", no_count, no_share)
    metric = row(METRIC, no_label, no_order, "n_rows", "n_counted", "1.0D")
    share = "double(one.n_rows) / double(n_rows)"
    every = row(LABEL, "one.label", "one.graph_order", "one.n_rows", "one.n_counted", share)
    written = f"inline(if(is_total = 1, array({total}), concat(array({metric}), transform(labels, one -> {every}))))"
    return sets.select(*scope, "metric", F.expr(written))


def utility_years(pubs: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every year between the first and the last publication (of each institution)."""
    bounds = pubs.groupBy(*scope).agg(F.min("published_year").alias("first"), F.max("published_year").alias("last"))
    return bounds.where("first IS NOT NULL").select(*scope, F.expr("explode(sequence(first, last))").alias("year"))
