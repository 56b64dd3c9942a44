"""Researchers' ORCID records (earlier form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.functions.casts import cast_boolean, cast_string
from scholaudit.functions.sql import either

# Flag, label when TRUE, label otherwise.
FLAGS = (
    ("is_orcid", "ORCID found for researcher", "No ORCID found for researcher"),
    ("orcid_verified", "Verified ORCID found for researcher", "No verified ORCID found for researcher"),
    ("is_affiliation", "ORCID affiliation found for researcher", "No ORCID affiliation found for researcher"),
)


def researcher_orcid(orcids: DataFrame, script_name: str, dataset_name: str, output_table: str) -> DataFrame:
    """Cleaned ids, given only where the record is an ORCID, with labelled flags."""
    orcid = F.expr(cast_string("orcid_id"))
    labelled = []
    for flag, yes, no in FLAGS:
        labelled += [
            F.expr(cast_boolean(flag)).alias(flag),
            F.expr(either(flag, yes, no)).alias(f"{flag}_PRETTY"),
        ]
    return orcids.select(
        orcid.alias("orcid_id_raw"),
        F.when(F.col("is_orcid"), orcid).alias("orcid_id"),
        *labelled,
        F.lit(script_name).alias("var_SQL_script_name"),
        F.lit(dataset_name).alias("var_ORCID_Dataset_name"),
        F.lit(output_table).alias("var_output_table"),
    )
