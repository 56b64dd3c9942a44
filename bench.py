"""Headline timings: one JSON line on standard output.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and runs each query on
``local[BENCH_CPUS]`` into a sink that takes every row and column. Queries run
twice: ``queries`` holds the second run, ``first_run`` the one that also pays
for class loading and code generation.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from checks.queries import QUERIES
from scholaudit.session import build_session

HEADLINE = (
    "trial_ids_in_text",
    "registry_entries",
    "any_source_trials",
    "alltrials",
    "clean_trials",
    "trials_in_publications",
    "trials",
    "enriched_doi",
    "license_label",
    "pubs",
    "many_institutions_trials",
    "many_institutions_pubs",
    "table_audit",
    "pubmed_extract",
    "dedupe_string",
    "month_boundary_diff",
)


def timed(spark, sf_dir: str) -> dict[str, float]:
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    first, second = timed(spark, sf_dir), timed(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
