"""Random works against a plain Python statement of the list rules."""

from __future__ import annotations

import random
import re

from builders import work, works

from scholaudit.config import Provenance
from scholaudit.operators.trial_ids import REGISTRIES, TRIAL_ID
from scholaudit.plans.alltrials import alltrials

PROVENANCE = Provenance("v1", "doi1", "dois_1", "oddpub_1", "trials_1", "inst")


def joined(items):
    present = [item.strip() for item in items if item is not None]
    return " ".join(present).strip() if present else None


def text_ids(text):
    return list(dict.fromkeys(re.findall(TRIAL_ID, (text or "").upper())))


def expected_list(abstract, numbers, pubmed):
    """The combined list of a work whose DOI no other work shares."""
    parts = [joined(text_ids(abstract)) or "", "", joined(text_ids(pubmed[1])) or "", ""]
    if numbers:
        parts[1] = joined(number and number.upper() for number, _ in sorted(numbers, key=nulls_first))
    entries = [(ids, name) for name, ids in pubmed[2] if re.search(REGISTRIES, name)]
    if entries:
        ordered = sorted(entries, key=lambda entry: (entry[0] is not None, entry[0] or [], entry[1]))
        parts[3] = joined(one for ids, _ in ordered for one in ids or [])
    if None in parts:
        return ""
    text = " ".join(parts).replace("  ", " ").strip()
    return " ".join(dict.fromkeys(text.split(" ")))


def nulls_first(number):
    value, kind = number
    return (value is not None, (value or "").upper(), kind is not None, kind or "")


def test_combined_lists(spark):
    random.seed(7)
    ids = ["nct00000001", "NCT00000002", " NCT00000003 ", "ISRCTN4", None]
    words = ["nct00000001", "xNct000000029", "NCT0000", "plain", "{}", ""]
    banks = ["ISRCTN", "ClinicalTrials.gov", "GEO", "Other"]
    rows, expected = [], {}
    for place in range(200):
        doi = f"10.1/{place}"
        abstract = random.choice([None, "", "{}", " ".join(random.choices(words, k=3))])
        numbers = random.choice(
            [None, [], [(random.choice(ids), random.choice(["t", None])) for _ in range(random.randint(1, 3))]]
        )
        held = [
            (random.choice(banks), random.choice([None, [], random.choices([one for one in ids if one], k=2)]))
            for _ in range(random.randint(0, 3))
        ]
        pubmed = (doi.upper(), random.choice([None, "", " ".join(random.choices(words, k=2))]), held)
        rows.append(work(doi, abstract=abstract, numbers=numbers, pubmed=pubmed))
        expected[doi] = expected_list(abstract, numbers, pubmed)
    found = alltrials(works(spark, *rows), 1, PROVENANCE).select("doi", "ANYSOURCE_clintrial_idlist").collect()
    assert {row.doi: row.ANYSOURCE_clintrial_idlist for row in found} == expected
