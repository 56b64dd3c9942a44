from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from scholaudit.llm.bloom_dedup import duplicate_groups, exact_dedup

SPACE = re.compile(r"[\x20\x09-\x0d]")


def expected(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        key = hashlib.sha256(SPACE.sub("", text or "").encode()).hexdigest()
        groups[key].append((-len(text or ""), doc is None, doc or 0, doc))
    result = []
    for key, members in groups.items():
        members.sort(key=lambda member: member[:3])
        for place, member in enumerate(members):
            result.append((member[3], members[0][3], len(members), place == 0, key))
    return sorted(result, key=repr)


def cases():
    rnd = random.Random(3)
    rows = [(place, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 5)))) for place in range(300)]
    rows += [(400 + place, "hot  text" if place % 2 else "hot text") for place in range(200)]
    rows += [(700, None), (701, " \t\n"), (702, "x\u00a0y"), (703, "xy"), (703, "xy"), (None, "xy"), (None, None)]
    return rows


def test_groups(spark):
    rows = cases()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"bits_per_row": 1, "max_blocks": 1}):
        found = duplicate_groups(docs, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_rows_that_stay(spark):
    rows = cases()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "doc_id as sha_of_text", "1 as maybe_repeated", "'a.b' as `odd.name`"
    )
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    found = sorted((row["doc_id"] for row in kept.collect()), key=repr)
    assert found == sorted((row[0] for row in expected(rows) if row[3]), key=repr)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert duplicate_groups(docs).count() == 0
    assert exact_dedup(docs).count() == 0


def test_unique_rows_do_not_shuffle(spark):
    docs = spark.createDataFrame([(place, f"text {place}") for place in range(50)], "doc_id long, text string")
    plan = exact_dedup(docs)._jdf.queryExecution().optimizedPlan().toString()
    first = plan.split("Union")[1].split("Aggregate")[0]
    assert "Repartition" not in first and "Sort" not in first
