from __future__ import annotations

import random

import pytest

import corpus_pipeline


def corpus():
    rnd = random.Random(6)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8))) for _ in range(n))

    rows = [(place, prose(90), "en", f"s{place % 3}", 0) for place in range(60)]
    near = prose(200).split()
    for place in range(5):
        text = list(near)
        text[place * 20] = "changed"
        rows.append((100 + place, " ".join(text), "en", "s0", 0))
    rows += [(200, rows[0][1] + "  ", "en", "s1", 0), (201, rows[0][1], "en", "s2", 0)]
    rows += [(300, "too short", "en", "s1", 0), (301, None, None, None, None)]
    return rows


def test_stages(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    kept = {row[0] for row in rows} - {300, 301}
    for name, function in corpus_pipeline.STAGES[:4]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == names, name
        kept -= {"exact dedup": {0, 201}, "n-gram Jaccard join": {101, 102, 103, 104}}.get(name, set())
        assert {row["doc_id"] for row in docs.collect()} == kept, name
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {row["doc_id"] for row in result} == kept
    assert all(row["round_trip"] and row["n_tokens"] == len(row["token_ids"]) for row in result)


@pytest.mark.parametrize("place", range(5))
def test_empty(spark, place):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.STAGES[place][1](spark, docs, "").count() == 0
