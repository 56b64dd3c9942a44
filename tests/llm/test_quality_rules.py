from __future__ import annotations

import random
import re
from collections import Counter

from scholaudit.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def measures(text):
    text = text or ""
    words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for place, window in enumerate(windows):
        if counts[window] > 1:
            covered |= {place, place + 1, place + 2}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(text.count(symbol) for symbol in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(3, 8))) for _ in range(n))


def corpus():
    rnd = random.Random(2)
    notice, menu = prose(rnd, 12), prose(rnd, 70)
    rows = [(place, f"{prose(rnd, 80)}\n{notice}\n{prose(rnd, 20)}", "a") for place in range(40)]
    rows += [(100 + place, f"{prose(rnd, 15)}\n{menu.upper()}  \n{prose(rnd, 10)}", "b") for place in range(40)]
    rows += [(200 + place, rows[3][1], "c") for place in range(60)]  # copies are one document
    rows += [(300, None, None), (301, "", "a"), (302, "x x x x " * 30, "a"), (303, "a\nb\n\na\n \na # | <b>", None)]
    rows += [(None, prose(rnd, 60), None), (304, prose(rnd, 9000), "a"), (304, "z\u00a0z\x1cq " * 60, "a")]
    return rows


def test_measures(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = rules.rule_report(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((doc, *measures(text)) for doc, text, _ in rows), key=repr)


def test_boilerplate(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    kept = {row["doc_id"]: row for row in rules.rule_report(docs).where("doc_id < 300").collect()}
    assert all(kept[place]["kept"] and kept[place]["n_boilerplate_words"] == 12 for place in range(40))
    assert not any(kept[100 + place]["kept"] or kept[100 + place]["base_failed"] for place in range(40))
    assert all(kept[200 + place]["kept"] and kept[200 + place]["n_boilerplate_words"] == 0 for place in range(60))


def test_rows_that_stay(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "7 as rule_lines")
    kept = rules.apply_rules(docs)
    assert kept.columns == docs.columns
    found = {row["doc_id"]: row["text"] for row in kept.collect()}
    assert found[0] == "\n".join(rows[0][1].split("\n")[::2])
    assert found[205] == rows[3][1]
    assert 300 not in found and 302 not in found and 100 not in found and None in found
    assert kept.where("doc_id between 200 and 299").count() == 60


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert rules.rule_report(docs).count() == 0
    assert rules.apply_rules(docs).count() == 0


def mostly_shared(rnd):
    """Documents that are nearly all shared lines: with a few words of their own, and ten of thirty lines each."""
    three, thirty = [prose(rnd, 70) for _ in range(3)], [prose(rnd, 20) for _ in range(30)]
    rows = [(place, "\n".join([*three, prose(rnd, 6)]), "a") for place in range(300)]
    return rows + [(1000 + place, "\n".join(rnd.sample(thirty, 10)), "b") for place in range(300)]


def edited_copies(rnd):
    lines = [[*prose(rnd, rnd.randint(6, 40)).split()] for _ in range(8)]
    for place in range(1500):
        copy = [[prose(rnd, 1) if rnd.random() < 0.04 else word for word in line] for line in lines]
        yield (2000 + place, "\n".join(map(" ".join, copy)), "c")


def test_documents_of_mostly_shared_lines(spark):
    docs = spark.createDataFrame(mostly_shared(random.Random(3)), "doc_id long, text string, source string")
    found = rules.rule_report(docs).collect()
    assert {row["n_boilerplate_words"] for row in found if row["doc_id"] < 1000} == {210}
    assert {row["n_boilerplate_words"] for row in found if row["doc_id"] >= 1000} == {200}
    assert not any(row["kept"] for row in found)


def test_near_copies_are_one_document(spark):
    rows = list(edited_copies(random.Random(4)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = rules.rule_report(docs).collect()
    assert len(found) == 1500 and all(row["kept"] and row["n_boilerplate_words"] == 0 for row in found)
