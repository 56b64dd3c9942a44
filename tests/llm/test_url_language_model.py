from __future__ import annotations

import math
import random
import re
from collections import defaultdict

from scholaudit.llm import url_language_model as model


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return re.sub("[A-Z]", lambda letter: letter[0].lower(), host), slash + path


def rule(host, path):
    fits = []
    for text in model.RULES:
        domain, _, start = text.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append(text)
    return max(fits, key=len, default=None)


URLS = [
    "http://example.org/es/1", "http://WWW.Example.ORG/en/17", "https://a.b.org", "https://a.b.org/", "x.com/fr/",
    "ftp://badexample.org/es/", "http://x.com/fr/?a://b.org/", "http://x.com#/de/", "http://x.com/de/9", None, "",
    "://", "http://example.org/en/2", "http://org/", "http://a.net/q?x=1", "http://É.org/É", "http://a.com/FR/",
    "http://a.org\n/x", "http://" + "long/" * 500,
]


def test_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[0])], "page_id long, url string").selectExpr("*", "1 as host")
    found = model.judge_urls(pages, model.RULES).collect()
    assert len(found) == len(URLS) + 1
    for row in found:
        if row["page_id"] is None:
            continue
        host, path = parts(URLS[row["page_id"]])
        assert (row["host"], row["path"]) == (host, path)
        assert row["rule"] == rule(host, path)
        if row["rule"]:
            assert row["verdict"] == model.RULES[row["rule"]]
        assert row["verdict"] in ("allow", "block")


def brute_ratios(counts):
    chances = {}
    for side in (0, 1):
        seen = [defaultdict(int) for _ in range(model.ORDER + 1)]
        for gram, pair in counts.items():
            for order in range(model.ORDER + 1):
                seen[order][gram[model.ORDER - order :]] += pair[side]
        for gram in counts:
            chance = 1 / model.SYMBOLS
            for order in range(model.ORDER + 1):
                part = gram[model.ORDER - order :]
                after = {key: n for key, n in seen[order].items() if key[:-1] == part[:-1] and n}
                total, kinds = sum(after.values()), len(after)
                if total + kinds:
                    chance = (seen[order].get(part, 0) + kinds * chance) / (total + kinds)
            chances[gram, side] = chance
    return {gram: math.log(chances[gram, 0]) - math.log(chances[gram, 1]) for gram in counts}


def test_smoothing(spark):
    rnd = random.Random(1)
    counts = {"".join(rnd.choice("ab/") for _ in range(4)): (rnd.randint(0, 3), rnd.randint(0, 3)) for _ in range(40)}
    rows = spark.createDataFrame([(gram, *pair) for gram, pair in counts.items()], "gram string, accepted long, rejected long")
    found = {row["gram"]: row["ratio"] for row in model.log_ratios(rows.where("accepted + rejected > 0"), rows).collect()}
    for gram, ratio in brute_ratios(counts).items():
        assert math.isclose(found[gram], ratio, abs_tol=1e-9)


def test_learns_from_the_rules(spark):
    rnd = random.Random(3)
    good = [f"http://{rnd.choice(['news', 'daily'])}{place}.org/story/{place}" for place in range(300)]
    bad = [f"http://{rnd.choice(['casino', 'poker'])}{place}.com/de/win{place}" for place in range(300)]
    new = [f"http://news{place}.net/story/{place}" for place in range(50)]
    new += [f"http://casino{place}.net/win{place}" for place in range(50)]
    pages = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    verdicts = {row["page_id"]: row["verdict"] for row in model.judge_urls(pages, model.RULES).collect()}
    right = [verdicts[600 + place] == ("allow" if place < 50 else "block") for place in range(100)]
    assert sum(right) >= 95


def test_empty(spark):
    assert model.judge_urls(spark.createDataFrame([], "page_id long, url string"), model.RULES).count() == 0
