from __future__ import annotations

import json
import random
import re
import time
from collections import Counter

from scholaudit.llm import html_wrappers as wrappers

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav class=menu><ul><li><a>Home</a><li>News</ul></nav>
<div id="cookie-notice">We use cookies</div><div class="content post-{n}"><h1>Title &amp; more {n}</h1>
<p>First  para {n} with <b>bold</b> text&nbsp;here<p>Second para {n} has <i>lots</i> of words too<br>after a break
<div class="sidebar">Side</div><ul><li>One item {n}<li>Two items</ul>{more}<p class=tip>Always the same tip</div>
<div id=comments><p>Nice post {n}</div><form>Name<input></form><aside>About</aside><footer>&copy; me</footer></body></html>"""


def main_text(n, more=""):
    lines = [f"Title & more {n}", f"First para {n} with bold text here", f"Second para {n} has lots of words too", "after a break",
             f"One item {n}", "Two items"]
    return "\n".join([*lines, *([more] if more else [])])


def test_main_text(spark):
    rows = [(n, f"http://a.org/{n}", PAGE.format(n=n, more=f"<h2>Extra {n}</h2>" if n % 3 else "")) for n in range(20)]
    rows += [(100, "http://b.org/", "<article><h1>A</h1><p>b &lt;c&gt;</article><footer>f</footer>"), (101, None, None),
             (102, "x", ""), (103, "http://b.org/2", "plain <b>text"), (104, "http://c.org", "a < b <!-- x --> & c <unended"),
             (100, "http://b.org/", "<article><h1>A</h1><p>b &lt;c&gt;</article><footer>f</footer>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as wrapper")
    found = {row["page_id"]: row for row in wrappers.extract_pages(pages.repartition(3)).collect()}
    assert wrappers.extract_pages(pages).count() == len(rows)
    for n in range(20):
        assert found[n]["text"] == main_text(n, f"Extra {n}" if n % 3 else "")
        assert found[n]["n_chars"] == len(found[n]["text"])
    assert found[100]["text"] == "A\nb <c>"
    assert found[101]["text"] == found[102]["text"] == ""
    assert found[103]["text"] == "plain text"
    assert found[104]["text"] == "a < b & c <unended"


def test_empty(spark):
    assert wrappers.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_folding():
    assert wrappers.folded(["a", "a", "a", "b"]) == [[["a"], True, False, False], [["b"], False, False, False]]
    assert wrappers.folded(["h", "p", "h", "p", "x"]) == [[["h", "p"], True, False, False], [["x"], False, False, False]]


def test_alignment():
    first, second = (wrappers.folded(paths) for paths in (["h", "p", "f"], ["h", "q", "p", "p", "f"]))
    wrapper = wrappers.aligned(first, second)
    assert wrapper == [
        [["h"], False, False, False], [["q"], False, True, False], [["p"], True, False, False], [["f"], False, False, False]
    ]


def as_expression(wrapper):
    """The wrapper as a regular expression over slots of one letter."""
    parts = []
    for slots, repeated, optional, loose in wrapper:
        if loose:
            parts.append("(?:" + "".join(f"{slot}?" for slot in slots) + ")*")
        else:
            parts.append(f"(?:{''.join(slots)})" + {(0, 0): "", (1, 0): "+", (0, 1): "?", (1, 1): "*"}[repeated, optional])
    return "".join(parts)


def test_wrappers_fit_every_page_they_come_from():
    """Random hosts, from regular ones to free text; joined at once and in parts."""
    rnd = random.Random(1)
    for turn in range(300):
        letters = "abcdefgh"[: rnd.randint(2, 8)]
        core = [rnd.choice(letters) for _ in range(rnd.randint(1, 12))]
        pages = []
        for _ in range(rnd.randint(1, 12)):
            page = [letter for letter in core for _ in range(rnd.choice([1, 1, 1, 0, 2, 5]) if rnd.random() < 0.4 else 1)]
            if turn % 3 == 0:
                page += rnd.choices(letters, k=rnd.randint(0, 15))
            pages.append(page or ["a"])
        streams = [json.dumps(wrappers.folded(page)) for page in pages]
        halves = [wrappers.joined(streams[: len(pages) // 2]), wrappers.joined(streams[len(pages) // 2 :])]
        for text in (wrappers.joined(streams), wrappers.joined(half for half in halves if half != "[]")):
            wrapper = json.loads(text)
            form = re.compile(as_expression(wrapper))
            assert all(form.fullmatch("".join(page)) for page in pages), (pages, wrapper)
            places = Counter(slot for item in wrapper for slot in dict.fromkeys(item[0]))
            assert max(places.values()) <= wrappers.MOST_PLACES
            # A page's blocks all find their places, and each in an item that holds the slot.
            for page in pages:
                for place, path, _ in wrappers.block_positions(wrappers.placed(page), wrapper):
                    assert place < 0 or path in wrapper[place][0]


def test_wrappers_of_free_text_stay_small():
    rnd = random.Random(2)
    kinds = ["h2", "h3", "p", "ul/li", "blockquote", "pre", "table/tr/td"]
    sizes = {}
    for pages in (100, 10_000):
        streams = {
            json.dumps(wrappers.folded(["h1", *rnd.choices(kinds, k=rnd.randint(3, 40)), "f"])) for _ in range(pages)
        }
        parts = [wrappers.joined(sorted(streams)[at : at + 32]) for at in range(0, len(streams), 32)]
        sizes[pages] = len(wrappers.joined(parts))
    assert sizes[10_000] <= 1.2 * sizes[100] < 2000


def test_deep_pages_are_linear():
    page = "".join(f"<div>text {level} " for level in range(15_000))
    assert len(page) > 200_000
    start = time.perf_counter()
    found = wrappers.blocks(page)
    items = wrappers.placed(path for path, _ in found)
    wrappers.block_positions(items, wrappers.bounded([item[:4] for item in items]))
    counts = Counter(path for path, _ in found)
    assert wrappers.main_paths(counts)
    assert len(found) == 15_000 and time.perf_counter() - start < 2


def test_unclosed_quote_is_linear():
    start = time.perf_counter()
    wrappers.blocks('<a href="' * 20_000)
    wrappers.blocks('<a href="' * 20_000 + "<p>end</p>")
    wrappers.blocks("<" * 200_000)
    wrappers.blocks("<" * 200_000 + ">")
    assert time.perf_counter() - start < 5
    assert wrappers.blocks("<p>one<b title='x <p>two</p>")[-1][1].endswith("two")


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {row["page_id"]: row["text"] for row in wrappers.extract_pages(pages).collect()}


def test_positions_decide_inside_articles(spark):
    page = "<body><article><h1>T {n}</h1><p>Share this page<h2>S {n}</h2><p>Text of page {n}</article>"
    found = extracted(spark, [(n, f"http://d.org/{n}", page.format(n=n)) for n in range(12)])
    assert found == {n: f"T {n}\nS {n}\nText of page {n}" for n in range(12)}


def test_names_around_the_article(spark):
    forms = ["<body class='has-sidebar not-logged-in login'><article><p>{w}</article>",
             "<body><div class=content-with-sidebar><main><p>{w}</main></div>",
             "<body><div class=right-sidebar><p>{w}</div>",
             "<body><article><p>{w}</article><div id=comments><article><p>Nice</article></div>"]
    words = "some words of the article " * 4
    found = extracted(spark, [(n, f"http://h{n}.org/", form.format(w=words)) for n, form in enumerate(forms)])
    assert found == dict.fromkeys(range(4), words.strip())


def test_copies_of_a_page_are_one_page(spark):
    copy = "<body><div><p>First text of it<blockquote>A quotation</blockquote></div>"
    rows = [(n, f"http://e.org/{n}", copy) for n in range(12)]
    rows += [(100 + n, f"http://e.org/o{n}", f"<body><div><p>Other text {n}</div>") for n in range(12)]
    found = extracted(spark, rows)
    assert {found[n] for n in range(12)} == {"First text of it\nA quotation"}


def test_many_streams(spark):
    rows = [(n, f"http://f.org/{n}", "<article>" + "".join(f"<{t}>{t} {n}</{t}>" for k, t in enumerate(
        ("h1", "h2", "pre", "h3", "h4", "h5", "blockquote")) if (n + 1) >> k & 1) + "</article>") for n in range(100)]
    found = extracted(spark, rows)
    assert all(found[n].count("\n") + 1 == bin(n + 1).count("1") for n in range(100))


def test_headings_that_all_pages_share_are_kept(spark):
    page = "<body><nav>Menu</nav><article><h1>Dish {n}</h1><h2>Ingredients</h2><ul><li>Salt {n}<li>Oil {n}</ul><h3>Method</h3><p>Cook {n} well</article>"
    found = extracted(spark, [(n, f"http://r.org/{n}", page.format(n=n)) for n in range(40)])
    assert found == {n: f"Dish {n}\nIngredients\nSalt {n}\nOil {n}\nMethod\nCook {n} well" for n in range(40)}


def test_a_notice_before_paragraphs_is_removed(spark):
    page = "<body><article><p>We use cookies on this site<p>First text of {n}<p>Second text of {n}</article>"
    for pages in (3, 40):
        found = extracted(spark, [(n, f"http://s{pages}.org/{n}", page.format(n=n)) for n in range(pages)])
        assert found == {n: f"First text of {n}\nSecond text of {n}" for n in range(pages)}


def test_topics_inside_articles_are_no_marks(spark):
    page = (
        "<body><article><h1>T {n}</h1><div class='search-results'><p>Found {n}</div><section class='related-work'><p>Others {n}"
        "</section><p class=login>Log in as {n}</p><div class=comment-list><p>Nice {n}</div><p class=ad>Buy {n}</p>"
        "<div class='share buttons'>Share {n}</div><p>End of {n}</article>"
    )
    found = extracted(spark, [(n, f"http://t.org/{n}", page.format(n=n)) for n in range(12)])
    assert found == {n: f"T {n}\nFound {n}\nOthers {n}\nLog in as {n}\nEnd of {n}" for n in range(12)}
