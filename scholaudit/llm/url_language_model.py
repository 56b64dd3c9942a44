"""URL filter: rules first, then the ratio of two character language models.

Rules name a host and the start of a path; they fit the host and all its
subdomains, and the longest fitting rule decides. The URLs that a rule decides
train two variable-order Markov models over characters, one for accepted and
one for rejected URLs: contexts of three, two, one and no characters, each
blended with the shorter one by Witten-Bell smoothing, down to equal chances.
A URL's score is the mean over its characters of the difference of the two
logarithms. One labelled URL in five is kept out of training and calibrates
the score: the threshold is the cut with the smallest balanced error there.

Characters are lower-cased and mapped to a fixed alphabet, so that the table
of four-character strings has at most 44 ** 4 rows; that bound allows it to be
broadcast. Different URLs are counted once each. Everything is native, and the
URLs' characters never shuffle: counting and scoring combine inside the tasks.

Defined cases: a null URL or one without ``://`` has an empty host and an
empty path, fits no rule and gets the verdict on the empty string. With no
labelled URL of some kind all scores are 0 and the verdict is ``allow``.
Repeated rows give repeated results; further columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, stage

ALLOW, BLOCK = "allow", "block"

#: Rules of the registered query.
RULES = {"org/": ALLOW, "example.org/es/": BLOCK, "example.org/en/1": BLOCK, "com/fr/": ALLOW, "com/de/": BLOCK}

ORDER = 3  # characters of context
ALPHABET = string.ascii_lowercase + string.digits + "./_%-"
OTHER, START, END = "~", "^", "$"
SYMBOLS = len(ALPHABET) + 3

FOLDS = 5  # one of them calibrates
BIN, BINS = 0.01, 500  # width of a bin of scores, and bins on either side of 0


PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    host, path = (F.coalesce(F.regexp_extract(url, PARTS, group), F.lit("")) for group in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def longest_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The text of the rule that decides and its verdict, both null if none fits."""
    chosen = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for text in sorted(rules, key=lambda text: (len(text), text)):
        domain, slash, start = text.partition("/")
        fits = F.startswith(path, F.lit(slash + start)) & (
            (host == domain) | F.endswith(host, F.lit("." + domain))
        )
        chosen = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(rules[text]).alias("verdict"))).otherwise(chosen)
    return chosen


def spelled(host: Column, path: Column) -> Column:
    """Host and path in the models' alphabet."""
    return F.regexp_replace(F.lower(F.concat(host, path)), f"[^{ALPHABET.replace('-', '')}-]", OTHER)


def grams(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per character of ``spelling``: the character after its context."""
    padded = F.concat(F.lit(START * ORDER), "spelling", F.lit(END))
    places = F.sequence(F.lit(1), F.length("spelling") + F.lit(1))
    return rows.withColumn("padded", padded).select(
        *keep, F.explode(F.transform(places, lambda i: F.substr(F.col("padded"), i, F.lit(ORDER + 1)))).alias("gram")
    )


def _last(name: str, n: int) -> Column:
    return F.substr(F.col(name), F.lit(ORDER + 2 - n), F.lit(n))


def log_ratios(counts: DataFrame, all_grams: DataFrame) -> DataFrame:
    """``(gram, ratio)`` for every gram: log P(accepted) - log P(rejected).

    ``counts`` has gram, accepted, rejected. At order k a character's chance
    is (n(context, character) + kinds * P of order k-1) / (n(context) + kinds),
    where kinds is the number of different characters seen after the context.
    """
    sides = ("accepted", "rejected")
    rows = all_grams.select("gram", *[F.lit(1.0 / SYMBOLS).alias(f"p_{side}") for side in sides])
    for order in range(ORDER + 1):
        seen = counts.groupBy(_last("gram", order + 1).alias("part")).agg(*[F.sum(side).alias(side) for side in sides])
        after = seen.groupBy(F.substr(F.col("part"), F.lit(1), F.lit(order)).alias("context")).agg(
            *[F.sum(side).alias(f"n_{side}") for side in sides],
            *[F.count_if(F.col(side) > 0).alias(f"kinds_{side}") for side in sides],
        )
        rows = (
            rows.withColumn("part", _last("gram", order + 1))
            .withColumn("context", F.substr(F.col("part"), F.lit(1), F.lit(order)))
            .join(seen, "part", "left")
            .join(after, "context", "left")
        )
        blended = {}
        for side in sides:
            total = F.coalesce(F.col(f"n_{side}"), F.lit(0))
            kinds = F.coalesce(F.col(f"kinds_{side}"), F.lit(0))
            own = F.coalesce(F.col(side), F.lit(0))
            below = F.col(f"p_{side}")
            blended[f"p_{side}"] = F.when(total + kinds > 0, (own + kinds * below) / (total + kinds)).otherwise(below)
        rows = rows.select("gram", *[value.alias(name) for name, value in blended.items()])
    return rows.select("gram", (F.log("p_accepted") - F.log("p_rejected")).alias("ratio"))


def scores(spellings: DataFrame, ratios: DataFrame) -> DataFrame:
    """``(spelling, score)``: the mean ratio over the characters, rounded to be stable."""
    return (
        grams(spellings, "spelling")
        .join(F.broadcast(ratios), "gram")
        .groupBy("spelling")
        .agg(F.round(F.avg("ratio"), 9).alias("score"))
    )


def best_threshold(scored: DataFrame) -> float:
    """The cut with the smallest balanced error; of equal ones the one closest to 0.

    Scores are counted in a fixed number of bins, which is all that reaches the driver.
    """
    place = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") / BIN)))
    counted = scored.groupBy(place.cast("int").alias("bin")).agg(
        *[F.count_if(F.col("label") == side).alias(side) for side in (ALLOW, BLOCK)]
    )
    counts = {row["bin"]: (row[ALLOW], row[BLOCK]) for row in counted.collect()}
    allowed = sum(pair[0] for pair in counts.values())
    blocked = sum(pair[1] for pair in counts.values())
    if not allowed or not blocked:
        return 0.0
    errors, below_allowed, below_blocked = {}, 0, 0
    for cut in range(-BINS, BINS + 2):
        errors[cut] = below_allowed / allowed + 1 - below_blocked / blocked
        add_allowed, add_blocked = counts.get(cut, (0, 0))
        below_allowed, below_blocked = below_allowed + add_allowed, below_blocked + add_blocked
    return min(errors, key=lambda cut: (round(errors[cut], 12), abs(cut), cut)) * BIN


def judge_urls(pages: DataFrame, rules: Mapping[str, str], id_column: str = "page_id", url_column: str = "url"):
    """One row per row: page_id, host, path, rule, verdict, score (null where a rule decides)."""
    host, path = host_and_path(column(pages, url_column).cast("string"))
    parsed = pages.select(column(pages, id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = stage(parsed, "urls").withColumn("decided", longest_rule(F.col("host"), F.col("path"), rules))
    rows = ruled.select(
        "page_id",
        "host",
        "path",
        F.col("decided.rule").alias("rule"),
        F.col("decided.verdict").alias("label"),
        spelled(F.col("host"), F.col("path")).alias("spelling"),
    )

    spellings = stage(rows.select("spelling", "label").distinct(), "spellings")
    fold = F.pmod(F.xxhash64("spelling"), F.lit(FOLDS))
    labelled = spellings.where("label is not null")
    counts = (
        grams(spellings.withColumn("train", F.col("label").isNotNull() & (fold != 0)), "label", "train")
        .groupBy("gram")
        .agg(
            F.count_if(F.col("train") & (F.col("label") == ALLOW)).alias("accepted"),
            F.count_if(F.col("train") & (F.col("label") == BLOCK)).alias("rejected"),
        )
    )
    counts = stage(counts, "gram_counts")
    both = counts.agg(F.sum("accepted"), F.sum("rejected")).first()
    ratios = counts.select("gram", F.lit(0.0).alias("ratio"))
    if both[0] and both[1]:
        ratios = stage(log_ratios(counts.where("accepted + rejected > 0"), counts), "log_ratios")

    held_out = labelled.where(fold == 0)
    threshold = best_threshold(held_out.join(scores(held_out.select("spelling").distinct(), ratios), "spelling"))
    open_scores = stage(scores(spellings.where("label is null").select("spelling").distinct(), ratios), "scores")
    own = F.when(F.col("score") >= F.lit(threshold), F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    decided = rows.where("label is not null").select(
        "page_id", "host", "path", "rule", F.col("label").alias("verdict"), F.lit(None).cast("double").alias("score")
    )
    scored = (
        rows.where("label is null")
        .join(open_scores, "spelling", "left")
        .select("page_id", "host", "path", "rule", own.alias("verdict"), "score")
    )
    return decided.unionByName(scored)


def accepted_pages(pages: DataFrame, rules: Mapping[str, str], id_column: str = "page_id", url_column: str = "url"):
    """The ids of the pages that may stay, each once."""
    judged = judge_urls(pages, rules, id_column, url_column)
    return judged.where(F.col("verdict") == ALLOW).select("page_id").distinct()


