"""Main text of web pages by wrappers that are inferred for each host.

A page is a stream of text blocks, each with the open tags above it. A wrapper
is a regular expression without alternatives over such tokens: a sequence of
text slots and groups of slots, each of which may be optional, repeated, or
both. It is inferred as follows. Within a page, a run of equal neighbours (or
of equal sequences of up to four slots) becomes a repeated group. Two
streams of one host are then aligned; a mismatch that equals its neighbour
makes that one repeated, and any other mismatch becomes optional. A slot that
would stand in more than ``MOST_PLACES`` places of the wrapper belongs to free
text: all between its first and last place becomes one repeated group of
optional slots, so a wrapper has a few places for each kind of slot, however
many pages it is inferred from. Texts are never compared in this step, they
fill slots. Wrappers align with wrappers in the same way, so streams are made
different first, joined in parts and then joined again, and no task sees all
pages of a host.

Each page is aligned with its host's wrapper. A block's position is its place
in the wrapper, its slot, and whether a repeated group begins with it. Positions are labelled for each host, with counts
over its different pages: pages, words and different texts. The main part is
the article or main element, or without one the innermost element with most of
the words. Not part of it are navigation, headers and footers outside of the
main part, sidebars, forms, notices, adverts and comments, known by their tags,
roles and class names. Inside article and main, names count only if all their
parts are known ones (``comment-list``, not ``related-work``), and on
paragraphs, headings, list items and the like only those of adverts and
notices. A block that is no heading is a notice, inside articles too, if its
position holds one and the same text on every page that has it, on three
different pages or more and on half of the host's, while others vary; later
blocks of a repeated group only if its first one is. Names
don't count on html, body and elements around most of the main part, nor if
nothing were left. A page gives the texts of its main positions; a page that
has none of them is labelled alone, by the same rules.

Blocks end at block elements and line breaks. In a block, character references
are decoded, white space becomes one space and the ends are trimmed; empty
blocks are left out.

Defined cases: null html is the empty page, with an empty text. A null URL or
one without a host belongs to the host ''. Elements below ``MOST_DEEP`` open
ones are read as their children, as browsers do. Repeated rows
give repeated results and are counted as one page. Empty tables give empty
results. Further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import difflib
import html
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, ship_package, slices, stage, whole_text
from scholaudit.llm.url_language_model import host_and_path

PART_STREAMS = 32  # wrappers of a host that one task joins
SAME_TEXT_PAGES, SAME_TEXT_SHARE = 3, 0.5
MOST_PLACES = 3
MOST_DEEP = 256
LONG_NAME = 200
MOST_WORDS = 0.7

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr img ruby rt rp".split()
)
RAW = set("script style textarea title xmp iframe noembed noframes".split())
# An element that starts ends these open ones, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# Names that mark what isn't the main text.
OUTSIDE_TAGS = set(
    "head nav footer aside form script style noscript template button select textarea svg iframe dialog menu title "
    "object canvas".split()
)
OUTSIDE_NAMES = set(
    "ad ads adbox adsense advert adverts advertisement banner sponsor sponsored promo promotion sidebar rail widget "
    "comment comments disqus reply replies respond cookie cookies consent gdpr notice notices alert modal popup overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager share sharing social related recommended "
    "newsletter subscribe signup login search footer masthead skip toolbar".split()
)
# Of these, the ones that no part of an article is called.
NEVER_TEXT = set(
    "ad ads adbox adsense advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr nav navbar navigation breadcrumb breadcrumbs pagination pager share sharing newsletter subscribe".split()
)
# Words that only say where or how large a part is.
LAYOUT_NAMES = set(
    "area article articles author bar block body bottom box button buttons center col column container content entry "
    "footer form group head header holder icons inner item items left links list main outer page panel post posts "
    "right row section site slot stories text thread title top unit wrap wrapper".split()
)
TEXT_TAGS = set("p li h1 h2 h3 h4 h5 h6 td th dd dt pre blockquote figcaption caption".split())
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
MAIN_TAGS = ("article", "main")

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|([^<]++|<)""", re.S
)
# After a quote that never ends: tags go up to the next bracket.
TOKEN_WITHOUT_QUOTES = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|([^<]++|<)""", re.S
)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
DIGITS = re.compile(r"\d+")


def element_name(tag: str, attributes: str) -> str:
    """The tag with its classes, id and role, numbers left out."""
    parts = [tag]
    if attributes:
        for kind, value in ATTRIBUTE.findall(attributes):
            value = DIGITS.sub("", value.strip("\"'").lower())
            mark = {"class": ".", "id": "#", "role": "@"}[kind.lower()]
            parts += [mark + name for name in sorted(set(value.split())) if name]
    name = "".join(parts).replace("/", "_")
    if len(name) > LONG_NAME:
        telling = [part for part in parts[1:] if is_outside(tag + part) or is_outside(tag + part, inside=True)]
        name = "".join([tag, *dict.fromkeys(telling)])[:LONG_NAME].replace("/", "_") + "#" + xxhash.xxh64_hexdigest(name)
    return name


def blocks(page: str) -> list[tuple[str, str]]:
    """The text blocks of a page in order, each with its path of open elements."""
    found: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # tag, and the path down to it; inline elements have their parent's
    texts: list[str] = []
    at = 0

    def end_block() -> None:
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            texts.clear()
            if text:
                found.append((stack[-1][1] if stack else "", text))

    form = TOKEN
    while at < len(page):
        token = form.match(page, at)
        if token is None:  # a tag that never ends, or a quote in it
            if page.find(">", at) < 0:
                texts.append(page[at:])
                break
            form = TOKEN_WITHOUT_QUOTES
            continue
        if token.group(4) == "<" and page.find(">", at) < 0:
            texts.append(page[at:])
            break
        at = token.end()
        closing, tag, attributes, text = token.groups()
        if text is not None:
            texts.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            end_block()
        if closing:
            for place in range(len(stack) - 1, -1, -1):
                if stack[place][0] == tag:
                    del stack[place:]
                    break
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(page, at)
            at = end.end()
            continue
        if not inline:
            while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p"):
                stack.pop()
            closes, limits = ENDS.get(tag, ((), ()))
            for place in range(len(stack) - 1, -1, -1) if closes else ():
                if stack[place][0] in limits:
                    break
                if stack[place][0] in closes:
                    del stack[place:]
        if not attributes.endswith("/"):
            if len(stack) >= MOST_DEEP:
                stack.pop()
            above = stack[-1][1] if stack else ""
            if inline:
                stack.append((tag, above))
            else:
                name = element_name(tag, attributes)
                stack.append((tag, f"{above}/{name}" if above else name))
    end_block()
    return found


# ---- wrappers: lists of [slots, repeated, optional, loose], slots a list of paths.
# A loose group is repeated, and each of its slots is optional.


def placed(paths: Iterable[str]) -> list[list]:
    """The items of ``folded``, each with its blocks as places in the item's slots, in order."""
    items: list[list] = []
    for path in paths:
        if items and items[-1][0] == [path]:
            items[-1][1] = True
            items[-1][4].append(0)
        else:
            items.append([[path], False, False, False, [0]])
    for size in (2, 3, 4):
        result: list[list] = []
        place = 0
        while place < len(items):
            here = items[place : place + size]
            again = items[place + size : place + 2 * size]
            if len(again) == size and [item[0] for item in here] == [item[0] for item in again]:
                slots = [slot for item in here for slot in item[0]]
                found: list[int] = []
                loose = False
                while [item[0] for item in items[place : place + size]] == [item[0] for item in here]:
                    before = 0
                    for item in items[place : place + size]:
                        found += [before + slot for slot in item[4]]
                        before += len(item[0])
                        loose = loose or item[1] or item[3]  # repeated within the group
                    place += size
                result.append([slots, True, False, loose, found])
            else:
                result.append(items[place])
                place += 1
        items = result
    return items


def folded(paths: Iterable[str]) -> list[list]:
    """A page's stream with runs of equal slots, or of equal sequences of slots, as repeated groups."""
    return [item[:4] for item in placed(paths)]


def loose_sets(*wrappers: list[list]) -> list[list[str]]:
    """The slots of the loose groups; groups that share a slot are one."""
    sets: list[list[str]] = []
    for wrapper in wrappers:
        for slots, _, _, loose in wrapper:
            if not loose:
                continue
            own = list(slots)
            for other in [one for one in sets if not set(one).isdisjoint(own)]:
                sets.remove(other)
                own = other + own
            sets.append(list(dict.fromkeys(own)))
    return sets


def gathered(items: list[list], sets: list[list[str]]) -> list[tuple[list, list[int]]]:
    """Items with neighbours that one loose group holds in its place, and the numbers of the items in each."""
    result: list[tuple[list, list[int]]] = []
    of_path = {path: place for place, own in enumerate(sets) for path in own}
    for number, item in enumerate(items):
        group = of_path.get(item[0][0])
        if group is None or any(of_path.get(path) != group for path in item[0]):
            result.append((item[:4], [number]))
        elif result and result[-1][0][3] and result[-1][0][0] is sets[group]:
            result[-1][0][2] &= item[2]
            result[-1][1].append(number)
        else:
            result.append(([sets[group], True, item[2], True], [number]))
    return result


def bounded(wrapper: list[list]) -> list[list]:
    """Spans between the places of a slot that has too many become loose groups."""
    while True:
        places: dict[str, list[int]] = {}
        for place, item in enumerate(wrapper):
            for path in dict.fromkeys(item[0]):
                places.setdefault(path, []).append(place)
        spans = [(own[0], own[-1]) for own in places.values() if len(own) > MOST_PLACES]
        if not spans:
            return wrapper
        first, last = min(spans)
        # A wider span that starts inside this one belongs to the same free text.
        while wider := [end for start, end in spans if start <= last < end]:
            last = max(wider)
        inside = wrapper[first : last + 1]
        slots = list(dict.fromkeys(path for item in inside for path in item[0]))
        group = [slots, True, all(item[2] for item in inside), True]
        wrapper = wrapper[:first] + [group] + wrapper[last + 1 :]
        wrapper = [item for item, _ in gathered(wrapper, loose_sets(wrapper))]


def positions(stream: list[list], wrapper: list[list]) -> list[int]:
    """The item of the wrapper that each item of a page's stream fills; -1 if none is alike."""
    grouped = gathered(stream, loose_sets(wrapper))
    slots = [[tuple(item[0]) for item in items] for items in ([item for item, _ in grouped], wrapper)]
    found = [-1] * len(grouped)
    for a, b, size in difflib.SequenceMatcher(None, *slots, autojunk=False).get_matching_blocks():
        found[a : a + size] = range(b, b + size)
    places: dict[tuple, list[int]] = {}
    for place, item in enumerate(slots[1]):
        places.setdefault(item, []).append(place)
    at = 0
    for place, item in enumerate(slots[0]):
        if found[place] < 0 and item in places:
            found[place] = next((option for option in places[item] if option >= at), places[item][-1])
        at = max(at, found[place])
    result = [-1] * len(stream)
    for place, (_, members) in zip(found, grouped, strict=True):
        for member in members:
            result[member] = place
    return result


FIRST, LATER = 0, 1


def block_positions(items: list[list], wrapper: list[list]) -> list[tuple[int, str, int]]:
    """Of each block of a page: its place in the wrapper, its path, and whether a repeated group begins with it."""
    result = []
    for item, place in zip(items, positions(items, wrapper), strict=True):
        for slot in item[4]:
            result.append((place, item[0][slot]))
    found = []
    for at, (place, path) in enumerate(result):
        repeated = place >= 0 and wrapper[place][1]
        begins = not repeated or at == 0 or result[at - 1][0] != place
        found.append((place, path, FIRST if begins else LATER))
    return found


def aligned(first: list[list], second: list[list]) -> list[list]:
    """The wrapper that fits what either wrapper fits."""
    sets = loose_sets(first, second)
    first, second = ([item for item, _ in gathered(wrapper, sets)] for wrapper in (first, second))
    slots = [[tuple(item[0]) for item in wrapper] for wrapper in (first, second)]
    result: list[list] = []

    def add(item: list, optional: bool) -> None:
        if result and result[-1][0] == item[0]:
            result[-1][1] = True
            result[-1][3] = result[-1][3] or item[3]
        else:
            result.append([item[0], item[1], item[2] or optional, item[3]])

    matcher = difflib.SequenceMatcher(None, *slots, autojunk=False)
    for kind, a, b, c, d in matcher.get_opcodes():
        if kind == "equal":
            for own, other in zip(first[a:b], second[c:d], strict=True):
                add([own[0], own[1] or other[1], own[2] or other[2], own[3] or other[3]], False)
        else:
            for item in (*first[a:b], *second[c:d]):
                add(item, True)
    return bounded(result)


def joined(wrappers: Iterable[str]) -> str:
    """One wrapper from many, in a fixed order: long ones first."""
    result = None
    for text in sorted(set(wrappers), key=lambda text: (-len(text), text)):
        wrapper = json.loads(text)
        result = wrapper if result is None else aligned(result, wrapper)
    return json.dumps(bounded(result or []), ensure_ascii=False)


# ---- labels


def is_outside(name: str, named: bool = True, inside: bool = False) -> bool:
    """Whether an element's tag, or if it counts its name, marks what isn't main text.

    ``inside`` is for elements of an article or main element.
    """
    tag, *marks = re.split(r"(?=[.#@])", name)
    if tag in OUTSIDE_TAGS:
        return True
    for mark in marks if named else ():
        if mark[0] == "@":
            if mark[1:] in OUTSIDE_ROLES:
                return True
            continue
        parts = {part for part in re.split(r"[-_]+", mark[1:]) if part}
        if not inside:
            if OUTSIDE_NAMES & parts:
                return True
        elif parts <= OUTSIDE_NAMES | LAYOUT_NAMES and parts & (NEVER_TEXT if tag in TEXT_TAGS else OUTSIDE_NAMES):
            return True
    return False


def _tag(name: str) -> str:
    return re.split(r"[.#@]", name)[0]


class Tree:
    """The elements of some paths: parents, tags and words, so that no path is taken apart twice."""

    def __init__(self, words: dict[str, int]):
        self.parent, self.name, self.tag, self.depth = [-1], [""], [""], [0]
        self.words, self.leaf = [0], {}
        children: dict[tuple[int, str], int] = {}
        for path, count in words.items():
            node = 0
            for name in path.split("/") if path else ():
                below = children.get((node, name))
                if below is None:
                    below = children[node, name] = len(self.parent)
                    self.parent.append(node)
                    self.name.append(name)
                    self.tag.append(_tag(name))
                    self.depth.append(self.depth[node] + 1)
                    self.words.append(0)
                node = below
            self.leaf[path] = node
            self.words[node] += count
        # Parents come before their children.
        self.main = [False] * len(self.parent)
        for node in range(1, len(self.parent)):
            self.main[node] = self.main[self.parent[node]] or self.tag[node] in MAIN_TAGS

    def summed(self, leaves: Iterable[int], own: dict[int, int]) -> list[int]:
        """Words at and below each element, of the given leaves."""
        total = [0] * len(self.parent)
        for leaf in leaves:
            total[leaf] += own[leaf]
        for node in range(len(self.parent) - 1, 0, -1):
            total[self.parent[node]] += total[node]
        return total

    def outside(self, unnamed: set[int] | None = frozenset()) -> list[bool]:
        """Elements that are marked, or below marked ones; the names of ``unnamed`` don't count, None is all."""
        result = [False] * len(self.parent)
        for node in range(1, len(self.parent)):
            above = self.parent[node]
            named = unnamed is not None and node not in unnamed and self.tag[node] not in ("html", "body")
            marked = is_outside(self.name[node], named, inside=self.main[above])
            lone_header = self.tag[node] == "header" and not self.main[node]
            result[node] = result[above] or marked or (lone_header and not self._holds_main(node))
        return result

    def _holds_main(self, node: int) -> bool:
        if not hasattr(self, "holds"):
            self.holds = [tag in MAIN_TAGS for tag in self.tag]
            for below in range(len(self.parent) - 1, 0, -1):
                self.holds[self.parent[below]] |= self.holds[below]
        return self.holds[node]

    def is_block(self, node: int) -> bool:
        return self.tag[node] in {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "pre"}


def _around_main(tree: Tree, leaves: list[int], own: dict[int, int]) -> set[int]:
    """Elements around most of the words of article and main, these included, or without them of all words."""
    marked = tree.outside()
    leaves = [leaf for leaf in leaves if not marked[leaf]] or leaves
    mains = [leaf for leaf in leaves if tree.main[leaf]]
    words = tree.summed(mains or leaves, own)
    total = sum(own[leaf] for leaf in mains or leaves)
    return {
        node
        for node in range(1, len(words))
        if words[node] >= MOST_WORDS * total
        and not tree.is_block(node)
        and (not mains or not tree.main[tree.parent[node]])
    }


def main_paths(words: dict[str, int]) -> set[str]:
    """The paths of the main text, from the words of each path."""
    tree = Tree(words)
    own = {tree.leaf[path]: count for path, count in words.items()}
    unmarked = tree.outside(None)
    tagged = [leaf for leaf in own if not unmarked[leaf]]
    if not tagged:
        return set()
    marked = tree.outside(_around_main(tree, tagged, own))
    inside = [leaf for leaf in tagged if not marked[leaf]] or tagged
    below = tree.summed(inside, own)
    mains = [node for node in range(1, len(below)) if tree.tag[node] in MAIN_TAGS and below[node]]
    if mains:
        # The outermost ones of the better kind of element.
        best = min(MAIN_TAGS.index(tree.tag[node]) for node in mains)
        roots = {node for node in mains if tree.tag[node] == MAIN_TAGS[best]}
    else:
        total = sum(own[leaf] for leaf in inside)
        enough = [n for n in range(1, len(below)) if below[n] >= MOST_WORDS * total and not tree.is_block(n)]
        roots = {max(enough, key=lambda node: (tree.depth[node], node))} if enough else {0}
    within = [False] * len(below)
    for node in range(len(below)):
        within[node] = node in roots or (node > 0 and within[tree.parent[node]])
    chosen = set(inside)
    return {path for path, leaf in tree.leaf.items() if leaf in chosen and within[leaf]}


def _is_heading(path: str) -> bool:
    return _tag(path.rsplit("/", 1)[-1]) in {"h1", "h2", "h3", "h4", "h5", "h6"}


Position = tuple[int, str, int]


def main_positions(counts: dict[Position, tuple[int, int, int]], n_pages: int) -> set[Position]:
    """The positions of the main text; ``counts`` has their pages, words and different texts."""
    words: dict[str, int] = {}
    for (_, path, _), (_, count, _) in counts.items():
        words[path] = words.get(path, 0) + count
    paths = main_paths(words)
    chosen = {key for key in counts if key[1] in paths}
    least = max(SAME_TEXT_PAGES, SAME_TEXT_SHARE * n_pages)
    fixed = {
        key for key in chosen if counts[key][0] >= least and counts[key][2] == 1 and not _is_heading(key[1])
    }
    # Later items of a group go with its first one.
    fixed = {(place, path, end) for place, path, end in fixed if end == FIRST or (place, path, FIRST) in fixed}
    varying = {key for key in chosen - fixed if counts[key][2] > 1}
    return chosen - fixed if varying else chosen


# ---- Spark


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page its host, a hash of its blocks, its folded stream, and the text hash and words of each block."""
    for batch in slices(batches):
        rows = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = blocks(page)
            items = placed(path for path, _ in found)
            texts = [xxhash.xxh64_intdigest(text) - 2**63 for _, text in found]
            words = [len(text.split()) for _, text in found]
            number = xxhash.xxh64_intdigest("\n".join(f"{path}\t{text}" for path, text in found)) - 2**63
            stream = json.dumps([item[:4] for item in items], ensure_ascii=False)
            rows.append((host, number, stream, json.dumps([item[4] for item in items]), texts, words))
        host, number, stream, filled, texts, words = zip(*rows, strict=True)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(number, pa.int64()), pa.array(stream, pa.string()),
             pa.array(filled, pa.string()), pa.array(texts, longs), pa.array(words, longs)],
            names=["host", "page", "stream", "filled", "texts", "words"],
        )


def _join_part(table: pa.Table) -> pa.Table:
    return pa.table({"host": table.column("host").slice(0, 1), "wrapper": [joined(table.column("wrapper").to_pylist())]})


def _count_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, place, path, end, text, words, pages) of pages with their wrappers, combined in the task."""
    slots: dict[tuple[str, int, str, int, int], list[int]] = {}
    wrappers: dict[str, list] = {}

    def rows() -> pa.RecordBatch:
        host, place, path, end, text = zip(*slots, strict=True) if slots else ((), (), (), (), ())
        words, pages = zip(*slots.values(), strict=True) if slots else ((), ())
        kinds = {"host": pa.string(), "path": pa.string()}
        columns = {"host": host, "place": place, "path": path, "end": end, "text": text, "words": words, "pages": pages}
        slots.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kinds.get(name, pa.int64())) for name, values in columns.items()], names=list(columns)
        )

    for batch in slices(batches):
        for host, stream, filled, texts, words, wrapper in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if wrapper not in wrappers:
                if len(wrappers) > 1000:
                    wrappers.clear()
                wrappers[wrapper] = json.loads(wrapper)
            items = [[*item, own] for item, own in zip(json.loads(stream), json.loads(filled), strict=True)]
            # A position of a page counts once; its text is all that fills it.
            held: dict[Position, list[int]] = {}
            for at, position in enumerate(block_positions(items, wrappers[wrapper])):
                held.setdefault(position, []).append(at)
            for (place, path, end), blocks_of in held.items():
                text = texts[blocks_of[0]] if len(blocks_of) == 1 else _hash([texts[at] for at in blocks_of])
                count = slots.setdefault((host, place, path, end, text), [0, 0])
                count[0] += sum(words[at] for at in blocks_of)
                count[1] += 1
        if len(slots) > 20_000:
            yield rows()
    yield rows()


def _hash(numbers: list[int]) -> int:
    return xxhash.xxh64_intdigest(np.array(numbers, np.int64).tobytes()) - 2**63


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, wrapper, n_pages, slots)`` to the wrapper and the positions of its main text, once for each host."""
    for batch in slices(batches, 64):
        mains = []
        for n_pages, slots in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            counts = {
                (row["place"], row["path"], row["end"]): (row["pages"], row["words"], row["texts"]) for row in slots or ()
            }
            mains.append(json.dumps(sorted(main_positions(counts, n_pages)), ensure_ascii=False))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(mains, pa.string())], names=["host", "wrapper", "main"]
        )


def join_streams(streams: DataFrame) -> DataFrame:
    """``(host, wrapper)``, one for each host: wrappers are joined in a tree, a bounded number in a task."""
    left = streams
    while True:
        sizes = stage(left.groupBy("host").agg(F.count(F.lit(1)).alias("streams")), "stream_counts")
        most = sizes.agg(F.max("streams")).first()[0] or 0
        if most <= 1:
            return left
        parts = F.ceil(F.col("streams") / PART_STREAMS)
        left = stage(
            left.join(sizes, "host")
            .withColumn("part", F.pmod(F.xxhash64("wrapper"), parts))
            .groupBy("host", "part")
            .applyInArrow(_join_part, "host string, wrapper string"),
            "joined",
        )


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, main)`` from pages ``(host, html)``: the wrapper, and the positions of its main text."""
    read = stage(
        pages.select("host", "html").mapInArrow(
            _read_pages,
            "host string, page long, stream string, filled string, texts array<long>, words array<long>",
        ),
        "pages_read",
    )
    different = stage(read.dropDuplicates(["host", "page"]), "different_pages")
    streams = stage(different.select("host", F.col("stream").alias("wrapper")).distinct(), "streams")
    wrappers = join_streams(streams)
    counted = different.join(wrappers, "host").select("host", "stream", "filled", "texts", "words", "wrapper")
    position = ["host", "place", "path", "end"]
    slots = (
        counted.mapInArrow(
            _count_positions,
            "host string, place long, path string, end long, text long, words long, pages long",
        )
        .groupBy(*position, "text")
        .agg(F.sum("words").alias("words"), F.sum("pages").alias("pages"))
        .groupBy(*position)
        .agg(F.sum("pages").alias("pages"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("texts"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("place", "path", "end", "pages", "words", "texts"))).alias("slots"))
    )
    n_pages = different.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    both = wrappers.join(n_pages, "host").join(slots, "host", "left").select("host", "wrapper", "n_pages", "slots")
    return stage(both.mapInArrow(_label, "host string, wrapper string, main string"), "wrappers")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[list, set[Position]]] = {}
    for batch in slices(batches):
        texts = []
        for page, wrapper, main in zip(*[batch.column(place).to_pylist() for place in (2, 3, 4)], strict=True):
            key = f"{wrapper}\n{main}"
            if key not in known:
                if len(known) > 1000:
                    known.clear()
                stated = {(place, path, end) for place, path, end in json.loads(main or "[]")}
                known[key] = (json.loads(wrapper or "[]"), stated)
            found = blocks(page)
            items = placed(path for path, _ in found)
            fills = [position in known[key][1] for position in block_positions(items, known[key][0])]
            if not any(fills):
                alone: dict[str, int] = {}
                for path, text in found:
                    alone[path] = alone.get(path, 0) + len(text.split())
                paths = main_paths(alone)
                fills = [path in paths for path, _ in found]
            texts.append("\n".join(text for (_, text), fill in zip(found, fills, strict=True) if fill))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract_pages(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per row: page_id, url, text, n_chars."""
    ship_package(pages.sparkSession)
    host, _ = host_and_path(column(pages, url_column).cast("string"))
    rows = pages.select(
        column(pages, id_column).alias("page_id"),
        column(pages, url_column).alias("url"),
        host.alias("host"),
        whole_text(pages, html_column).alias("html"),
    )
    wrappers = infer_wrappers(rows)
    joined_rows = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper", "main")
    kinds = {field.name: field.dataType.simpleString() for field in rows.schema}
    texts = joined_rows.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
