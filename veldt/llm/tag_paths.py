"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with the path of block elements from the root. For every path the length of
its texts outside links and their punctuation are taken per node, so that the length of a page does not matter; a path's
ratio is smoothed along its ancestors up to the content node and fused with what element and class names say. Paths
below the content node stay, except mere links and asides; of the others those below a share of the best one go.

Defined results: null or empty html, and pages without a content path, give ''; markup that is cut off or not closed
is read as far as it goes; repeated rows give repeated rows. Extra columns pass through; a column named like the output
is replaced.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from veldt.llm.common import map_rows

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.DOTALL
)
NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var".split()
)
#: their contents are skipped; without an end tag only the start tag is, except for those that hold no markup
UNREAD = frozenset("script style noscript template iframe svg math textarea select object canvas title".split())
RAW = frozenset("script style textarea".split())
#: elements that hold something other than the article's text
ASIDE = frozenset("nav footer aside form button menu dialog head fieldset".split())
#: those that hold something else however much text they have
NEVER = frozenset("nav footer aside button menu head".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar side nav navbar navigation "
    "menu breadcrumb breadcrumbs footer header masthead comment comments disqus respond reply replies cookie cookies "
    "consent notice alert popup modal overlay share sharing social related recommended newsletter subscribe signup login "
    "search pagination pager toolbar widget complementary contentinfo".split()
)
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
MAIN = frozenset(("article", "main"))
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡\"“”«»()]")
CONTAINERS = frozenset("html body div section article main center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEAR = math.exp(-0.5)
SHARE, OUTSIDE, ONLY_LINKS, NAMED = 0.1, 0.2, 0.05, 0.03
MOST, LINKED = 2 / 3, 0.9


def names_in(attributes: str) -> tuple[set[str], set[str]]:
    """(whole names, their parts in letters)."""
    found = " ".join("".join(m) for m in NAMES.findall(attributes)).lower()
    return set(found.split()), set(re.split(r"[^a-z]+", found)) - {""}


def blocks(html: str) -> list[tuple[tuple[tuple[str, bool], ...], str, int]]:
    """(path, text, letters in links) of each block in page order; a step of a path is its label, and whether its names
    or its tag tell of something other than content."""
    out: list[tuple[tuple[tuple[str, bool], ...], str, int]] = []
    open_: list[tuple[str, str, bool]] = []
    held: list[str] = []
    without_end: set[str] = set()
    linked = links = 0
    at, size = 0, len(html)

    def flush():
        nonlocal linked
        if held:
            text = " ".join(references.unescape("".join(held)).split())
            if text:
                out.append((tuple(x[1:] for x in open_), text, linked))
            held.clear()
        linked = 0

    while at < size:
        m = MARKUP.search(html, at)
        text = html[at : m.start() if m else size]
        if text:
            held.append(text)
            linked += len(text) if links else 0
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        if tag in VOID:
            held.append(" ")
            if tag == "hr":
                flush()
            continue
        flush()
        if closing:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == tag:
                    del open_[i:]
                    break
            continue
        if tag in UNREAD:
            if not m[0].endswith("/>") and tag not in without_end:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                if end:
                    at = end.end()
                elif tag in RAW:
                    at = size
                else:
                    without_end.add(tag)
            continue
        if open_ and open_[-1][0] == "p":
            open_.pop()
        while open_ and open_[-1][0] in CLOSED_BY.get(tag, ()):
            open_.pop()
        names, parts = names_in(m[3])
        inside = any(x[0] in MAIN for x in open_)
        aside = tag in ASIDE or tag == "header" and not inside
        aside = aside or bool(names & HINTS) and tag not in ("html", "body", *MAIN)
        label = tag if not parts else f"{tag}.{'.'.join(sorted(parts))}"
        links = 0
        open_.append((tag, label, aside))
    flush()
    return out


def ratio(sums: list[float]) -> float:
    """Text and punctuation per node, whatever their number; ``sums`` holds length, marks and nodes."""
    length, marks, nodes = sums
    return math.sqrt(length / nodes) * (1 + math.log1p(marks / nodes))


def main_text(html: str | None) -> str:
    """The texts of the content blocks, one line each.

    All paths below the content node (article or main, else the container that most text is in) are kept; paths
    elsewhere by their ratio. What an element or its names tell lowers a path's ratio, unless the element holds most
    of the page's text (of article and main, where there are any).
    """
    found = blocks(html or "")
    if not found:
        return ""
    # the tree of paths: a node has a larger number than its parent, the root is 0
    number: dict[tuple[int, tuple[str, bool]], int] = {}
    up, tags, aside = [0], [""], [False]
    places = []
    for path, _, _ in found:
        at = 0
        for step in path:
            if (at, step) not in number:
                number[at, step] = len(up)
                up.append(at)
                tags.append(step[0].split(".")[0])
                aside.append(step[1])
            at = number[at, step]
        places.append(at)
    own = [[0, 0, 0] for _ in up]
    in_links, letters = [0] * len(up), [0] * len(up)
    for at, (_, text, linked) in zip(places, found, strict=True):
        for i, x in enumerate((max(0, len(text) - linked), len(PUNCTUATION.findall(text)), 1)):
            own[at][i] += x
        in_links[at] += linked
        letters[at] += len(text)
    below = [list(x) for x in own]
    for n in range(len(up) - 1, 0, -1):
        for i in range(3):
            below[up[n]][i] += below[n][i]
    mains = [tag in MAIN for tag in tags]
    for n in range(1, len(up)):
        mains[n] = mains[n] or mains[up[n]]
    counted = mains if any(x[0] for x, main in zip(own, mains, strict=True) if main) else [True] * len(up)
    text_below = [x[0] if c else 0 for x, c in zip(own, counted, strict=True)]
    for n in range(len(up) - 1, 0, -1):
        text_below[up[n]] += text_below[n]
    for n in range(1, len(up)):
        aside[n] = aside[up[n]] or aside[n] and (tags[n] in NEVER or text_below[n] < MOST * max(1, text_below[0]))
    if all(aside[n] for n in places):
        return ""
    tops = {n for n, tag in enumerate(tags) if tag in MAIN and not aside[n]}
    has_main = bool(tops)
    tops = tops or {content_node(up, tags, below)}
    above = {0}
    for n in range(len(up) - 1, 0, -1):
        if n in tops or n in above:
            above.add(up[n])
    # sums of ratio and weight from a node up to the content node; outside it, up to what does not hold it
    inside = [n in tops for n in range(len(up))]
    chain = [(0.0, 0.0)] * len(up)
    fused = [0.0] * len(up)
    kept = [False] * len(up)
    for n in range(len(up)):
        total, weight = chain[up[n]]
        inside[n] = inside[n] or n > 0 and inside[up[n]]
        if inside[n] or n not in above:
            chain[n] = ratio(below[n]) + NEAR * total, 1 + NEAR * weight
        if own[n][2]:
            only_links = in_links[n] >= LINKED * letters[n] and tags[n] not in HEADINGS
            smooth = (ratio(own[n]) + NEAR * total) / (1 + NEAR * weight)
            fused[n] = smooth * (OUTSIDE if has_main and not inside[n] else 1.0) * (ONLY_LINKS if only_links else 1.0)
            fused[n] *= NAMED if aside[n] else 1.0
            kept[n] = inside[n] and not only_links and not aside[n]
    least = SHARE * max(fused)
    return "\n".join(b[1] for n, b in zip(places, found, strict=True) if kept[n] or fused[n] >= least)


def content_node(up: list[int], tags: list[str], below: list[list[float]]) -> int:
    """The deepest container that holds most of the text of the one above it, from the root down."""
    boxes: dict[int, int] = {}
    for n in range(1, len(up)):
        if tags[n] in CONTAINERS and (up[n] not in boxes or below[n][0] > below[boxes[up[n]]][0]):
            boxes[up[n]] = n
    node = 0
    while node in boxes and below[boxes[node]][0] >= MOST * below[node][0]:
        node = boxes[node]
    return node


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add each page's main text."""

    def make():
        return lambda values: ([main_text(v) for v in values],)

    return map_rows(pages, make, [html], [(text, StringType())], chunk=256)
