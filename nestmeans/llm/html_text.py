"""Main text of web pages by line-block distribution.

The markup is stripped into lines, one for each block of text; lines keep only the length of text
that can be content: text in boilerplate zones (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments) counts 0, and link text counts 0. The lengths are summed over a
sliding window of lines. A surge (the window sum rises above ``threshold`` and does not fall to
zero in the next lines) starts a stretch of main text, together with the unbroken lines of content
just above it; a dive (the sum falls to zero) ends it. The lines between that carry text are kept,
each as one block. The threshold is the smaller of
``SURGE`` and a share of the page's largest window sum, so that short articles surge as well.

Adverts and notices inside an article make the sums fall to zero too. So content lines are kept as well when they stand
in the ``article`` (else ``main``, else the element named as content) that holds most of the page's text, and paragraphs
and headings beside a kept paragraph. A paragraph that is one link is kept between kept lines.

Names of classes and ids only suggest a zone. A name that tells of a zone elsewhere (``page-with-sidebar``,
``has-comments``) says nothing; headings are never zones, paragraphs only by a class that is the bare word; an element
that is also named as content, holds the page's title or is a form is a zone unless it holds most of the text.

Map-only: each page is parsed in the task that reads it, with Python's ``re`` scanner over Arrow
batches; memory is a few times the largest page.

Defined cases: NULL or empty html gives an empty text; broken, truncated or unclosed markup is read
as far as it goes; repeated pages give repeated results, whatever their ids; tables of zero rows give zero rows. Very
long pages are read whole in time linear in their length. Other columns of the table are not read, also one called
``text`` or ``n_chars``.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 86
SHARE = 0.05
LINK_SHARE = 0.5

# Elements whose content is never text.
SILENT = frozenset("script style noscript template svg math iframe object canvas head select option textarea button".split())
# Elements that hold page furniture.
ZONES = frozenset("nav header footer aside menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements inside a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Closed implicitly by the next block of the same kind.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Words of class, id and role attributes that mark page furniture.
FURNITURE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent disqus footer foot form header masthead menu nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted promotion related respond replies reply share sharing sidebar sidebars sidenav social "
    "sponsor sponsored subscribe subscription tags toolbar topbar widget widgets contentinfo complementary search login signup "
    "gdpr alert modal overlay disclaimer copyright".split()
)
# Elements and bare names that hold the article.
ARTICLE = frozenset("article main body html".split())
CONTENT = frozenset("article articlebody main content post entry story".split())
# First or inner words of names that tell of a zone elsewhere or file a text under a subject.
ABOUT = frozenset("with without has no not non tag category type status format".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_MARKS = re.compile(r"(?:\b|(?<=\s))(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SPACE = re.compile(r"\s+")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in SILENT}


def _names(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether the names an element carries suggest a zone, and whether they suggest content."""
    zone = content = False
    for match in _MARKS.finditer(attributes):
        kind = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        tokens = [value] if kind == "aria-label" else value.split()
        for token in tokens:
            # camelCase, dashes and underscores separate words
            words = _WORD.findall(_CAMEL.sub(r"\1 \2", token).lower())
            bare = token.lower()
            content |= bare in CONTENT
            if FURNITURE.isdisjoint(words) or name in ARTICLE or name in HEADINGS or not ABOUT.isdisjoint(words):
                continue
            if name == "p":
                zone |= kind == "class" and bare in FURNITURE
            elif (name == "section" and kind == "id") or kind == "aria-label":
                zone |= bare in FURNITURE
            else:
                zone = True
    return zone, content


@dataclass
class _Marked:
    """An element that may be a zone or hold the article."""

    parent: int  # the marked element around it, -1 for none
    name: str
    zone: bool
    content: bool
    unsure: bool  # a zone only if it does not hold most of the text


class Line(NamedTuple):
    text: str
    size: int  # characters that can be content
    linked: bool  # mostly link text, in no ruled-out element
    marked: int  # innermost marked element, -1 for none
    parent: int  # the element around a paragraph or heading, -1 for other lines


def lines_of(page: str) -> tuple[list[Line], list[_Marked]]:
    """The lines of a page, one for each block of text, and its marked elements in page order."""
    lines: list[Line] = []
    marks: list[_Marked] = []
    parts: list[str] = []
    linked = 0
    open_tags: list[tuple[str, bool, int, int]] = []  # name, zone, marked element it is in or is, number
    zones = links = opened = 0
    at, size = 0, len(page)

    def parent() -> int:
        blocks = (i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] not in INLINE)
        i = next(blocks, -1)
        if i < 0 or not (open_tags[i][0] == "p" or open_tags[i][0] in HEADINGS):
            return -1
        return open_tags[i - 1][3] if i else 0

    def flush() -> None:
        nonlocal linked
        if not parts:
            return
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            mostly = linked > LINK_SHARE * len(text)
            lines.append(Line(text, 0 if zones or mostly else len(text), mostly and not zones,
                              open_tags[-1][2] if open_tags else -1, parent()))
        linked = 0

    def close(upto: int) -> None:
        nonlocal zones, links
        while len(open_tags) > upto:
            name, zone, _, _ = open_tags.pop()
            zones -= zone
            links -= name == "a"

    while at < size:
        cut = page.find("<", at)
        if cut < 0:
            cut = size
        if cut > at:
            parts.append(page[at:cut])
            if links:
                linked += cut - at
        if cut == size:
            break
        match = _TOKEN.match(page, cut)
        if match is None:  # a bare "<"
            parts.append("<")
            at = cut + 1
            continue
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
        elif name == "br":
            parts.append(" ")
        if match[1]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    close(i)
                    break
                if open_tags[i][1] and name in INLINE:
                    break
            continue
        if name in SILENT:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else (size if name in ("script", "style") else at)
            if end or name in ("script", "style"):
                continue
        if name in VOID or (match[3] or "").endswith("/"):
            continue
        ends = SELF_CLOSING.get(name)
        if ends:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] in ends:
                    close(i)
                    break
                if open_tags[i][0] not in INLINE and open_tags[i][0] not in SELF_CLOSING:
                    break
        if name not in INLINE:  # unclosed inline elements end with their block
            while open_tags and open_tags[-1][0] in INLINE:
                close(len(open_tags) - 1)
        zone, content = _names(name, match[3] or "")
        if zone and name in INLINE and name != "a":
            flush()
        within = open_tags[-1][2] if open_tags else -1
        hard = name in ZONES
        if not hard and (zone or content or name in ("form", "article", "main", "h1")):
            marks.append(_Marked(within, name, zone or name == "form", content or name in ("article", "main"), content or name == "form"))
            within = len(marks) - 1
        opened += 1
        open_tags.append((name, hard, within, opened))
        zones += hard
        links += name == "a"
    flush()
    return lines, marks


def _masses(lines: list[Line], marks: list[_Marked], out: list[bool]) -> tuple[list[int], int]:
    """Content in each marked element and on the page, without that in elements ruled out."""
    mass, total = [0] * len(marks), 0
    for line in lines:
        if line.marked < 0:
            total += line.size
        elif not out[line.marked]:
            total += line.size
            mass[line.marked] += line.size
    for i in range(len(marks) - 1, -1, -1):  # inner elements come after those around them
        if marks[i].parent >= 0:
            mass[marks[i].parent] += mass[i]
    return mass, total


def _ruled_out(lines: list[Line], marks: list[_Marked]) -> list[bool]:
    """Which marked elements are zones, or lie in one."""
    for mark in reversed(marks):  # what holds the title or an article may hold the page
        if mark.name in ("h1", "article", "main") or mark.unsure:
            at = mark.parent
            while at >= 0 and not marks[at].unsure:
                marks[at].unsure = True
                at = marks[at].parent
    out: list[bool] = []
    for mark in marks:
        out.append((mark.zone and not mark.unsure) or (mark.parent >= 0 and out[mark.parent]))
    mass, total = _masses(lines, marks, out)
    for i, mark in enumerate(marks):
        out[i] |= (mark.zone and 2 * mass[i] <= total) or (mark.parent >= 0 and out[mark.parent])
    return out


def _article(lines: list[Line], marks: list[_Marked], out: list[bool]) -> list[bool]:
    """Which marked elements are, or lie in, the one that holds most of the text."""
    mass, total = _masses(lines, marks, out)
    most = [i for i, m in enumerate(marks) if m.content and 2 * mass[i] > total]
    best = max(most, key=lambda i: (marks[i].name == "article", marks[i].name == "main", i), default=-1)
    inside: list[bool] = []
    for i, mark in enumerate(marks):
        inside.append(i == best or (mark.parent >= 0 and inside[mark.parent]))
    return inside


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The kept lines of a page, joined by blank lines."""
    if not page:
        return ""
    lines, marks = lines_of(page)
    out = _ruled_out(lines, marks)
    free = [x.marked < 0 or not out[x.marked] for x in lines]
    sizes = np.array([x.size if ok else 0 for x, ok in zip(lines, free)], dtype=np.int64)
    if not sizes.any():
        return ""
    sums = np.convolve(sizes, np.ones(window, np.int64))[window - 1:]  # of lines i .. i + window - 1
    threshold = min(surge, SHARE * int(sums.max()))
    kept = [False] * len(lines)
    waiting: list[int] = []  # content lines just before a possible surge
    between = False
    for i, n in enumerate(sizes):
        if not between and n and sums[i] > threshold:
            between = True
            for k in waiting:
                kept[k] = True
        elif between and not sums[i]:
            between = False
        waiting = [*waiting, i] if n and not between else []
        kept[i] = bool(between and n)
    inside = _article(lines, marks, out)
    beside = {x.parent for x, k in zip(lines, kept) if k and x.parent >= 0}
    for i, line in enumerate(lines):
        kept[i] |= bool(sizes[i]) and ((line.marked >= 0 and inside[line.marked]) or line.parent in beside)
    last = max((i for i, k in enumerate(kept) if k), default=-1)
    first = next((i for i, k in enumerate(kept) if k), last)
    for i in range(first, last):
        kept[i] |= lines[i].linked and free[i] and lines[i].parent in beside
    return "\n\n".join(x.text for x, k in zip(lines, kept) if k)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    window: int = WINDOW, surge: int = SURGE,
) -> DataFrame:
    """``(page id, url, text, n_chars)`` of every page."""
    known = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).alias("text"))
    fields = {f.name: f for f in known.schema}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in (id_col, url_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(x, window, surge) for x in batch["text"]]
            yield batch.assign(text=texts, n_chars=np.array([len(t) for t in texts], dtype=np.int64))

    return known.mapInPandas(run, f"{schema}, text string, n_chars bigint")
