"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams its events; they are folded into lines,
one per block element, each with its text, the tags around it, its links
and the container it stands in.  The ratio of text to tags is smoothed over
neighbouring lines with a Gaussian kernel and lines above a threshold, found by
splitting the ratios into two clusters, mark the content; the container that
holds them is the article.  Menus, adverts, notices and the like, told by
element, role or class name, count as ratio 0 and are left out wherever they
stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article aside blockquote body center div footer form header main nav section table td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
UNSEEN = frozenset("applet audio button canvas datalist head iframe math noframes noscript object script select style svg template textarea title video".split())
BOILERPLATE = frozenset("aside dialog footer form menu nav search".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of a class or id that mark boilerplate.
HINTS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments consent cookie cookies "
    "disclaimer discussion discussions disqus footer gdpr header login masthead menu modal nav navbar navigation navi newsletter notice notices notification notifications "
    "pager pagination paywall popup promo promoted promotion recommended related replies reply respond responses search share sharing sidebar sidenav signup "
    "skip social sponsor sponsored subscribe subscription toc toolbar widget widgets".split()
)
COMMENTS = frozenset("comment comments discussion discussions disqus replies reply respond responses".split())
#: Marks that also stand on what wraps a whole page: text that holds most of the page's smoothed ratios is no boilerplate for them.
SOFT = frozenset("form header masthead notice notices promo promoted promotion related recommended search share sharing sidebar social sponsored subscribe subscription toc toolbar widget widgets".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"\w")
#: What follows says which parts a page has, or lacks.
_WITH = re.compile(r"(?:^|[-_])(?:has|with|no|without|is|not)[-_].*")

SIGMA = 1.0


def hinted(attrs: list[tuple[str, str | None]]) -> set[str]:
    """The words of class and id that mark boilerplate, and a role that does."""
    found: set[str] = set()
    for name, value in attrs:
        if name in ("class", "id") and value:
            for part in value.split():
                found.update(w for w in (x.lower() for x in _WORDS.findall(_WITH.sub("", part))) if w in HINTS)
        elif name == "role" and value and value.strip().lower() in ROLES:
            found.add(value.strip().lower())
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            found.add("hidden")
    return found


class _Line:
    __slots__ = ("boiler", "container", "heading", "links", "tags", "text")

    def __init__(self, text: str, tags: int, links: int, container: int, heading: bool, boiler: frozenset) -> None:
        # links: their number where all words are in links, or else 0; boiler: (mark, number of its element)
        self.text, self.tags, self.links, self.container, self.heading, self.boiler = text, tags, links, container, heading, boiler


class PageLines(HTMLParser):
    """Folds parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        # containers by number: parent and tag; 0 is the page
        self.parent, self.kind = [0], ["page"]
        # open elements that matter: (tag, container before, boilerplate before, unseen before)
        self.open: list[tuple[str, int, frozenset | set, int]] = []
        self.container, self.boiler, self.unseen, self.marked = 0, frozenset(), 0, 0
        self.parts: list[str] = []
        self.tags, self.links, self.in_link, self.unlinked, self.heading = 0, 0, False, False, False

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append(_Line(text, self.tags, 0 if self.unlinked else self.links, self.container, self.heading, self.boiler))
            self.parts = []
        self.tags, self.links, self.in_link, self.unlinked = 0, 0, False, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.unseen and tag != "body":
            if tag in UNSEEN:
                self.push(tag)
                self.unseen += 1
            return
        if tag in BLOCKS:
            self.flush()
            self.heading = tag in HEADINGS
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.in_link = True
            self.links += 1
        if tag in VOID:
            return
        if tag == "body":
            self.open, self.unseen, self.boiler = [], 0, frozenset()
        if tag in UNSEEN:
            self.push(tag)
            self.unseen += 1
            return
        marks: set[str] = hinted(attrs) if attrs else set()
        if tag in ("html", "body", "main") or tag in HEADINGS:
            marks &= {"hidden"}
        if "header" in marks and self.inside("article"):
            marks.discard("header")
        if tag in BOILERPLATE or tag == "header" and not self.inside("article"):
            marks.add(tag)
        if tag in CONTAINERS or marks:
            self.push(tag)
            if tag in CONTAINERS:
                self.parent.append(self.container)
                self.kind.append(tag)
                self.container = len(self.kind) - 1
            if tag in ("main", "article") and not any(m in COMMENTS for m, _ in self.boiler):
                self.boiler = frozenset()  # a page's wrapper may have any class name
            if marks:
                self.marked += 1
                self.boiler = self.boiler | {(m, self.marked) for m in marks}

    def push(self, tag: str) -> None:
        self.open.append((tag, self.container, self.boiler, self.unseen))

    def inside(self, tag: str) -> bool:
        return any(x[0] == tag for x in self.open)

    def handle_endtag(self, tag: str) -> None:
        if not self.unseen:
            if tag in BLOCKS:
                self.flush()
                self.heading = False
            self.tags += 1
            if tag == "a":
                self.in_link = False
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if self.unseen and self.open[i][3] and tag not in UNSEEN:
                    return
                _, self.container, self.boiler, self.unseen = self.open[i]
                del self.open[i:]
                return
            if self.open[i][0] in UNSEEN and tag not in UNSEEN:
                return

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            self.parts.append(data)
            if not self.in_link and not self.unlinked and _WORD.search(data):
                self.unlinked = True

    def up(self, container: int) -> list[int]:
        """The container and all around it, the innermost first."""
        out = [container]
        while container:
            container = self.parent[container]
            out.append(container)
        return out


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel's weights are those that have lines."""
    radius = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    whole = np.convolve(ratios, kernel)[radius : radius + len(ratios)]
    return whole / np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The border of two clusters of ``values``, found by moving it between their means; at most one standard deviation."""
    border = float(values.mean())
    for _ in range(50):
        low, high = values[values < border], values[values >= border]
        if not len(low) or not len(high):
            break
        new = float((low.mean() + high.mean()) / 2)
        if abs(new - border) < 1e-9:
            break
        border = new
    return min(border, float(values.std())) if values.std() > 0 else border


def link_lists(lines: list[_Line], root: int) -> set[int]:
    """Lines that are lists of links: several links, a neighbour of links alone, or nothing else in its container."""
    texts = {x.container for x in lines if not x.links}
    alone = [x.links > 0 for x in lines]
    return {
        i for i, x in enumerate(lines)
        if alone[i] and (x.links > 1 or x.container != root and x.container not in texts or i and alone[i - 1] or alone[i + 1 : i + 2] == [True])
    }


_GAP = _Line("", 1, 0, -1, False, frozenset())


def ratios(lines: list[_Line], boiler: list[bool]) -> np.ndarray:
    """Characters per tag of every line, 0 for boilerplate."""
    return np.array([0.0 if b else len(x.text) / max(x.tags, 1) for x, b in zip(lines, boiler, strict=True)])


def unmarked_by_mass(lines: list[_Line]) -> list[bool]:
    """Which lines are boilerplate on a page without an article element.

    An element whose class, id, role or name is a soft mark is none if its
    lines, above the threshold, hold half of the page's smoothed ratios.
    """
    hard = [any(m not in SOFT for m, _ in x.boiler) for x in lines]
    if all(hard):
        return hard
    level = smooth(ratios(lines, hard))
    mass = np.where((level >= threshold(level)) & ~np.array(hard), level, 0.0)
    total = mass.sum()
    of: dict[int, float] = {}
    for x, own in zip(lines, mass.tolist(), strict=True):
        for n in {n for _, n in x.boiler}:
            of[n] = of.get(n, 0.0) + own
    lifted = {n for n, own in of.items() if total > 0 and own >= 0.5 * total}
    return [h or any(n not in lifted for _, n in x.boiler) for x, h in zip(lines, hard, strict=True)]


def main_text(html: str | None) -> str:
    """The page's article: its blocks in page order, joined by newlines; white space within a block is one space.

    Null, empty or text-free html gives the empty string.
    """
    if not html:
        return ""
    page = PageLines()
    page.feed(html)
    page.close()
    page.flush()
    lines = page.lines
    above = {c: page.up(c) for c in {x.container for x in lines}}

    def article(i: int) -> int | None:
        return next((c for c in reversed(above[lines[i].container]) if page.kind[c] in ("article", "main")), None)

    boiler = [bool(x.boiler) for x in lines]
    if not any(article(i) is not None for i, x in enumerate(boiler) if not x):
        boiler = unmarked_by_mass(lines)
    usable = [i for i, x in enumerate(boiler) if not x]
    if not usable:
        return ""
    level = smooth(ratios(lines, boiler))
    border = threshold(level)
    marked = [i for i in usable if level[i] >= border] or [max(usable, key=lambda i: level[i])]
    named = {i: article(i) for i in usable}
    chosen = {named[i] for i in marked} - {None} or set(named.values()) - {None}
    if chosen:
        # lists of links whose smoothed ratio is low are menus, also within an article
        menus = {i for c in chosen for i in link_lists([lines[j] if named.get(j) == c else _GAP for j in range(len(lines))], c) if level[i] < border}
        kept = [i for i in usable if named[i] in chosen and i not in menus]
    else:
        root = next(c for c in above[lines[marked[0]].container] if all(c in above[lines[i].container] for i in marked))
        lists, content = link_lists(lines, root), set(usable)
        content -= lists
        if page.kind[root] in ("page", "body"):
            # from the marked lines on to the next boilerplate or list of links
            first, last = marked[0], marked[-1]
            while first - 1 in content:
                first -= 1
            while last + 1 in content:
                last += 1
            while first < marked[0] and lines[first].links:
                first += 1
            while last > marked[-1] and lines[last].links:
                last -= 1
        else:
            first, last = 0, len(lines)
        kept = [i for i in usable if first <= i <= last and root in above[lines[i].container] and i in content]
    return "\n".join(lines[i].text for i in kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (the page's article, empty if there is none) and n_chars, one row per page.

    Null ids and urls stay null; repeated rows are extracted each.
    """
    fields = ", ".join(f"`{c}` {pages.select(c).schema[0].dataType.simpleString()}" for c in (id_col, url_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(run, f"{fields}, text string, n_chars long")
