"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block of text; what is never part of an article (scripts,
menus, forms, page headers and footers, notices, adverts, reader comments) leaves empty lines, as do the
edges of sections, so that regions of text stand apart. Text lengths (links do not count) are summed over
sliding windows of lines. Where the sum rises above a share of the page's highest window is a surge
point, where it falls back a dive point; the lines from the first surge to the last dive are kept,
with the lines that touch them without a gap. Inside an ``article`` or ``main`` element the element's edges
are the surge and the dive, since they are where the text begins and ends.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
#: Share of the highest window sum above which text surges.
SURGE_SHARE = 0.2
#: Share of a line's letters in links above which it is a menu.
LINK_SHARE = 0.5

# Elements by what they mean for the text.
RAW = frozenset("script style title textarea noscript template iframe svg math canvas object audio video select button option".split())
OUTSIDE = frozenset("nav aside footer form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody thead tfoot tr ul".split()
)
SECTIONS = frozenset("article aside body footer header main nav section".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class and id that mark what is no article.
NOT_ARTICLE = frozenset(
    "ad ads adbox adsense adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification outbrain overlay pager pagination paywall popup promo promoted promotion recommended related reply replies respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_tag = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)",
    re.S,
)
_attribute = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_marks = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _attribute.finditer(rest)} if rest.strip(" /") else {}


def _outside(name: str, rest: str, in_article: bool) -> bool:
    """Whether an element is no part of an article."""
    if name in OUTSIDE or name == "header" and not in_article:
        return True
    found = _attributes(rest)
    if not found:
        return False
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
        return True
    if name in ("html", "body", "main"):
        return False
    if found.get("role") in ROLES:
        return True
    words = {w.lower() for key in ("class", "id") for w in _marks.findall(found.get(key, ""))}
    if name == "article":
        return bool(words & {"comment", "reply"})
    return bool(words & NOT_ARTICLE)


@dataclass
class Line:
    text: str
    links: int
    article: int  # number of the article or main element it stands in, 0 outside


@dataclass
class _Reader:
    lines: list[Line] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0

    def text(self, piece: str, in_link: bool) -> None:
        if piece:
            piece = html.unescape(piece)
            self.parts.append(piece)
            if in_link:
                self.link_chars += len("".join(piece.split()))

    def end_block(self, article: int, gap: bool = False) -> None:
        line = " ".join("".join(self.parts).split())
        if line:
            self.lines.append(Line(line, self.link_chars, article))
        if gap:
            self.lines.extend([Line("", 0, article)] * WINDOW)
        self.parts.clear()
        self.link_chars = 0


def page_lines(page: str) -> list[Line]:
    """One line for each block of text; gaps of empty lines at sections and where something was left out."""
    out = _Reader()
    at, in_link, article, articles, depth = 0, False, 0, 0, 0
    hidden, nested = "", 0  # the element left out at present, and how many of its name are open inside
    low = None
    size = len(page)
    while at < size:
        found = _tag.search(page, at)
        if not found:
            if not hidden:
                out.text(page[at:], in_link)
            break
        if not hidden:
            out.text(page[at : found.start()], in_link)
            if found["cdata"]:
                out.text(found["cdata"], in_link)
        at = found.end()
        if not found["name"]:
            continue
        name, closing, rest = found["name"].lower(), bool(found["close"]), found["rest"]
        if name in RAW and not closing and not rest.endswith("/"):
            if low is None:
                low = page.lower() if page.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), page)
            end = low.find(f"</{name}", at)
            at = size if end < 0 else (low.find(">", end) + 1 or size)
            continue
        if hidden:
            opens_article = name in ("article", "main") and not closing
            if hidden == "p" and not closing and name in BLOCKS:
                hidden = ""
            elif opens_article and not _outside(name, rest, False):
                hidden = ""
            elif name == hidden:
                nested += -1 if closing else 0 if rest.endswith("/") else 1
                if nested < 0:
                    hidden = ""
                    out.end_block(article, gap=True)
                continue
            else:
                continue
            out.end_block(article, gap=True)
        if not closing and name not in VOID and not rest.endswith("/") and _outside(name, rest, article > 0):
            out.end_block(article, gap=True)
            hidden, nested = name, 0
            continue
        if name == "a":
            in_link = not closing
        elif name in ("br", "td", "th", "img"):
            out.text(" ", False)
        elif name in BLOCKS:
            out.end_block(article, gap=name in SECTIONS or name == "hr")
            if name in ("article", "main"):
                if closing:
                    depth = max(0, depth - 1)
                    article = article if depth else 0
                else:
                    depth += 1
                    if depth == 1:
                        articles += 1
                        article = articles
    out.end_block(article)
    return out.lines


def _length(line: Line) -> int:
    return max(0, len(line.text) - 2 * line.links) if line.links else len(line.text)


def main_lines(lines: list[Line]) -> list[str]:
    """The lines between the surge and the dive points."""
    sizes: dict[int, int] = {}
    for line in lines:
        if line.article and line.text:
            sizes[line.article] = sizes.get(line.article, 0) + _length(line) + 1
    if sizes:
        best = max(sizes, key=lambda a: (sizes[a], -a))
        return [x.text for x in lines if x.article == best and x.text]
    lengths = [_length(x) for x in lines]
    sums = [sum(lengths[max(0, i - WINDOW + 1) : i + 1]) for i in range(len(lengths))]
    limit = SURGE_SHARE * max(sums, default=0)
    strong = [i for i, s in enumerate(sums) if s > limit and lengths[i]]
    if not strong:
        return []
    surge, dive = strong[0], strong[-1]
    while surge > 0 and lines[surge - 1].text:
        surge -= 1
    while dive + 1 < len(lines) and lines[dive + 1].text:
        dive += 1
    return [x.text for x in lines[surge : dive + 1] if x.text and x.links <= LINK_SHARE * len("".join(x.text.split()))]


def main_text(page: str | None) -> str:
    return "\n".join(main_lines(page_lines(page))) if page else ""


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``; no shuffle.

    A null or empty page, and one without text, has the empty text. Null and repeated ids and urls stay
    as they are; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = [main_text(p) for p in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    slim = pages.selectExpr("CAST(page_id AS LONG) AS page_id", "CAST(url AS STRING) AS url", "CAST(html AS STRING) AS html")
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
