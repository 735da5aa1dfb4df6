"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a sliding window, and the text length (without links) from which a window surges.
WINDOW_LINES = 3
SURGE_CHARS = 80

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>script|style|textarea)\b(?:[^>"']|"[^"]*"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*+|[^<>]*)>|<[!?][^>]*>""",
    re.IGNORECASE | re.DOTALL,
)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are passed over up to their closing tag; without one, or self-closed, only the tag is.
_ISLANDS = frozenset("noscript template svg iframe select title".split())
#: Elements that hold no article text wherever they stand.
_NEVER = frozenset("nav footer aside form button dialog menu object canvas audio video map".split())
#: Sectioning elements: what lies directly in the same one belongs together.
_SECTIONS = frozenset("article main section div td body blockquote".split())
_HEADINGS = frozenset(("h1", "h2"))
#: Elements whose end tag may be left out: the tags that end them, and the elements around them, inside which such tags do not.
_IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "td": (frozenset(("td", "th", "tr", "tbody")), frozenset(("table",))),
    "th": (frozenset(("td", "th", "tr", "tbody")), frozenset(("table",))),
    "tr": (frozenset(("tr", "tbody")), frozenset(("table",))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
}
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Words in class or id that mark what surrounds an article; a word is bounded by the ends, blanks, hyphens or underscores.
_AROUND = re.compile(
    r"(?:ads?(?:\d+|box|slot|unit|wrap\w*|container)?|advert\w*|adsense|sponsor\w*|promo\w*|\w*banner\w*|cookie\w*|consent|gdpr|notices?|notification\w*|alerts?|popup|modal|overlay|"
    r"newsletter|subscri\w*|share|sharing|social|sidebar\w*|asides?|rail|\w*menus?|\w*nav|\w*navbar|navigation|breadcrumbs?|\w*footer|copyright|comment(?!ary)\w*|disqus|repl(?:y|ies)|respond|discussion|"
    r"related|recommend\w*|widgets?|pagination|pager|masthead|toolbar|login|sign-?up|forms?|search|skip|toc|tags?)",
    re.IGNORECASE,
)
_HEADER = re.compile(r"(?:\w*header|topbar|top-bar|site-title)", re.IGNORECASE)
_READERS = re.compile(r"(?:comment(?!ary)\w*|disqus|repl(?:y|ies))", re.IGNORECASE)
#: Words beside those above that leave a name what it is: share-buttons, site-footer, comment-list.
_BESIDE = re.compile(
    r"(?:site|page|post|posts|article|articles|main|global|primary|secondary|left|right|top|bottom|fixed|sticky|floating|buttons?|links?|lists?|box|area|bar|blocks?|sections?|"
    r"wrap\w*|container|inner|outer|content|text|body|thread|items?|icons?|media|us|up|in|to|you|may|also|like|message|msg|policy|modal|cloud|slot|unit|\d+)",
    re.IGNORECASE,
)
_WHOLE = frozenset("html head body main article".split())
#: How an element belongs to what surrounds an article: not, by a name that may mean something else, or surely.
_IS_TEXT, _PERHAPS, _SURELY = range(3)


def _named(value: str, words: re.Pattern) -> int:
    """How class or id names mark an element. A name surely does if all its parts do, or stand beside one that does; ``tag-python`` and ``has-sidebar`` perhaps."""
    found = _IS_TEXT
    for name in value.split():
        parts = [part for part in re.split(r"[-_]+", name) if part]
        around = [words.fullmatch(part) for part in parts]
        if words.fullmatch(name) or any(around):
            sure = name not in ("tag", "tags") and all(hit or _BESIDE.fullmatch(part) for hit, part in zip(around, parts))
            found = max(found, _SURELY if sure else _PERHAPS)
    return found


def _surrounds(tag: str, attrs: str, inside: bool) -> int:
    """Whether an element is not part of the article; ``inside``: it stands in an article or main element."""
    if tag in _NEVER or tag == "header" and not inside:
        return _SURELY
    found = _IS_TEXT
    for name, *values in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _SURELY
        if name == "role" and value in _ROLES:
            return _SURELY
        if name in ("class", "id"):
            if tag in _WHOLE:
                if tag == "article":
                    found = max(found, _named(value, _READERS))
            else:
                found = max(found, _named(value, _AROUND), _IS_TEXT if inside else _named(value, _HEADER))
    return found


class Line(NamedTuple):
    text: str
    #: Length of it outside links.
    length: int
    #: Number of the sectioning element around it, and of the outermost article or main element, 0 for none.
    section: int
    article: int
    heading: bool


class _Reader:
    """One pass over a page. Every tag is looked at once, and the end of an island is sought once for each it has."""

    def __init__(self, html: str, strip: bool, kept: frozenset[int]):
        self.html, self.strip, self.kept = html, strip, kept
        self.lines: list[Line] = []
        #: By element that is perhaps left out: its text outside links.
        self.perhaps: dict[int, int] = {}
        self.parts: list[str] = []
        self.linked = self.sections = self.elements = self.articles = 0
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.in_link = self.inside = 0
        self.heading = False
        #: The element that is left out, tags opened inside it, and its number if it is only perhaps.
        self.skipped = ""
        self.opened: dict[str, int] = {}
        self.skipped_as: int | None = None
        self.endless: set[str] = set()
        self.form_end = 0

    def end_line(self) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            if text:
                self.lines.append(Line(text, max(0, len(text) - self.linked), self.stack[-1][1], self.articles if self.inside else 0, self.heading))
            self.parts.clear()
        self.linked = 0

    def put(self, text: str) -> None:
        if not text:
            return
        if self.skipped:
            if self.skipped_as is not None and not self.in_link:
                self.perhaps[self.skipped_as] += len(text.strip())
            return
        self.parts.append(text)
        if self.in_link:
            self.linked += len(text)

    def island_end(self, tag: str, at: int) -> int | None:
        """Behind the closing tag of an island that opens before ``at``."""
        if tag in self.endless:
            return None
        found = re.compile(f"</{tag}\\s*>", re.IGNORECASE).search(self.html, at)
        if not found:
            self.endless.add(tag)
        return found and found.end()

    def wraps_page(self, at: int) -> bool:
        """Whether a form that opens before ``at`` holds over half of the page, as some systems put all of it in one."""
        if self.form_end < at:
            end = self.html.find("</form", at)
            self.form_end = len(self.html) if end < 0 else end
        return self.form_end - at > len(self.html) / 2

    def ends_skipped(self, tag: str, closing: bool) -> bool:
        """Whether a tag inside the element that is left out ends it without being its own end tag."""
        tags, around = _IMPLIED.get(self.skipped, (frozenset(), frozenset()))
        nested = any(self.opened.get(name) for name in around)
        if self.skipped == "p":
            return tag != "p" and tag not in _INLINE and tag not in _VOID or tag == "p" and not closing
        if not closing:
            return tag in tags and not nested
        return not self.opened.get(tag) and (tag in around or any(open_ == tag for open_, _ in self.stack))

    def skip(self, tag: str, closing: bool, empty: bool) -> bool:
        """Whether a tag belongs to the element that is left out."""
        if tag == self.skipped and closing and not self.opened.get(tag):
            self.skipped = ""
            return True
        if self.ends_skipped(tag, closing):
            self.skipped = ""
            return False
        if tag == "a":
            self.in_link = 0 if closing else 1
        elif closing:
            self.opened[tag] = max(0, self.opened.get(tag, 0) - 1)
        elif tag not in _VOID and not empty:
            self.opened[tag] = self.opened.get(tag, 0) + 1
        return True

    def leave_out(self, tag: str, attrs: str, at: int) -> bool:
        how = _surrounds(tag, attrs, self.inside > 0) if self.strip else _IS_TEXT
        if how == _IS_TEXT or tag == "form" and self.wraps_page(at):
            return False
        self.elements += 1
        if self.elements in self.kept:
            return False
        if tag not in _INLINE:
            self.end_line()
        if tag not in _VOID and not attrs.endswith("/"):
            self.skipped, self.opened, self.in_link = tag, {}, 0
            self.skipped_as = self.elements if how == _PERHAPS else None
            if how == _PERHAPS:
                self.perhaps[self.elements] = 0
        return True

    def read(self) -> None:
        at = 0
        while token := _TOKEN.search(self.html, at):
            self.put(self.html[at : token.start()])
            at = token.end()
            tag, attrs = (token["tag"] or "").lower(), token["attrs"] or ""
            if not tag:
                continue
            closing = bool(token["close"])
            if tag in _ISLANDS:
                at = (None if closing or attrs.endswith("/") else self.island_end(tag, at)) or at
                continue
            if self.skipped and self.skip(tag, closing, attrs.endswith("/")):
                continue
            if tag == "a":
                self.in_link = 0 if closing else 1
            elif tag == "br":
                self.put(" ")
            elif (closing or not self.leave_out(tag, attrs, at)) and tag not in _INLINE:
                self.block(tag, closing)
        self.put(self.html[at:])
        self.end_line()

    def block(self, tag: str, closing: bool) -> None:
        """A block element begins or ends, and with it a line."""
        self.end_line()
        self.in_link = 0
        self.heading = tag in _HEADINGS and not closing
        if tag not in _SECTIONS:
            return
        if not closing:
            self.sections += 1
            self.stack.append((tag, self.sections))
            if tag in ("article", "main"):
                self.articles += not self.inside
                self.inside += 1
        elif any(open_ == tag for open_, _ in self.stack):
            while True:
                open_, _ = self.stack.pop()
                self.inside -= open_ in ("article", "main")
                if open_ == tag:
                    break


def text_lines(html: str, strip: bool = True) -> list[Line]:
    """Lines of a page. A block element ends a line, an inline element or a br does not.

    ``strip`` leaves out elements that surround an article. One whose name only perhaps says so is kept if it holds most of the
    page's text outside links: then the page is read a second time, with these elements as part of the text.
    """
    kept: frozenset[int] = frozenset()
    for _ in range(3):
        reader = _Reader(html, strip, kept)
        reader.read()
        whole = sum(line.length for line in reader.lines) + sum(reader.perhaps.values())
        most = {number for number, length in reader.perhaps.items() if length > whole / 2}
        if not most:
            break
        kept |= most
    return reader.lines


def main_region(lengths: list[int], window: int = WINDOW_LINES, surge: int = SURGE_CHARS) -> tuple[int, int]:
    """First and last line, plus one, of the region with most text; (0, 0) if no window surges.

    The blocks are sums of ``window`` lines from each line on. A region starts where the blocks surge to
    ``surge`` or more and ends where they dive to nothing, or below a tenth of that.
    """
    sums = list(accumulate(lengths, initial=0))
    n = len(lengths)
    blocks = [sums[min(n, i + window)] - sums[i] for i in range(n)]
    best, best_text, i = (0, 0), 0, 0
    while i < n:
        if blocks[i] >= surge:
            j = i
            while j < n and blocks[j] >= max(1, surge // 10):
                j += 1
            if sums[j] - sums[i] > best_text:
                best, best_text = (i, j), sums[j] - sums[i]
            i = j
        i += 1
    return best


def main_blocks(html: str | None) -> list[str]:
    """Blocks of the main text in page order; none if the page is null or has no text outside what surrounds articles.

    Where article or main elements hold text, all lines of those with a surging region are kept, or, if none surges, of the one with
    most text. Elsewhere the region of the line blocks is kept, without edge lines that have no text outside links, and widened to its
    neighbours in the same sectioning elements, so that a short first or last paragraph stays, and to a heading just above it.
    """
    if not html:
        return []
    # A page that is one big form, or wholly in an element with a misleading name, is read without leaving elements out.
    lines = text_lines(html) or text_lines(html, strip=False)
    articles: dict[int, list[Line]] = {}
    for line in lines:
        if line.article:
            articles.setdefault(line.article, []).append(line)
    lengths = {number: [line.length for line in own] for number, own in articles.items()}
    if any(map(sum, lengths.values())):
        surging = {number for number, own in lengths.items() if main_region(own) != (0, 0)}
        taken = surging or {max(lengths, key=lambda number: sum(lengths[number]))}
        return [line.text for line in lines if line.article in taken]
    low, high = main_region([line.length for line in lines])
    if low == high:
        return [line.text for line in lines if line.length] or [line.text for line in lines]
    longest = max(lines[low:high], key=lambda line: line.length).section
    # The first window may begin before the text that made it surge.
    while low < high - 1 and lines[low].section != longest and lines[low].length < SURGE_CHARS:
        low += 1
    while high - 1 > low and lines[high - 1].section != longest and lines[high - 1].length < SURGE_CHARS:
        high -= 1
    while low and lines[low - 1].section == lines[low].section:
        low -= 1
    while high < len(lines) and lines[high].section == lines[high - 1].section:
        high += 1
    same = [k for k, line in enumerate(lines) if line.section == longest]
    low, high = min(low, same[0]), max(high, same[-1] + 1)
    heading = [k for k in range(max(0, low - WINDOW_LINES), low) if lines[k].heading]
    return [line.text for line in lines[min([low, *heading]) : high]]


def extract_main_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text in column ``name`` (replaced if there): blocks joined by an empty line; empty for a null page."""

    @F.pandas_udf("string")
    def texts(htmls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in htmls:
            yield pd.Series(["\n\n".join(main_blocks(html)) for html in batch], dtype=object)

    return pages.withColumn(name, texts(F.col(html_col)))


def op8_line_block_html(pages: DataFrame) -> DataFrame:
    """The digest of the query."""
    found = extract_main_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text")
    return found.withColumn("n_chars", F.length("text").cast("long"))
