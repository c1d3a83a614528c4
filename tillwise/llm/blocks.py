"""Main text of web pages by line-block distribution.

A page is cut into lines at its block elements, markup is stripped, and containers that never hold an article (menus, page
headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles) leave blank lines, but for those that stand
among the paragraphs of one element: they part nothing. Text lengths, without the
text of links, are summed over sliding windows of lines: where the sum rises over a threshold the text begins (surge),
where it falls to nothing it ends (dive), and every line between stays whole; so does what lies between two surges of one
element that only left-out containers part. The threshold follows the densest window of the page. A marked article lowers it
to any text outside links: there only windows without such text, as in lists of links, are left out, and in an ``article`` with other text not even
these. Dense text outside it stays, too. Names in class and id tell containers apart, not headings, paragraphs and words.

Nulls: a null html is an empty page with an empty text; url and id are passed on as they are. Unclosed and stray tags, cut-off
markup and unknown entities do not fail. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.shipping import ship, whole
from tillwise.session import tune

WINDOW = 3
DENSE = 80  # characters in a window that make a surge, at most

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-z][a-z0-9:-]*)(?P<rest2>[^>]*+)>"
    r"|</?[a-z][^>]*+\Z"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</[^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
# what follows these is no markup up to their end tag, or the end of the page
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>?|\Z", re.IGNORECASE) for name in ("script", "style", "title", "textarea")}
_UNQUOTED = re.compile(r"=\s*[^\s\"'>]+/\Z")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")

_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html isindex legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_HOLDERS = frozenset("html body div main article section center table tbody td th tr fieldset details".split())
# what a class or an id can be the name of; those of headings, paragraphs and inline elements say nothing
_CONTAINERS = _HOLDERS | frozenset("article main header figure ul ol dl li".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("nav footer aside form menu dialog button select datalist canvas audio video object map head".split())
_INLINE = frozenset("svg math template noscript iframe noframes noembed xmp".split())  # left out, and may stand inside a line
_FOREIGN = frozenset(("svg", "math"))
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner billboard sponsor sponsored promo promotion nav "
    "navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer footers masthead topbar cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login share sharing "
    "social comment comments commentlist disqus respond reply replies discussion related recommended recommendations widget widgets "
    "toolbar pagination pager search searchbox form skip".split()
)
_HEADS = frozenset(("header", "headers", "topnav"))
_REMARKS = frozenset("comment comments commentlist reply replies".split())
_MODIFIERS = frozenset("has with no without is".split())
# an open element of the first kind ends where one of the second kind begins
_ENDS_BEFORE = {"p": _BLOCKS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


def _words(attribute: str) -> set[str]:
    parts = [part.lower() for part in _CAMEL.split(attribute) if part]
    return {part for i, part in enumerate(parts) if not i or parts[i - 1] not in _MODIFIERS} - _MODIFIERS


def _boilerplate(name: str, rest: str, inside: bool) -> bool:
    """Whether an element holds no article text; ``inside``: whether an article holds the element."""
    if name in _NEVER or name in _INLINE or (name == "header" and not inside):
        return True
    if not rest or name in ("html", "body"):
        return False
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if key in ("class", "id") and (name in _CONTAINERS or "-" in name):
            words = _words(value)
            if words & (_REMARKS if name in _MAIN else _NAMES) or (words & _HEADS and not inside and name not in _MAIN):
                return True
    return False


@dataclass
class _Page:
    """Lines of a page: their text, how many of its visible characters are in no link, and whether a marked article holds them.

    ``bridge`` is 0 at lines with text, at blank ones the number of the element that holds the left-out containers and the
    text on both sides, or -1.
    """

    text: list[str] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    marked: list[bool] = field(default_factory=list)
    bridge: list[int] = field(default_factory=list)
    article: list[int] = field(default_factory=list)  # the number of the innermost article that holds the line, or 0
    parts: list[str] = field(default_factory=list)
    visible: int = 0
    # open elements, whether they are left out, their numbers, and how many are open down to the last that holds paragraphs
    stack: list[tuple[str, bool, int, int]] = field(default_factory=list)
    holder: int = 0  # how many elements were open down to the one that holds the last line
    low: int = 0  # the fewest open elements since the last line
    gap_at: int | None = None  # the fewest open elements at a left-out container since the last line
    parted: bool = False  # by the beginning or end of a marked article
    open_articles: list[int] = field(default_factory=list)

    def flush(self, marked: bool) -> None:
        line = " ".join("".join(self.parts).split())
        if line:
            holder = self.stack[-1][3] if self.stack else 0
            self._blank(holder)
            self.text.append(line)
            self.length.append(self.visible)
            self.marked.append(marked)
            self.bridge.append(0)
            self.article.append(self.open_articles[-1] if self.open_articles else 0)
            self.holder, self.low, self.gap_at, self.parted = holder, len(self.stack), None, False
        self.parts, self.visible = [], 0

    def _blank(self, holder: int) -> None:
        """Blank lines for the containers since the last line, if they part it from the one to come."""
        if not self.text or (self.gap_at is None and not self.parted):
            return
        # the element that holds both lines holds a container, too
        among = not self.parted and self.gap_at == self.low
        if among and self.low >= min(self.holder, holder):
            return  # and a paragraph of its own
        self.text += [""] * WINDOW
        self.length += [0] * WINDOW
        self.marked += [False] * WINDOW
        self.article += [0] * WINDOW
        self.bridge += [(self.stack[self.low - 1][2] if self.low else 0) + 1 if among else -1] * WINDOW

    def gap(self) -> None:
        at = len(self.stack)
        self.gap_at = at if self.gap_at is None else min(at, self.gap_at)


def lines_of(page: str) -> _Page:
    """The lines of a page in their order."""
    out, at = _Page(), 0
    stack, number = out.stack, 0
    open_names: dict[str, int] = {}
    left_out = links = articles = foreign = 0

    def close(name: str) -> None:
        nonlocal left_out, links, articles, foreign
        while stack:
            last, skipped, *_ = stack.pop()
            out.low = min(out.low, len(stack))
            open_names[last] -= 1
            left_out -= skipped
            links -= last == "a"
            articles -= last in _MAIN
            if last == "article":
                out.open_articles.pop()
            foreign -= last in _FOREIGN
            if last == name:
                break

    def add(piece: str) -> None:
        if piece and not left_out:
            piece = html.unescape(piece) if "&" in piece else piece
            out.parts.append(piece)
            if not links:
                out.visible += sum(map(len, piece.split()))

    while match := _MARKUP.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            continue
        closing = match["close"] or match["close2"]
        if name in _BLOCKS:
            out.flush(articles > 0)
        if closing:
            if open_names.get(name):
                out.parted |= name in _MAIN
                close(name)
            continue
        if stack and name in _ENDS_BEFORE.get(stack[-1][0], ()):
            close(stack[-1][0])
        if name in _EMPTY:
            continue
        rest = match["rest"] or match["rest2"] or ""
        if (foreign or name in _INLINE) and rest.endswith("/") and not _UNQUOTED.search(rest):
            continue  # closed by itself
        if name in _RAW_ENDS and not foreign:
            at = _RAW_ENDS[name].search(page, at).end()
            continue
        skipped = _boilerplate(name, rest, articles > 0)
        if (name in _MAIN or skipped) and name not in _INLINE:
            out.flush(articles > 0)
            if skipped and not left_out:
                out.gap()
            out.parted |= name in _MAIN
        number += 1
        holder = len(stack) + 1 if name in _HOLDERS else stack[-1][3] if stack else 0
        stack.append((name, skipped, number, holder))
        open_names[name] = open_names.get(name, 0) + 1
        left_out += skipped
        links += name == "a"
        articles += name in _MAIN
        if name == "article":
            out.open_articles.append(number)
        foreign += name in _FOREIGN
    add(page[at:])
    out.flush(articles > 0)
    return out


def _window_sums(length: np.ndarray) -> np.ndarray:
    """Of the window that begins at each line."""
    return np.convolve(length, np.ones(WINDOW, np.int64))[WINDOW - 1 :] if len(length) else length


def kept_lines(length: np.ndarray, marked: np.ndarray, bridge: np.ndarray | None = None, article: np.ndarray | None = None) -> np.ndarray:
    """Which lines lie between a surge and its dive, or between two surges that a bridge joins.

    Of marked lines those in windows without text outside links are left out, but not in an ``article`` that has such text somewhere.
    """
    n = len(length)
    surge = max(1, min(DENSE, int(_window_sums(length).max(initial=0)) // 2))
    sums = _window_sums(np.where(marked, 0, length))
    # runs of windows with any text, of which the dense ones are kept from their first dense window on
    alive = np.concatenate([[False], sums > 0, [False]])
    begins, ends = np.flatnonzero(alive[1:] & ~alive[:-1]), np.flatnonzero(~alive[1:] & alive[:-1])
    keep = np.zeros(n, bool)
    last = -1
    for begin, end in zip(begins, ends):
        dense = np.flatnonzero(sums[begin:end] >= surge)
        if len(dense):
            own = begin + dense[0] + np.flatnonzero(~marked[begin + dense[0] : end] & (length[begin + dense[0] : end] > 0))  # lines of links only may stand around
            keep[own[0] : own[-1] + 1] = True
            if bridge is not None and last >= 0:
                between = bridge[last + 1 : own[0]]
                if len(set(between[between != 0].tolist()) | {-1}) == 2 and -1 not in between:
                    keep[last + 1 : own[0]] |= length[last + 1 : own[0]] > 0
            last = own[-1]
    inside = np.flatnonzero(marked)
    stays = np.ones(len(inside), bool)
    for begin in np.flatnonzero(_window_sums(length[inside])[: max(0, len(inside) - WINDOW + 1)] == 0):
        stays[begin : begin + WINDOW] = False
    if article is not None and len(inside):
        texts = np.bincount(article, length, article.max() + 1)
        stays |= (article[inside] > 0) & (texts[article[inside]] > 0)
    keep[inside] = stays
    return keep


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, white space as single spaces."""
    found = lines_of(page or "")
    keep = kept_lines(np.array(found.length, np.int64), np.array(found.marked, bool), np.array(found.bridge, np.int64), np.array(found.article, np.int64))
    return " ".join(text for text, stays in zip(found.text, keep) if stays and text)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship(tune(pages.sparkSession))
    columns = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), whole(source).alias("html"))
    return columns.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
