"""Main text of web pages by line-block distribution.

Markup is stripped into lines: every block-level tag ends a line, and whatever is cut out (scripts, styles, forms,
menus, headers, footers, notices, comments) leaves blank lines behind, adverts and asides none. The weights of ``WINDOW``
consecutive lines are summed; the distribution surges where text starts and dives to zero where it ends. Text between
a surge and its dive is kept if the run is heavy enough; a line weighs its length, and more where the page marks an article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Lines summed for one point of the distribution.
WINDOW = 3
#: A run surges if one of its windows weighs so much; also what an article mark adds to a line of text.
SURGE = 80

# HTML element names and words that mark page furniture.
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i img ins kbd label map mark meter nobr output picture q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var video wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg textarea title iframe object math".split())
#: Those of them whose content is text to the end of the page if they are never closed.
OPAQUE = frozenset("script style textarea title iframe".split())
CUT = frozenset("nav header footer aside form menu dialog select button head".split())
MAIN = frozenset(("article", "main"))
#: Elements of running text: their class and id never make them furniture.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt figcaption td th".split())
FURNITURE = re.compile(
    r"(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|"
    r"foot(?:er)?\w*|masthead|topbar|toolbar|comments?|commentlist|disqus|respond|responses|replies|notices?|cookies?\w*|"
    r"consent|gdpr|popup|modal|overlay|newsletter|subscribe|share|sharing|social|widget\w*|pagination|pager)", re.I)
#: Words that say so outside an article only; inside, they may name a part of the text.
OUTSIDE = re.compile(r"(?:head(?:er)?|related|recommended|copyright|legal|disclaimer|skip|login|search|searchform|searchbox)", re.I)
ADVERT = re.compile(r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|newsletter|subscribe|share|sharing|social|related|recommended)", re.I)
#: A name that begins so tells about the page, not about the element.
ABOUT = frozenset("has no not with without".split())
FURNITURE_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"))

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[_-]+")


class Token(NamedTuple):
    """A piece of markup; ``name`` is empty for comments and for elements that are cut with their content, named by ``raw``."""

    start: int
    end: int
    raw: str
    closing: bool
    name: str
    attributes: str


def tokens_of(page: str) -> list[Token]:
    """The markup of a page in order, in time linear in the page.

    A comment or an opaque element that is never closed lasts to the end. Quotes hide what ends a tag; once they turn out
    to leave a tag open to the end of the page, tags end at the next ``>`` from there on. A ``<`` that begins no tag is text.
    """
    out, at, n = [], 0, len(page)
    last, quoted, unclosed = page.rfind(">"), True, set()
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at) or page.startswith("<![CDATA[", at):
            mark = "-->" if page[at + 2] == "-" else "]]>"
            end = page.find(mark, at + 4)
            end = n if end < 0 else end + 3
            out.append(Token(at, end, "", False, "", ""))
            at = end
            continue
        if at > last:  # nothing can close a tag any more; only a comment may follow
            at += 1
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.index(">", at) + 1
            out.append(Token(at, end, "", False, "", ""))
            at = end
            continue
        head = _NAME.match(page, at)
        if head is None:
            at += 1
            continue
        rest = _REST.match(page, head.end()) if quoted else None
        quoted = rest is not None
        end = rest.end() if quoted else page.find(">", head.end()) + 1
        if not end:
            at += 1
            continue
        name, attributes = head[2].lower(), page[head.end():end - 1]
        if name in RAW and not head[1] and not attributes.endswith("/"):
            close = None if name in unclosed else _CLOSE[name].search(page, end)
            if close is None:
                unclosed.add(name)
            if close is not None or name in OPAQUE:
                end = n if close is None else close.end()
                out.append(Token(at, end, name, False, "", ""))
                at = end
                continue
        out.append(Token(at, end, "", bool(head[1]), name, attributes))
        at = end
    return out


def _names(value: str, words: re.Pattern) -> bool:
    """Whether one of the names in a class or id is such a word, or begins or ends with one as a part of its own."""
    for name in value.replace("side-bar", "sidebar").split():
        parts = _PARTS.split(name.strip("_-"))
        if parts[0].lower() not in ABOUT and (words.fullmatch(parts[0]) or words.fullmatch(parts[-1])):
            return True
    return False


def _is_furniture(name: str, attributes: str, article: bool = False) -> bool:
    if name in CUT:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            if name not in TEXT and (_names(value, FURNITURE) or not article and _names(value, OUTSIDE)):
                return True
        elif key == "role":
            if value.lower() in FURNITURE_ROLES:
                return True
        elif key == "hidden" and not value:
            return True
        elif key == "aria-hidden" and value.lower() == "true":
            return True
        elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _is_advert(name: str, attributes: str) -> bool:
    """Cut parts that stand in the middle of a text."""
    return name == "aside" or any(key.lower() in ("class", "id") and _names(value.strip("\"'"), ADVERT) for key, value in _ATTRIBUTE.findall(attributes))


def _is_inline(name: str) -> bool:
    """Elements inside a line of text; so are those with names of the page's own making."""
    return name in INLINE or "-" in name


def _closers(tokens: list[Token]) -> dict[int, int]:
    """Where each opened element is closed, by the positions of the tags; elements never closed are left out."""
    opened: dict[str, list[int]] = {}
    closed: dict[int, int] = {}
    for i, m in enumerate(tokens):
        name = m.name
        if not name or name in VOID:
            continue
        if m.closing:
            if opened.get(name):
                closed[opened[name].pop()] = i
        elif not m.attributes.endswith("/"):
            opened.setdefault(name, []).append(i)
    return closed


def _menus(lines: list[tuple[str, int]], links: list[tuple[int, bool]]) -> list[int]:
    """Which lines of links are menus. ``links`` names them with whether some of their words are no link."""
    def beside(side: list[tuple[str, int]]) -> int:
        return next((weight for text, weight in side if text), 0)

    out, group = [], []
    for k, (i, some) in enumerate(links):
        group.append((i, some))
        if k + 1 < len(links) and not any(weight for _, weight in lines[i + 1:links[k + 1][0]]) and links[k + 1][0] - i <= WINDOW:
            continue
        first, last = group[0][0], i
        listed = min(beside(lines[max(0, first - WINDOW):first][::-1]), beside(lines[last + 1:last + 1 + WINDOW])) >= SURGE
        out += [j for j, own in group if not (listed or own and beside(lines[max(0, j - WINDOW):j][::-1]) and beside(lines[j + 1:j + 1 + WINDOW]))]
        group = []
    return out


def strip_markup(page: str) -> list[tuple[str, int]]:
    """Lines of a page with their weight in the distribution.

    A line weighs its length and ``SURGE`` more inside an article. A line that is mostly link text stays, with a weight of 1,
    if some of its words are no link and text is near on both sides, or if it belongs to a list of links between two long
    paragraphs; else it is a menu and blank. Cut parts and the ends of an article leave ``WINDOW`` blank lines; a cut advert
    leaves none, as text goes on behind it. A header inside an article carries its headline and stays. A cut element that is
    never closed ends where an article starts or its parent ends, an advert already where the next block starts; nothing
    inside a closed one is kept.
    """
    lines: list[tuple[str, int]] = []
    links: list[tuple[int, bool]] = []
    parts: list[str] = []
    linked = text_size = 0
    words = False
    article = anchors = 0
    tokens = tokens_of(page)
    closed = _closers(tokens)
    cut = brief = False
    until = parent = -1
    parents: list[int] = []
    at = 0

    def end_line() -> None:
        nonlocal linked, text_size, words
        line = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if line and not article and 2 * linked > text_size:
            links.append((len(lines), words))
            lines.append((line, 0))
        else:
            lines.append((line, len(line) + (SURGE if line and article else 0)))
        parts.clear()
        linked = text_size = 0
        words = False

    def blank() -> None:
        lines.extend([("", 0)] * WINDOW)

    def add(piece: str) -> None:
        nonlocal linked, text_size, words
        if piece and not cut:
            parts.append(piece)
            size = len(piece) - piece.count(" ")
            text_size += size
            linked += size if anchors else 0
            words = words or not anchors and any(map(str.isalpha, piece))

    for i, m in enumerate(tokens):
        if i <= until:
            at = m.end
            continue
        add(page[at:m.start])
        at = m.end
        name, attributes = m.name, m.attributes
        if not name:
            if m.raw and m.raw not in ("svg", "math"):
                end_line()
            continue
        while parents and parents[-1] < i:
            parents.pop()
        if cut:
            if not m.closing and name in MAIN or i == parent or brief and not _is_inline(name) and name not in VOID:
                cut = False  # this tag is read like any other
            else:
                if not m.closing and i in closed and _is_furniture(name, attributes):
                    until = closed[i]
                continue
        if i in closed and name not in ("html", "body"):
            parents.append(closed[i])
        if name == "a" and (m.closing or not (attributes and _is_furniture(name, attributes, article > 0))):
            anchors = 0 if m.closing else 1
            continue
        if _is_inline(name) and not (attributes and _is_furniture(name, attributes, article > 0)):
            continue
        end_line()
        if m.closing:
            if name in MAIN:
                article = max(0, article - 1)
                anchors = 0
                blank()
            continue
        inner_header = name == "header" and article
        if name not in VOID and not attributes.endswith("/") and not inner_header and _is_furniture(name, attributes, article > 0):
            advert = _is_advert(name, attributes)
            if not advert:
                blank()
            if i in closed:
                until = closed[i]
            else:
                cut, brief = True, advert and name != "aside" or name == "head"
                parent = parents[-1] if parents else -1
        elif name in MAIN:
            article += 1
            blank()
    if not cut:
        add(page[at:] if not page.startswith("<", at) else "")
    end_line()
    menus = _menus(lines, links)
    for i, _ in links:
        lines[i] = (lines[i][0], 1)
    for i in menus:
        lines[i] = ("", 0)
    return lines


def runs_of_text(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(surge, dive, peak) of each run: the first line with text and the first of ``WINDOW`` blank lines after it."""
    runs, n = [], len(lengths)
    window = sum(lengths[:WINDOW])
    start, peak = -1, 0
    for i in range(n):
        if start < 0 and lengths[i]:
            start, peak = i, 0
        if start >= 0:
            peak = max(peak, window)
            if window == 0:
                runs.append((start, i, peak))
                start = -1
        window += (lengths[i + WINDOW] if i + WINDOW < n else 0) - lengths[i]
    if start >= 0:
        runs.append((start, n, peak))
    return runs


def main_text(page: str | None) -> str:
    """The main text of one page, its blocks joined by one space; empty for null, empty or textless pages.

    Each run whose peak reaches ``SURGE`` is kept, and on a page without such a run the one with the highest peak. Lines of
    links are kept between lines of text. An article mark only adds weight.
    """
    if not page:
        return ""
    lines = strip_markup(page)
    runs = runs_of_text([weight for _, weight in lines])
    least = min(SURGE, max((peak for _, _, peak in runs), default=0))
    return " ".join(text for start, dive, peak in runs if peak >= least for text, _ in lines[start:dive] if text)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The page's columns without its html, with ``text`` and ``n_chars`` (code points) of the main text.

    One pass without a shuffle. Null html gives an empty text; columns named like the results are replaced; repeated
    rows stay; an empty table gives an empty table.
    """
    keep = [f for f in pages.schema if f.name not in (html_col, "text", "n_chars")]
    slim = pages.select(F.col(f"`{html_col}`").alias("__html"), *[F.col(f"`{f.name}`") for f in keep])
    schema = StructType([*keep, StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(0).to_pylist()]
            columns = [*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return slim.mapInArrow(run, schema)
