"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Every line has a weight: its text length, or zero
if it is part of a menu, script, form or other furniture, or, where a page has none of the article and main
elements, one of three and more lines in turn that are all link. Where it has one, lines outside weigh
nothing, and lines inside more than the threshold each, so that short articles rise too. Weights are summed over a
sliding window of lines. The text starts at a surge point, where the sum of the lines that weigh rises above the
threshold, and takes in the lines before it back to the next furniture. It ends at the dive point behind
the last surge, where the sum over the window, furniture included, falls to zero. An exact check follows: a run
behind the dive stays if it holds a sentence, so that a short last paragraph is not lost to the notices
around it. Pages without a surge keep all lines that weigh, and so do texts without any tag.

Elements named after furniture, and forms, may wrap a page. One that holds the only article or main
elements is no furniture. Where furniture holds all text of a page, the outer element that holds
most of it is none, again until some text is left; reader comments stay furniture in any case.

Defined results: null or empty html and pages without text give an empty string; markup that
is never closed ends with the page; equal rows give equal results; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of

#: Lines in a window.
WINDOW = 3
#: Characters that a window must exceed to start a text on a page without an article.
SURGE_CHARS = 80

# Element kinds and name parts that mark a page's furniture.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template", "svg", "math"}
FURNITURE = {
    "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "input", "label",
    "fieldset", "object", "embed", "applet", "canvas", "audio", "video", "head",
}
#: Furniture that may also wrap a whole page.
WRAPPERS = {"form", "fieldset"}
SOFT, HARD, COMMENTS = 1, 2, 3
MAIN = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: An element of the key closes an open element of the value, up to the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = {"div", "article", "main", "section", "body", "table", "ul", "ol", "dl", "blockquote", "aside", "nav"}
NAMED = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banners?|nav\w*|menus?|breadcrumbs?|side-?bars?"
    r"|footers?|site-?header|page-?header|masthead|comments?|respond|disqus\w*|cookies?|notices?|consent|gdpr|alerts?|pop-?ups?|modals?"
    r"|overlay|share\w*|sharing|social\w*|related|newsletters?|subscribe|sign-?up|log-?in|widgets?|toolbar"
    r"|navigation|complementary|contentinfo|search)(?![a-z])")
READERS = re.compile(r"(?<![a-z])(?:comments?|respond|disqus\w*)(?![a-z])")
#: Parts that say what an element has or lacks, not what it is.
HAS = re.compile(r"(?<![a-z])(?:has|no|with|without)-+[a-z0-9]+(?:-+[a-z0-9]+)*")
ATTRIBUTES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
#: A line that ends as a sentence does.
SENTENCE = re.compile(r"""[.!?\u2026\u3002\uff01\uff1f\u0964\u061f\u06d4]["'\u201d\u2019\u00bb)\]]*$""")
TAG = re.compile(r"""<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|([!?][^>]*>)|(/?[a-zA-Z][^>]*(?:>|$)))""")


def _is_furniture(tag: str, attributes: str, in_main: bool) -> int:
    """0, or SOFT or COMMENTS by a name or an element that may wrap a page, or HARD."""
    if tag in FURNITURE - WRAPPERS:
        return HARD
    soft = SOFT if tag in WRAPPERS or (tag == "header" and not in_main) else 0
    if not attributes or tag in MAIN or tag in ("body", "html"):
        return soft
    for name, value in ATTRIBUTES.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return HARD
        named = HAS.sub(" ", value.replace("_", "-")) if name in ("class", "id", "role") else ""
        if READERS.search(named):
            soft = COMMENTS
        elif NAMED.search(named):
            soft = soft or SOFT
    return soft


def lines_of(page: str) -> tuple[list[tuple[str, bool, bool, bool]], bool]:
    """(text, furniture, inside article or main, link) per line, and whether the page has a main element.

    A link is a line whose whole text is that of links.

    Soft furniture that holds the only main elements, or without which no text is left, is none.
    """
    lines: list[tuple[str, tuple[int, ...], bool, bool]] = []  # furniture as the numbers of its elements, 0 for hard
    parts: list[str] = []
    plain = False  # whether the line has text outside links
    stack: list[tuple[str, int | None, bool]] = []  # tag, number of furniture, main
    furniture: tuple[int, ...] = ()
    main = False
    mains: list[tuple[int, ...]] = []
    numbers = 0
    readers: set[int] = set()

    def add(text: str) -> None:
        nonlocal plain
        parts.append(text)
        plain = plain or bool(text.strip()) and not any(t == "a" for t, _, _ in stack)

    def end_line() -> None:
        nonlocal plain
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((text, furniture, main, not plain))
        plain = False

    def state() -> tuple[tuple[int, ...], bool]:
        return tuple(f for _, f, _ in stack if f is not None), any(m for _, _, m in stack)

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[1]:
            end = page.find("-->", m.start() + 2)
            at = size if end < 0 else end + 3
            continue
        if not m[3]:
            continue
        closing, tag, attributes = m[2], m[3].lower(), m[4]
        if not closing and tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            if tag in BLOCKS:
                end_line()
            else:
                parts.append(" ")
            continue
        if tag == "br" or tag in VOID - BLOCKS:
            parts.append(" ")
            continue
        if tag in BLOCKS:
            end_line()
        if closing:
            if any(t == tag for t, _, _ in stack):
                while stack.pop()[0] != tag:
                    pass
                if tag not in BLOCKS and state() != (furniture, main):
                    end_line()
                furniture, main = state()
            continue
        closes = CLOSES.get(tag, {"p"} if tag in BLOCKS else set())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in closes:
                del stack[k:]
                furniture, main = state()
                break
            if stack[k][0] in CONTAINERS:
                break
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        own = _is_furniture(tag, attributes, main)
        if own and tag not in BLOCKS and not furniture:
            end_line()
        numbers += own in (SOFT, COMMENTS)
        number = 0 if own == HARD else numbers if own else None
        if own == COMMENTS:
            readers.add(numbers)
        stack.append((tag, number, tag in MAIN))
        furniture, main = furniture if number is None else (*furniture, number), main or tag in MAIN
        if tag in MAIN:
            mains.append(furniture)
    end_line()
    cleared: set[int] = set()
    open_mains = [set(owners) for owners in mains if 0 not in owners]
    if open_mains and not any(not owners for owners in open_mains):
        cleared.update(*open_mains)
    while not any(cleared.issuperset(owners) for _, owners, *_ in lines):
        held: dict[int, int] = {}
        for text, owners, *_ in lines:
            if 0 not in owners and readers.isdisjoint(set(owners) - cleared):
                outer = next(k for k in owners if k not in cleared)
                held[outer] = held.get(outer, 0) + len(text)
        if not held:
            break
        cleared.add(max(held, key=lambda k: (held[k], -k)))
    has_main = any(owners <= cleared for owners in open_mains)
    return [(text, not cleared.issuperset(owners), main, link) for text, owners, main, link in lines], has_main


def kept_lines(sizes: list[int], window: int = WINDOW, surge: int = SURGE_CHARS) -> list[bool]:
    """Which lines lie between a surge and the next dive of the line-block distribution."""
    n = len(sizes)
    block = [sum(sizes[k:k + window]) for k in range(n)]
    kept, inside = [False] * n, False
    for k in range(n):
        if not inside and sizes[k] and block[k] > surge:
            inside = True
        elif inside and not block[k]:
            inside = False
        kept[k] = inside and sizes[k] > 0
    return kept


def line_weights(lines: list[tuple[str, bool, bool, bool]], has_main: bool, window: int, surge: int) -> list[int]:
    """What each line adds to the sums: its length, or nothing where it is furniture or outside the main elements.

    A main element marks its lines as text: each one weighs more than the threshold by itself.
    """
    if has_main:
        return [len(text) + surge if main and not furniture else 0 for text, furniture, main, _ in lines]
    links = [link and not furniture for _, furniture, _, link in lines]
    listed = [False] * len(lines)
    for k in range(len(lines) - window + 1):
        if all(links[k:k + window]):
            listed[k:k + window] = [True] * window
    return [0 if furniture or out else len(text) for (text, furniture, *_), out in zip(lines, listed)]


def dive_point(sizes: list[int], window: int = WINDOW, surge: int = SURGE_CHARS) -> int:
    """Where the text ends: the first line after the last surge at which the sums fall to zero.

    The sums of a surge pass over single lines of furniture, but not over a dive. Without a surge nothing ends.
    """
    end, surged, part, dived = len(sizes), False, [], False
    for k, size in enumerate([*sizes, 0]):
        over = k == len(sizes) or not sum(sizes[k:k + window])
        if size:
            part.append(size)
            dived = False
        if over and not dived:
            if any(sum(part[j:j + window]) > surge for j in range(len(part))):
                end, surged = k, True
            part, dived = [], True
    return end if surged else len(sizes)


def main_text(page: str, window: int = WINDOW, surge: int = SURGE_CHARS) -> str:
    lines, has_main = lines_of(page)
    weights = line_weights(lines, has_main, window, surge)
    dive = dive_point(weights, window, surge)
    runs: list[list[int]] = [[]]  # lines between furniture and lists of links
    for k, weight in enumerate(weights):
        if weight:
            runs[-1].append(k)
        elif runs[-1]:
            runs.append([])
    places = [k for run in runs for k in run]
    surged = kept_lines([weights[k] for k in places], window, surge)
    kept = {k for k, inside in zip(places, surged) if inside}
    out = []
    for run in runs:
        texts = [lines[k][0] for k in run]
        # Behind the dive only sentences are text.
        if not kept or not kept.isdisjoint(run) and (run[0] < dive or any(SENTENCE.search(t) for t in texts)):
            out += texts
    return "\n\n".join(out)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) per page."""
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))
    kinds = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("id", "url"))
    return slim.mapInArrow(_extract, f"{kinds}, text string").toDF(id_col, url_col, "text")
