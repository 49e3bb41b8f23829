"""Main text of web pages by the distribution of text over line blocks.

The markup is stripped and each block-level element becomes a line. Lengths of text are
summed over windows of ``WINDOW`` lines. The text between the first surge of the sums
over the threshold and the last dive under it is kept, whole, short lines included; the
lines around it that stand in the same container as its first or last line belong to it.
Lines that are mostly link text count nothing and are left out before the surge and
after the dive; between them, and in a marked article, nothing is.

What is never article is left out before lines are counted: scripts, styles, forms,
menus, page headers and footers, sidebars, adverts, notices and reader comments, by
element, role, class or id. A class or id counts if it is such a name as a whole, alone
or with words of layout (``ad-slot``, ``left-sidebar2``, not ``ad-hoc``), and on block
elements only; inline elements of marked parts go by their element alone. Formulas are
text, without their annotations; so is what browsers show without scripts. If a page marks its article (``article``, ``main``), surge
and dive are looked for inside, and widened to the ends of the marked elements that hold
them; other ``article`` elements beyond them, such as teasers, stay out. Several marked
elements that hold less than half of the page's text are teasers themselves: surge and
dive are looked for on the whole page then. A single marked element is always believed.
Marked text without a surge is kept whole.

Defined results: null and empty html have no text; unclosed elements end where HTML ends
them (a block closes an open paragraph, a closing tag closes what is open inside); tags
cut off at the end are dropped; rows are read one by one, equal rows alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.arrays import map_arrow

WINDOW = 3  # lines summed up
SURGE = 80  # characters in a window
LINKS = 0.5  # share of link text from which a line counts nothing

# HTML elements by what they do to lines.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea iframe svg annotation annotation-xml object canvas".split())
NEVER = frozenset("head title nav aside footer form menu button select option dialog label fieldset audio video map".split())
MARKED = frozenset("article main".split())
CONTAINERS = frozenset("article body center div html main section".split())
CLOSES_PARAGRAPH = BLOCKS - frozenset("html head body title td th tr caption tbody thead tfoot li dd dt legend summary".split())
OWN_KIND = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
            "th": ("tr", "table"), "option": ("select",)}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
LAYOUT = (
    r"(?:(?:main|site|page|top|bottom|left|right|primary|secondary|header|footer|global|mobile|sticky|user|reader|post|google)[_-]?)?",
    r"(?:[_-]?(?:box|container|wrapper|wrap|area|list|section|block|slot|unit|bar|banner|panel|holder|inner|outer|items|links))?"
    r"(?:[_-]?\d+)?")
NAMES = re.compile(LAYOUT[0] + (
    r"(?:ads?|adv|adverts?|advertisements?|advertising|adsbygoogle|sponsored|promo|nav|navbar|navigation|menu|menubar|breadcrumbs?|"
    r"pagination|pager|toolbar|side-?bar|aside|footer|notices?|notifications?|alerts?|comments?|disqus|respond|replies|"
    r"(?:cookies?|consent|gdpr)[_-]?(?:notice|consent|banner|bar|popup|modal|overlay|alert))") + LAYOUT[1])
# Names of page headers and notices that may name a part of an article: not inside a marked one.
PAGE_NAMES = re.compile(
    r"(?:(?:site|page|top|main|global)[_-]?header|masthead|banner|cookies?|consent|gdpr|popup|modal)" + LAYOUT[1])

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|<(?=[a-zA-Z/])[^>]*(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
WHITE = re.compile(r"\s+")


@dataclass
class Line:
    text: list[str] = field(default_factory=list)
    link: int = 0
    mark: int = 0  # the outermost marked element's number
    article: int = 0  # the outermost article's number
    container: int = -1


def _unwanted(name: str, rest: str, inside_article: bool) -> bool:
    """Whether an element is never article."""
    if name in NEVER or name == "header" and not inside_article:
        return True
    if "=" not in rest or name in ("html", "body") or inside_article and name not in BLOCKS:
        return False
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(rest)}
    if found.get("role", "").lower() in ROLES:
        return True
    if name in MARKED or name not in BLOCKS:
        return False
    named = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    return any(NAMES.fullmatch(n) or not inside_article and PAGE_NAMES.fullmatch(n) for n in named)


def lines_of(html: str) -> list[Line]:
    """The page's lines in order: text of each block without what is never article."""
    lines, now = [], Line()
    stack: list[tuple[str, bool, int, int, int]] = []  # element, left out, numbers of its mark, article and container
    places: dict[str, list[int]] = {}  # of each element that is open: its places on the stack
    at = links = opened = 0

    def close() -> None:
        nonlocal now
        if now.text:
            lines.append(now)
        now = Line()

    def text(part: str) -> None:
        if part and not (stack and stack[-1][1]):
            now.text.append(part)
            if stack and part.strip():
                now.mark, now.article, now.container = stack[-1][2:]
            if links:
                now.link += len(part.strip())

    def leave(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            name = stack.pop()[0]
            places[name].pop()
            if name in BLOCKS:
                close()
            links -= name == "a"

    def last_of(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def depth_of(names: tuple[str, ...], stop: tuple[str, ...] = ()) -> int | None:
        """Place of the last open element of the names, unless one of ``stop`` was opened in it."""
        depth = last_of(names)
        return None if depth < 0 or last_of(stop) > depth else depth

    while at < len(html):
        token = TOKEN.search(html, at)
        text(html[at:token.start() if token else None])
        if token is None:
            break
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if token["end"]:
            depth = depth_of((name,))
            if depth is not None:
                leave(depth)
            elif name in BLOCKS:
                close()
            continue
        if name in RAW:
            ends = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.I).search(html, at)
            at = ends.end() if ends else len(html)
            continue
        if name in CLOSES_PARAGRAPH:
            depth = depth_of(("p",), ("table", "td", "div", "article", "section", "body"))
            if depth is not None:
                leave(depth)
        elif name in OWN_KIND:
            own = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
            depth = depth_of(own, OWN_KIND[name])
            if depth is not None:
                leave(depth)
        if name == "br":
            text("\n")
        if name in BLOCKS:
            close()
        if name in VOID or token["rest"].rstrip().endswith("/") and name not in BLOCKS:
            continue
        out, mark, article, container = stack[-1][1:] if stack else (False, 0, 0, -1)
        opened += 1
        places.setdefault(name, []).append(len(stack))
        stack.append((name, out or _unwanted(name, token["rest"], mark > 0), mark or opened * (name in MARKED),
                      article or opened * (name == "article"), opened if name in CONTAINERS else container))
        links += name == "a"
    close()
    return lines


def main_text(html: str | None) -> str:
    """The blocks of the article, one empty line between them."""
    found = []
    for line in lines_of(html or ""):
        text = WHITE.sub(" ", unescape("".join(line.text))).strip()
        if text:
            found.append((text, line))
    sizes = [0 if line.link >= LINKS * len(text) else len(text) for text, line in found]
    marks = {line.mark for _, line in found} - {0}
    of_marks = sum(size for (_, line), size in zip(found, sizes, strict=True) if line.mark)
    if marks and (len(marks) == 1 or 2 * of_marks >= sum(sizes)):
        inner = [i for i, (_, line) in enumerate(found) if line.mark]
        found, sizes = [found[i] for i in inner], [sizes[i] for i in inner]
    else:
        marks = set()
    sums = [sum(sizes[i:i + WINDOW]) for i in range(len(sizes))]
    high = [i for i, s in enumerate(sums) if s >= SURGE]
    if not high:  # no window is long enough: all that is marked, or all lines that are not links
        return "\n\n".join(text for (text, _), size in zip(found, sizes, strict=True) if size or marks)
    # A window surges because of its long lines: the first of the first window, the last of the last one.
    long = [i for h in (high[0], high[-1]) for i in range(h, min(h + WINDOW, len(sizes))) if sizes[i] * WINDOW >= SURGE]
    surge, dive = min(long), max(long)
    ends = [found[i][1] for i in (surge, dive)]
    if marks:
        held, articles = {e.mark for e in ends}, {e.article for e in ends}
        kept = [i for i, (_, line) in enumerate(found) if surge <= i <= dive or line.mark in held and (
            not line.article or line.article in articles)]
    else:
        inside = {e.container for e in ends}
        first, last = surge, dive
        while first and found[first - 1][1].container in inside:
            first -= 1
        while last + 1 < len(found) and found[last + 1][1].container in inside:
            last += 1
        kept = range(first, last + 1)
    return "\n\n".join(found[i][0] for i in kept if sizes[i] or surge <= i <= dive or marks and found[i][1].article)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page."""
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("address"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                texts = [main_text(html) for html in rows.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("address"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["id", "address", "text", "n_chars"])

    kind = source.schema["id"].dataType.simpleString()
    made = map_arrow(source, run, f"id {kind}, address string, text string, n_chars bigint")
    return made.withColumnsRenamed({"id": id_col, "address": url_col})
