"""Main text of web pages by the distribution of text over line blocks.

A page is stripped of its markup into lines, one for each block in page order; a line weighs as many characters as it
has outside links, and nothing inside a menu, page header, footer, sidebar, notice, advert, form or reader comment. Weights are
summed over windows of ``window`` lines. Text begins at a surge, where the sum rises above a bar, and ends at a dive, where the sum
falls to 0; all lines between the two stay, short ones too. Where a page names its article, only lines inside it
have weight, and any sum above 0 is a surge.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SURGE = 3, 86
OUT_BYTES = 8 << 20

# A quote counts only after "=". All loops are possessive, so a page is read in linear time.
TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])|\Z", re.I) for name in "script style title textarea iframe noembed noframes xmp".split()}
BLOCKS = frozenset(
    "address article aside blockquote body center caption dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
BLOCKS_BUT_P = BLOCKS - {"p"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element that begins ends an open one of its kind, up to the element that holds both.
ENDS_OWN_KIND = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
BESIDE = frozenset("nav footer aside form button select datalist template noscript svg canvas object audio video dialog menu head".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
# Words that, as a class or id, name what stands beside the text.
_HINT = (
    "ad|ads|advert|adverts|advertisement|advertisements|advertising|adsense|adsbygoogle|adbox|sponsor|sponsored|sponsors|promo|promoted|promotion|"
    "nav|navbar|navigation|menu|submenu|breadcrumb|breadcrumbs|pagination|pager|header|masthead|topbar|banner|footer|bottombar|copyright|legal|"
    "sidebar|sidebars|aside|rail|widget|widgets|related|recommended|recommendations|trending|popular|tags|toolbar|"
    "notice|notices|cookie|cookies|consent|gdpr|popup|modal|overlay|disclaimer|alert|announcement|paywall|"
    "newsletter|subscribe|subscription|signup|login|search|searchbox|form|share|sharing|social|"
    "comment|comments|commentlist|respond|reply|replies|disqus|discussion|skip|print|hidden"
)
HINT = re.compile(rf"(?:[a-z0-9]+[-_])*?(?:{_HINT})(?:[-_](?:[0-9]+|box|bar|area|container|wrapper|wrap|block|section|list|list[-_]?item|item|items|links?|panel|unit|slot|top|bottom|left|right|main|inner|form|text|title|body|content|message|banner|nav|menu|widget))*")
NO_HINT = re.compile(r"(?:has|have|with|without|no|is|not)[-_].*|.*[-_](?:open|enabled|disabled|active)")
COMMENT = re.compile(r".*(?:comment|repl(?:y|ies)|respond|disqus|discussion).*")
NOTHING: frozenset[str] = frozenset()
FREE, IN_HEADER, BESIDE_TEXT, COMMENTS = 0, 1, 2, 3


HEADER = re.compile(r".*header.*")


def _attributes_say(name: str, written: str) -> int:
    """What class, id, role and visibility say of an element: FREE, IN_HEADER, BESIDE_TEXT or COMMENTS."""
    if name in ("html", "body"):
        return FREE
    say = FREE
    for key, *values in ATTRIBUTE.findall(written):
        key, value = key.lower(), unescape("".join(values)).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            say = max(say, BESIDE_TEXT)
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            say = max(say, BESIDE_TEXT)
        elif key == "role" and value.strip() in BESIDE_ROLES:
            say = max(say, BESIDE_TEXT)
        elif key in ("class", "id", "itemprop"):
            for word in value.split():
                if HINT.fullmatch(word) and not NO_HINT.fullmatch(word):
                    if COMMENT.fullmatch(word):
                        say = COMMENTS
                    elif name not in ("article", "main"):
                        say = max(say, IN_HEADER if HEADER.fullmatch(word) else BESIDE_TEXT)
    return say


def page_lines(page: str) -> list[tuple[str, int, int, bool]]:
    """(text, characters outside links, number of the article, is a heading) for every line that is not beside the text.

    The article is 0 outside of any; each outermost ``article`` has its own number, ``main`` is -1.
    """
    lines: list[tuple[str, int, int, bool]] = []
    pieces: list[str] = []
    outside = 0  # characters of the line outside links
    # Open elements: name, state, article, and whether inside a link or a heading.
    stack: list[tuple[str, int, int, bool, bool]] = []
    opened: Counter[str] = Counter()
    said: dict[tuple[str, str], int] = {}
    state, article, link, heading = FREE, 0, False, False
    articles = 0

    def end_line() -> None:
        nonlocal outside
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                lines.append((text, outside, article, heading))
            pieces.clear()
        outside = 0

    def pop_to(depth: int) -> None:
        nonlocal state, article, link, heading
        _, state, article, link, heading = stack[depth]
        while len(stack) > depth:
            opened[stack.pop()[0]] -= 1

    def close(name: str, holders: frozenset[str] | set[str]) -> None:
        """Ends the innermost open ``name``, unless one of ``holders`` stands between."""
        if not opened[name]:
            return
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] == name:
                pop_to(depth)
                return
            if stack[depth][0] in holders:
                return

    def add(text: str) -> None:
        nonlocal outside
        if state == FREE:
            if "&" in text:
                text = unescape(text)
            pieces.append(text)
            if not link:
                outside += 0 if text.isspace() else len(text)

    at, size = 0, len(page)
    while at < size:
        token = TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        name = token[2].lower()
        if token[1]:
            if name in BLOCKS or name == "br":
                end_line()
            close(name, NOTHING if name in BLOCKS else BLOCKS)  # an inline element ends inside its block only
            continue
        if name in VOID:
            if name in ("br", "hr"):
                end_line()
            continue
        if name in RAW_ENDS:
            at = RAW_ENDS[name].search(page, at).start()
            continue
        if name in BLOCKS:
            end_line()
            if name != "head":
                close("head", NOTHING)  # a head that was not closed
            close("p", BLOCKS_BUT_P)
        elif name in ("td", "th"):
            add(" ")
        elif name == "a":
            close("a", BLOCKS)
        if name in ENDS_OWN_KIND:
            close(name, ENDS_OWN_KIND[name])
        say = FREE
        if token[3]:
            if (name, token[3]) not in said:
                said[name, token[3]] = _attributes_say(name, token[3])
            say = said[name, token[3]]
        if say == FREE and name not in BLOCKS and name not in BESIDE and name not in ("a", "td", "th"):
            continue  # an inline element changes nothing
        stack.append((name, state, article, link, heading))
        opened[name] += 1
        if name in ("article", "main") and say == FREE and article <= 0 and state != COMMENTS:
            # An article cannot stand in a menu: that one was not closed. One in a sidebar or footer is a teaser.
            if state == FREE or not any(x[0] in ("aside", "footer", "form") for x in stack):
                state = FREE
                if name == "main":
                    article = -1
                else:
                    articles += 1
                    article = articles
        elif say > IN_HEADER or name in BESIDE:
            state = max(state, say, BESIDE_TEXT)
        elif name == "header" or say == IN_HEADER:
            state = max(state, IN_HEADER if article > 0 else BESIDE_TEXT)
        elif name in HEADINGS and state == IN_HEADER:
            state = FREE  # the headline of an article often stands in its header
        if name == "a":
            link = True
        elif name in HEADINGS:
            heading = True
    end_line()
    return lines


def _regions(weights: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """[first, end) of the lines between each surge and the dive after it."""
    n, regions, i = len(weights), [], 0
    sums = [sum(weights[k : k + window]) for k in range(n)]
    while i < n:
        if sums[i] > surge:
            end = i
            while end < n and sums[end] > 0:
                end += 1
            first = i
            while first > 0 and weights[first - 1] > 0:  # text that leads up to the surge
                first -= 1
            regions.append((first, end))
            i = end
        else:
            i += 1
    return regions


def main_text_of(page: str, window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The blocks of the main text of one page, in page order."""
    lines = page_lines(page)
    in_articles = sum(line[1] for line in lines if line[2] > 0)
    in_main = sum(line[1] for line in lines if line[2] < 0)
    kind = 0
    if in_articles or in_main:
        kind, surge = (1 if in_articles >= in_main else -1), 0
    kept: list[str] = []
    groups: dict[int, list[tuple[str, int, int, bool]]] = {}
    for line in lines:
        if line[2] * kind > 0 or kind == 0:
            groups.setdefault(line[2], []).append(line)
    for group in groups.values():
        weights = [line[1] for line in group]
        regions = _regions(weights, window, surge)
        if not regions and any(weights):
            regions = _regions(weights, window, 0)  # a page of a few words
        for first, end in regions:
            # Links at either side lead elsewhere, unless they are headings.
            while first < end and not weights[first] and not group[first][3]:
                first += 1
            while first < end and not weights[end - 1]:
                end -= 1
            kept += [line[0] for line in group[first:end]]
    return kept


def extract_main_text(pages: DataFrame, window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """page_id, url, text, n_chars (code points) and n_blocks for every row of ``pages`` (page_id, url, html).

    ``text`` has the blocks joined by one line feed; character references are decoded and white space inside a block
    is one space. Null, empty and blank pages, and pages of links alone, have an empty text. Unclosed and crossing
    elements, comments and scripts are read as far as they go, to the end of the page if need be. Repeated rows and
    null ids are kept as they are; other columns are ignored, whatever their names. Pages are read whole, at any
    length, each by itself: there is no shuffle.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, blocks = 0, 0, []
            htmls = batch.column(2)
            for i in range(batch.num_rows):
                blocks.append(main_text_of(htmls[i].as_py() or "", window, surge))
                size += sum(map(len, blocks[-1]))
                if size > OUT_BYTES or i + 1 == batch.num_rows:
                    texts = pa.array(["\n".join(b) for b in blocks], pa.string())
                    counts = pa.array(list(map(len, blocks)), pa.int64())
                    ids = [batch.column(k).slice(first, len(blocks)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*ids, texts, counts], ["page_id", "url", "text", "n_blocks"])
                    first, size, blocks = i + 1, 0, []

    types = {k: pages.schema[k].dataType.simpleString() for k in ("page_id", "url")}
    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_blocks bigint"
    found = pages.select("page_id", "url", "html").mapInArrow(extract, schema)
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_blocks")
