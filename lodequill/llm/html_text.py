"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of text in page order; of
menus, headers, footers, sidebars, notices, adverts, forms and reader comments
each block leaves an empty line, scripts and styles leave none. Text lengths are
summed over windows of `window` lines. Where the sum is largest lies the main
text. Going back from there, the sums fall to zero before the surge, going on
they fall to zero after the dive, and the lines between the two are the result.
This decides on every page; markup only shapes the distribution:

- Lines that are mostly links count as empty, as menus without a name are.
- Around the <main> or <article> (with the articles beside it in the same
  element) that holds the densest window stand `window` empty lines, so that
  the surge and the dive lie at its ends at the latest.
- Inside it, boxes that were taken out leave fewer empty lines than a window,
  and links in the outermost article (in the main, if no article holds the
  window) count like text. So titles, short lines and one-line closings stay.

A <header> inside an article or main keeps its headings and loses the rest.

Defined results: a null or empty html, or a page without such text, gives an
empty text of 0 characters. Character references are decoded once, white space
inside a block becomes one space, blocks are joined by two line feeds. Unclosed
elements end with the element around them; unclosed comments and scripts end
with the page. After a tag whose quotes never close, tags of that page end at
the next >, quoted or not; a < without any > after it is text. The scan is
linear in the page's length. Rows are independent, so ties, repeated rows and
null page_ids pass through; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits

SCHEMA = "page_id long, url string, text string, n_chars long"
WINDOW = 3

_NAME_AT = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTED_END = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {t: re.compile(f"</{t}(?=[\\s/>])[^>]*>?", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
_ENDS_P = _BLOCKS - frozenset("body head html td th tr tbody thead tfoot caption option optgroup".split())
_SCOPE = frozenset("article aside body button div footer form header main nav section table td th ul ol dl menu blockquote figure fieldset details dialog".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SIBLING_SCOPE = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")), "option": frozenset(("select",))}
_DROPPED = frozenset("nav header footer aside form script style noscript template iframe svg math canvas object audio video select button input textarea dialog menu search head map".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_NAME = r"(?:ad|ads|advert\w*|adsense|adslot|banner|promo\w*|sponsor\w*|sidebar|widget|nav|navbar|navigation|menu|breadcrumbs?|footer|header|masthead|cookies?|consent|gdpr|notice|newsletter|subscribe|subscription|popup|modal|overlay|comments?|disqus|respond|repl(?:y|ies)|share|sharing|social|related|recommend\w*|pagination|pager|toolbar|login|signup|search|skip-?link)"
_PLAIN = r"(?:box|wrap|wrapper|container|inner|outer|block|area|bar|section|list|item|items|links?|buttons?|icons?|form|slot|unit|top|bottom|left|right|posts?|articles?|stories|thread|\d+(?:x\d+)?)"
_NAMES = re.compile(rf"(?:^|[\s_-]){_NAME}(?=$|[\s_-])", re.I)
# A whole class or id of such names; words that only say where or what kind of box may stand beside them.
_WHOLE = re.compile(rf"(?:{_PLAIN}[_-]+)*{_NAME}(?:[_-]+(?:{_NAME}|{_PLAIN}))*", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOXES = frozenset("div section ul ol dl table details fieldset figure center span".split())


def _named(name: str, key: str, value: str, inside: bool) -> bool:
    """Whether a class or id names boilerplate. Ids inside an article are often
    made from its headings, so only whole names count there, ids only of boxes,
    and headings are never dropped by one."""
    if not inside:
        return bool(_NAMES.search(value))
    if name in _HEADINGS or key == "id" and name not in _BOXES:
        return False
    return any(_WHOLE.fullmatch(x) for x in value.split())


def _unwanted(name: str, attrs: str, inside: bool = False) -> bool:
    if name in _DROPPED:
        return True
    if not attrs or attrs.isspace() or name in ("html", "body", "article", "main"):
        return False
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id") and _named(name, key, value, inside) or key == "role" and value.lower() in _ROLES:
            return True
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _tags(page: str):
    """(start, end, name, closing, attributes) of each tag, in one pass; comments
    and declarations have an empty name. The caller may send the position to go
    on from."""
    pos, n, quoted = 0, len(page), True
    while (at := page.find("<", pos)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            pos = n if end < 0 else end + 3
            yield at, pos, "", False, ""
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            pos = n if end < 0 else end + 1
            yield at, pos, "", False, ""
            continue
        m = _NAME_AT.match(page, at + 1)
        if not m:
            pos = at + 1
            continue
        end = _QUOTED_END.match(page, m.end()) if quoted else None
        if not end:
            quoted = False
            close = page.find(">", m.end())
            if close < 0:
                return
        pos = end.end() if end else close + 1
        sent = yield at, pos, m[2].lower(), bool(m[1]), page[m.end() : pos - 1]
        pos = sent or pos


def lines(page: str) -> tuple[list[tuple[str, int, int, int]], list[tuple[str, int, int]]]:
    """(text, characters inside links, number of the article or main element
    around it or 0, empty lines before it) for each block of text that isn't
    dropped, and of each such element the name, the number of the one around it
    and its parent element."""
    out: list[tuple[str, int, int, int]] = []
    regions = [("", 0, 0)]
    parts: list[str] = []
    stack: list[tuple[str, int, int, bool, int]] = []  # name, dropped here, region, link, serial number
    where: dict[str, list[int]] = {}  # the places of each open name
    scopes: list[int] = [-1]  # and of those that end a paragraph's reach
    linked = serial = empty = dropped = soft = region = links = pos = 0
    ghost = False

    def flush():
        nonlocal linked, empty, ghost
        if parts:
            if text := " ".join("".join(parts).split()):
                out.append((text, linked, region, empty))
                empty = 0
            parts.clear()
        linked, empty, ghost = 0, empty + ghost, False

    def push(name, drop, inner):
        nonlocal dropped, links, serial
        dropped += drop
        links += name == "a"
        serial += 1
        where.setdefault(name, []).append(len(stack))
        if name in _SCOPE:
            scopes.append(len(stack))
        stack.append((name, drop, inner, name == "a", serial))

    def pop():
        nonlocal dropped, soft, region, links
        name, drop, inner, link, _ = stack.pop()
        where[name].pop()
        if name in _SCOPE:
            scopes.pop()
        if name in _BLOCKS or inner:
            flush()
        dropped -= drop
        soft -= drop == 1 and name == "header" and region > 0
        links -= link
        if inner:
            region = regions[inner][1]

    def last(names):
        return max((w[-1] for x in names if (w := where.get(x))), default=-1)

    def close(names, limit):
        k = last(names)
        if k >= 0 and k > limit():
            while len(stack) > k:
                pop()

    def put(text):
        nonlocal linked, ghost
        if not text:
            return
        if dropped:
            ghost = ghost or not text.isspace()
            return
        text = _html.unescape(text)
        parts.append(text)
        if links:
            linked += len(text.strip())

    scan, sent = _tags(page), None
    while True:
        try:
            at, end, name, closing, attrs = scan.send(sent)
        except StopIteration:
            break
        put(page[pos:at])
        pos, sent = end, None
        if not name:
            continue
        if closing:
            if where.get(name):
                k = where[name][-1]
                while len(stack) > k:
                    pop()
            elif name in _BLOCKS:
                flush()
            continue
        if name in _BLOCKS:
            flush()
            if name in _ENDS_P:
                close(("p",), lambda: scopes[-1])
            if name in _SIBLINGS:
                close(_SIBLINGS[name], lambda: last(_SIBLING_SCOPE[name]))
        elif name == "br":
            put(" ")
        if name in _RAW_END:
            m = _RAW_END[name].search(page, pos)
            pos = sent = m.end() if m else len(page)
            continue
        if name in _VOID or attrs.endswith("/") and name not in _BLOCKS:
            continue
        drop, inner = int(_unwanted(name, attrs, region > 0)), 0
        if drop and name == "header" and region:
            soft += 1
        elif name in _HEADINGS and not drop and dropped and dropped == soft:
            drop = -dropped  # a heading in an article's header stays
        if name in ("article", "main") and not dropped:
            regions.append((name, region, stack[-1][4] if stack else 0))
            region = inner = len(regions) - 1
        if drop or name == "a" or name in _BLOCKS or name in _SCOPE:  # others change nothing
            push(name, drop, inner)
    put(page[pos:])
    while stack:
        pop()
    flush()
    return out, regions


def _peak(length: list[int], window: int) -> int:
    """The longest line of the first densest window."""
    total = best = sum(length[:window])
    at = 0
    for i in range(1, len(length)):
        total += (length[i + window - 1] if i + window <= len(length) else 0) - length[i - 1]
        if total > best:
            best, at = total, i
    return max(range(at, min(len(length), at + window)), key=lambda i: (length[i], -i))


def _between(length: list[int], start: int, window: int) -> tuple[int, int]:
    """Surge and dive around a line: the last places before and after it where
    no window of empty lines has been met."""
    found = []
    for step in (-1, 1):
        edge, run, i = start, 0, start + step
        while 0 <= i < len(length) and run < window:
            run = 0 if length[i] else run + 1
            if length[i]:
                edge = i
            i += step
        found.append(edge)
    return found[0], found[1]


def main_text(page: str | None, window: int = WINDOW) -> str:
    found, regions = lines(page) if page else ([], [])
    if not found:
        return ""
    outer, article = [0], [0]  # of each region: the outermost one, and the outermost article
    for k, (name, around, _) in enumerate(regions[1:], 1):
        outer.append(outer[around] or k)
        article.append(article[around] or (k if name == "article" else 0))
    length = [0 if 2 * linked > len(text) else len(text) for text, linked, _, _ in found]
    core = _peak(length, window)
    own = found[core][2]
    low, high, inside = 0, len(found) - 1, set()
    if own:
        top = article[own]
        kin = {k for k in set(article) - {0} if regions[k][1:] == regions[top][1:]} if top else set()
        inside = {k for k in range(1, len(regions)) if (article[k] == top if top else outer[k] == outer[own])}
        near = [i for i, x in enumerate(found) if x[2] and (article[x[2]] in kin or outer[x[2]] == outer[own])]
        low, high = near[0], near[-1]
    spread, line_at = [], []  # the distribution, and where each line stands in it
    for i, (text, _, region, empty) in enumerate(found):
        if own and i in (low, high + 1):
            empty = max(empty, window)
        elif own and low < i <= high:
            empty = min(empty, window - 1 if length[i - 1] or found[i - 1][2] in inside else 0)
        spread += [0] * min(empty, window)
        line_at.append(len(spread))
        spread.append(len(text) if region in inside else length[i])
    surge, dive = _between(spread, line_at[core], window)
    return "\n\n".join(x[0] for x, at in zip(found, line_at) if surge <= at <= dive)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row."""
    arrow_limits(pages.sparkSession, 1000, 4)

    def run(batches):
        for b in batches:
            texts = [main_text(v.as_py()) for v in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, SCHEMA)
