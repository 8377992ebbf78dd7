"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block element. Each line has a weight, its
characters outside links; the block at a line is the weight of the next `width` lines together.
Text begins at a surge (the block exceeds the threshold) and ends at a dive (the block is
zero); so it goes on every page. Elements, roles and names are prior weights alone: lines of
parts that are never the article (menus, page headers, footers, sidebars, notices, adverts,
forms, comments) weigh nothing, and a character in an article or main element, linked or not,
weighs `prior` times as much. Blocks do not reach across the border of such an element, and
lines beyond it must surge themselves. Unwanted lines keep text from beginning, but are
skipped within running text, so they do not end it.

Edge cases: null, empty and text-less pages give ''; unclosed and crossing elements end with
what encloses them; very long pages are read in one forward pass, whatever they leave open; repeated rows each get a
row; an empty table gives no rows; only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import table

_OPEN = re.compile(r"<(?:!|\?|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)

# Elements and names of HTML.
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul option".split())
_NEVER = frozenset("nav footer aside form head select button dialog menu object applet canvas audio video datalist search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion nav navbar navigation menu topbar breadcrumb breadcrumbs
    sidebar rail footer masthead cookie cookies cookiebar consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login paywall
    share sharing social related recommended widget comment comments commentlist disqus reply replies respond discussion search toolbar pagination pager skip""".split()
)
_HEADERS = frozenset(["header", "topbar", "site-title"])
#: Words that say nothing of their own in a name: in an article, a name is unwanted only if all its parts are of these or the above.
_PLAIN = frozenset("area article articles bar block body box button buttons center container content form group holder icons inline inner item items left link links list main message page panel post posts right row section site slot small stories story text thread unit wrap wrapper".split())
_UNLESS = re.compile(r"(?:no|has|with|without)[_-]\w+")
_IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_ENDS_P = _BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}


def _named(value: str, in_article: bool) -> bool:
    """Whether a class or id names a part that is no article: by any part of a name, or inside an article by whole names."""
    for token in _UNLESS.sub("", value).split():
        parts = [x for x in re.split(r"[_-]+", token) if x]
        if in_article:
            if token in _NAMES or any(x in _NAMES for x in parts) and all(x in _NAMES or x in _PLAIN or x.isdigit() for x in parts):
                return True
        elif token in _HEADERS or any(x in _NAMES or x in _HEADERS for x in parts):
            return True
    return False


def _unwanted(name: str, attributes: str, in_article: bool) -> bool:
    if name in _NEVER or name == "header" and not in_article:
        return True
    if not attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("html", "body", "main", "article") and key != "role":
            if name == "article" and re.search(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies))(?:$|[\s_-])", value):
                return True
            continue
        if key == "role" and value in _ROLES:
            return True
        if key in ("class", "id") and _named(value, in_article):
            return True
    return False


class _Page:
    """A page whose tags are found in one pass: what was looked for in vain is not looked for again."""

    def __init__(self, page: str):
        self.page, self.gone = page, set()

    def find(self, what: str, at: int) -> int:
        """Where `what` comes next from a place on, or -1; where it is -1, it stays so, as places only grow."""
        if what in self.gone:
            return -1
        if (found := self.page.find(what, at)) < 0:
            self.gone.add(what)
        return found

    def end_of(self, at: int) -> int:
        """Where a tag ends whose attributes begin at a place, if a `>` follows: after the next one outside quotes; a quote that is not closed is none."""
        while m := _STOP.search(self.page, at):
            at = m.end()
            if m[0] == ">":
                return at
            at = max(at, self.find(m[0], at) + 1)
        return self.page.rfind(">") + 1  # all are in quotes

    def tag(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the next tag from a place on; a comment or a declaration has no name, a marked section the name `[` and its text as attributes."""
        page = self.page
        if not (m := _OPEN.search(page, at)):
            return None
        start = m.start()
        if page.startswith("<!--", start) or self.find(">", start) < 0:
            if (start := self.find("<!--", start)) < 0:
                return None
            end = self.find("-->", start + 4)
            return start, end + 3 if end >= 0 else len(page), "", "", ""
        if m[2]:
            end = self.end_of(m.end())
            return start, end, m[1], m[2].lower(), page[m.end() : end - 1]
        if page.startswith("<![CDATA[", start) and (end := self.find("]]>", start)) >= 0:
            return start, end + 3, "", "[", page[start + 9 : end]
        return start, self.find(">", start) + 1, "", "", ""


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, characters outside links, inside an article) of each line; unwanted lines are ('', 0, False)."""
    out: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # element, unwanted, inside an article, inside a link
    where: dict[str, list[int]] = {}  # the places of each element in the stack
    menus: set[int] = set()  # those of unwanted menus and headers
    text: list[str] = []
    linked: list[str] = []
    state = (False, False, False)

    def say(raw: str) -> None:
        if not state[0]:
            text.append(raw)
            if state[2]:
                linked.append(raw)

    def end_line() -> None:
        if text:
            if line := " ".join(html.unescape("".join(text)).split()):
                own = len(" ".join(html.unescape("".join(linked)).split()))
                out.append((line, len(line) - own, state[1]))
            text.clear()
            linked.clear()
        elif state[0]:
            out.append(("", 0, False))

    def pop(at: int) -> None:
        nonlocal state
        if any(x[0] in _BLOCK for x in stack[at:]):
            end_line()
        for i in range(len(stack) - 1, at - 1, -1):
            where[stack[i][0]].pop()
            menus.discard(i)
        del stack[at:]
        state = stack[-1][1:] if stack else (False, False, False)

    def close(names: set[str], scope: set[str]) -> None:
        last = lambda of: max((where[x][-1] for x in of if where.get(x)), default=-1)
        if (i := last(names)) > last(scope):
            pop(i)

    at, tags = 0, _Page(page)
    while found := tags.tag(at):
        start, end, slash, name, attributes = found
        if start > at:
            say(page[at:start])
        at = end
        if not name:
            continue
        if name == "[":
            say(html.escape(attributes, False))
            continue
        if slash:
            if name in ("br", "p") and not where.get(name):
                say(" ")
            else:
                close({name}, {"table"} if name not in ("table", "body", "html", "article", "main", "div", "section") else set())
            continue
        if name in _RAW:
            shut = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = (tags.find(">", shut.end()) + 1 if shut else 0) or len(page)
            say(" ")
            continue
        if name in _VOID:
            end_line() if name == "hr" else say(" ")
            continue
        if name in _ENDS_P:
            close({"p"}, {"table", "td", "th", "article", "section", "div", "aside", "nav", "li", "button"})
        if name in _IMPLIED and name != "p":
            close(_IMPLIED[name], _SCOPES.get(name, set()))
        if name in _BLOCK:
            end_line()
        unwanted, article, link = state
        if name in ("article", "main") and unwanted and menus:
            unwanted = False  # an unclosed menu or header before it
        unwanted = unwanted or _unwanted(name, attributes, article)
        if unwanted and name in ("nav", "header"):
            menus.add(len(stack))
        where.setdefault(name, []).append(len(stack))
        state = (unwanted, article or (name in ("article", "main") and not unwanted), link or name == "a")
        stack.append((name, *state))
    if at < len(page):
        say(page[at:])
    end_line()
    return out


def weights(found: list[tuple[str, int, bool]], prior: int) -> list[tuple[int, bool]]:
    """(weight, inside an article) of each line: its characters outside links, or in an article `prior` times all of them; an unwanted line weighs nothing, on the side of the line before it."""
    only_links = not any(own or article for text, own, article in found if text)
    out: list[tuple[int, bool]] = []
    for text, own, article in found:
        if not text:
            out.append((0, bool(out) and out[-1][1]))
        else:
            out.append((prior * len(text) if article else len(text) if only_links else own, article))
    return out


def blocks(lines: list[tuple[int, bool]], width: int) -> list[int]:
    """For each line the weight of it and the next ones, `width` in all, as far as they are on its side of an article's border."""
    out = [0] * len(lines)
    total = stop = 0
    for i, (weight, side) in enumerate(lines):
        stop = max(stop, i)
        while stop < min(len(lines), i + width) and lines[stop][1] == side:
            total += lines[stop][0]
            stop += 1
        out[i] = total
        total -= weight
    return out


def main_text(page: str | None, width: int = 3, threshold: int = 86, prior: int = 8) -> str:
    """The lines from each surge to the next dive. A page whose largest block is below the threshold surges there."""
    found = lines_of(page) if page else []
    lines = weights(found, prior)
    ahead = blocks(lines, width)
    surge = min(threshold, max(ahead, default=0) - 1)
    running = iter(blocks([x for x, f in zip(lines, found) if f[0]], width))  # unwanted lines do not end running text
    kept, inside, before = [], False, False
    for (text, _, _), (weight, side), block in zip(found, lines, ahead):
        if not text:
            continue
        rest = next(running)
        inside = rest > 0 if inside and side == before else block > surge
        before = side
        if inside and weight > 0:
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""

    def run(batches):
        for batch in batches:
            column = batch.column(2)
            found = [main_text(column[i].as_py()) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select("page_id", "url", "html").mapInArrow(run, kind)


def op9_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
