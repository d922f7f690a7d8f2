r"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block-level tags. Pass one decides what it
can: blocks inside menus, headers, footers, sidebars, notices, adverts, forms
and comments (by tag, role, class or id) and blocks outside an article that
are mostly links are boilerplate; long blocks, or medium ones with many stop
words, are text. Short blocks, those with too few stop words, and those of an
article that are mostly links, stay open. A class or id marks no article and
nothing that holds one, and says nothing where it names a state of the element
(``has-sidebar``, ``comments-open``); if all text of a page were marked, its
marks by class and id do not count. In pass two an open
block takes the label of the nearest decided block of its region (the
enclosing article, if there is one); between two different neighbours the
nearer counts, at the same distance the text. A page that marks its article
has no text outside it.

Scripts, styles and the like are skipped up to their end tag, as browsers do.
Character references are decoded, white space in a block is one space, blocks
are joined by a line feed. No block of the text is dropped or shortened.

Each page is worked on alone: no shuffle.

Cases: null and empty pages give an empty text; unclosed and stray tags are
accepted; a page of short blocks only is text; very long pages are whole;
equal pages give equal texts; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_slices

BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
SKIPPED = frozenset(
    "audio button canvas datalist embed head iframe map noembed noframes noscript optgroup option script "
    "select style svg template textarea title video".split()
)
RAW = frozenset("iframe noembed noframes noscript script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("aside dialog footer form menu nav".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words of class and id that mark boilerplate.
MARKS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter "
    "notice notification pager pagination popup promo promoted promotion recommended related replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they "
    "this to was were which will with you au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur "
    "mais ne nous ou par pas pour que qui sa se ses son sur un une vous als auch auf aus bei bin das dass dem den der "
    "des die ein eine einer es für hat ich ihr im ist mit nach nicht noch nur oder sich sie sind so um und von war wie "
    "wir zu zum zur al como con del el ella ellos era es esta este fue ha hay las lo los más mi muy no o para pero por "
    "si sin su sus también te tu una y ya".split()
)
SHORT, LONG = 70, 140
MANY_LINKS = 0.5
STOPS = 0.2

#: Words that make a name of a class the name of a state.
STATES_BEFORE = frozenset("has hide is no not show with without".split())
STATES_AFTER = frozenset("allowed closed disabled enabled layout off on open".split())

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORD = re.compile(r"\w+")


@dataclass
class Block:
    text: str
    linked: int  # code points inside links
    outside: bool  # in a part that is not the article, by tag, role or style
    marks: frozenset[int]  # numbers of the elements around it that class or id mark
    region: int  # number of the enclosing article, 0 if none
    heading: bool


class Tags:
    """Finds the tags of a page from left to right; work is linear in the page whatever it holds.

    A quote matters where it opens a value (after ``=``) and is closed later.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}

    def next(self, at: int) -> tuple[int, int, str | None, str, str] | None:
        """(start, end, slash or None for a comment or declaration, name, attributes) of the next tag."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0:
                return None
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, None, "", ""
            if page.startswith(("<!", "<?"), start):
                end = page.find(">", start)
                return start, len(page) if end < 0 else end + 1, None, "", ""
            found = NAME.match(page, start + 1)
            end = self._end(found.end()) if found else -1
            if end >= 0:
                return start, end + 1, found[1], found[2].lower(), page[found.end() : end]
            at = start + 1

    def _end(self, at: int) -> int:
        """Where the tag's ``>`` is, or -1."""
        page = self.page
        while at <= self.last[">"]:
            stop = STOP.search(page, at)
            if stop[0] == ">":
                return stop.start()
            at = stop.end()
            back = stop.start() - 1
            while back >= 0 and page[back] in " \t\r\n\f" and stop.start() - back < 64:
                back -= 1
            if back >= 0 and page[back] == "=" and self.last[stop[0]] >= at:
                at = page.index(stop[0], at) + 1
        return -1

    def after_raw(self, tag: str, at: int) -> int:
        """The end of the closing tag of an element whose content is no markup."""
        stop = re.compile(rf"</{tag}\b", re.I).search(self.page, at)
        end = self.page.find(">", stop.end()) if stop else -1
        return len(self.page) if end < 0 else end + 1


def _is_mark(name: str) -> bool:
    """Whether a name of class or id marks boilerplate."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    if MARKS.isdisjoint(words):
        return False
    return not (words[0] in STATES_BEFORE or words[-1] in STATES_AFTER)


def _marked(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is boilerplate by tag, role or style, and whether by class or id."""
    if tag in BOILERPLATE or (tag == "header" and not in_article):
        return True, False
    if not attributes.strip() or tag in ("html", "body", "main"):
        return False, False
    named = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id") and tag != "article" and any(map(_is_mark, value.split())):
            named = True
        if name == "role" and value in ROLES:
            return True, named
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, named
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, named
    return False, named


def blocks_of(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, int]] = []  # tag, marked, region, number if marked by class or id
    tags = Tags(page)
    elements = 0
    holds_article: set[int] = set()  # marked elements around an article
    parts: list[str] = []
    linked = links = breaks = regions = 0
    at, end = 0, len(page)
    skipped = ""  # the element whose content is passed over
    depth = 0

    def close() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(
                Block(text, linked, any(x[1] for x in stack), frozenset(x[3] for x in stack if x[3]),
                      stack[-1][2] if stack else 0, any(x[0] in HEADINGS for x in stack))
            )
        parts, linked = [], 0

    def say(raw: str) -> None:
        nonlocal linked, breaks
        text = html.unescape(raw)
        if text.strip():
            breaks = 0
            if links:
                linked += len(" ".join(text.split()))
        parts.append(text)

    while at < end:
        found = tags.next(at)
        if found is None:
            if not skipped:
                say(page[at:])
            break
        start, stop, slash, tag, attributes = found
        if start > at and not skipped:
            say(page[at:start])
        at = stop
        if slash is None:
            continue
        closing = bool(slash)
        if skipped:
            if tag == skipped:
                depth += -1 if closing else 1
                if depth == 0:
                    skipped = ""
            elif skipped == "head" and tag in ("body", "article", "main", "div", "p"):
                skipped = ""  # a head that was never closed
            if skipped or closing:
                if skipped and not closing and tag in RAW:
                    at = tags.after_raw(tag, at)
                    depth -= tag == skipped
                continue
        if tag in SKIPPED:
            if closing or tag == "embed" or attributes.endswith("/"):
                continue
            if tag in RAW:
                at = tags.after_raw(tag, at)
            else:
                skipped, depth = tag, 1
            parts.append(" ")
            continue
        if tag == "br":
            breaks += 1
            parts.append(" ")
            if breaks == 2:
                close()
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag not in BLOCK:
            continue
        close()
        links = breaks = 0
        if tag == "hr":
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if stack and stack[-1][0] == "p" or stack and stack[-1][0] == tag and tag in ("li", "dt", "dd", "td", "th", "tr"):
            stack.pop()
        region = stack[-1][2] if stack else 0
        if tag in ("article", "main") and not region:
            regions += 1
            region = regions
            holds_article.update(x[3] for x in stack)
        marked, named = _marked(tag, attributes, region > 0)
        elements += named
        stack.append((tag, marked, region, elements if named else 0))
    close()
    return [replace(b, marks=b.marks - holds_article) if b.marks else b for b in out]


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def decide(block: Block) -> bool | None:
    """Pass one: text, boilerplate or (None) open."""
    n = len(block.text)
    if block.outside:
        return False
    if block.linked > MANY_LINKS * n and not block.heading:
        return None if block.region else False
    if n < SHORT or block.heading:
        return None
    if n >= LONG and block.region:
        return True
    words = WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words)
    return True if stops >= STOPS * len(words) else None


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    found = _text_of([replace(b, outside=b.outside or bool(b.marks)) if b.marks else b for b in blocks])
    return found or _text_of(blocks)


def _text_of(blocks: list[Block]) -> str:
    labels = [decide(b) for b in blocks]
    marked = any(b.region and not b.outside for b in blocks)
    nearest = {r: _decided(blocks, labels, r) for r in {b.region for b in blocks}}
    kept = []
    for i, (block, label) in enumerate(zip(blocks, labels)):
        if marked and not block.region:
            continue
        if label is None:
            label = _inherited(nearest[block.region], labels, i)
        if label:
            kept.append(block.text)
    return "\n".join(kept)


def _decided(blocks: list[Block], labels: list[bool | None], region: int) -> list[int]:
    """The decided blocks (of the region, if it is an article), in order.

    Link lists inside an article do not pass on their label while it has text.
    """
    decided = [
        j
        for j, label in enumerate(labels)
        if label is not None and (not region or blocks[j].region == region and not blocks[j].outside)
    ]
    texts = [j for j in decided if labels[j]]
    return texts if region and texts else decided


def _inherited(decided: list[int], labels: list[bool | None], i: int) -> bool:
    """Pass two: the label of the nearest decided block, text if there is none or two are as near."""
    at = bisect(decided, i)
    near = decided[max(0, at - 1) : at + 1]
    gap = min((abs(j - i) for j in near), default=0)
    return not near or any(labels[j] for j in near if abs(j - i) == gap)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text and n_chars (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_html"):
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                chars = pa.array([len(x) for x in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), chars],
                    names=["page_id", "url", "text", "n_chars"],
                )

    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("_html")
    )
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
