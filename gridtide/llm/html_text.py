"""Main text of web pages: the contiguous region of highest score, words scoring positive and tags negative.

A page is read as a sequence of tags and runs of words. Each has a context: the block it stands in, whether it is in a link, whether some element
around it is boilerplate by its name, role, class or id. Weights of contexts come from labelled pages: those that mark their main
part (``article`` or ``main``) say of each word and tag whether it is within. A word weighs the log odds of its context, from minus to plus
a bound; a tag weighs the odds against it, and is never positive. A linear scan finds the region with the largest sum. Where a page marks its main part itself, words
outside have a context of their own. Of the region, the words that are in no boilerplate element are returned, block by block.

The scan overrules names: a first scan takes no notice of classes, ids and forms, and what holds most of its region is no boilerplate, whatever it is
called (``overruled``); wrappers are often named after what stands beside the article.

Counts for the weights are added up over all pages; their number is bounded by the number of contexts, a few hundred.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ship

# fixed values: element names of HTML
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4"
    " h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is not markup
RAW = frozenset("script style textarea title noframes xmp iframe noembed".split())
#: elements that are never main text
BOILER = frozenset("nav footer aside head script style noscript template textarea title iframe svg select button object menu dialog".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: parts of class names and ids that say what an element is not
NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb"
    " breadcrumbs cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup login comment comments commentlist reply"
    " replies disqus related share sharing social footer masthead toolbar widget pagination pager skip disclaimer copyright".split()
)
#: parts of a class name that make it say what the page has or may do, not what the element is
STATES = frozenset("has no with without open closed enabled disabled".split())
#: shares of the words of the region that no boilerplate holds: where it holds the headline too, or there is none; where it does not
HOLDS, HOLDS_ALONE = 0.5, 0.9
#: a start tag closes open elements of these kinds, up to one that holds it; every block closes an open paragraph
CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
          "option": (("option",), ("select",))}

#: bounds of weights: of a word, of a tag
WORD, TAG = 4.0, 3.0
#: what is added to counts
SMOOTH = 0.5

_ATTRIBUTES = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/><]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>""")
#: the same without regard to quotes, for what follows a quote that is never closed
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)([^>]*+)>")
_NOT_NAME = re.compile(r"[^a-z0-9]+")
_LETTER = re.compile(r"[a-zA-Z/!?]")
_LETTER_ONLY = re.compile(r"/?[a-zA-Z]")


class Item(NamedTuple):
    context: str  #: what its weight depends on
    words: int  #: 0 of a tag
    text: str  #: characters as shown, white space as it is
    breaks: bool  #: begins a block
    boiler: bool
    main: bool  #: within an element that the page marks as its main part
    named: int  #: the nearest element around it that is boilerplate by its name only, -1 without
    main_in: int  #: the same of the element that marks the main part


class Page(NamedTuple):
    """Tags and runs of words in order, boilerplate by its kind only, and the elements that are boilerplate by name."""

    items: list[Item]
    around: list[int]  #: of each named element the nearest one around it
    headline: int | None  #: the named element around the first one that marks the main part, or else around the first heading; -1 without


_SURE, _NAMED, _NOT = 2, 1, 0


def _boilerplate(name: str, attributes: str, in_main: bool) -> int:
    """Whether an element is boilerplate: surely, by its name only, or not."""
    if name in BOILER or name == "header" and not in_main:
        return _SURE
    found = _NAMED if name == "form" else _NOT
    if not attributes or name in ("html", "body", "main"):
        return found
    for key, value in _ATTRIBUTES.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and not NAMES.isdisjoint(_NOT_NAME.split(value)):
            parts = [_NOT_NAME.split(each) for each in value.split()]
            if any(not NAMES.isdisjoint(each) and STATES.isdisjoint(each) for each in parts):
                found = _NAMED
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return _SURE
        if key == "style" and "display:none" in value.replace(" ", ""):
            return _SURE
    return found


def parse(page: str) -> Page:
    """One pass; what is not closed is open to the end."""
    out: list[Item] = []
    around: list[int] = []
    marks: dict[bool, int] = {}  # the named element around the first main part, and around the first heading
    # open elements: name, boilerplate here or around, main part here or around, nearest block, links around, nearest named, that of the main part
    stack: list[tuple[str, bool, bool, str, int, int, int]] = []
    opened: Counter = Counter()
    at, end, fresh, pattern = 0, len(page), True, _TAG
    boiler, main, block, links, named, main_in = False, False, "", 0, -1, -1

    def say(text: str) -> None:
        nonlocal fresh
        if text:
            context = f"w {block}{' a' if links else ''}"
            out.append(Item(context, len(text.split()), text, fresh, boiler, main, named, main_in))
            fresh = False

    def cut(depth: int) -> None:
        nonlocal boiler, main, block, links, named, main_in
        for element in stack[depth:]:
            opened[element[0]] -= 1
        del stack[depth:]
        _, boiler, main, block, links, named, main_in = stack[-1] if stack else ("", False, False, "", 0, -1, -1)

    while at < end:
        open_at = page.find("<", at)
        if open_at < 0:
            say(unescape(page[at:]))
            break
        if not _LETTER.match(page, open_at + 1):  # a lone sign is text
            close = page.find("<", open_at + 1)
            close = end if close < 0 else close
            say(unescape(page[at:close]))
            at = close
            continue
        if open_at > at:
            say(unescape(page[at:open_at]))
        if page.startswith("<!--", open_at):
            close = page.find("-->", open_at + 4)
            at = end if close < 0 else close + 3
            continue
        found = pattern.match(page, open_at)
        if not found:  # a declaration, or a tag that is not well-formed
            if _LETTER_ONLY.match(page, open_at + 1):
                pattern = _PLAIN
                found = pattern.match(page, open_at)
            if not found:
                close = page.find(">", open_at)
                at = end if close < 0 else close + 1
                continue
        at = found.end()
        closing, name, attributes = found[1], found[2].lower(), found[3]
        if name in BLOCKS:
            fresh = True
        shown = name if name in BLOCKS else "inline"
        if closing:
            if opened[name]:
                cut(max(depth for depth, element in enumerate(stack) if element[0] == name) if stack[-1][0] != name else len(stack) - 1)
            out.append(Item(f"t /{shown}", 0, "", False, boiler, main, named, main_in))
            continue
        if name in CLOSES and any(opened[k] for k in CLOSES[name][0]):
            kinds, holders = CLOSES[name]
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in kinds:
                    cut(depth)
                    break
                if stack[depth][0] in holders or stack[depth][0] in MAIN:
                    break
        if name in BLOCKS and opened["p"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    cut(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
        how = _boilerplate(name, attributes, main)
        of, by = boiler or how == _SURE, named
        if how == _NAMED and not of:
            by = len(around)
            around.append(named)
        out.append(Item(f"t {shown}", 0, "", False, of, main, by, main_in))
        if name == "br":
            say("\n")
        if name in VOID or attributes.endswith("/"):
            continue
        if name in RAW:
            close = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
            at = close.start() if close else end
        starts = not main and name in MAIN and not of
        if not of and (starts or name == "h1"):
            marks.setdefault(starts, by)
        stack.append((name, of, main or starts, name if name in BLOCKS else block, links + (name == "a"), by, by if starts else main_in))
        opened[name] += 1
        _, boiler, main, block, links, named, main_in = stack[-1]
    return Page(out, around, marks.get(True, marks.get(False)))


def overruled(page: Page, table: dict[str, float]) -> list[bool]:
    """Which of the named elements are no boilerplate: they hold most of the region that a scan without regard to names finds."""
    held = [0] * len(page.around)
    plain = [_resolved(x, []) for x in page.items]
    start, end = _best(plain, table)
    total = 0
    for x in plain[start:end]:
        if x.words and not x.boiler:
            total += x.words
            if x.named >= 0:
                held[x.named] += x.words
    holds, at = set(), page.headline
    while at is not None and at >= 0:
        holds.add(at)
        at = page.around[at]
    for i in reversed(range(len(held))):  # an element comes after those around it
        if page.around[i] >= 0:
            held[page.around[i]] += held[i]
    return [n > (HOLDS if page.headline is None or i in holds else HOLDS_ALONE) * total for i, n in enumerate(held)]


def _resolved(x: Item, dropped: list[bool]) -> Item:
    boiler = x.boiler or bool(dropped) and x.named >= 0 and dropped[x.named]
    main = x.main and not (dropped and x.main_in >= 0 and dropped[x.main_in])
    if not boiler and main == x.main:
        return x
    return x._replace(context=f"{x.context} x" if boiler else x.context, boiler=boiler, main=main)


def items(html: str, table: dict[str, float] | None = None) -> list[Item]:
    """Tags and runs of words in order, with what is boilerplate in the end."""
    page = parse(html)
    dropped: list[bool] = []
    for i, no in enumerate(overruled(page, table or {})) if page.around else ():
        dropped.append(not no or page.around[i] >= 0 and dropped[page.around[i]])
    return [_resolved(x, dropped) for x in page.items]


def _best(sequence: list[Item], table: dict[str, float]) -> tuple[int, int]:
    return region([weight(key, table) * max(x.words, 1) if x.words or not x.text else 0.0 for key, x in _keys(sequence)])


def _keys(page: list[Item]) -> Iterator[tuple[str, Item]]:
    """Contexts with whether the page marks its main part, and whether within (words only)."""
    marked = any(x.main for x in page)
    for x in page:
        yield (f"{'in' if x.main else 'out'} {x.context}" if marked and x.words else x.context), x


def count(page: list[Item]) -> Counter:
    """Of a labelled page, (context, within or not) to number. Other pages count nothing."""
    out: Counter = Counter()
    if any(x.main for x in page):
        for key, x in _keys(page):
            label = x.main and not x.boiler
            for k in {key, x.context}:
                out[k, label] += max(x.words, 1)
    return out


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weights of contexts by log odds: words within bounds, tags not above zero."""
    out = {}
    for context in {c for c, _ in counts}:
        odds = math.log((counts.get((context, True), 0) + SMOOTH) / (counts.get((context, False), 0) + SMOOTH))
        is_tag = context.split()[0] == "t"
        out[context] = max(-TAG, min(-0.01, odds)) if is_tag else max(-WORD, min(WORD, odds))
    return out


def weight(context: str, table: dict[str, float]) -> float:
    """The weight of a context; one that no labelled page has is judged by what it says."""
    known = table.get(context)
    if known is not None:
        return known
    if context.startswith(("in ", "out ")):
        return table.get(context.split(" ", 1)[1], 1.0 if context.startswith("in ") else -1.0) if " x" not in context else -WORD
    if context.startswith("t "):
        return -TAG if context.endswith(" x") else -0.3
    return -WORD if context.endswith(" x") else -0.5 if context.endswith(" a") else 1.0


def region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the largest sum, the first of equals; empty if no sum is above zero."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def extract(page: str, table: dict[str, float]) -> str:
    """The main text: blocks in order, white space within a block as one space, joined by one space."""
    sequence = items(page, table)
    start, end = _best(sequence, table)
    blocks: list[list[str]] = []
    broken = True
    for x in sequence[start:end]:
        broken = broken or x.breaks
        if x.text and not x.boiler:
            if broken:
                blocks.append([])
                broken = False
            blocks[-1].append(x.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks)
    return " ".join(t for t in texts if t)


def learn(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weights from all pages that mark their main part."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(count(items(page.as_py() or "")))
        keys = sorted(total)
        yield pa.record_batch(
            [pa.array([k for k, _ in keys], pa.string()), pa.array([m for _, m in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())],
            ["context", "main", "n"],
        )

    rows = pages.select(F.make_valid_utf8(F.col(html_col).cast("string")).alias("html")).mapInArrow(run, "context string, main boolean, n long")
    # contexts are made of element names that are listed here: a few hundred rows
    return weights({(r.context, r.main): r.n for r in rows.groupBy("context", "main").agg(F.sum("n").alias("n")).collect()})


def main_text(
    pages: DataFrame, table: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): one row for each row of ``pages``, from the whole html.

    A null or empty page, and one without a region above zero, has an empty text. Without labelled pages, words weigh by
    what their context says. Bytes that are not UTF-8 are read as U+FFFD. A very long page is read in one pass; of equal regions the first is taken. Repeated rows are returned as often as they come; an empty table gives no rows. Other columns are not looked at.
    """
    ship(pages.sparkSession)
    table = learn(pages, html_col) if table is None else table
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.make_valid_utf8(F.col(html_col).cast("string")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py() or "", table) for page in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
