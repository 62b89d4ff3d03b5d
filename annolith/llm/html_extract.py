"""Main text of web pages by line-block distribution.

Markup is stripped into one line for each block element.  A line weighs as many characters as it has outside links;
lines of menus, footers, forms and of elements whose names say that they are no article weigh nothing.  Over all lines
of the page runs a window; where its sum leaps up from nothing the text surges, where it drops to nothing it dives, and
the lines between the two are a stretch.

Of each stretch the core is the element whose own lines weigh most: inside article or main, if the page marks its
content so, else the heaviest div or body of the heaviest stretch.  Stretches with lines of the core stay, whatever
their weight; without marked content, others of at least a third of the heaviest do too.  At the edges of a stretch
short lines that stand in a box of their own, before the core's first line or after its last, go: they are what windows
drag along, an advert above a heading or a notice below the text.

Null or empty html gives an empty text.  Broken markup never raises: unclosed tags end with the page or with the element
around them, an unfinished tag at the end is dropped, and bad character references stay.  Time is linear in the page.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|svg|math|iframe|object|select|xmp)\b(?>[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-z][a-z0-9:-]*)((?>[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-z][a-z0-9:-]*)([^<>]*)(?:>|(?=<)|\Z)",
    re.I | re.S,
)
#: Elements that start a line of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold the article.
BOILERPLATE = frozenset("nav footer aside form menu button dialog fieldset head".split())
#: Words of class, id or role that mark such an element.
MARKED = re.compile(
    r"(?<![a-z])(?:ad|ads|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|complementary|consent|contentinfo|cookie|cookies|disclaimer|disqus|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notices|overlay|pagination|pager|popup|promo|promotion|promoted|related|reply|replies|respond|share|sharing|sidebar|signup|skyscraper|social|sponsor|sponsored|subscribe|toolbar|topbar|widget|widgets)(?![a-z])"
)
HEADER = re.compile(r"(?<![a-z])(?:header|site-header|page-header)(?![a-z])")
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style|itemprop)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
WINDOW = 3
#: A further stretch needs this part of the heaviest one's weight, a box at a stretch's edge that of the core's.
SHARE, EDGE = 3, 4
#: Elements that hold text of their own kind; others (lists, tables, quotes) belong to the box around them.
BOXES = frozenset("div body html header section dialog details".split())


class Line(NamedTuple):
    """A line of the page; noise has weight -1.  box is the number of the element it stands in, marked: inside article or main."""

    text: str
    weight: int
    box: int
    marked: bool
    heading: bool


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(raw)}


def _noise(tag: str, raw: str, inside: bool) -> bool:
    """Whether an element and all it holds is no part of the article."""
    if tag in BOILERPLATE or tag == "header" and not inside:
        return True
    if not raw or tag in ("html", "body", "main") or tag in VOID:
        return False
    got = _attributes(raw)
    if "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", ""):
        return True
    names = re.sub(r"[^a-z]+", " ", f"{got.get('class', '')} {got.get('id', '')} {got.get('role', '')}")
    return bool(MARKED.search(names)) or not inside and bool(HEADER.search(names))


def lines(page: str) -> list[Line]:
    """The lines of a page."""
    found: list[Line] = []
    parts: list[str] = []
    linked = 0
    open_: list[tuple[str, bool, bool, int]] = []  # tag, starts noise, starts content, box
    places: dict[str, list[int]] = {}  # where each tag stands in open_
    noise = content = boxes = 0

    def end() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            weight = -1 if noise else len(text) if content else max(0, len(text) - linked)
            found.append(Line(text, weight, open_[-1][3] if open_ else 0, content > 0, bool(open_) and open_[-1][0] in HEADINGS))
        parts.clear()
        linked = 0

    def close(k: int) -> None:
        nonlocal noise, content
        for tag, n, c, _ in open_[k:]:
            noise -= n
            content -= c
            places[tag].pop()
        del open_[k:]

    at, links = 0, 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(text)
            if links:
                linked += len(text)
        at = m.end()
        if m[1] is not None:
            if m[1].lower() in ("title", "textarea", "select"):
                end()
            continue
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        closing, raw = bool(m[2] or m[5]), (m[4] or m[7] or "")
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            parts.append(" ")
        if tag in BLOCKS:
            end()
        if tag in VOID:
            continue
        if closing:
            if places.get(tag):
                k = places[tag][-1]
                if tag in BLOCKS or k == len(open_) - 1:
                    close(k)
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th") or tag in BLOCKS and open_ and open_[-1][0] == "p":  # such elements end where the next begins
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag or open_[k][0] == "p":
                    close(k)
                    break
                if open_[k][0] in BLOCKS:
                    break
        if not raw.rstrip().endswith("/"):
            starts = _noise(tag, raw, content > 0)
            marks = not starts and (tag in ("article", "main") or bool(raw) and (_attributes(raw).get("role") in ("main", "article") or _attributes(raw).get("itemprop") == "articlebody"))
            if marks and tag in ("article", "main") and noise:  # noise left open before the article begins
                for k, (_, n, _, _) in enumerate(open_):
                    if n and open_[k][0] in ("nav", "header", "aside", "form", "div", "ul", "menu", "p") and not content:
                        close(k)
                        break
            if tag in BLOCKS or marks or starts and not noise:  # noise inside noise changes nothing
                around = open_[-1][3] if open_ else 0
                if marks and not content or tag in BOXES and not content:  # inside marked content all is one box
                    boxes += 1
                    around = boxes
                places.setdefault(tag, []).append(len(open_))
                open_.append((tag, starts, marks, around))
                noise += starts
                content += marks
    if at < len(page):
        parts.append(page[at:])
    end()
    return found


def stretches(weights: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(surge, past the dive) of every run of lines whose window sums stay above nothing."""
    n = len(weights)
    sums = [0] * (n + 1)
    for k, w in enumerate(weights):
        sums[k + 1] = sums[k] + max(0, w)
    block = [sums[min(n, k + window)] - sums[k] for k in range(n)]
    found, k = [], 0
    while k < n:
        if block[k] <= 0:
            k += 1
            continue
        past = k
        while past < n and block[past] > 0:
            past += 1
        surge = next(j for j in range(k, n) if weights[j] > 0)
        dive = next(j for j in range(min(n, past + window - 1) - 1, -1, -1) if weights[j] > 0) + 1
        found.append((surge, max(dive, surge + 1)))
        k = max(past, dive)
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    all_ = lines(page)
    weights = [x.weight for x in all_]
    runs = stretches(weights)
    if not runs:
        return ""
    marked = any(x.marked and x.weight > 0 for x in all_)
    heavy = [sum(max(0, w) for w in weights[a:b]) for a, b in runs]
    kept = []
    if marked:
        core = lambda x: x.marked
        least = sum(heavy) + 1
    else:
        a, b = runs[heavy.index(max(heavy))]
        own: dict[int, int] = {}
        for x in all_[a:b]:
            own[x.box] = own.get(x.box, 0) + max(0, x.weight)
        box = max(own, key=lambda k: (own[k], -k))
        core = lambda x: x.box == box and x.weight >= 0
        least = max(heavy) / SHARE
    for (a, b), weight in zip(runs, heavy, strict=True):
        inside = [k for k in range(a, b) if core(all_[k]) and weights[k] >= 0]
        if inside:
            kept += [k for k in (inside if marked else range(*_trimmed(all_, a, b, inside))) if weights[k] >= 0]
        elif weight >= least:
            kept += [k for k in range(a, b) if weights[k] >= 0]
    return "\n".join(all_[k].text for k in kept)


def _trimmed(all_: list[Line], a: int, b: int, inside: list[int]) -> tuple[int, int]:
    """The stretch a..b without light boxes before the first and after the last line of the core, which has several lines."""
    if len(inside) < 2:
        return a, b
    own: dict[int, int] = {}
    for x in all_[a:b]:
        own[x.box] = own.get(x.box, 0) + max(0, x.weight)
    goes = lambda k: all_[k].box != all_[inside[0]].box and not all_[k].heading and own[all_[k].box] * EDGE < own[all_[inside[0]].box]
    while a < inside[0] and goes(a):
        a += 1
    while b - 1 > inside[-1] and goes(b - 1):
        b -= 1
    return a, b


def extract(df: DataFrame, *, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """key, url, text and n_chars of every page."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [main_text(x.as_py()) for x in batch.column(2)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.string()), pa.array(map(len, got), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("page_id"), df[url].alias("url"), df[html]), f"page_id {kind}, url string, text string, n_chars bigint", rows)
