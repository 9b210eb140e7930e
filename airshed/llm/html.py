"""Main text of web pages by tag-path ratios.

A page is read once as a sequence of blocks: runs of text between tags of block elements, each
with its path from the root (tags with class and id names). For each path, text length, punctuation
and link text of its blocks are summed and divided by their number. These ratios are smoothed over
neighbouring blocks, fused into one score per path, and paths above a threshold are seeds. The
article is what main and article elements hold, all of them that have seeds, if that is most of the
seeds' text. Else it reaches from the first seed to the last, and beyond them in the innermost
element around all seeds. Of its blocks those are returned whose path has a ratio above half its mean text
length: link lists fall below, as link text counts nothing, unless their punctuation makes up for it.
Headings stay with the article. Elements of other kinds (nav, ...) are left out, and so are forms and
elements named as other things (menus, adverts, comments, ...), but for those that hold most of the
seeds' text: wrappers are named after their parts, and some sites put a page into one form.

A page is read in time linear in its length, however deep its elements are nested. Equal pages give equal
texts; every row is a page of its own, whatever its id. Null, empty and text-free pages have an empty text.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import sqrt

import pandas as pd
from pyspark.sql import DataFrame

from airshed.llm.common import as_id, as_text

# Element kinds of HTML, and names that sites give to what is not the article.
_RAW = "script|style|template|noscript|textarea|title|iframe|noembed|noframes|xmp"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "html head body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead "
    "tbody tfoot tr td th caption blockquote pre figure figcaption header footer nav aside form "
    "fieldset address details summary menu dialog select option button object canvas svg video "
    "audio center hgroup search legend".split())
_CLOSES_P = _BLOCK - frozenset("html head body td th tr tbody thead tfoot caption option".split())
_NOT_TAGS = frozenset(
    "head nav footer aside script style template noscript select option button svg object "
    "menu dialog iframe canvas audio video search textarea legend".split())
_FORMS = frozenset("form fieldset".split())
_NOT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer header "
    "masthead topbar toolbar comment comments respond reply replies disqus cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations tags pagination pager copyright "
    "legal disclaimer skip search".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SAME = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
         "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
         "td": ("td th", ("tr",)), "th": ("td th", ("tr",)), "option": ("option", ("select",))}
#: Elements that are a part of a text and do not hold a whole one.
_PARTS = _HEADINGS | frozenset("p ul ol li dl dt dd menu table caption thead tbody tfoot tr td th "
                               "blockquote pre figure figcaption address details summary".split())
MOST = 0.6  # part of the seeds' text that main and article elements must hold to be the article
PROSE = 12  # spaces in a paragraph that a form must hold to be a page's body

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)"
    r"(?P<attrs>(?:[^<>\"']*+(?:\"[^\"]*+\"|'[^']*+'))*+[^<>\"']*+|[^>]*+)>"
    r"|<[!?/][^>]*+>", re.S | re.I)
_CUT = re.compile(r"<!--.*|<[a-zA-Z/!?][^<]*\Z", re.S)  # a comment or a tag that the page's end cuts off
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PUNCT = ".,;:!?"


@dataclass(frozen=True, eq=False, slots=True)
class _Path:
    """Tags and names from the root to an element; equal paths are one object, linked to the one above."""
    above: _Path | None
    tag: str
    depth: int
    in_article: bool  # below or at a main or article
    not_article: bool  # a tag on the path says that it is not the article
    header: bool  # in the header of an article, of which only headings are kept
    named: _Path | None  # innermost element on the path whose kind or name says that it is not the article
    kept_by: _Path | None  # ``named`` of what is around the outermost main or article
    form: bool

    @property
    def other(self) -> bool:
        return self.not_article or self.header and self.tag not in _HEADINGS


_ROOT = _Path(None, "", 0, False, False, False, None, None, False)


def _below(above: _Path, tag: str, names: tuple[str, ...]) -> _Path:
    path = _Path(above, tag, above.depth + 1, above.in_article or tag in ("article", "main"),
                 above.not_article or tag in _NOT_TAGS or tag == "header" and not above.in_article,
                 above.header or tag == "header" and above.in_article, above.named,
                 above.kept_by if above.in_article else above.named, tag in _FORMS)
    # Main and article are the article whatever their names, but for an article inside another.
    out = path.form or any(n in _NOT_NAMES for n in names) and tag not in ("html", "body", "main") and (
        tag != "article" or above.in_article)
    return replace(path, named=path) if out else path


class _Element:
    __slots__ = ("above", "tag", "path", "number", "last", "article")

    def __init__(self, above, tag, path, number):
        self.above, self.tag, self.path, self.number, self.last = above, tag, path, number, number
        self.article = above.article if above and above.article else None  # outermost main or article
        if self.article is None and tag in ("article", "main"):
            self.article = self

    def holds(self, other: _Element | None) -> bool:
        return other is not None and self.number <= other.number <= self.last


class _Block:
    __slots__ = ("element", "path", "text", "link")

    def __init__(self, element):
        self.element, self.path = element, element.path if element else _ROOT
        self.text, self.link = [], 0


def _names(attrs: str) -> tuple[str, ...]:
    if "=" not in attrs:
        return ()
    words = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs)).lower()
    return tuple(x for x in re.split(r"[^a-z]+", words) if x)


def blocks(page: str) -> list[_Block]:
    """The blocks of a page in order. Unclosed, misnested and cut-off tags are read as browsers do:
    a block element ends an open p, li ends li, an end tag closes all that is open inside."""
    end = page.rfind(">") + 1
    if "<" in page[end:]:  # what follows the last tag holds none, and need not be searched for one
        page = page[:end] + _CUT.sub("", page[end:]).replace("<", "&lt;")
    found: list[_Block] = []
    stack: list[_Element] = []
    open_at: dict[str, list[int]] = defaultdict(list)  # tag -> its places in the stack
    paths: dict = {}
    count = links = at = 0
    block = None

    def add(raw: str) -> None:
        nonlocal block
        if not raw:
            return
        if block is None:
            if raw.isspace():
                return
            block = _Block(stack[-1] if stack else None)
            found.append(block)
        block.text.append(raw)
        if links:
            block.link += len(raw)

    def close(place: int) -> None:
        while len(stack) > place:
            done = stack.pop()
            open_at[done.tag].pop()
            done.last = count

    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            add(" ")
        if tag == "a":
            links = max(0, links + (-1 if m["end"] else 1))
        if tag == "hr":
            block = None
            continue
        if tag not in _BLOCK:
            continue
        if m["end"]:
            if open_at[tag]:
                close(open_at[tag][-1])
                block = None
            continue
        block = None
        links = 0
        if tag in _CLOSES_P and open_at["p"]:
            close(open_at["p"][-1])
        elif tag in _SAME:
            closes, stops = _SAME[tag]
            stop = max((open_at[x][-1] for x in stops if open_at[x]), default=-1)
            inner = [open_at[x][-1] for x in closes.split() if open_at[x] and open_at[x][-1] > stop]
            if inner:
                close(min(inner))
        if tag == "body" and open_at["head"]:
            close(open_at["head"][0])
        count += 1
        above = stack[-1] if stack else None
        key = (above.path if above else _ROOT, tag, _names(m["attrs"]))
        if key not in paths:
            paths[key] = _below(*key)
        open_at[tag].append(len(stack))
        stack.append(_Element(above, tag, paths[key], count))
    add(page[at:])
    close(0)
    return found


def _chain(path: _Path | None) -> Iterator[_Path]:
    """The elements of the path, from the innermost, whose kind or name says that they are not the article."""
    while path is not None:
        yield path
        path = path.above.named


def _deviation(x: list[float]) -> float:
    mean = sum(x) / len(x)
    return sqrt(sum((v - mean) ** 2 for v in x) / len(x))


def _scores(found: list[_Block], texts: list[str]) -> tuple[list[float], list[bool]]:
    """Smoothed and fused ratio of each block's path, 0 where it is below the threshold; and whether the
    path's own ratio is above half its mean text length."""
    total: dict = defaultdict(lambda: [0, 0, 0, 0])
    for b, t in zip(found, texts, strict=True):
        s = total[b.path]
        s[0] += len(t)
        s[1] += sum(map(t.count, _PUNCT))
        s[2] += min(b.link, len(t))
        s[3] += 1
    ratios = {path: (chars / n) * (1 + punct / n) * (1 - link / max(1, chars))
              for path, (chars, punct, link, n) in total.items()}
    side = [0.0, *(ratios[b.path] for b in found), 0.0]
    smooth = [(side[i - 1] + 2 * side[i] + side[i + 1]) / 4 for i in range(1, len(side) - 1)]
    by_path: dict = defaultdict(list)
    for b, x in zip(found, smooth, strict=True):
        by_path[b.path].append(x)
    score = {p: sum(x) / len(x) for p, x in by_path.items()}
    least = min(_deviation(smooth), max(score.values()) / 2)
    return ([score[b.path] if score[b.path] >= least else 0.0 for b in found],
            [ratios[b.path] * total[b.path][3] * 2 >= total[b.path][0] for b in found])


def _misnamed(found: list[_Block], texts: list[str]) -> set[_Path]:
    """The elements of other kinds or names that are not left out: those that hold more of the seeds' text
    than there is outside all elements to be left out, such as a wrapper named has-sidebar. A form must
    also hold an article or a paragraph of some words. Once a main or article is known to stay, only the
    text in such elements counts."""
    named: dict[_Path, bool] = {}  # in order of the page -> may it stay
    for b, t in zip(found, texts, strict=True):
        prose = b.path.in_article or b.path.tag == "p" and t.count(" ") >= PROSE
        for e in _chain(b.path.named):
            if e in named and (named[e] or not prose):
                break
            named[e] = prose or not e.form
    deepest = sorted(named, key=lambda e: -e.depth)

    def seeds(scope: list[bool]) -> dict[_Path, int]:
        some = [(b, t) for b, t, x in zip(found, texts, scope, strict=True) if x]
        total: dict = defaultdict(int)
        score, _ = _scores([b for b, _ in some], [t for _, t in some])
        for (b, t), s in zip(some, score, strict=True):
            total[b.path] += len(t) if s else 0
        return total

    wrappers = {b.path.kept_by for b in found if b.path.in_article}
    kept: set[_Path] = set()
    before = None
    while True:
        stays: dict[_Path | None, bool] = {None: True}  # are the element and all around it kept
        for e in reversed(deepest):
            stays[e] = e in kept and stays[e.above.named]
        scope = [b.path.in_article and stays[b.path.kept_by] for b in found]
        scope = scope if any(scope) else [True] * len(found)
        if scope != before:
            total, before = seeds(scope), scope
        own: dict[_Path | None, int] = defaultdict(int)
        for path, n in total.items():
            own[path.named] += n
        outside = sum(n for e, n in own.items() if stays[e])
        held = defaultdict(int, own)
        for e in deepest:
            held[e.above.named] += held[e]
        size = len(kept)
        for e in sorted((e for e in named if named[e] and e not in kept), key=lambda e: (-held[e], e.depth)):
            if held[e] <= outside:
                break
            kept.add(e)
            stays[e] = stays[e.above.named]
            outside += own[e] if stays[e] else 0
            if stays[e] and e in wrappers:
                break  # an article is now known to stay
        if len(kept) == size:
            return kept


def main_text(page: str | None) -> str:
    """The article of a page: its blocks joined by an empty line; empty if there is none."""
    found = [b for b in blocks(page or "") if not b.path.other]
    texts = [" ".join(entities.unescape("".join(b.text)).split()) for b in found]
    pairs = [(b, t) for b, t in zip(found, texts, strict=True) if t]
    if not pairs:
        return ""
    found, texts = [b for b, _ in pairs], [t for _, t in pairs]
    if any(b.path.named for b in found):
        kept = _misnamed(found, texts)
        left: dict[_Path | None, bool] = {None: True}
        for b in found:
            new = []
            for e in _chain(b.path.named):
                if e in left:
                    break
                new.append(e)
            for e in reversed(new):
                left[e] = e in kept and left[e.above.named]
        pairs = [(b, t) for b, t in pairs if left[b.path.named]]
        if not pairs:
            return ""
        found, texts = [b for b, _ in pairs], [t for _, t in pairs]
    score, high = _scores(found, texts)
    seeds = [i for i, x in enumerate(score) if x] or list(range(len(found)))
    # The outermost main or article of each seed in one.
    parts = {i: found[i].element.article for i in seeds if found[i].path.in_article}
    if sum(len(texts[i]) for i in parts) >= MOST * sum(len(texts[i]) for i in seeds):
        roots = set(parts.values())
        inside = [i for i, b in enumerate(found) if b.path.in_article and b.element.article in roots]
        reach = range(inside[0], inside[-1] + 1)
    else:
        first, last = seeds[0], seeds[-1]
        root = _common(found[first].element, found[last].element)
        reach = [i for i, b in enumerate(found) if first <= i <= last or (root is None or root.holds(b.element))
                 and (b.link * 2 <= len(texts[i]) or b.path.tag in _HEADINGS)]
    return "\n\n".join(texts[i] for i in reach if high[i] or found[i].path.tag in _HEADINGS)


def _common(first: _Element | None, last: _Element | None) -> _Element | None:
    """The innermost element around the first and the last seed, and so around all of them, that is
    not itself a part of a text, such as a quote or a list."""
    while first is not None and (first.tag in _PARTS or not first.holds(last)):
        first = first.above
    return first


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars. A null or empty page has an empty text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [main_text(x) for x in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"],
                                "text": text, "n_chars": [len(t) for t in text]})

    return pages.select(as_text("page_id"), "url", "html").mapInPandas(
        run, "page_id string, url string, text string, n_chars long").select(
        as_id("page_id"), "url", "text", "n_chars")
