"""Main text of web pages by ratios of tag paths."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from earshot.llm.common import arrow_texts, in_batches

# Share of the page's mean score (geometric, each block weighed by its punctuation) that a content path reaches.
THRESHOLD = 0.3
# Share of the content paths' text that may lie outside the bound of the article.
OUTSIDE = 0.05
# Weights of a text node's neighbours on both sides when scores are smoothed.
KERNEL = (0.15, 0.7, 0.15)

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
NO_CONTENT = frozenset(
    "script style textarea title noscript iframe template xmp noembed noframes head nav footer aside form button select "
    "option input svg math menu dialog object audio video canvas map".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split())
# An element that opens ends an open one of these, up to the given container.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd dt", ("dl",)), "dd": ("dd dt", ("dl",)), "tr": ("tr td th", ("table",)),
        "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
# Element names above that also wrap whole pages.
WRAPS = frozenset("form header".split())
# Classes, ids and roles, in lower case without - and _, that name something around an article.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbanner adblock adbox adcontainer adslot adunit adwrapper "
    "sponsor sponsors sponsored sponsoredcontent promo promos promobox promotion banner topbanner sitebanner sidebar leftsidebar "
    "rightsidebar sidebarleft sidebarright sidebarprimary primarysidebar secondarysidebar sidebarwidget aside nav navbar navigation "
    "navmenu navlinks mainnav mainnavigation sitenav sitenavigation topnav subnav bottomnav postnavigation postnav pagenav menu "
    "mainmenu topmenu sidemenu footermenu mobilemenu menubar footer sitefooter pagefooter mainfooter footernav footerlinks masthead "
    "siteheader pageheaderbar topbar cookie cookies cookiebanner cookiebar cookieconsent cookienotice cookiepolicy cookiemessage "
    "cookiepopup consent consentbanner gdpr gdprbanner notice notices alert alerts popup modal overlay dialog alertdialog comment "
    "comments commentlist commentform commentsarea commentssection commentsection commentthread commentrespond reply replies disqus "
    "disqusthread respond social socials socialbar socialicons sociallinks socialmedia socialshare share sharebar sharebuttons "
    "sharelinks sharing sharetools sharethis addthis related relatedarticles relatedcontent relatedlinks relatedposts relatednews "
    "relatedstories recommend recommended recommendations recommendedarticles breadcrumb breadcrumbs pagination pager subscribe "
    "subscription newsletter newslettersignup signup signupform login loginform search searchbar searchbox searchform toolbar widget "
    "widgets widgetarea complementary contentinfo skiplink skiplinks skipnav skiptocontent hidden visuallyhidden".split())
# What parts of an article are gathered in.
LISTS = frozenset("ul ol dl li blockquote table thead tbody tr figure".split())
# Those that make an article element a comment on another one.
REMARKS = frozenset("comment comments reply replies respond".split())
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|(?P<text>[^<]+|<)", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")
PUNCTUATION = re.compile(r"[.,;:!?¡¿…。，、；：！？؟،]")


class _Element:
    """mark is the nearest element, from this one upwards, that may stand around an article."""

    __slots__ = ("name", "path", "mark", "sure", "up", "depth")

    def __init__(self, name: str, up: _Element | None, marked: bool, sure: bool = False):
        self.name, self.up, self.sure = name, up, sure
        self.path = f"{up.path}>{name}" if up else name
        self.depth = up.depth + 1 if up else 0
        self.mark: _Element | None = self if marked else up and up.mark


def _marked(name: str, attrs: str, inside: bool) -> bool:
    """Whether an element by its name, class, id, role or as a hidden one may stand around an article."""
    if name in NO_CONTENT or name == "header" and not inside:
        return True
    if not attrs or name in ("body", "html", "main"):
        return False
    known: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(attrs):
        value = value[1:].removesuffix(value[0]) if value[:1] in ('"', "'") else value
        known.setdefault(key.lower(), html.unescape(value))  # the first of a name counts
    names = {n for key in ("class", "id", "role") for n in known.get(key, "").lower().replace("-", "").replace("_", "").split()}
    if name == "article":
        return not names.isdisjoint(REMARKS)
    return ("hidden" in known or known.get("aria-hidden", "").strip().lower() == "true"
            or bool(re.search(r"display\s*:\s*none", known.get("style", ""), re.IGNORECASE)) or not names.isdisjoint(AROUND))


def blocks_of(page: str) -> list[tuple[_Element, str]]:
    """Text of every block with the block's element, in page order: inline elements belong to the block around them."""
    root = _Element("", None, False)
    stack = [root]
    out: list[tuple[_Element, str]] = []
    held: list[str] = []
    block = root

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((block, text))
            held.clear()

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.match(page, at)
        at = token.end()
        text = token["text"] if token["text"] is not None else token["cdata"]
        if text is not None:
            top = next((e for e in reversed(stack) if e.name not in INLINE), root)
            home = top if stack[-1].mark is top.mark else stack[-1].mark
            if home is not block:
                flush()
                block = home
            held.append(html.unescape(text) if token["text"] is not None else text)
            continue
        if token["name"] is None:
            continue
        name = token["name"].lower()
        if name == "br":
            held.append(" ")
            continue
        if name not in INLINE:
            flush()
        if token["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k].name not in INLINE:
                    break
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    del stack[k:]
                    break
                if stack[k].name not in INLINE:
                    break
        if name in ENDS:
            ended, within = ENDS[name]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in within:
                    break
                if stack[k].name in ended.split():
                    del stack[k:]
                    break
        if name in VOID:
            continue
        inside = any(e.name in ("article", "main") for e in stack)
        element = _Element(name, stack[-1], _marked(name, token["attrs"], inside), name in NO_CONTENT - WRAPS)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if not token["attrs"].rstrip().endswith("/") or name not in ("svg", "path"):
            stack.append(element)
    flush()
    return out


def _marks(element: _Element | None) -> Iterator[_Element]:
    """The marked elements from this one upwards."""
    while element and element.mark:
        yield element.mark
        element = element.mark.up


def _article(element: _Element | None) -> _Element | None:
    """The nearest article or main that is no remark."""
    while element and (element.name not in ("article", "main") or element.mark is element):
        element = element.up
    return element


def without_around(blocks: list[tuple[_Element, str]]) -> list[tuple[_Element, str]]:
    """The blocks that stand in no marked element.

    A mark by class, id, role, hiding, form or header does not count where the element holds the article or main with
    most text or, on a page without these, more than half of the text, each block weighed by length and punctuation.
    """
    if not any(e.mark for e, _ in blocks):
        return blocks
    open_to = [(e, len(t) * math.log1p(1 + len(PUNCTUATION.findall(t)))) for e, t in blocks if not any(m.sure for m in _marks(e))]
    articles: dict[_Element, float] = {}
    held: dict[_Element, float] = {}
    of: dict[_Element, _Element | None] = {}
    for element, weight in open_to:
        if element not in of:
            of[element] = _article(element)
        if of[element]:
            articles[of[element]] = articles.get(of[element], 0.0) + weight
        for mark in _marks(element):
            held[mark] = held.get(mark, 0.0) + weight
    if articles:
        cleared = set(_marks(max(articles, key=articles.get)))
    else:
        half = sum(weight for _, weight in open_to) / 2
        cleared = {mark for mark, weight in held.items() if weight > half}
    return [(e, t) for e, t in blocks if all(m in cleared for m in _marks(e))]


def path_scores(blocks: list[tuple[_Element, str]]) -> list[float]:
    """Log score of every block: mean text length times mean punctuation of its path, smoothed in page order."""
    sums: dict[str, list[float]] = {}
    for element, text in blocks:
        total = sums.setdefault(element.path, [0.0, 0.0, 0.0])
        total[0] += len(text)
        total[1] += len(PUNCTUATION.findall(text))
        total[2] += 1
    fused = {path: math.log(size / n) + math.log1p(marks / n) for path, (size, marks, n) in sums.items()}
    raw = [fused[element.path] for element, _ in blocks]
    padded = [raw[0], *raw, raw[-1]] if raw else []
    return [sum(w * padded[k + j] for j, w in enumerate(KERNEL)) for k in range(len(raw))]


def main_text(page: str, threshold: float = THRESHOLD) -> str:
    """The article's blocks, one per line.

    Blocks in elements that by name, class, id or role stand around an article are out (see without_around). Of the
    rest, paths whose mean smoothed score reaches the threshold are content. The smallest element that holds nearly all
    text of content paths, or the article around it, bounds the result. An article element is taken whole; in any other
    bound, blocks below the threshold stay between the first and the last content, before it as headings or as lines
    beside content (in the same element, or in a list or quote in it) after a heading, and after it as lists or quotes
    beside content.
    """
    blocks = without_around(blocks_of(page))
    if not blocks:
        return ""
    scores = path_scores(blocks)
    by_path: dict[str, list[float]] = {}
    for (element, _), score in zip(blocks, scores):
        by_path.setdefault(element.path, []).append(score)
    means = {path: sum(s) / len(s) for path, s in by_path.items()}
    weights = [len(PUNCTUATION.findall(text)) for _, text in blocks]
    if not any(weights):
        weights = [len(text) for _, text in blocks]
    usual = sum(w * means[e.path] for w, (e, _) in zip(weights, blocks)) / sum(weights)
    least = min(usual + math.log(threshold), max(means.values()))
    content = [means[e.path] >= least for e, _ in blocks]
    bound, whole = _bound([block for block, is_content in zip(blocks, content) if is_content])
    inside = [(e, t, c) for (e, t), c in zip(blocks, content) if _within(e, bound)]
    places = [k for k, (_, _, c) in enumerate(inside) if c]
    if whole or not places:
        return "\n".join(t for _, t, _ in inside)
    first, last = places[0], places[-1]
    around = {e.up for e, _, c in inside if c}
    headings = [k for k, (e, _, _) in enumerate(inside) if k < first and _heading(e)]

    def stays(k: int, element: _Element) -> bool:
        if k < first:
            return k in headings or bool(headings) and k > headings[0] and _beside(element, around)
        return k <= last or element.name in LISTS and _beside(element, around)

    return "\n".join(t for k, (e, t, _) in enumerate(inside) if stays(k, e))


def _beside(element: _Element, around: set[_Element | None]) -> bool:
    """Whether a block lies in an element that holds content, itself or in a list, table or quote."""
    while element.up not in around and element.up and element.up.name in LISTS:
        element = element.up
    return element.up in around


def _bound(content: list[tuple[_Element, str]]) -> tuple[_Element, bool]:
    """(the smallest element that holds all but OUTSIDE of the content's text, or the article around it; is it an article)."""
    held: dict[_Element, int] = {}
    total = sum(len(text) for _, text in content)
    for element, text in content:
        at = element.up or element
        held[at] = held.get(at, 0) + len(text)
        while at.up and at.up not in held:
            at = at.up
            held[at] = 0
    for element in sorted(held, key=lambda e: -e.depth):
        if element.up:
            held[element.up] += held[element]
    bound = max((e for e, size in held.items() if size >= (1 - OUTSIDE) * total), key=lambda e: e.depth)
    found, at = None, bound
    while at:
        if at.name == "article" or at.name == "main" and found is None:
            found = at
        at = at.up
    return found or bound, bool(found and found.name == "article")


def _heading(element: _Element | None) -> bool:
    while element:
        if element.name in ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"):
            return True
        element = element.up
    return False


def _within(element: _Element, bound: _Element) -> bool:
    while element and element.depth > bound.depth:
        element = element.up
    return element is bound


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text, one row per page, worked out page by page where it is read.

    Null or empty html gives empty text; broken markup is read as far as it goes. Repeated rows stay; other columns
    are not read.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((p, u, main_text(h)) for b in batches
                for p, u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), arrow_texts(b, "html")))
        return in_batches(rows, schema, lambda row: 100 + len(row[2]))

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id long, url string, text string")
