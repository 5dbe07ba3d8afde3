"""Main text of web pages by tag-path ratios.

Every text block of a page has a root-to-leaf path of block elements (with their first class or id).
Per path the text length, punctuation and linked text of all its blocks are added up; the ratios are
smoothed along the page, fused, and thresholded. The selected paths vote, by their text, for the
container that holds the article. Inside an article container every block counts, short ones too, and so do the
blocks on selected paths in the same outermost article element. Without a container, or if it holds less than nearly
all of the selected text, all blocks on selected paths count.

Class and id words such as "sidebar" or "comments" lower the scores of the paths below, the more so the less text
they hold, and blocks of paths so named count only if selected all the same. The name of an element that is or holds
the page's main article, or holds most text of the article or page, is not asked. What is so named beside the main
article, and is and holds no other article, is left out.

Elements that are not shown (scripts, hidden ones, pictures) leave the text around them in one block; an inline element
between blocks that is named an advert or the like is left out.

Time is linear in the length of a page, whatever its depth. A page is a row of its own: the work is one map over rows, without a shuffle.

Defined cases: null or empty html, and pages without content, give an empty string. Broken markup (unclosed
or stray tags, cut-off pages, unquoted attributes) is read as far as it goes. Repeated rows give
repeated results; page_id and url are handed through, nulls included. Columns other than the three
are not read.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr "
    "math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
DROPPED = frozenset("form nav footer aside head dialog menu xmp noframes".split())
#: not shown as text, and no end of the block around them
UNSHOWN = frozenset(
    "script style textarea title noscript template svg iframe object select button canvas audio video datalist annotation "
    "annotation-xml".split()
)
#: blocks of their own text stand in these only between other blocks
CONTAINERS = frozenset("html body main article section div fieldset".split()) | {""}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: an opening tag of the key closes an open element of the value
CLOSES = {
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
} | {
    x: {"p"}
    for x in "p div section article main header footer aside nav ul ol dl table pre blockquote form address figure hr "
    "h1 h2 h3 h4 h5 h6 fieldset details".split()
}
#: elements beyond which an implied end does not reach
WALLS = frozenset("html body div section article main table ul ol dl header footer aside nav form blockquote td th".split())
_WALL_OF = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

_BOILER = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumb\w*|side-?bar\w*|aside|"
    r"footer|foot|masthead|site-?header|page-?header|top-?bar|toolbar|comment\w*|disqus\w*|repl(?:y|ies)|responses|"
    r"discussion|cookie\w*|consent\w*|gdpr|notice\w*|alert\w*|popup|modal|overlay|newsletter\w*|subscri\w*|signup|"
    r"login|search\w*|share\w*|sharing|social\w*|related\w*|recommend\w*|widget\w*|pagination|pager|copyright|legal|"
    r"disclaimer|hidden|print-?only|skip-?link)(?:$|[\s_-])",
    re.I,
)
_HEADER_NAME = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
_ARTICLE = re.compile(
    r"(?:^|[\s_-])(?:article\w*|main|content|post|story\w*|entry|post-?body|body-?text|main-?content|text-?body)(?:$|[\s_-])", re.I
)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: a quoted value of any length, if there is one. A quote that is not closed is a plain character; so is one whose next
#: like quote begins another value (="x).
_QUOTED = r"""(?:"[^"]*+"(?:(?<!=")|(?=[\s>]|/>|\Z))|'[^']*+'(?:(?<!=')|(?=[\s>]|/>|\Z)))"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+{_QUOTED}?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(rf"([^\s/>=]++)(?:\s*+=\s*+(?:({_QUOTED})|([^\s>]++)))?+")
_READ = frozenset("class id role hidden aria-hidden style".split())
#: what a score is multiplied by below a boilerplate name, and below one with less than SMALL of the text
NAMED, NAMED_APART = 1 / 4, 1 / 32
SMALL = 1 / 5
#: an article element with less of the page's text is not its main article
TINY = 1 / 20
#: share of the chosen text that a deeper container has to keep
NEARLY_ALL = 0.95
#: elements of other vocabularies, in which a tag that ends with a slash is its own end
_SELF_CLOSED = frozenset(["svg", "iframe", *(t for t in INLINE if t.startswith("m") and t not in ("mark",))])
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?¡¿…。，、！？]")


@dataclass
class Block:
    path: int
    text: str
    linked: int
    heading: bool
    #: number of the innermost article-like element, 0 outside
    holder: int


@dataclass
class Page:
    """Blocks of a page outside dropped subtrees, and its paths as a parent-linked list."""

    blocks: list[Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [-1])
    labels: list[str] = field(default_factory=lambda: [""])
    article: list[bool] = field(default_factory=lambda: [False])
    #: paths of elements with a boilerplate name
    named: list[bool] = field(default_factory=lambda: [False])
    #: path of every article-like element
    holders: list[int] = field(default_factory=lambda: [0])

    # a path has a higher number than its parent

    def below(self, top: int) -> list[bool]:
        """For every path whether it is ``top`` or lies below it."""
        out = [False] * len(self.parents)
        out[top] = True
        for p in range(top + 1, len(out)):
            out[p] = out[self.parents[p]]
        return out

    def sums(self, values: dict[int, int]) -> list[int]:
        """For every path the sum over itself and all paths below it."""
        out = [0] * len(self.parents)
        for p, value in values.items():
            out[p] = value
        for p in range(len(out) - 1, 0, -1):
            out[self.parents[p]] += out[p]
        return out

    def ancestors(self, path: int) -> Iterator[int]:
        while path > 0:
            yield path
            path = self.parents[path]


def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I)


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        name = m[1].lower()
        if name in _READ:
            found.setdefault(name, m[2][1:-1] if m[2] else (m[3] or "").strip("\"'"))
    return found


def _hidden(attrs: dict[str, str]) -> bool:
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I))


def _unwanted(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_article) or _hidden(attrs):
        return True
    return attrs.get("role", "").lower() in _ROLES


def _named(tag: str, names: str, in_article: bool) -> bool:
    """Whether class and id words call the element boilerplate. An article that its words also call one is not."""
    if tag in ("html", "body", "main") or not names.strip() or (tag == "article" and _ARTICLE.search(names)):
        return False
    return bool(_BOILER.search(names)) or (not in_article and bool(_HEADER_NAME.search(names)))


class _Open:
    """The open block elements, with the places of every tag, so that an end tag needs no search."""

    def __init__(self):
        # (tag, path, dropped, innermost article-like element)
        self.stack: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]
        self._places: dict[str, list[int]] = {}

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost element of the tags, 0 if none is open."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)

    def first(self, tags: Iterable[str], after: int) -> int:
        """Place of the outermost element of the tags inside a place, 0 if there is none."""
        lists = [places for t in tags if (places := self._places.get(t)) and places[-1] > after]
        return min((places[bisect_right(places, after)] for places in lists), default=0)

    def push(self, tag: str, path: int, dropped: bool, holder: int) -> None:
        self._places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, path, dropped, holder))

    def close(self, place: int) -> None:
        """End the element at a place and all inside it."""
        while len(self.stack) > place:
            self._places[self.stack.pop()[0]].pop()


@dataclass
class _Inline:
    """An open inline element whose text is not shown, or is named boilerplate, in a block at ``depth``."""

    tag: str
    depth: int
    open: int = 1

    def met(self, tag: str, closing: str) -> bool:
        """Whether the element is still open after this tag."""
        if tag == self.tag:
            self.open += -1 if closing else 1
        return self.open > 0


def parse(source: str) -> Page:
    """Blocks with their paths. Inline elements are part of their block and not of the path."""
    page = Page()
    known: dict[tuple[int, str, bool, bool], int] = {}
    tree = _Open()
    stack = tree.stack
    pieces: list[str] = []
    linked, link_depth, named_chars, all_chars = 0, 0, 0, 0
    hidden: _Inline | None = None
    boiler: _Inline | None = None

    def flush() -> None:
        nonlocal linked, named_chars, all_chars
        if pieces:
            text = _SPACE.sub(" ", "".join(pieces)).strip()
            pieces.clear()
            if text:
                tag, path, dropped, holder = stack[-1]
                # an advert between paragraphs may be an inline element
                advert = named_chars == all_chars and tag in CONTAINERS
                if not dropped and not advert:
                    page.blocks.append(Block(path, text, min(linked, len(text)), tag in HEADINGS, holder))
        linked = named_chars = all_chars = 0

    def said(raw: str) -> None:
        nonlocal linked, named_chars, all_chars
        if raw and not hidden:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if link_depth:
                linked += len(text)
            if not text.isspace():
                all_chars += len(text)
                named_chars += len(text) if boiler else 0

    at, size = 0, len(source)
    while at < size:
        cut = source.find("<", at)
        if cut < 0:
            said(source[at:])
            break
        m = _TOKEN.match(source, cut)
        if m is None:  # a bare "<" is text
            said(source[at : cut + 1])
            at = cut + 1
            continue
        said(source[at:cut])
        at = m.end()
        if m[2] is None:
            continue
        closing, tag = m[1], m[2].lower()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in INLINE or tag in UNSHOWN:
            if tag == "a":
                link_depth = max(0, link_depth - 1) if closing else link_depth + 1
            empty = tag in VOID or (m[3].endswith("/") and tag in _SELF_CLOSED)
            if hidden:
                hidden = hidden if empty or hidden.met(tag, closing) else None
            elif not closing and not empty and (tag in UNSHOWN or (m[3] and _hidden(_attributes(m[3])))):
                hidden = _Inline(tag, len(stack))
            if boiler:
                boiler = boiler if empty or boiler.met(tag, closing) else None
            elif not closing and not empty and m[3] and stack[-1][0] in CONTAINERS:
                attrs = _attributes(m[3])
                if _BOILER.search(f"{attrs.get('class', '')} {attrs.get('id', '')}"):
                    boiler = _Inline(tag, len(stack))
            if not closing and tag in RAW:
                end = _end_of(tag).search(source, at)
                at = end.start() if end else size
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if not closing and tag in RAW:
            flush()
            end = _end_of(tag).search(source, at)
            at = end.end() if end else size
            continue
        place, ends = 0, CLOSES.get(tag)
        if closing:
            place = tree.last((tag,))
        elif ends:
            wall = tree.last(_WALL_OF.get(tag, WALLS) - ends)
            if hidden and hidden.tag in UNSHOWN:
                wall = max(wall, hidden.depth - 1)
            place = tree.first(ends, wall)
        if not hidden or 0 < place < hidden.depth:  # what is not shown does not part the text around it
            flush()
            link_depth = 0
        if place:
            tree.close(place)
        # an inline element ends with the block it is in
        hidden = hidden if hidden and hidden.depth <= len(stack) else None
        boiler = boiler if boiler and boiler.depth <= len(stack) else None
        if closing:
            continue
        if m[3].rstrip().endswith("/") and tag == "path":
            continue
        attrs = _attributes(m[3])
        _, parent, dropped, holder = stack[-1]
        name = (attrs.get("class") or attrs.get("id") or "").split()
        label = f"{tag}.{name[0].lower()}" if name else tag
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        article = tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article") or bool(_ARTICLE.search(names))
        named = _named(tag, names, holder > 0)
        path = known.get((parent, label, article, named))
        if path is None:
            path = known[(parent, label, article, named)] = len(page.parents)
            page.parents.append(parent)
            page.labels.append(label)
            page.article.append(article)
            page.named.append(named)
        dropped = dropped or hidden is not None or _unwanted(tag, attrs, holder > 0)
        if article:
            holder = len(page.holders)
            page.holders.append(path)
        tree.push(tag, path, dropped, holder)
    flush()
    return page


def name_factors(page: Page) -> dict[int, float]:
    """What boilerplate names multiply the score of every path that has blocks with; 1 without such a name."""
    text: dict[int, int] = {}
    for b in page.blocks:
        text[b.holder] = text.get(b.holder, 0) + len(b.text)
    total = sum(text.values())
    tagged = {p for p in page.holders if page.labels[p].split(".")[0] in ("article", "main")}
    # short elements that only their words call an article may be its title or date
    text = {h: n for h, n in text.items() if h and n >= total * (TINY if page.holders[h] in tagged else SMALL)}

    n = len(page.parents)
    in_named = [False] * n
    for p in range(1, n):
        in_named[p] = page.named[p] or in_named[page.parents[p]]

    def size(holder: int) -> float:
        return text[holder] * (NAMED if in_named[page.holders[holder]] else 1)

    # the main article: the article-like element with the most text of its own
    main = page.holders[max(text, key=lambda h: (size(h), -h))] if text else 0
    around = set(page.ancestors(main))
    chars: dict[int, int] = {}
    for b in page.blocks:
        chars[b.path] = chars.get(b.path, 0) + len(b.text)
    under = page.sums(chars)
    whole = under[main] if main else total
    in_main = page.below(main)
    over_articles = page.sums({p: 1 for p in tagged if p and not page.named[p]})

    def factor(named: int) -> float:
        if named in around:
            return 1.0
        if main and not in_main[named]:
            return NAMED if named in tagged else NAMED_APART if over_articles[named] else 0.0
        if under[named] < SMALL * whole:
            return NAMED_APART
        return 1.0 if 2 * under[named] > whole else NAMED

    least = [1.0] * n
    for p in range(1, n):
        least[p] = min(least[page.parents[p]], factor(p)) if page.named[p] else least[page.parents[p]]
    return {p: least[p] for p in chars}


def path_scores(page: Page) -> dict[int, float]:
    """Fused score of every path that has blocks: its text and punctuation per block without the
    linked part, and the same smoothed along the page, lowered by names."""
    chars: dict[int, float] = {}
    marks: dict[int, float] = {}
    links: dict[int, float] = {}
    nodes: dict[int, int] = {}
    for b in page.blocks:
        chars[b.path] = chars.get(b.path, 0.0) + len(b.text)
        marks[b.path] = marks.get(b.path, 0.0) + len(_PUNCTUATION.findall(b.text))
        links[b.path] = links.get(b.path, 0.0) + b.linked
        nodes[b.path] = nodes.get(b.path, 0) + 1
    ratio = {
        p: chars[p] / nodes[p] * (1 - links[p] / max(chars[p], 1)) * math.log(2 + marks[p] / nodes[p]) for p in nodes
    }
    series = [ratio[b.path] for b in page.blocks]
    weights = (1, 2, 4, 2, 1)
    smooth: dict[int, float] = {}
    for i, b in enumerate(page.blocks):
        near = [(series[i + k], w) for k, w in zip(range(-2, 3), weights) if 0 <= i + k < len(series)]
        value = sum(x * w for x, w in near) / sum(w for _, w in near)
        smooth[b.path] = smooth.get(b.path, 0.0) + value / nodes[b.path]
    factors = name_factors(page)
    return {p: math.sqrt(ratio[p] * smooth[p]) * factors[p] for p in nodes}


def main_text(source: str | None) -> str:
    """Content blocks in page order, one per line."""
    page = parse(source or "")
    if not page.blocks:
        return ""
    scores = path_scores(page)
    weight: dict[int, int] = {}
    for b in page.blocks:
        weight[b.path] = weight.get(b.path, 0) + len(b.text)
    # threshold: a third of the text-weighted mean, so that it follows the page's own main text
    mean = sum(scores[p] * w for p, w in weight.items()) / sum(weight.values())
    chosen = {p for p in scores if scores[p] >= mean / 3}
    factors = name_factors(page)
    left_out = {p for p in scores if factors[p] < 1 and p not in chosen}
    votes = page.sums({p: weight[p] for p in chosen})
    total = votes[0]
    # from the outermost article-like element with most of the chosen text down, while nearly all of it is kept. Those
    # with more than half lie on one line, so their numbers grow with their depth.
    container = None
    for p in range(1, len(votes)):
        if page.article[p] and 2 * votes[p] > total and (container is None or votes[p] >= NEARLY_ALL * votes[container]):
            container = p
    inside: set[int] = set()
    near = chosen
    if container is not None:
        in_container = page.below(container)
        inside = {p for p in weight if in_container[p]} - left_out
        if votes[container] >= NEARLY_ALL * total:
            in_top = page.below([p for p in page.ancestors(container) if page.article[p]][-1])
            near = {p for p in chosen if in_top[p]}
    picked = [b.path in inside or b.path in near for b in page.blocks]
    if near is chosen:
        for i in range(len(picked) - 2, -1, -1):  # a heading belongs to the content it stands above
            picked[i] = picked[i] or (page.blocks[i].heading and picked[i + 1] and page.blocks[i].path not in left_out)
    return "\n".join(b.text for b, p in zip(page.blocks, picked) if p)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            texts = [main_text(source) for source in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    key = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id), F.col(url).cast("string"), F.col(source).cast("string"))
    return rows.mapInArrow(_extract, f"page_id {key}, url string, text string, n_chars long")
