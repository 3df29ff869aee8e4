"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text; a block's path is the chain of block-level tags
from the root to it.  Per path, text length and punctuation are summed over its
blocks; their product per block is the path's raw ratio.  Ratios are smoothed along
the tree of paths and fused with what tags, names and repeated structure say of the
elements around.  A block weighs its length times the square of its ratio, so that a long text
without sentences does not outweigh a shorter one that has them: the way down to where the
weight lies leads to the article's container, and what weighs little beside it is left
out.  All passes are linear in the page.
"""

from __future__ import annotations

import html
import re
from itertools import groupby
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns

# Share of a path's own ratio in its smoothed one; the rest is that of the path above.
OWN = 0.75
# The article is in the child that holds so much of an element's weight.  Beside it, a wrapper
# of so much of the child's weight is part of the article, and text of so much of its ratio.
MOST, PART, ALIKE = 0.5, 0.3, 0.6
# What an element's nature makes of the weights in it, and the share of the unmarked ratio
# that a marked element in the container needs to stay.
ARTICLE, MARKED = 16.0, 0.1
ENOUGH = 0.25
# A block mostly made of links is a menu; in the article's container, one or several blocks
# of a path with so many links, which are so short.
MAX_LINK_SHARE = 0.5
MENU_LINKS, MENU_CHARS = 3, 40
# Items that readers or feeds add open with a line so short that has a date or a link.
ITEM_CHARS, ITEM_SHARE = 60, 2 / 3

# Tags without an end, tags whose inside is not text, inline tags, tags that
# an opening tag closes, and tags and names that mark everything around the article.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "title", "svg", "math", "object", "xmp")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var".split()
)
CLOSED_BY = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
# Tags that hold an article's paragraphs, rather than text of their own.
CONTAINERS = frozenset("html body main article section div center form fieldset".split())
# Tags that mark what is around the article wherever they stand.
AROUND = frozenset("nav header footer aside button select menu dialog head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose names tell nothing about what is in them: the page, the article, and text.
UNNAMED = frozenset(
    "html body main article p h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead pre blockquote figcaption".split()
)
AROUND_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner sponsor sponsored promo "
    "promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside "
    "widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login comment comments commentlist disqus respond reply replies "
    "related recommended recommendations share sharing social toolbar copyright disclaimer legal "
    "pagination pager skip search complementary contentinfo".split()
)
# Beside these, a name speaks of the article's own parts.
CONTENT_WORDS = frozenset("article body content entry main page post story text".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*|[^<>]*)>",
    re.DOTALL,
)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none", re.IGNORECASE)
_QUOTED = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*')")
_WORD = re.compile(r"[A-Za-z]+")
_DIGITS = re.compile(r"[\d_-]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")


def _marked(name: str, kind: str, token: str) -> bool:
    """Whether a class, id or role speaks of what is around the article.

    An id on a section may just be where a link to its heading leads.
    """
    if name in UNNAMED or (name == "section" and kind == "id"):
        return False
    words = {w.lower() for w in _WORD.findall(token)}
    return bool(words & AROUND_WORDS) and not words & CONTENT_WORDS


def _described(name: str, rest: str) -> tuple[str, bool, bool]:
    """A tag's path step, whether its names mark it, and whether it is hidden."""
    if not rest:
        return name, False, False
    marks = [(kind.lower(), "".join(m)) for kind, *m in _MARKS.findall(rest)]
    marked = any(_marked(name, kind, token) for kind, m in marks for token in m.split())
    hidden = name not in ("html", "body") and bool(
        _HIDDEN.search(_QUOTED.sub("=", rest)) or re.search(r"display\s*:\s*none", rest, re.IGNORECASE)
    )
    # The first class without its numbers: those of a list's items differ in nothing else.
    first = next((m.split()[0] for kind, m in marks if kind == "class" and m.split()), "")
    return f"{name}.{_DIGITS.sub('', first)}" if first else name, marked, hidden


class Element:
    """An element that is not inline, and the weight of what is in it."""

    __slots__ = (
        "above", "article", "bare", "blocks", "factor", "first", "gone", "header", "inside",
        "mass", "name", "path", "weight",
    )

    def __init__(self, name: str, path: int, above: Element | None, factor: float, gone: bool):
        self.name, self.path, self.above, self.factor = name, path, above, factor
        self.gone = gone or (above is not None and above.gone)
        self.article = name in ("article", "main") or (above is not None and above.article)
        # The header it is in, if nothing else takes it out of the article.
        self.header = above.header if above is not None else None
        self.inside: list[Element | Block] = []
        self.weight, self.blocks, self.first = 0.0, 0, None
        # Weight, and ratio by weight, whatever marks there are.
        self.bare, self.mass = 0.0, 0.0

    @property
    def mean(self) -> float:
        """Ratio of the element's text by weight."""
        return self.mass / self.bare if self.bare else 0.0


class Block:
    """A run of text without block-level tags in it."""

    __slots__ = ("dated", "element", "link_chars", "links", "ratio", "text")

    def __init__(self, element: Element, text: str, link_chars: int, links: int, dated: bool):
        self.element, self.text, self.link_chars = element, text, link_chars
        self.links, self.dated, self.ratio = links, dated, 0.0

    @property
    def own_chars(self) -> int:
        """Characters beyond links and as many again."""
        return max(0, len(self.text) - 2 * self.link_chars)

    @property
    def weight(self) -> float:
        return self.ratio**2 * self.own_chars


class Page:
    """Elements and blocks of a page in order, and the tree of their paths."""

    def __init__(self, page: str):
        self.steps: dict[tuple[int, str], int] = {}
        self.above: list[int] = [-1]
        self.elements = [Element("", 0, None, 1.0, False)]
        self.blocks: list[Block] = []
        self._read(page)

    def _opened(self, name: str, rest: str, above: Element) -> Element:
        step, marked, hidden = _described(name, rest)
        key = above.path, step
        path = self.steps.get(key)
        if path is None:
            path = self.steps[key] = len(self.above)
            self.above.append(above.path)
        factor = ARTICLE if name in ("article", "main") and not above.article else 1.0
        if marked or name == "form":
            factor *= MARKED
        around = name in AROUND
        element = Element(name, path, above, factor, around or hidden)
        if around or hidden:
            only = name == "header" and not hidden and not above.gone
            element.header = element if only else None
        above.inside.append(element)
        self.elements.append(element)
        return element

    def _read(self, page: str) -> None:
        # Each open tag with the innermost element that is not inline.
        stack: list[tuple[str, Element]] = [("", self.elements[0])]
        pieces: list[str] = []
        links = link_chars = link_count = inline = at = 0
        dated = False
        open_names: dict[str, int] = {}

        def close_block() -> None:
            nonlocal link_chars, link_count, dated
            text = " ".join("".join(pieces).split())
            if text:
                block = Block(stack[-1][1], text, link_chars, link_count, dated)
                block.element.inside.append(block)
                self.blocks.append(block)
            pieces.clear()
            link_chars, link_count, dated = 0, links, False

        def text_until(stop: int) -> None:
            nonlocal link_chars
            if stop > at:
                if stack[-1][0] == "head" and not page[at:stop].isspace():
                    pop_to(len(stack) - 1)
                decoded = html.unescape(page[at:stop])
                pieces.append(decoded)
                if links:
                    link_chars += len(decoded)

        def pop_to(depth: int) -> None:
            nonlocal links, inline
            while len(stack) > depth:
                name = stack.pop()[0]
                open_names[name] -= 1
                links -= name == "a"
                inline -= name in INLINE

        def push(name: str, element: Element) -> None:
            stack.append((name, element))
            open_names[name] = open_names.get(name, 0) + 1

        def depth_of(name: str) -> int:
            return next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name)

        while m := _TAG.search(page, at):
            text_until(m.start())
            at = m.end()
            if m["name"] is None:
                continue
            name = m["name"].lower()
            if m["close"]:
                if not open_names.get(name):
                    if name not in INLINE:
                        close_block()
                elif name in INLINE:
                    # Formatting ends alone; blocks opened inside it stay open.
                    depth = len(stack) - 1
                    while stack[depth][0] in INLINE and stack[depth][0] != name:
                        depth -= 1
                    if stack[depth][0] == name:
                        pop_to(depth)
                else:
                    close_block()
                    pop_to(depth_of(name))
                continue
            if name in RAW:
                if name in ("svg", "math") and m["rest"].endswith("/"):
                    continue
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
                if name != "svg" and name != "math":
                    pieces.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    close_block()
                elif name == "br":
                    pieces.append(" ")
                continue
            if stack[-1][0] == "head":
                # Any other tag ends a head that is left open.
                close_block()
                pop_to(len(stack) - 1)
            if name in INLINE:
                hides = m["rest"] and _described(name, m["rest"])[2]
                element = stack[-1][1]
                if hides:
                    # Hidden text is an element of its own.
                    close_block()
                    element = self._opened(name, m["rest"], element)
                push(name, element)
                inline += 1
                links += name == "a"
                link_count += name == "a"
                dated |= name == "time"
                continue
            close_block()
            # A block ends an open paragraph; list items, cells and the like end their equals.
            for i in range(len(stack) - 1, 0, -1):
                open_ = stack[i][0]
                if open_ == "p" or open_ in CLOSED_BY.get(name, ()):
                    pop_to(i)
                    break
                if open_ not in INLINE and open_ not in HEADINGS:
                    break
            # Inline tags left open before a block do not reach into it.
            while stack[-1][0] in INLINE:
                pop_to(len(stack) - 1)
            push(name, self._opened(name, m["rest"], stack[-1][1]))
        text_until(len(page))
        close_block()


def _ratio(length: float, signs: float) -> float:
    return log(1 + length) * (1 + signs)


def path_ratios(page: Page) -> list[float]:
    """Smoothed ratio of every path: its own, averaged with that of the path above it.

    A path's raw ratio is the logarithm of its mean text length times its mean
    punctuation; that of a path with others below is the mean over all their blocks.
    """
    n = len(page.above)
    count, length, signs = [0] * n, [0] * n, [0] * n
    for b in page.blocks:
        if not b.element.gone:
            path = b.element.path
            count[path] += 1
            length[path] += b.own_chars
            signs[path] += len(_PUNCTUATION.findall(b.text))
    total = [
        c * _ratio(size / c, s / c) if c else 0.0
        for c, size, s in zip(count, length, signs, strict=True)
    ]
    for path in range(n - 1, 0, -1):  # paths come after the path above them
        count[page.above[path]] += count[path]
        total[page.above[path]] += total[path]
    smoothed = [0.0] * n
    for path in range(n):
        mean = total[path] / count[path] if count[path] else 0.0
        smoothed[path] = mean if path == 0 else OWN * mean + (1 - OWN) * smoothed[page.above[path]]
    return smoothed


def _items(element: Element) -> list[Element]:
    """Children of one step that open with a short line of a date or a link, as comments do."""
    by_step: dict[int, list[Element]] = {}
    for child in element.inside:
        if isinstance(child, Element) and child.blocks and not child.gone:
            by_step.setdefault(child.path, []).append(child)
    found = []
    for alike in by_step.values():
        opened = [c for c in alike if _opens_like_an_item(c)]
        if len(opened) > 1 and len(opened) >= ITEM_SHARE * len(alike):
            found += alike
    return found


def _opens_like_an_item(element: Element) -> bool:
    first = element.first
    return (
        element.blocks > 1
        and len(first.text) <= ITEM_CHARS
        and first.element.name not in ("h1", "h2", "h3")
        and (first.dated or first.links > 0)
    )


def weigh(page: Page) -> None:
    """Ratios of all blocks and weights of all elements, fused from the inside out."""
    ratios = path_ratios(page)
    for b in page.blocks:
        b.ratio = ratios[b.element.path]
    for e in reversed(page.elements):  # elements come after those around them
        for part in e.inside:
            if isinstance(part, Block):
                e.blocks += 1
                e.first = e.first or part
                if not e.gone:
                    e.bare += part.weight
                    e.mass += part.ratio * part.weight
            else:
                e.blocks += part.blocks
                e.first = e.first or part.first
                e.bare += part.bare
                e.mass += part.mass
        # Items are found once their blocks are counted; what they weigh depends on it.
        for item in _items(e):
            item.factor *= MARKED
        for part in e.inside:
            if isinstance(part, Element):
                e.weight += part.factor * part.weight
            elif not e.gone:
                e.weight += part.weight


def _main_child(element: Element) -> Element | None:
    """The child container that holds most of an element's weight."""
    most = MOST * element.weight
    for part in element.inside:
        if isinstance(part, Element) and part.name in CONTAINERS and part.factor * part.weight > most:
            return part
    return None


def _blocks_in(element: Element) -> list[Block]:
    out, todo = [], [element]
    while todo:
        part = todo.pop()
        if isinstance(part, Block):
            out.append(part)
        else:
            todo.extend(reversed(part.inside))
    return out


def _within(container: Element, mean: float | None = None) -> list[Block]:
    """Blocks of the container, but for elements of low ratio for what marks them.

    ``mean`` is the ratio to compare with, that of the unmarked text in the container if
    it isn't given.
    """
    factors = {id(container): 1.0}
    marked: dict[int, list[float]] = {}
    plain = [0.0, 0.0]
    order, todo = [], [container]
    while todo:
        part = todo.pop()
        if isinstance(part, Block):
            if part.element.gone:
                continue
            sums = plain
            if factors[id(part.element)] < 1:
                sums = marked.setdefault(id(part.element), [0.0, 0.0])
            sums[0] += part.ratio * part.own_chars * factors[id(part.element)]
            sums[1] += part.own_chars
            continue
        order.append(part)
        for child in reversed(part.inside):
            if isinstance(child, Element):
                factors[id(child)] = factors[id(part)] * min(1.0, child.factor)
            todo.append(child)
    kept = {id(e) for e in order if factors[id(e)] == 1}
    everything = sum(s for s, _ in marked.values()) + plain[0], sum(n for _, n in marked.values()) + plain[1]
    share, chars = plain if plain[1] else everything
    if mean is None:
        mean = share / chars if chars else 0.0
    needed = ENOUGH * mean
    # A marked element is judged as a whole, by the outermost one with a mark.
    for e in order:
        if factors[id(e)] < 1 and e is not container and id(e.above) in kept:
            inner = [x for x in _elements_in(e) if id(x) in marked]
            size = sum(marked[id(x)][1] for x in inner)
            if not size or sum(marked[id(x)][0] for x in inner) / size >= needed:
                kept |= {id(x) for x in _elements_in(e)}
    return [b for b in _blocks_in(container) if id(b.element) in kept]


def _elements_in(element: Element) -> list[Element]:
    out, todo = [], [element]
    while todo:
        part = todo.pop()
        out.append(part)
        todo.extend(x for x in part.inside if isinstance(x, Element))
    return out


def select(page: Page) -> list[Block]:
    """The article's blocks in page order.

    From the root the way leads to the child that holds most of the weight, while there is
    one.  On the way, text beside that child is kept if its ratio is like the child's, and
    a wrapper too if it also holds a good part of what the child does; the last element's
    blocks are kept but for marked ones of low ratio.
    """
    weigh(page)
    kept: set[int] = set()
    at = page.elements[0]
    while (child := _main_child(at)) is not None:
        alike = ALIKE * child.mean
        for part in at.inside:
            if part is child:
                continue
            if isinstance(part, Block):
                if part.ratio >= alike and part.own_chars:
                    kept.add(id(part))
            elif part.factor < 1 or part.gone:
                continue
            elif part.name in HEADINGS and at.name not in ("", "html", "body"):
                kept |= {id(b) for b in _blocks_in(part)}
            elif part.name in CONTAINERS:
                if part.weight >= PART * child.factor * child.weight and part.mean >= alike:
                    kept |= {id(b) for b in _within(part, child.mean)}
            elif part.weight and part.mean >= alike:
                kept |= {id(b) for b in _within(part, child.mean)}
        at = child
    kept |= {id(b) for b in _within(at)}
    out = []
    for b in page.blocks:
        header = b.element.header
        # The headings of the article's own header are its text.
        own = header is not None and b.element.name in HEADINGS and (
            header.above.article or (header.above is at and at.name not in ("", "html", "body"))
        )
        if (id(b) in kept and not b.element.gone) or own:
            out.append(b)
    return out


def _menu(run: list[Block]) -> bool:
    """Whether neighbours of one path are a list of many short links."""
    size, links = sum(len(b.text) for b in run), sum(b.links for b in run)
    linked = sum(b.link_chars for b in run)
    return linked > MAX_LINK_SHARE * size and links >= MENU_LINKS and linked <= MENU_CHARS * links


def main_text(page: str | None) -> str:
    """The article's blocks joined by line ends; empty if the page has none.

    Short and unpunctuated blocks in the article's container are kept; menus are not.
    """
    if not page:
        return ""
    out = []
    for _, run in groupby(select(Page(page)), key=lambda b: b.element.path):
        run = list(run)
        if not _menu(run):
            out += [b.text for b in run]
    return "\n".join(out)


def extract(pages: DataFrame, page: str = "html", to: str = "text", size: str = "n_chars") -> DataFrame:
    """``pages`` with the main text and its code points.

    Whole pages are read; null and empty pages, and pages without an article, have
    an empty text.  Repeated rows are extracted each; columns named like the
    results are replaced.  Map-only.
    """

    def make():
        def columns(sources: pa.Array) -> list[pa.Array]:
            texts = [main_text(s.as_py()) for s in sources]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return columns

    fields = [T.StructField(to, T.StringType()), T.StructField(size, T.LongType())]
    return append_columns(pages, fields, [page], make)
