"""Pages as trees of block elements and runs of inline text, with features."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is never article text.
UNSEEN = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video "
    "select option optgroup datalist textarea button input".split()
)
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input button select "
    "textarea script style noscript template iframe object svg math canvas audio video "
    "option optgroup datalist meta link".split()
)
#: A start tag that ends open elements of these names up to the given limits.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
CATEGORIES = ("content", "nav", "header", "footer", "side", "ad", "notice", "form", "comment", "more")
TAG_CATEGORY = {
    "article": "content", "main": "content", "nav": "nav", "menu": "nav", "header": "header",
    "footer": "footer", "aside": "side", "form": "form", "dialog": "notice", "fieldset": "form",
}
#: Fixed words found in class, id and role attributes, by what they tell.
TOKENS = {
    "content": "content article post entry story text main body prose".split(),
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs topnav tabs pagination pager".split(),
    "header": "header masthead topbar logo brand site tagline".split(),
    "footer": "footer foot bottom copyright legal colophon contentinfo".split(),
    "side": "sidebar side aside rail widget widgets complementary column".split(),
    "ad": "ad ads advert advertisement adverts sponsor sponsored promo promotion banner".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay toast dialog warning "
              "paywall announcement".split(),
    "form": "form newsletter subscribe signup search login subscription contact".split(),
    "comment": "comment comments reply replies respond disqus discussion thread feedback "
               "reviews".split(),
    "more": "related recommended recommendations share sharing social trending popular tags more "
            "readmore teaser byline author meta".split(),
}
TOKEN_CATEGORY = {word: name for name, words in TOKENS.items() for word in words}
SHAPES = ("p", "heading", "list", "item", "box", "table", "quote", "run")
TAG_SHAPE = {
    "p": "p", "pre": "p", **{f"h{i}": "heading" for i in range(1, 7)}, "ul": "list", "ol": "list",
    "dl": "list", "li": "item", "dt": "item", "dd": "item", "div": "box", "section": "box",
    "table": "table", "tr": "table", "td": "table", "th": "table", "blockquote": "quote",
    "figure": "quote", "figcaption": "quote",
}

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，]")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}


@dataclass
class Page:
    """Nodes in page order; a node's parent stands before it. Leaves hold text."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    marks: list[frozenset[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)

    def add(self, tag, parent, marks=frozenset(), text=None, linked=0, label=0) -> int:
        for values, value in zip(
            (self.tag, self.parent, self.marks, self.text, self.linked, self.label),
            (tag, parent, marks, text, linked, label),
        ):
            values.append(value)
        return len(self.tag) - 1


def _marks(tag: str, attributes: str) -> tuple[frozenset[str], int]:
    """Categories told by a tag and its attributes, and a training label."""
    found = {TAG_CATEGORY[tag]} if tag in TAG_CATEGORY else set()
    label = 0
    if attributes and "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = "".join(values)
            if name == "data-y":
                label = 1
            else:
                for token in _TOKEN.findall(value):
                    category = TOKEN_CATEGORY.get(token.lower())
                    if category:
                        found.add(category)
    return frozenset(found), label


def parse(source: str) -> Page:
    """Build the tree of a page. Broken markup never fails: end tags without a
    start are ignored, missing ones are implied, an open `<` is text."""
    page = Page()
    root = page.add("body", -1)
    open_blocks: list[tuple[str, int]] = [("body", root)]  # (tag, node)
    unseen, unseen_depth = "", 0  # outermost open element without text
    links = linked = 0
    run: list[str] = []

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            page.add("#run", open_blocks[-1][1], text=text, linked=min(linked, len(text)),
                     label=page.label[open_blocks[-1][1]])
        run.clear()
        linked = 0

    def close_to(position: int) -> None:
        flush()
        del open_blocks[position:]

    at, size = 0, len(source)
    while at < size:
        found = _MARKUP.search(source, at)
        if found is None:
            if not unseen:
                run.append(source[at:])
            break
        before = source[at : found.start()]
        at = found.end()
        if before and not unseen:
            run.append(before)
            if links:
                linked += len(before)
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if unseen:
                unseen_depth -= tag == unseen
                unseen = unseen if unseen_depth else ""
            elif tag in INLINE:
                links = max(0, links - (tag == "a"))
            else:
                for i in range(len(open_blocks) - 1, 0, -1):
                    if open_blocks[i][0] == tag:
                        close_to(i)
                        links = 0
                        break
            continue
        if tag in ("br", "hr"):
            run.append("\n" if not unseen else "")
            if tag == "hr":
                flush()
            continue
        closed = found[3].endswith("/")
        if unseen == "head" and tag not in VOID and tag not in UNSEEN:
            unseen, unseen_depth = "", 0  # its end tag is missing
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            at = end.start() if end else size
            if end:
                close = source.find(">", at)
                at = close + 1 if close >= 0 else size
            continue
        if tag in VOID or closed and tag in UNSEEN:
            continue
        if unseen:
            unseen_depth += tag == unseen
            continue
        if tag in UNSEEN:
            unseen, unseen_depth = tag, 1
            continue
        if tag in INLINE:
            links += tag == "a" and not closed
            continue
        if tag in ("html", "body"):
            continue
        ends, limits = ENDS.get(tag, (frozenset(), frozenset()))
        for i in range(len(open_blocks) - 1, 0, -1):
            name = open_blocks[i][0]
            if name == "p" or name in ends:
                close_to(i)
                if name != "p":
                    break
            elif name in limits or name not in ("p",):
                if not ends or name in limits:
                    break
        flush()
        marks, label = _marks(tag, found[3])
        parent = open_blocks[-1][1]
        node = page.add(tag, parent, marks, label=label or page.label[parent])
        if not closed:
            open_blocks.append((tag, node))
    flush()
    return _folded(page)


def _folded(page: Page) -> Page:
    """The page without empty elements, and with an element's only run taken up
    into it."""
    size = len(page.tag)
    children = [0] * size
    full = [text is not None for text in page.text]
    for i in range(size - 1, 0, -1):
        if full[i]:
            full[page.parent[i]] = True
            children[page.parent[i]] += 1
    folded, place = Page(), [-1] * size
    for i in range(size):
        if not full[i] and i:
            continue
        parent = page.parent[i]
        if page.tag[i] == "#run" and parent > 0 and children[parent] == 1:
            host = place[parent]
            folded.text[host], folded.linked[host] = page.text[i], page.linked[i]
            continue
        place[i] = folded.add(
            page.tag[i], place[parent] if parent >= 0 else -1, page.marks[i], page.text[i],
            page.linked[i], page.label[i],
        )
    return folded


FEATURES = 18 + len(SHAPES) + 3 * len(CATEGORIES)


def node_features(page: Page) -> np.ndarray:
    """One row per node: subtree densities, place, sibling statistics, shape,
    attribute tokens of the node, of its ancestors and of what it contains."""
    size = len(page.tag)
    parent = np.array(page.parent)
    lengths = np.array([len(t) if t else 0 for t in page.text], float)
    sums = np.zeros((size, 6))  # chars, words, linked, punctuation, runs, elements
    sums[:, 0] = lengths
    sums[:, 1] = [t.count(" ") + 1 if t else 0 for t in page.text]
    sums[:, 2] = page.linked
    sums[:, 3] = [len(_PUNCTUATION.findall(t)) if t else 0 for t in page.text]
    sums[:, 4] = lengths > 0
    sums[:, 5] = 1
    longest = lengths.copy()
    order = {name: i for i, name in enumerate(CATEGORIES)}
    own = np.zeros((size, len(CATEGORIES)))
    for i, marks in enumerate(page.marks):
        for mark in marks:
            own[i, order[mark]] = 1
    above, below = np.zeros_like(own), own.copy()
    depth, count, index = np.zeros(size), np.zeros(size), np.zeros(size)
    start = np.r_[0.0, np.cumsum(lengths)[:-1]]
    for i in range(1, size):
        up = parent[i]
        depth[i] = depth[up] + 1
        above[i] = np.maximum(above[up], own[up])
        index[i] = count[up]
        count[up] += 1
    before, after = np.zeros(size), np.zeros(size)
    for i in range(size - 1, 0, -1):
        up = parent[i]
        sums[up] += sums[i]
        longest[up] = max(longest[up], longest[i])
        below[up] = np.maximum(below[up], below[i])
    last: dict[int, int] = {}
    for i in range(1, size):
        previous = last.get(parent[i])
        if previous is not None:
            before[i], after[previous] = sums[previous, 0], sums[i, 0]
        last[parent[i]] = i
    chars = sums[:, 0]
    some = np.maximum(chars, 1)
    up = np.maximum(parent, 0)
    siblings = np.maximum(count[up], 1)
    shape = np.zeros((size, len(SHAPES)))
    for i, tag in enumerate(page.tag):
        name = "run" if tag == "#run" else TAG_SHAPE.get(tag, "box")
        shape[i, SHAPES.index(name)] = 1
    total = max(chars[0], 1)
    return np.column_stack([
        np.log1p(chars), np.log1p(sums[:, 1]), sums[:, 2] / some, 100 * sums[:, 3] / some,
        chars / np.maximum(sums[:, 4], 1), np.minimum(100 * sums[:, 5] / some, 100),
        chars / total, chars / np.maximum(chars[up], 1), depth, index / siblings, siblings,
        start / total, (start + chars) / total, np.log1p(before), np.log1p(after),
        np.log1p(longest), longest / max(longest[0], 1), np.log1p(count), shape, own, above, below,
    ])
