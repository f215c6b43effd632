"""Main text of web pages by gradient-boosted trees over DOM nodes.

The trees give every node the odds that it holds article text, from its subtree's
densities, its place, its siblings, and the words in its attributes and those
above and below it. Decoding is hierarchical: it takes the likeliest labelling of
the whole tree in which nothing below a dropped node is kept and every kept
element holds something kept.

Labels come without a reader: pages that mark their article by an element are
taken as they are, and their passages are also set into invented layouts with
known truth, with and without telling attribute names, so that the model doesn't
depend on one template.
"""

from __future__ import annotations

import html
import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.llm.common import as_rows, hash_sample, map_rows, query, texts_of
from weirflow.llm.dom import Page, node_features, parse
from weirflow.plans.registry import table

TRAINING_PAGES = 300
LAYOUTS_PER_PAGE = 6
TREES = 60
DEPTH = 4
BINS = 32
RATE = 0.2
LEAST_WEIGHT = 20.0
#: What invented layouts take of a training page.
PASSAGES = 40
PASSAGE_CHARS = 4_000
#: The start of an article element.
ARTICLE = r"(?i)<article[\s/>]"

#: Ways to mark up the parts of invented pages; "" leaves a part unmarked.
PARTS = {
    "content": ["<article>", "<main>", '<div class="content">', '<div class="article-body">',
                '<div class="post-content">', '<div id="story">', '<section class="entry">',
                '<div class="main-text">', '<div role="main">', "<div>", '<div class="c1">'],
    "nav": ["<nav>", '<div class="menu">', '<ul class="nav">', '<div id="navbar">', "<div>",
            '<div class="breadcrumbs">', '<div role="navigation">', '<div class="c2">'],
    "header": ["<header>", '<div class="header">', '<div id="masthead">', '<div class="topbar">',
               '<div class="site-header">', "<div>"],
    "footer": ["<footer>", '<div class="footer">', '<div id="bottom">', '<div class="copyright">',
               '<div class="site-footer">', "<div>"],
    "side": ["<aside>", '<div class="sidebar">', '<div id="side">', '<div class="widget">',
             '<aside class="rail">', "<div>"],
    "ad": ['<div class="ad">', '<div class="advert">', '<div class="sponsored">',
           '<aside class="promo">', '<div id="banner-ad">', '<div class="advertisement">',
           '<section class="ads">'],
    "notice": ['<div class="cookie-notice">', '<div id="consent">', '<div class="notice">',
               '<div class="alert">', '<div role="dialog">', '<div class="gdpr-banner">',
               '<div class="popup">', '<section class="notice">'],
    "form": ["<form>", '<form class="newsletter">', '<div class="subscribe">',
             '<form id="search">', '<form class="login">', '<div class="signup-form">'],
    "comment": ['<div class="comments">', '<section id="comments">', '<div class="comment-list">',
                '<div id="disqus_thread">', '<div class="discussion">', '<ol class="comments">',
                '<section class="replies">', '<div class="reader-comments">'],
    "more": ['<div class="related">', '<section class="recommended">', '<div class="share">',
             '<div class="read-more">', '<ul class="tags">', '<div class="trending">'],
}
WRAPPERS = ["<div>", '<div id="page">', '<div class="wrap">', '<div class="row">',
            '<div class="container">', "<section>"]

RESULT = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("nodes", T.IntegerType()),
    T.StructField("kept", T.IntegerType()),
])


def _closed(start: str, inner: str) -> str:
    name = start[1:].split()[0].rstrip(">")
    return f"{start}{inner}</{name}>"


class Layouts:
    """Invented pages around given passages; `short` and `long` texts fill the
    other parts."""

    def __init__(self, seed: int, short: list[str], long: list[str]) -> None:
        self.random = random.Random(seed)
        self.short = [html.escape(t) for t in short] or ["Home", "More"]
        self.long = [html.escape(t) for t in long] or ["Some text that stands here."]

    def _pick(self, texts: list[str], least: int, most: int) -> list[str]:
        return [self.random.choice(texts) for _ in range(self.random.randint(least, most))]

    def _links(self, least: int, most: int) -> str:
        items = [f'<a href="/{i}">{t}</a>' for i, t in enumerate(self._pick(self.short, least, most))]
        if self.random.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " | ".join(items)

    def _paragraphs(self, least: int, most: int) -> str:
        return "".join(f"<p>{t}</p>" for t in self._pick(self.long, least, most))

    def part(self, name: str) -> str:
        rnd = self.random
        if name in ("nav", "more"):
            head = f"<h3>{rnd.choice(self.short)}</h3>" if name == "more" else ""
            inner = head + self._links(2, 9)
            if name == "more" and rnd.random() < 0.3:
                inner += self._paragraphs(1, 2)
        elif name == "header":
            inner = f'<a href="/">{rnd.choice(self.short)}</a>' + (
                f"<p>{rnd.choice(self.short)}</p>" if rnd.random() < 0.6 else ""
            )
        elif name == "side":
            inner = f"<h3>{rnd.choice(self.short)}</h3>" + rnd.choice(
                [self._links(2, 8), self._paragraphs(1, 3), self._links(1, 3) + self._paragraphs(1, 2)]
            )
        elif name == "form":
            inner = (f"<label>{rnd.choice(self.short)}</label><input><button>ok</button>"
                     f"<p>{rnd.choice(self.short + self.long)}</p>")
        elif name == "comment":
            rows = "".join(
                rnd.choice([f"<div><b>{rnd.choice(self.short)}</b><p>{t}</p></div>",
                            f"<p>{t}</p>", f"<li>{t}</li>",
                            f'<div class="comment"><p>{t}</p></div>'])
                for t in self._pick(self.long, 1, 6)
            )
            inner = (f"<h3>{rnd.choice(self.short)}</h3>" if rnd.random() < 0.6 else "") + rows
        elif name == "footer":
            inner = f"&copy; {rnd.choice(self.short)} &middot; {rnd.choice(self.short + self.long)}"
        else:
            inner = rnd.choice([
                rnd.choice(self.short), f"<p>{rnd.choice(self.short)}</p>", self._paragraphs(1, 2),
            ])
        return _closed(rnd.choice(PARTS[name]), inner)

    def article(self, title: str, passages: list[str]) -> str:
        rnd = self.random
        parts = [f'<h1 data-y="1">{html.escape(title)}</h1>'] if title else []
        for text in passages:
            text = html.escape(text)
            kind = rnd.random()
            if kind < 0.74:
                close = "</p>" if rnd.random() < 0.8 else ""
                parts.append(f'<p data-y="1">{text}{close}')
            elif kind < 0.82:
                parts.append(f'<div data-y="1">{text}</div>')
            elif kind < 0.87:
                parts.append(f'<blockquote data-y="1"><p>{text}</p></blockquote>')
            elif kind < 0.93:
                words = text.split(" ")
                cut = max(1, len(words) // 3)
                items = [" ".join(words[i : i + cut]) for i in range(0, len(words), cut)]
                parts.append('<ul data-y="1">' + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            else:
                parts.append(f'<h2 data-y="1">{rnd.choice(self.short)}</h2><p data-y="1">{text}</p>')
            if rnd.random() < 0.06:
                parts.append(self.part(rnd.choice(["ad", "more", "form", "notice"])))
        return "".join(parts)

    def page(self, title: str, passages: list[str]) -> str:
        rnd = self.random
        start = rnd.choice(PARTS["content"])
        inner = self.article(title, passages)
        if rnd.random() < 0.3:
            inner = _closed(rnd.choice(WRAPPERS), inner)
        if rnd.random() < 0.25:
            inner += self.part(rnd.choice(["comment", "more", "ad"]))
        body = [_closed(start, inner)]
        for name, chance in (("notice", 0.4), ("ad", 0.5), ("nav", 0.8), ("header", 0.7)):
            if rnd.random() < chance:
                body.insert(0, self.part(name))
        for name, chance in (("side", 0.5), ("more", 0.4), ("comment", 0.5), ("form", 0.4),
                             ("ad", 0.3), ("notice", 0.2), ("footer", 0.8)):
            if rnd.random() < chance:
                body.append(self.part(name))
        if rnd.random() < 0.4:
            body = [_closed(rnd.choice(WRAPPERS), "".join(body))]
        return "<html><head><title>t</title></head><body>" + "".join(body) + "</body></html>"


def node_labels(page: Page) -> np.ndarray:
    """1 for nodes that hold labelled text."""
    holds = np.array([bool(t) and y > 0 for t, y in zip(page.text, page.label)], bool)
    for i in range(len(holds) - 1, 0, -1):
        if holds[i]:
            holds[page.parent[i]] = True
    return holds.astype(float)


def _article_of(page: Page) -> list[int] | None:
    """Leaves of the page's one article element, without parts of other kinds."""
    articles = [i for i, t in enumerate(page.tag) if t == "article"]
    if len(articles) != 1:
        return None
    inside = np.zeros(len(page.tag), bool)
    inside[articles[0]] = True
    for i in range(articles[0] + 1, len(page.tag)):
        inside[i] = inside[page.parent[i]] and not (page.marks[i] - {"content"})
    return [i for i in range(len(page.tag)) if inside[i] and page.text[i]]


def training_nodes(sources: list[str], layouts: int = LAYOUTS_PER_PAGE):
    """(features, labels) of the nodes of the given pages that mark an article,
    and of invented layouts of their passages."""
    pages = [parse(s) for s in sources]
    marked = [(p, a) for p in pages if (a := _article_of(p))]
    short, long = [], []
    for page, article in marked:
        inside = set(article)
        for i, text in enumerate(page.text):
            if text and i not in inside:
                short.append(text[:200])
        long += [page.text[i][:600] for i in article[1:4]]
    features, labels = [], []
    for number, (page, article) in enumerate(marked):
        page.label = [0] * len(page.tag)
        for i in article:
            page.label[i] = 1
        heading = page.tag[article[0]] in ("h1", "h2")
        title = page.text[article[0]] if heading else ""
        passages = [page.text[i][:PASSAGE_CHARS] for i in article[heading:]][:PASSAGES]
        made = Layouts(number, short, long)
        for one in [page, *(parse(made.page(title, passages)) for _ in range(layouts))]:
            features.append(node_features(one))
            labels.append(node_labels(one))
    if not features:
        return np.zeros((0, 1)), np.zeros(0)
    return np.vstack(features), np.concatenate(labels)


@dataclass
class BoostedTrees:
    """Full binary trees of one depth: split features and limits by place in the
    tree, and leaf values. `start` is the log-odds before the first tree."""

    start: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        result = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            place = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                place = 2 * place + 1 + (rows[every, feature[place]] > limit[place])
            result += value[place - (value.shape[0] - 1)]
        return result


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, *, trees: int = TREES, depth: int = DEPTH
) -> BoostedTrees:
    """Second-order boosting of the logistic loss over feature histograms; every
    tree is grown on another half of the rows."""
    if len(labels) == 0 or labels.min() == labels.max():
        kept = 10.0 if len(labels) == 0 or labels[0] else -10.0
        return BoostedTrees(kept, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 1)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in rows.T]
    binned = np.column_stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, rows.T)])
    width = rows.shape[1]
    rate = labels.mean()
    start = float(np.log(rate / (1 - rate)))
    margin = np.full(len(labels), start)
    all_features, all_limits, all_values = [], [], []
    binned = np.ascontiguousarray(binned.T.astype(np.int32))
    halves = np.random.default_rng(0)
    every = np.arange(len(labels))
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, weight = labels - chance, chance * (1 - chance)
        half = halves.permutation(len(labels))[: -(-len(labels) // 2)]
        half_slope, half_weight, half_bins = slope[half], weight[half], binned[:, half]
        place = np.zeros(len(labels), np.int64)
        feature = np.zeros(2**depth - 1, np.int64)
        limit = np.full(2**depth - 1, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-6)
            node = (place[half] - first) * BINS
            for f in range(width):
                if not len(cuts[f]):
                    continue
                cell = node + half_bins[f]
                g = np.bincount(cell, half_slope, nodes * BINS).reshape(nodes, BINS)
                h = np.bincount(cell, half_weight, nodes * BINS).reshape(nodes, BINS)
                left_g, left_h = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                total_g, total_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                right_g, right_h = total_g - left_g, total_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - total_g**2 / (total_h + 1)
                gain[(left_h < LEAST_WEIGHT / 10) | (right_h < LEAST_WEIGHT / 10)] = -1
                gain[:, len(cuts[f]) :] = -1
                at = gain.argmax(1)
                better = gain[np.arange(nodes), at] > best
                best[better] = gain[np.arange(nodes), at][better]
                feature[first : first + nodes][better] = f
                limit[first : first + nodes][better] = cuts[f][np.minimum(at, len(cuts[f]) - 1)][better]
            place = 2 * place + 1 + (rows[every, feature[place]] > limit[place])
        leaf = place - (2**depth - 1)
        g = np.bincount(leaf, slope, 2**depth)
        h = np.bincount(leaf, weight, 2**depth)
        value = RATE * g / (h + 1)
        margin += value[leaf]
        all_features.append(feature)
        all_limits.append(limit)
        all_values.append(value)
    return BoostedTrees(start, np.array(all_features), np.array(all_limits), np.array(all_values))


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Nodes to keep: the labelling with the highest likelihood in which a kept
    node's parent is kept and a kept element without own text has a kept child.
    Of equal ones, the one that drops more."""
    size = len(page.tag)
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    keep, drop = yes.copy(), no.copy()  # best sums below a kept and a dropped node
    surplus = np.full(size, -np.inf)  # the least costly child to keep
    chosen = np.full(size, -1)
    takes = np.zeros(size, bool)  # has a child that is kept anyway
    for i in range(size - 1, -1, -1):
        if not page.text[i]:
            if not takes[i]:
                keep[i] = keep[i] + surplus[i] if chosen[i] >= 0 else -np.inf
        if i:
            up = page.parent[i]
            gain = keep[i] - drop[i]
            keep[up] += max(keep[i], drop[i])
            drop[up] += drop[i]
            takes[up] |= gain > 0
            if gain > surplus[up]:
                surplus[up], chosen[up] = gain, i
    kept = np.zeros(size, bool)
    kept[0] = keep[0] > drop[0]
    forced = np.zeros(size, bool)
    for i in range(size):
        if i:
            kept[i] = kept[page.parent[i]] and (keep[i] > drop[i] or forced[i])
        if kept[i] and not page.text[i] and not takes[i] and chosen[i] >= 0:
            forced[chosen[i]] = True
    return kept


def main_text(page: Page, odds: np.ndarray) -> tuple[str, int]:
    """Kept blocks in page order, and how many."""
    kept = decode(page, odds)
    blocks = [t for t, k in zip(page.text, kept) if t and k]
    return " ".join(blocks), len(blocks)


def fit_extractor(
    pages: DataFrame, *, source: str = "html", key: str = "page_id",
    training_pages: int = TRAINING_PAGES,
) -> BoostedTrees:
    """Learn from up to `training_pages` pages that mark one article, chosen by a
    hash of the key among all such pages of the table. If there is none, everything
    is kept. Equal pages are learned from once. Invented layouts hold up to
    `PASSAGES` passages of a page, up to `PASSAGE_CHARS` characters of each."""
    known = pages.select(pages[key].alias("key"), pages[source].alias("html"))
    marked = known.filter(F.regexp_count("html", F.lit(ARTICLE)) == 1)
    chosen = hash_sample(marked, training_pages, "key").select("html")
    rows, labels = training_nodes(list(dict.fromkeys(r["html"] for r in chosen.collect())))
    return fit_trees(rows, labels)


def extract(rows: DataFrame, model: BoostedTrees, *, source: str = "html") -> DataFrame:
    """Add `result` (text, nodes, kept) to a table of `row` structs.

    White space within a block is one space, blocks are joined by one space. A
    null, empty or textless page has an empty text. Nothing is shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            pages = [parse(s or "") for s in texts_of(batch, source)]
            odds = shared.value.log_odds(np.vstack([node_features(p) for p in pages])) if pages else []
            texts, kept, at = [], [], 0
            for page in pages:
                text, count = main_text(page, odds[at : at + len(page.tag)])
                at += len(page.tag)
                texts.append(text)
                kept.append(count)
            yield batch.column("row"), pa.StructArray.from_arrays(
                [pa.array(texts, pa.string()), pa.array([len(p.tag) for p in pages], pa.int32()),
                 pa.array(kept, pa.int32())],
                names=["text", "nodes", "kept"],
            )

    return map_rows(rows, run, RESULT)


@query("op5_extraction")
def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(as_rows(pages), fit_extractor(pages))
    return found.select(
        "row.page_id", "row.url", "result.text", F.length("result.text").cast("long").alias("n_chars")
    )
