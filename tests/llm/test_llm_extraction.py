import itertools
import random
import re

import html as entities
import numpy as np
import pytest

from weirflow.llm import dom, extraction as e
from weirflow.llm.catalog import all_queries
from weirflow.llm.common import as_rows


def leaves(source):
    page = dom.parse(source)
    return [(page.tag[i], t) for i, t in enumerate(page.text) if t]


@pytest.mark.parametrize("source, expected", [
    ("", []), ("  ", []), ("plain", [("#run", "plain")]),
    ("<p>a<p>b <b>c</b>d<br>e</div></p>x", [("p", "a"), ("p", "b cd e"), ("#run", "x")]),
    ("<div class=x>a &amp; b&nbsp;c<!-- x", [("div", "a & b c")]),
    ("<a href='>'>t</a> 3 < 4 <", [("#run", "t 3 < 4 <")]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e",
     [("li", "a"), ("#run", "b"), ("li", "c"), ("li", "d"), ("#run", "e")]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", [("td", "1"), ("td", "2"), ("td", "3")]),
    ("<script>var x='</p>'", []), ("<p>un<i>in</i>ted</p><button>k</button>z", [("p", "uninted"), ("#run", "z")]),
    ("<select><option>a</select>ok<noscript><p>no</p></noscript>y", [("#run", "oky")]),
    ("<head><title>t</title><p>b", [("p", "b")]), ("</p></div>", []), ("<p", [("#run", "<p")]),
])
def test_parse(source, expected):
    assert [(t, x) for t, x in leaves(source)] == expected


def test_parse_survives_random_markup():
    rnd = random.Random(3)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<li>", "<", ">", "&lt;", "x y", "<!--", "-->",
             "<script>", "</script>", "<a href=\"", "</ul>", "<head>", "<option>", "é", "<svg/>"]
    for _ in range(300):
        page = dom.parse("".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))))
        assert dom.node_features(page).shape == (len(page.tag), dom.FEATURES)
        assert all(p < i for i, p in enumerate(page.parent))


def test_decoding_is_the_best_consistent_labelling():
    rnd = random.Random(8)
    for _ in range(200):
        page, size = dom.Page(), rnd.randint(1, 8)
        for i in range(size):
            page.add("div", rnd.randrange(i) if i else -1)
        inner = set(page.parent)
        for i in range(size):
            if i not in inner or rnd.random() < 0.2:
                page.text[i] = "x"
        odds = np.array([rnd.uniform(-3, 3) for _ in range(size)])
        best = None
        for kept in itertools.product([False, True], repeat=size):
            if any(kept[i] and not kept[page.parent[i]] for i in range(1, size)):
                continue
            if any(kept[i] and not page.text[i] and not any(
                    kept[j] for j in range(1, size) if page.parent[j] == i) for i in range(size)):
                continue
            score = sum(-np.logaddexp(0, -o if k else o) for o, k in zip(odds, kept))
            if best is None or score > best[0]:
                best = (score, kept)
        assert tuple(e.decode(page, odds)) == best[1]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    rows = rng.random((4000, 3))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.3)).astype(float)
    model = e.fit_trees(rows, labels, trees=20)
    assert ((model.log_odds(rows) > 0) == labels).mean() > 0.97
    assert (e.fit_trees(np.zeros((0, 1)), np.zeros(0)).log_odds(np.zeros((2, 1))) > 0).all()


def article(source):
    inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
    inner = re.sub(r"<br>", " ", inner)
    inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1)>", "\n", inner))
    return " ".join(entities.unescape(inner).split())


def test_query_and_unseen_layouts(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = all_queries()["op5_extraction"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        source = pages[r["page_id"]]
        assert (r["url"], r["n_chars"]) == (source["url"], len(r["text"]))
        assert r["text"] == article(source["html"])


def test_unseen_layouts(spark, sf):
    sources = [r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").orderBy("page_id").collect()]
    model = e.fit_trees(*e.training_nodes(sources[::2][:80]))
    right = wrong = missed = 0
    pages = [dom.parse(s) for s in sources[1::2][:60]]
    texts = [[t for t in p.text if t] for p in pages]
    for n, page in enumerate(pages):
        own = [page.text[i] for i in e._article_of(page)]
        made = e.Layouts(10_000 + n, [t[0] for t in texts], [t[-2] for t in texts])
        new = dom.parse(made.page(own[0], own[1:20]))
        kept = e.decode(new, model.log_odds(dom.node_features(new)))
        for text, label, keep in zip(new.text, new.label, kept):
            size = len(text or "")
            right, wrong, missed = right + size * (label and keep), wrong + size * (
                not label and keep), missed + size * (label and not keep)
    assert right > 0.95 * (right + wrong) and right > 0.95 * (right + missed)


def test_odd_pages(spark):
    pages = spark.createDataFrame(
        [(1, None, "u", "x"), (2, "", None, "x"), (None, "<article><p>a b</p></article>", "u", "x"),
         (3, "<article><p>a b</p></article>", "u", "x"), (3, "<nav>" * 3000 + "t", "u", "x"),
         (4, "<p>" + "long text, here. " * 20_000, "u", "x")],
        "page_id long, html string, url string, result string",
    )
    model = e.fit_extractor(pages)
    rows = e.extract(as_rows(pages), model).collect()
    assert len(rows) == 6
    assert {r["result"]["text"] for r in rows if not r["row"]["html"]} == {""}
    empty = pages.limit(0)
    assert e.extract(as_rows(empty), e.fit_extractor(empty)).count() == 0


def test_pages_with_an_article_are_found_among_many_without(spark, sf):
    """The sample is drawn among the pages that mark an article."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").limit(40)
    other = spark.range(10_000, 12_000).selectExpr("id as page_id", "concat('<nav>menu ', id, '</nav>') as html")
    model = e.fit_extractor(pages.unionByName(other), training_pages=40)
    page = dom.parse("<nav><a>Home</a></nav><article><h1>T</h1><p>" + "Some long words. " * 20 + "</p></article>")
    text, _ = e.main_text(page, model.log_odds(dom.node_features(page)))
    assert "Some long words." in text and "Home" not in text
