"""Messages against enumeration, parsing, labelled pages held out of training, edges."""

import html as entities
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from triage.llm import html_extract as H
from triage.llm.queries import QUERIES

P = "<p>" + "This is a plain paragraph of the article with words. " * 3 + "</p>"


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark.read.parquet(f"{SF01}/pages.parquet"), sample=60, layouts=500)


def text(page, model):
    tree = H.parse(page)
    return H.main_text(tree, H.content([tree], model)[0])


def blocks(page):
    return [t for t in H.parse(page).text if t is not None]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    m = H.Model(rng.normal(size=H.BUCKETS), rng.normal(size=(H.N_GROUPS ** 2, 2, 2)))
    trees = [H.parse(x) for x in ("<div><p>a b<p>c</div>", "<ul><li>x<li>y</ul>", "q", "<article><h1>t</h1><div>z</div></article>", "")]
    got = H.content(trees, m)
    for tree, p in zip(trees, got):
        f = H.forest([tree], [False])
        own = np.bincount(f.node, m.weight[f.ids], minlength=len(f.parent))
        n = len(own)
        total, ones = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            s = sum(own[i] for i in range(n) if y[i]) + sum(m.edge[f.edge[i], y[f.parent[i]], y[i]] for i in range(n) if f.parent[i] >= 0)
            total += np.exp(s)
            ones += np.exp(s) * np.array(y)
        assert np.allclose((ones / total)[f.place], p)


def test_gradient_is_that_of_the_likelihood(monkeypatch):
    monkeypatch.setattr(H, "STEPS", 60)
    trees = [H.parse(H.layout(i)) for i in range(40)]
    m = H.train(trees, [False] * 40)
    right = np.concatenate([(p >= 0.5) == np.array(t.label) for t, p in zip(trees, H.content(trees, m))])
    assert right.mean() > 0.97


@pytest.mark.parametrize(("page", "want"), [
    ("<p>a<p>b", ["a", "b"]), ("a<br>b", ["a b"]), ("a <b>b</b>\n\t c&nbsp;&amp;&#x41;", ["a b c &A"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<script>var a='<p>x</p>'</script>y", ["y"]), ("<!-- <p>x</p> -->y<!-- z", ["y"]), ("<!-->a", ["a"]), ("<title>t</title><p>x", ["x"]),
    ("<head><title>t</title><p>x", ["x"]), ("a < b > c", ["a < b > c"]), ("<p title='>'>x", ["x"]), ('<p title=">">x', ["x"]), ("<p title=it's>x</p>y", ["x", "y"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]), ("<select><option>a</select>b", ["b"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
    ("</div>x</p>y", ["x", "y"]), ("<style>p{}", []), ("x<textarea>y</textarea>z", ["x z"]), ("<DIV>A</Div>", ["A"]), ("&lt;p&gt;", ["<p>"]), ("x<hr>y", ["x", "y"]),
    ("<p><b>a<br><p>b</p>", ["a", "b"]), ("x <a href=y", ["x"]), ("", []), (" \n", []),
])
def test_parsing(page, want):
    assert blocks(page) == want


def test_pages_whole(spark):
    """Every page that marks its article gives just the article's blocks."""
    pages = {r.page_id: r for sf in (SF001, SF01) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op12_html_extraction"](spark, SF01).collect()}
    for i, r in got.items():
        article = re.search(r"<article>(.*?)</article>", pages[i].html, re.S)[1]
        parts = (" ".join(entities.unescape(re.sub("</?b>", "", x).replace("<br>", " ")).split()) for x in re.split("</?(?:p|h1)>", article))
        want = "\n\n".join(x for x in parts if x)
        assert r.text == want and r.n_chars == len(want) and r.url == pages[i].url


def test_held_out_layouts(model):
    right = total = 0
    for i in range(9000, 9150):
        tree = H.parse(H.layout(i))
        for label, p, t in zip(tree.label, H.content([tree], model)[0], tree.text):
            if t is not None:
                right += label == (p >= 0.5)
                total += 1
    assert right / total > 0.97


@pytest.mark.parametrize("junk", [
    '<nav><a href="/">Home</a></nav>', '<div class="sidebar"><p>Some words beside the text.</p></div>', '<footer>(c) 2024 by us</footer>', "<script>var x = 1</script>",
    '<section class="comments"><h2>Comments</h2><div class="comment"><p>I think this is a great article, thanks for it.</p></div></section>',
    '<div class="cookie-notice">We use cookies on this site.</div>', '<div class="ad">Buy our product now.</div>', '<form><p>Search here</p><input></form>',
    '<div id="header"><h1>My site</h1></div>'])
def test_boilerplate_goes(model, junk):
    for page in (f"<body>{junk}<article><h1>Title</h1>{P}{P}</article></body>", f"<body><article><h1>Title</h1>{P}{P}</article>{junk}</body>",
                 f'<body><div class="content"><h1>Title</h1>{P}{P}</div>{junk}</body>'):
        assert text(page, model) == "\n\n".join(blocks(f"<h1>Title</h1>{P}{P}"))


def test_edges(spark, model):
    long = "<article>" + P * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", f"<article>{P}</article>"), (3, "u", f"<article>{P}</article>"), (3, "u", f"<article>{P}</article>"), (4, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("text", "n_chars", "label")})
    got = sorted(((r.page_id, r.url, r.n_chars) for r in H.extract(df, model).collect()), key=str)
    one = len(blocks(P)[0])
    assert got == sorted([(1, "u", 0), (2, None, 0), (None, "u", one), (3, "u", one), (3, "u", one), (4, "u", one * 20_000 + 2 * 19_999)], key=str)
    assert H.extract(df.limit(0), model).collect() == []
    assert H.fit(df.limit(0), layouts=5) is not None


def test_any_markup_is_parsed():
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<div class='a", "'>", "<li>", "</ul>", "<td>", "<b>", "text ", "<!--", "-->", "<script>", "</script>", "&am", "<", ">", "\"", "</", "<table>", "<button>", "<head>", "<body>", "</body>"]
    for _ in range(400):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        tree = H.parse(page)
        assert all(0 <= p < i for i, p in enumerate(tree.parent) if i)


@pytest.mark.parametrize("page", ["<a " * 200_000, "<!--" * 200_000, '<p a="' * 100_000, "</div>" * 100_000, "<script>" * 100_000, "<" * 300_000, "<ul><li>" * 5_000])
def test_linear_in_the_page(page):
    H.parse(page)
