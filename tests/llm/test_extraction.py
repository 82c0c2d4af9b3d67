import re
import time

import numpy as np
import pytest
from conftest import SF

from barline.llm import html_extraction as web
from barline.llm import queries

PAGES = "page_id long, url string, html string, text string, n_chars int"
BODY = "This paragraph tells, at some length, what the author has seen in the old town that summer. It was warm."


@pytest.fixture(scope="module")
def chain():
    return web.trained()


def texts(page):
    return [b.text for b in web.leaf_blocks(page)[0]]


def test_leaf_blocks():
    assert texts("<p>one<b> two<p>three</b><br>four &amp; five&nbsp;six") == ["one two", "three four & five six"]
    assert texts("<ul><li>a<li>b</ul>c<table><tr><td>d<td>e<tr><td>f</table>") == list("abcdef")
    assert texts('<script>if (a<b) "</p>"</script><style>p{}</style><!-- <p>no</p> --><p>x') == ["x"]
    assert texts("a < b <3 <p>c") == ["a < b <3", "c"]
    assert texts("<head><title>T</title><meta></head><body>x") == ["x"] and web.leaf_blocks("<title>A &lt; b</title>x")[1] == ""
    assert web.leaf_blocks("<html><head><title>A &lt; b</title></head>x")[1] == "A < b"
    assert texts("<p>kept</p><p class='a") == ["kept"] and texts("<!-- open") == [] and texts("<script>open") == []
    assert texts("<P CLASS=x>UPPER</P><DIV>y</DIV>") == ["UPPER", "y"] and texts("<p>&am") == ["&am"] and texts("&copy") == ["©"]


@pytest.mark.parametrize("unit", ["<div>", "<a <a ", "<b><p>", '<p "', "</div>", "<!-- ", "<li><div>", "&#", "<", "<table><td>", "<script>", "<p x='"])
def test_work_is_linear_in_the_page(unit):
    began = time.time()
    web.features(unit * 60_000)
    assert time.time() - began < 8


def test_likelihood_is_exact():
    pages = [(web.features(p)[1][:4], y[:4]) for p, y in web.labelled_pages(6, 3)]
    got = web.train(pages, rounds=400, rate=0.1, decay=0.05)

    def loss(e, s, f):
        total = 0.0
        for x, y in pages:
            score = np.array([e[i].sum(0) for i in x])
            paths = np.array(np.meshgrid(*[[0, 1]] * len(y), indexing="ij")).reshape(len(y), -1).T
            worth = [f[z[0]] + sum(score[k, z[k]] for k in range(len(z))) + sum(s[a, b] for a, b in zip(z, z[1:], strict=False)) for z in paths]
            mine = f[y[0]] + sum(score[k, y[k]] for k in range(len(y))) + sum(s[a, b] for a, b in zip(y, y[1:], strict=False))
            best = max(range(len(paths)), key=worth.__getitem__)
            assert np.isclose(worth[best], max(worth)) and (not np.isfinite(mine) or web.Chain(e, s, f).states(x) == paths[best].tolist())
            total += np.logaddexp.reduce(worth) - mine
        return total / len(pages) + 0.025 * sum((p**2).sum() for p in (e, s, f))

    least = loss(got.emission, got.step, got.first)
    rng = np.random.default_rng(1)
    for size in (0.003, 0.03, 0.3):
        moved = [p + rng.normal(size=p.shape) * size for p in (got.emission, got.step, got.first)]
        assert loss(*moved) > least - 1e-4


def test_held_out_pages(chain):
    right = blocks = whole = 0
    pages = web.labelled_pages(300, 99)
    for page, states in pages:
        found = chain.states(web.features(page)[1])
        right += sum(a == b for a, b in zip(states, found, strict=True))
        blocks += len(states)
        whole += states == found
    assert right / blocks > 0.99 and whole / len(pages) > 0.9


def test_parts_that_are_no_article(chain):
    page = f"""<html><head><title>The old town</title></head><body><div class="cookie-consent"><p>We use cookies, as others do. Agree?</p><button>Yes</button></div>
    <header><a href="/">Daily News</a></header><nav><ul><li><a href="/a">World</a></li><li><a href="/b">Sport</a></li></ul></nav>
    <main><article><h1>The old town</h1><p>{BODY}</p><div class="ad">Buy two, pay one! Only today.</div><p>{BODY}<br>And so on.</p><ul><li>{BODY}</li></ul></article></main>
    <aside class="sidebar"><h3>Most read</h3><ul><li><a href="/c">Ten towns</a></li></ul></aside>
    <section id="comments"><h3>2 comments</h3><div class="comment"><p>I was there too, and it rained. {BODY}</p></div></section>
    <form><label>Your name</label><input></form><footer>&copy; example.com &middot; All rights reserved.</footer></body></html>"""
    assert web.main_text(page, chain) == f"The old town\n\n{BODY}\n\n{BODY} And so on.\n\n{BODY}"


def test_pages_of_the_table(spark, chain):
    """The table's articles are marked by their element, which the chain knows as one feature of many."""
    for r in queries.QUERIES["op12_html_extraction"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), ["page_id", "url"]).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html or "", re.S)
        assert r.text == "\n\n".join(texts(inner[1] if inner else "")) and r.n_chars == len(r.text)


def test_edge_cases(spark, chain):
    long = f"<article><h1>Title of it</h1>{f'<p>{BODY}</p>' * 20_000}</article>"
    rows = [(1, "u", None, "x", 0), (2, None, "", "x", 0), (None, "u", long, None, None), (3, "u", "<nav><a href=x>a</a></nav>", "x", 0), (4, "u", f"<article><p>{BODY}</p></article>", "", 1), (4, "u", f"<article><p>{BODY}</p></article>", "", 1)]
    got = {(r.page_id, r.n_chars, len(r.text)): r.text for r in web.extract(spark.createDataFrame(rows, PAGES), chain).collect()}
    assert set(got) == {(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, len(BODY), len(BODY)), (None, 11 + 20_000 * (len(BODY) + 2), 11 + 20_000 * (len(BODY) + 2))}
    assert web.extract(spark.createDataFrame(rows, PAGES), chain).count() == 6 and web.extract(spark.createDataFrame([], PAGES), chain).collect() == []
