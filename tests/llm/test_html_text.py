"""HTML extraction: blocks, gradients, and the main text of marked and unmarked layouts."""

import html
import random
import re

import numpy as np
import pytest

from tidegrid.llm import queries
from tidegrid.llm.html_text import BlockLabeller, fit, leaf_blocks, main_text, padded, \
    taught_labels, vectors


def texts(page):
    return [b.text for b in leaf_blocks(page)]


def test_blocks():
    assert texts(None) == texts("") == texts("<p></p><!-- x --><script>a<b</p></script>") == []
    assert texts("plain &amp; text") == ["plain & text"]
    assert texts("<p>a<b>b</b>c<br>d\n e<p>f&nbsp;&lt;g") == ["abc d e", "f <g"]
    assert texts("<ul><li>1<li>2</ul>x<!-- <p>no</p> -->y<style>p{}</style>") == ["1", "2", "xy"]
    assert texts("<p title='a > b'>q</p><script>if (a</script>r") == ["q", "r"]
    assert texts("<script>never closed <p>x") == []
    path = leaf_blocks('<body class="Top-page"><div id=main><p>x</div></p>y')
    assert path[0].path == ("body", "top", "page", "div", "main", "p")
    assert path[1].path == ("body", "top", "page")
    assert leaf_blocks("<li><a href=x>ab</a> c")[0].link_chars == 2


def test_taught_labels():
    page = "<title>t</title><nav>n</nav><article>a<aside>s</aside><p>b</article><footer>f</footer>"
    assert taught_labels(leaf_blocks(page)) == [0, 0, 1, 0, 1, 0]
    assert taught_labels(leaf_blocks("<div>a</div>")) is None


def test_gradients():
    rng = np.random.default_rng(3)
    model = BlockLabeller()
    x, mask = padded([rng.normal(size=(n, vectors(leaf_blocks("<p>x")).shape[1])).astype(np.float32)
                      for n in (3, 1, 4)])
    y = rng.integers(0, 2, mask.shape).astype(np.float32) * mask

    def loss():
        p = model.probabilities(x, mask).astype(np.float64)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()
    grad = model.gradients(x, y, mask)
    for name in model.NAMES:
        flat = model.w[name].reshape(-1)
        for i in rng.integers(0, len(flat), 4):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - grad[name].reshape(-1)[i]) < 2e-4


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def test_query_gives_the_articles(spark, sf_dir, pages):
    got = {r.page_id: r for r in queries.QUERIES["op3_html_text"](spark, sf_dir).collect()}
    right = 0
    for p in pages.collect():
        inner = re.search(r"<article>(.*)</article>", p.html, re.DOTALL)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|br|h\d)>", " ", inner))).split())
        right += got[p.page_id].text == want
        assert got[p.page_id].n_chars == len(got[p.page_id].text)
    assert right / len(got) > 0.98


def test_other_layouts_and_odd_pages(spark, pages):
    rnd = random.Random(2)
    words = " ".join(p.html for p in pages.limit(20).collect())
    words = re.findall(r"[a-zé]{2,12}", re.sub("<[^>]*>", " ", words))
    sentence = lambda n: " ".join(rnd.choice(words) for _ in range(n)) + "."
    body = [sentence(40) for _ in range(6)]
    unmarked = ("<html><body><nav><ul><li><a href=x>home</a><li><a href=y>news</a></ul></nav>"
                "<div class=content>" + "".join(f"<p>{b}</p>" for b in body) + "</div>"
                "<div class=sidebar><ul><li><a href=z>more</a></ul></div>"
                f"<div class=comments><div class=comment><p>{sentence(8)}</p></div></div>"
                "<form><label>mail</label></form><footer><p>&copy; me</p></footer></body></html>")
    rows = [(1, None), (2, ""), (3, "   "), (4, "<<<>>"), (5, unmarked), (5, unmarked),
            (None, "<article>" + "<p>word here</p>" * 3000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "1 AS n_chars")
    model = fit(pages).cache()
    got = main_text(df, model=model).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[3] == ""
    assert by[5] == " ".join(body)
    assert by[None].startswith("word here word here")
    assert main_text(df.limit(0)).count() == 0
    assert {r.text for r in main_text(df.where("page_id < 4")).collect()} == {""}
