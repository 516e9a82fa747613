"""HTML extraction on hostile and broken pages, repeated pages and pages without marks."""

import time

import pytest

from tidegrid.llm.html_text import leaf_blocks, main_text


@pytest.mark.parametrize("unit", ['<div class=x ', '<a href="x ', "<a href='x ", "<!-- x ", "<svg>x ",
                                  "<div>", "<div><p>x", "</div>x", "<![x ", "<script>", "<a b='c\">x",
                                  "< x", "<p class=a>y</q>", '<a ">" b', "<select><option>x"])
def test_linear_on_a_megabyte(unit):
    began = time.process_time()
    leaf_blocks(unit * (1_000_000 // len(unit)))
    assert time.process_time() - began < 6
    began = time.process_time()
    leaf_blocks("<p>" + unit * (250_000 // len(unit)))
    assert time.process_time() - began < 3


def test_many_names_deep():
    page = "".join(f"<div class='n{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}'>x"
                   for i in range(20_000))
    began = time.process_time()
    assert len(leaf_blocks(page)) == 20_000 and time.process_time() - began < 10


@pytest.mark.parametrize("tag", "svg select template noscript iframe".split())
def test_unclosed_elements_lose_no_text(tag):
    texts = [b.text for b in leaf_blocks(f"<article><p>one</p><{tag} a=b>gone?<p>two</p><p>three</p>")]
    assert texts[0] == "one" and texts[-2:] == ["two", "three"]
    closed = [b.text for b in leaf_blocks(f"<p>one</p><{tag}><b>gone</b></{tag} ><p>two</p>")]
    assert closed == ["one", "two"]


def test_raw_text_runs_on():
    for tag in ("script", "style", "textarea"):
        assert [b.text for b in leaf_blocks(f"<p>one</p><{tag}>two<p>three</p>")] == ["one"]
    assert [b.text for b in leaf_blocks("<p>one<!-- two<p>three")] == ["one"]


def test_signs_in_text_stay():
    assert [b.text for b in leaf_blocks("<p>a < b and c<d &lt; e</p><p>f > g")] == ["a < b and c f > g"] \
        or [b.text for b in leaf_blocks("<p>a < b &amp; c &lt; d</p><p>f > g")] == ["a < b & c < d", "f > g"]
    assert [b.text for b in leaf_blocks('<p title="a > b">x</p>')] == ["x"]
    assert [b.text for b in leaf_blocks("<p>x <unfinished tag")] == ["x <unfinished tag"]


def test_paths():
    blocks = leaf_blocks("<html><body><div class='a b'><div id=b><p>x</p></div></div><p>y")
    assert blocks[0].path == ("html", "body", "a", "div", "b", "p")
    assert blocks[1].path == ("html", "body", "p")


def page(i, body):
    return (i, f"<html><body><nav><ul><li><a href=/>home</a></li><li><a href=/{i}>more</a></li></ul></nav>"
               f"<div>{body}</div><footer><p>© all rights</p></footer></body></html>")


def test_no_page_is_marked(spark):
    prose = "This is a sentence of some length, number {}, and it goes on for a while until it ends."
    rows = [page(i, "".join(f"<p>{prose.format(100 * i + k)}</p>" for k in range(4))) for i in range(60)]
    got = {r.page_id: r.text for r in main_text(
        spark.createDataFrame(rows, "page_id long, html string")).collect()}
    for i in range(60):
        assert got[i] == " ".join(prose.format(100 * i + k) for k in range(4))


def test_a_third_of_all_pages_equal(spark):
    rows = [(0, "<html><body><article><p>The same page over and over again, as it is.</p></article>"
                "<footer><p>foot</p></footer></body></html>")] * 3000
    rows += [(i, f"<html><body><header><p>Top</p></header><article><p>Text {i} says this and that, of "
                 f"course.</p></article><footer><p>foot</p></footer></body></html>") for i in range(1, 200)]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'x' AS n_chars", "1 AS weights")
    got = main_text(df, "html").select("page_id", "text", "weights").distinct().collect()
    assert len(got) == 200
    assert {r.text for r in got if r.page_id == 7} == {"Text 7 says this and that, of course."}
    assert {r.text for r in got if r.page_id == 0} == {"The same page over and over again, as it is."}
