"""The element tree and the widgets read from it, on literal pages."""

import pytest
from pagelens.operators import elements as E
from pagelens.operators import widgets as W
from pyspark.sql import functions as F


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id int, html string")


def spans(spark, html):
    """(name, first token, token after the last, parent's first token) of every element."""
    rows = pages(spark, html).select(E.tokens(F.col("html")).alias("t"))
    rows = rows.select("t", E.nodes(F.col("t"), lambda t: F.lit(None).cast("string"), W.PLAIN_TAGS, W.SECTION_TAGS).alias("n"))
    got = rows.select("t", F.explode("n").alias("n")).filter("n.t IS NULL").select(F.get("t", F.col("n.p"))["name"], "n.p", "n.e", "n.u").collect()
    return [tuple(r) for r in got]


@pytest.mark.parametrize("html, expected", [
    ("<div><p>a<p>b</div>c", [("div", 1, 4, -1), ("p", 2, 3, 1), ("p", 3, 4, 1)]),
    ("<ul><li>a<li><p>b<li>c</ul>", [("ul", 1, 6, -1), ("li", 2, 3, 1), ("li", 3, 5, 1), ("p", 4, 5, 3), ("li", 5, 6, 1)]),
    ("<h2>a<p>b<b>c</p>d</b>", [("h2", 1, 2, -1), ("p", 2, 4, -1), ("b", 3, 4, 2)]),
    ("<html><body><div>a<br>b</div></body></html>", [("div", 3, 5, -1), ("br", 4, 5, 3)]),
    ("<a>x</b></a><!-- <i> --><u>", [("a", 1, 3, -1), ("u", 4, 5, -1)]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", [("table", 1, 7, -1), ("tr", 2, 5, 1), ("td", 3, 4, 2), ("td", 4, 5, 2), ("tr", 5, 7, 1), ("td", 6, 7, 5)]),
    ("a < b <3", []), ("", []),
])
def test_elements(spark, html, expected):
    assert spans(spark, html) == expected


def test_a_page_of_many_chunks(spark):
    n = E.CHUNK * 3 + 5
    got = spans(spark, "<div>" + "<i>x</i>" * n + "</div>")
    assert got[0] == ("div", 1, 2 * n + 2, -1) and got[-1] == ("i", 2 * n, 2 * n + 1, 1) and len(got) == n + 1


def test_paragraphs_keep_their_markup(spark):
    rows = W.html_to_widgets(pages(spark, '<p>A <a href="/z">link</a> &amp; B</p><p> </p><h3 class="text-right">A <b>b</b></h3><blockquote>q</blockquote><em>e</em>')).collect()
    assert [(r.widgetType, r.text, r.content, r.align) for r in rows] == [
        ("text-editor", "A link & B", '<p>A <a href="/z">link</a> &amp; B</p>', None), ("heading", "A b", None, "right"),
        ("text-editor", None, "<blockquote>q</blockquote>", None), ("text-editor", None, "<p><em>e</em></p>", None)]


def test_sections(spark):
    html = 'a<section class="bg-gray-700 py-3"><div><p>b</p><header>c</header></div></section><footer></footer>d<i>e</i>'
    rows = W.html_to_widgets(pages(spark, html)).collect()
    assert [(r.section, r.pos, r.text or r.content, r.section_background, r.section_padding) for r in rows] == [
        (0, 1, "a", None, None), (1, 2, "b", "#4b5563", 12), (1, 3, "c", "#4b5563", 12), (2, 4, "<footer></footer>", None, None), (3, 5, "d", None, None), (3, 6, "<p><i>e</i></p>", None, None)]


def test_pages_without_widgets(spark):
    rows = W.html_to_widgets(pages(spark, "", None, "<div><img></div>", "<head><title>t</title></head>")).collect()
    assert [(r.page_id, r.widgetType, r.content) for r in rows] == [(0, "text-editor", ""), (1, "text-editor", None), (2, "text-editor", "<div><img></div>"), (3, "text-editor", "<head><title>t</title></head>")]
    assert W.special_widgets(pages(spark, "", None)).count() == 0


def items(spark, html):
    return [[tuple(i) for i in r["items"]] for r in W.special_widgets(pages(spark, html)).collect()]


def test_accordion_items(spark):
    assert items(spark, '<div data-elementor="accordion"><details><summary>Q <i>1</i></summary><p>A <b>bold</b> 1</p><p>more</p></details>'
                 '<div><strong>Q2</strong><span>A2</span><em>no</em></div><div>no question</div><h3>out</h3></div>') == [[("Q 1", "A bold 1 more", None), ("Q2", "A2", None)]]
    assert items(spark, '<div data-elementor="accordion"><h3>Q</h3><p>A</p></div>') == [[(W.FAQ_TITLE, "QA", None)]]


def test_list_items_have_their_own_icons(spark):
    assert items(spark, '<ul data-elementor="icon-list" data-icon="star"><li data-icon="check">One <b>1</b><li>Two</li><li> </li><li data-icon="odd">3</li>text</ul>') == [
        [(None, "One 1", "fa fa-check"), (None, "Two", "fa fa-star"), (None, "3", "fa fa-star")]]
    assert items(spark, '<div data-elementor="icon-list" data-icon="odd"><p>x</p></div>') == [[(None, "x", "fa fa-check")]]


def test_special_widgets_are_not_looked_for_in_others(spark):
    rows = W.special_widgets(pages(spark, '<div data-elementor="call-to-action"><h2>T</h2><div><h3>in</h3></div><p>a</p><p>b</p><a href="/1">x</a><a>Go <b>on</b></a><i data-elementor="button">no</i></div>'
                                   '<p><i data-elementor="button">no</i></p><b data-elementor="button" href="/b"> yes </b>')).collect()
    assert [(r.pos, r.widgetType, r.title, r.text, r.button, r.link) for r in rows] == [(1, "call-to-action", "T", "a b", "Go on", "#"), (2, "button", None, None, "yes", "/b")]


def test_tokens(spark):
    got = pages(spark, "a<B c='d'>e\n<!x>f</B >g<1>h< i<j<k/>é\U0001F600<?l<m\n>").select(F.explode(E.tokens(F.col("html")))).select("col.*").collect()
    assert [tuple(r) for r in got] == [("", False, "", "a"), ("b", False, " c='d'", "e\n"), ("", False, "", "f"), ("b", True, " ", "g"), ("", False, "", "<1>h"), ("", False, "", "< i"),
                                       ("j", False, "", ""), ("k", False, "/", "é\U0001F600"), ("", False, "", ""), ("m", False, "\n", "")]
