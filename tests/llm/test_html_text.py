import time

import pytest

from ringlens.llm.catalog import CATALOG
from ringlens.llm.html_text import extract_text, visible_text

CASES = {
    "blocks": ("<h1>A  b</h1><p>one<p>two <b>x</b>y<div>in</div>out", "A b\n\none\n\ntwo xy\n\nin\nout"),
    "breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "hidden": ("<head><title>T</title><style>.x{display:none}</style></head>a<p class=x>no</p><p hidden>no</p><i style='display: none'>no</i>b<script>var t='</p>'</script>", "ab"),
    "visibility": ("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b></div>", "yes"),
    "lists": ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>", "- a\n- b\n  3. c\n  4. d\n- e"),
    "table": ("<table><tr><th>A<th>Bee<tr><td>long cell<td>1<tr><td colspan=2>w<td>z</table>", "A          Bee\nlong cell  1\nw               z"),
    "nested table": ("<table><tr><td><table><tr><td>a<td>b</table><td>c</table>", "a  b  c"),
    "pre": ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
    "entities": ("a &amp; b &lt;c&gt; &#233;", "a & b <c> é"),
    "misnested": ("<p><b>one<p>two</b> three", "one\n\ntwo three"),
    "stray ends": ("</p></div>a</li></table>b", "ab"),
    "details": ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    "inline": ("a <span> b </span> c<!-- x -->d", "a b cd"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
    "cell outside a table": ("<td>a<td>b<li>c", "a\nb\n- c"),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    html, text = CASES[name]
    assert visible_text(html) == text


def test_depth_and_length():
    assert visible_text("<div>" * 30_000 + "x") == "x"
    assert visible_text("<table><tr><td>" * 300 + "x") == "x"
    assert visible_text("<p>word " * 20_000).count("word") == 20_000
    wide = visible_text("<table>" + "<tr><td>" + "y" * 100_000 + "<td>z" * 2 + "<tr><td>a<td>b" * 3 + "</table>")
    assert wide.count("y") == 100_000 and len(wide) < 101_000


@pytest.mark.parametrize(
    "html",
    ["<div>" * 100_000 + "x", "<b>" * 100_000 + "x", "<b><div>" * 50_000 + "x" + "</b></div>" * 50_000, "<p><i>" * 50_000 + "x" + "</i>" * 50_000,
     "<table><tr><td>" * 30_000 + "x", "<div>" * 50_000 + "x" + "</span></li></b>" * 50_000],
    ids=["div", "b", "crossed", "ended", "tables", "stray"],
)
def test_time_does_not_depend_on_the_depth(html):
    began = time.monotonic()
    assert visible_text(html) == "x"
    assert time.monotonic() - began < 10


def test_formatting_that_ends_inside_its_blocks():
    assert visible_text("<b>a<div>b</b>c</div>d") == "a\nbc\nd"
    assert visible_text("<table><tr><td><i>a<div>b</i></div>c<td>d</table>e") == "a  d\nb\nc\n\ne"


def test_query_keeps_every_shown_word(spark, sf):
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect()}
    rows = CATALOG["op10_html_text"].run(spark, sf).collect()
    assert len(rows) == len(pages)
    for row in rows:
        html = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>|<style.*?</style>", " ", pages[row.page_id])
        body = re.sub(r"<[^>]*>", " ", html).replace("&quot;", '"').replace("&copy;", "©").replace("&middot;", "·").replace("&amp;", "&")
        shown = re.sub(r"(?m)^\s*(- |\d+\. )", "", row.text)
        assert "".join(shown.split()) == "".join(body.split())


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, id int"
    rows = [(1, "u", "<p>a", "x", 1), (1, "u", "<p>a", "x", 1), (None, None, None, None, None), (2, None, "", None, None), (3, None, "<", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.page_id or -1), r.text) for r in extract_text(df).collect())
    assert got == [(-1, ""), (1, "a"), (1, "a"), (2, ""), (3, "<")]
    assert extract_text(df.limit(0)).collect() == []
