from __future__ import annotations

import pytest

from ledgerlane.llm.html_render import render, rendered

CASES = {
    "implied ends": ("<p>one<p>two<div>three</div>", "one\n\ntwo\n\nthree"),
    "head is unseen": ("<html><head><title>t</title><style>p{}</style><body>seen", "seen"),
    "implied body": ("<head><meta charset=utf-8><title>t</title><p>seen", "seen"),
    "scripts": ("a<script>if (1 < 2) '</p>'</script>b<!-- <p>no --><noscript>c</noscript>", "abc"),
    "blanks": ("<p> a \n <b> b</b>  <i>c </i>d</p>", "a b c d"),
    "break": ("a<br>b<br/><br>c", "a\nb\n\nc"),
    "entities": ("<p>&lt;a&gt; &amp;amp; &eacute;&#8364;", "<a> &amp; é€"),
    "list": ("<ul><li>a<li>b<ol start=9><li>c<li>d</ol><li>e</ul>z", "- a\n- b\n  9. c\n  10. d\n- e\n\nz"),
    "lists of paragraphs": ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\n  b"),
    "table": ("<table><tr><th>n<th>name<tr><td>10<td>x<tr><td>7<td>longer</table>", "n   name\n10  x\n7   longer"),
    "spanned": ("<table><tr><td colspan=2>ab</td><td>c</tr><tr><td>1<td>22<td>3</table>", "ab     c\n1  22  3"),
    "stray cells": ("<td>a<td>b", "a  b"),
    "lines in cells": ("<table><tr><td>a<br>bb<td>c</table>", "a   c\nbb"),
    "nested tables": ("<table><tr><td>x<table><tr><td>1<td>2</table><td>y</table>", "x     y\n\n1  2"),
    "caption": ("<table><caption>title</caption><tr><td>a</table>", "title\na"),
    "hidden": ("<p hidden>a</p><p style='color:red; display : none'>b<p style=visibility:hidden>c<p>d", "d"),
    "hidden by rule": ("<style>.x, p#y {display:none} div.z{color:red}</style><b class='w x'>a</b><p id=y>b<div class=z>c", "c"),
    "details": ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    "dialog": ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    "pre": ("<pre>\n a  b\n\n  c</pre>d", " a  b\n\n  c\n\nd"),
    "quote": ("a<blockquote>b<br>c</blockquote>d", "a\n\n  b\n  c\n\nd"),
    "definitions": ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
    "options": ("<select><option>a<option>b</select><input value=v><input type=hidden value=w>", "a\nb\nv"),
    "headings": ("<h1>a</h1>b<h2>c</h2>d", "a\n\nb\n\nc\n\nd"),
    "end tags without start": ("a</b></div></ul>b</p>c", "ab\n\nc"),
    "misnested": ("<b><i>a</b>b</i>c", "abc"),
    "quotes in attributes": ("<a title='x > y' href=\"<b>\">t</a>", "t"),
    "open at the end": ("<div><p>a<b>b <a href='x", "ab"),
    "nothing": ("", ""), "null": (None, ""), "no tags": ("a & b < c", "a & b < c"), "only tags": ("<p></p><ul><li></ul>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_render(name):
    page, text = CASES[name]
    assert render(page) == text


def test_deep_and_long_pages():
    assert render("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert render("<ul><li>" * 300 + "x").endswith("- x")
    assert render("<p>word " * 50_000).count("word") == 50_000
    assert render("<" * 5000) == "<" * 5000


def test_wide_cells_do_not_pad_others():
    page = "<table><tr><td>" + "x" * 5000 + "<td>a" + "<tr><td>b<td>c" * 500 + "</table>"
    assert len(render(page)) < 12_000


def test_rows(spark):
    rows = [(1, "u", "<p>a<p>b", 1), (1, "u", "<p>a<p>b", 1), (2, None, None, 1), (3, "w", "", 1), (None, "z", "x", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = sorted(map(str, (tuple(row) for row in rendered(frame).collect())))
    want = [(1, "u", "a\n\nb", 3, 4)] * 2 + [(2, None, "", 0, 0), (3, "w", "", 0, 0), (None, "z", "x", 1, 1)]
    assert found == sorted(map(str, want))
    assert rendered(frame.limit(0)).collect() == []


def test_all_visible_words_of_the_sample(given):
    """Words of paragraphs are all there, in order; those of scripts and styles are not."""
    import html
    import re

    for page in given("pages").limit(30).collect():
        source = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->", " ", page["html"])
        want = html.unescape(re.sub(r"</?(b|i|em|a|span)\b[^>]*>", "", source))
        want = re.sub(r"<[^<>]*>", " ", re.sub(r"</?(b|i|em|a|span)\b[^>]*>", "", source))
        words = html.unescape(want).split()
        found = [x for x in render(page["html"]).split() if x != "-"]
        assert [w for w in words if w != "-"] == found
