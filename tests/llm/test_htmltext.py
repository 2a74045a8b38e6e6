import pytest
from pyspark.sql import functions as F

from histkit.llm.htmltext import extract, visible_text

CASES = {
    "<p>One<p>Two <b>bo</b>ld": "One\n\nTwo bold",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "  a \n b\t<i> c</i>d ": "a b cd",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>z": "- a\n- b\n  3. x\n  4. y\n- c\n\nz",
    "<table><tr><th>Name<th>Qty<tr><td>Apple<td>12<tr><td colspan=2>wide cell<tr><td>文字<td>1</table>": "Name  | Qty\nApple | 12\nwide cell\n文字  | 1",
    "<head><title>T</title><style>p{}</style></head><p>x<script>var a='</p>';</script>y": "xy",
    "<div hidden>no</div><div style='Display : none'>no</div><p>yes<template>no</template>": "yes",
    "<pre>  a\n   b</pre>c": "  a\n   b\n\nc",
    "&lt;b&gt; &amp; &copy; &am": "<b> & © &am",
    "<blockquote>q<p>r</blockquote>": "> q\n\n> r",
    "x<a href='y'": "x",
    "<p>a</div></span>b": "ab",
    "<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>": "in | ner | out",
    "<td>stray": "stray",
    "": "",
    "<!-- c --><!DOCTYPE html>": "",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\nd\nu",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert visible_text(html) == CASES[html]


KEPT = {
    "<table><tr><form><td>a<td>b</td></form></tr></table>": "a | b",
    "<table><form><tr><td>a</td></tr></form><tr><td>b</table>": "a\nb",
    "<table><tr>te<b>x</b>t<td>a</td></tr></table>z": "text\na\n\nz",
    "<table><tbody>one<div>two</div><td>a<td>b<tr><td>c<td>d</table>": "one\ntwo\na | b\nc | d",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>": "a | b\n  | c\nd | e",
    "<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d</table>": "a | b\n  | c\nd",
    "<table><colgroup>w<col><tr><td>a</table>": "w\na",
    "x<svg/>y<math/>z": "xyz",
    "<svg><defs/><text>a</text><text>b</text><title>no</title><defs><text>no</text></defs></svg>c": "a\nb\nc",
    "<svg><defs><g><p>out</p>side": "out\n\nside",
    "<math><mi>x</mi><mo>=</mo><mn/><mn>1</mn><annotation>no</annotation></math> y": "x=1 y",
    "<textarea>a\n b</textarea>c": "a\n b\nc",
    "<select><option>a<option selected>b</select> c": "b c",
    "<select multiple><option>a<option>b</select>c": "a b c",
    "<select><option disabled>a<option>b<p>c": "b\n\nc",
    "<head><title>T</title>text": "text",
    "<html><head><meta charset=x><a href=y>link</a> more": "link more",
    "<body>a<head>b</head>c": "abc",
}


@pytest.mark.parametrize("html", KEPT)
def test_shown_words_stay(html):
    assert visible_text(html) == KEPT[html]


def test_deep_tables_and_foreign_elements():
    assert visible_text("<table><tr><td>a" + "<tr><b>" * 3000 + "<td>x").split() == ["a", "x"]
    assert visible_text("<svg><g>" * 3000 + "x") == "x"


def test_deep_and_long_pages():
    assert visible_text("<div>" * 30_000 + "x") == "x"
    assert visible_text("<ul><li>" * 300 + "x").endswith("x")
    assert visible_text("<table><tr><td>" * 200 + "x").endswith("x")
    assert len(visible_text("<p>" + "word " * 200_000)) == 999_999


def test_every_visible_word_stays(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = extract(pages.withColumn("text", F.lit(1))).collect()
    import re
    from html import unescape

    for r in rows:
        body = re.sub(r"(?s)<(head|script|style)\b.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>", "", r.html)
        body = re.sub(r"<[^<>]*\Z", "", body)
        words = unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert re.sub(r"^- ", "", r.text, flags=re.M).split() == words


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", ""), (1, None, None)], "page_id long, url string, html string")
    assert [r.text for r in extract(df).collect()] == ["", "", ""]
    assert extract(df.where("false")).collect() == []
