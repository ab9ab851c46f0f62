"""Main text of pages: the query against the pages' own article element, odd markup in linear time."""

import html
import re
import time

import pytest

from tallyseq.llm import html_main, queries

DIR = "/root/testdata/sf0.001"
BLOCKS = "p h1 h2 h3 h4 h5 h6 div section ul ol li table tr td th blockquote pre figure figcaption article"


def article_text(page):
    """What stands between the article's own tags, cut at block tags."""
    inside = re.search(r"<article\b[^>]*>(.*?)</article>", page or "", re.DOTALL)
    if not inside:
        return ""
    text = re.sub(r"<!--.*?-->|<(script|style|form|nav|aside|header|footer)\b.*?</\1>", "", inside[1], flags=re.DOTALL)
    text = re.sub(rf"</?(?:{'|'.join(BLOCKS.split())})\b[^>]*>", "\0", text)
    text = re.sub(r"<br\b[^>]*>", " ", text)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in text.split("\0")]
    return "\n".join(filter(None, parts))


def test_query_equals_the_article_element(spark):
    found = queries.op6_html_extraction(spark, DIR).toPandas().set_index("page_id")
    pages = spark.read.parquet(f"{DIR}/pages.parquet").toPandas().set_index("page_id")
    assert set(found.index) == set(pages.index)
    for i, r in pages.iterrows():
        assert found.text[i] == article_text(r.html)
        assert found.n_chars[i] == len(found.text[i]) and found.url[i] == r.url


SHAPES = {
    "unmatched end tags": lambda n: "<div>" * n + "</x>" * n,
    "open tags and a quote": lambda n: "<b " * n + "'",
    "other inline end tags": lambda n: "<b>" * n + "</i>" * n,
    "items far below": lambda n: "<div>" * n + "<li>" * n,
    "quotes that never close": lambda n: "<a b='" * n,
    "cells": lambda n: "<td>" * n,
    "signs": lambda n: "</" * n + "<" * n,
    "letters in a tag": lambda n: "<div " + "a" * 13 * n + ">",
    "spaces in a tag": lambda n: "<div a" + " " * 13 * n + ">",
    "names in a tag": lambda n: "<div " + "a " * 6 * n + ">",
    "signs in a tag": lambda n: "<div " + "a=" * 6 * n + ">",
    "quotes in a tag": lambda n: "<div " + "a='' b=\"" * 2 * n + ">",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_parser_is_linear(shape):
    def seconds(n):
        page, best = SHAPES[shape](n), 1e9
        for _ in range(3):
            began = time.perf_counter()
            html_main.parse(page)
            best = min(best, time.perf_counter() - began)
        return best

    assert shape.endswith("in a tag") is False or seconds(80_000) < 1  # a tag of 1 MB
    assert seconds(80_000) < 16 * seconds(10_000) + 0.2  # eight times as long; the square would be 64 times


def test_tree_of_broken_markup():
    def shown(node):
        return "".join(c[0][0] if isinstance(c, list) else f"({c.tag} {shown(c)})" for c in node.children)

    tree = lambda page: shown(html_main.parse(page))
    assert tree("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == "(ul (li a)(li b(ul (li c))d))e"
    assert tree("<table><tr><td>a<td>b<tr><td>c</table>") == "(table (tr (td a)(td b))(tr (td c)))"
    assert tree("<div>a</div></div>b") == "(div a)b"
    assert tree("<p title='a>b'>c</p><!-- <p>x</p> -->d<script>if (a<b) {}</script>e") == "(p c)d(script )e"


def test_odd_pages(spark):
    page = "<html><body><nav><a href=x>Home</a></nav><article><h1>Title here</h1>" + "<p>Some words of the text, over and over.</p>" * 20_000 + "</article></body></html>"
    rows = spark.createDataFrame([(1, page, "x"), (1, page, "x"), (2, None, "y"), (None, "", None)], "page_id long, html string, text string")
    got = html_main.extract_pages(rows).collect()
    assert got[0].text == "Title here\n" + "\n".join(["Some words of the text, over and over."] * 20_000) and got[0] == got[1]
    assert [(r.text_input, r.text) for r in got[2:]] == [("y", ""), (None, "")]
    assert html_main.extract_pages(rows.limit(0)).count() == 0
