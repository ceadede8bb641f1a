import pytest
from pyspark.sql import functions as F

from reviewloom.functions import elements as el
from reviewloom.functions import markup as mk

NESTED = """<html><head><title>A &amp; B</title><script>var x = "<div class='package-item'>no</div>";</script></head><body>
<div class="vendor-name"><div>Test</div><div>Venue &amp; Sons</div></div>
<div data-testid='starting-price'>From <span>$2</span>,500</div>
<!-- <div class="package-item">no</div> -->
<div class="package-item big"><div><div class="package-name">In <b>and</b> out</div></div>
  <div class="package-price"><div>$1</div></div><div class="package-description"><ul><li>caf&eacute;<li>&lt;tea&gt; &#8364;5</ul></div></div>
<div class="package-item"><h3 class="package-name"></h3><p class="package-price">$3<p class="package-description">loose</div>
</body></html>"""


def test_nested_items_and_references():
    facts = el.read_facts(el.parse_page(NESTED), mk.VENDOR_MARKERS, ["text", "title", "name", "price", "packages", "cards", "links"])
    assert (facts["title"], facts["name"], facts["price"]) == ("A & B", "Test Venue & Sons", "From $2,500")
    assert facts["packages"] == [
        {"package_number": 1, "name": "In and out", "price": "$1", "description": "café <tea> €5"},
        {"package_number": 2, "name": "", "price": "$3", "description": "loose"}]
    assert facts["cards"] == ["In and out $1 café <tea> €5", "In and out", "$1", "café <tea> €5", "$3 loose", "$3", "loose"]
    assert "no" not in facts["text"].split()


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("a<b>b</b>c <i>d", "abc d"), ("a<br>b<p>c", "a b c"), ("x</div>y", "x y"), ("<p>one<p>two", "one two"),
    ("a &nbsp; b&notanentity; &#x41;&#65;", "a \xa0 b¬anentity; AA"), ("<style>p{}</style>t<template>no</template>", "t"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("<![if IE]>x<![endif]>", "x"),
    ("<DIV CLASS=Q>up</DIV>", "up"),
])
def test_text(html, text):
    assert el.parse_page(html).text() == text


def test_ends():
    page = el.parse_page('<ul><li class="a">1<ul><li class="b">2</ul></li><li class="c">3</ul><table><tr><td class="d">4<td class="e">5<tr><td class="f">6</table><i class="g">7</p>8')
    assert {m: page.text(next(page.marked(m))) for m in "abcdefg"} == {"a": "1 2", "b": "2", "c": "3", "d": "4", "e": "5", "f": "6", "g": "7 8"}
    assert page.first_text(["none", "b"]) == "2" and page.first_text(["b"], within=next(page.marked("a"))) == "2" and page.first_text(["c"], within=next(page.marked("a"))) == ""


def test_deep_and_long_pages():
    page = el.parse_page("<div>" * 20_000 + '<p class="x">' + "y " * 100_000 + "</p>" + "</div>" * 20_000)
    assert len(page.text(next(page.marked("x")))) == 199_999


def test_columns(spark):
    df = spark.createDataFrame([(1, NESTED), (2, None), (3, "<p>none")], "id INT, html STRING")
    rows = {r["id"]: r for r in mk.vendor_pages(df, ["id"]).collect()}
    assert rows[1]["name"] == "Test Venue & Sons" and len(rows[1]["packages"]) == 2 and rows[2]["cards"] == [] and rows[3]["name"] == ""
    got = df.select("id", mk.visible_text("html").alias("t"), mk.vendor_name("html").alias("n"), mk.starting_price_text("html").alias("p"), mk.card_texts("html", max_len=5).alias("c")).collect()
    assert [(r["n"], r["p"], r["c"]) for r in got] == [("Test Venue & Sons", "From $2,500", ["$1", "$3"]), ("", "", []), ("", "", [])] and got[2]["t"] == "none"
    assert mk.package_rows(df, ["id"]).agg(F.max("package_number")).first()[0] == 2
    plan = mk.vendor_pages(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_first_text(spark):
    df = spark.createDataFrame([(None, " ", " a "), ("x", "y", "z"), (None, None, None)], "a STRING, b STRING, c STRING")
    assert [r[0] for r in df.select(mk.first_text("a", "b", "c")).collect()] == ["a", "x", ""]
