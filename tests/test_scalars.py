import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import scalars as sc

PRICES = [
    ("$1500", 1500.0), ("$2000", 2000.0), ("$1,500", 1500.0), ("$10,000", 10000.0), ("$100,000", 100000.0),
    ("$1,500.50", 1500.5), ("$2000.99", 2000.99), ("Starting at $1,500", 1500.0), ("From $2,000", 2000.0),
    ("Starting price $3000", 3000.0), ("", None), ("TBD", None), ("Contact for pricing", None),
    ("Price upon request", None), ("No pricing available", None), (None, None),
]


def test_parse_price(spark):
    df = spark.createDataFrame(PRICES, "t STRING, want DOUBLE")
    for row in df.withColumn("got", sc.parse_price("t")).collect():
        assert row["got"] == row["want"], row


@pytest.mark.parametrize("text,low,avg", [
    ("$500-$2,000", 500.0, 1250.0), ("$1,200", 1200.0, 1200.0), ("", None, None), ("$5", None, None), (None, None, None),
    ("100 to 200 to 600", 100.0, 300.0),
])
def test_price_range(one, text, low, avg):
    assert one(sc.price_range_min, text) == low
    assert one(sc.price_range_avg, text) == avg


@pytest.mark.parametrize("text,want", [
    ("$2,400.00", 2400.0), ("$2400", 2400.0), ("$500-$900", None), ("", None), ("12d", None), ("call us", None), ("1e3", 1000.0),
])
def test_money_to_number(one, text, want):
    assert one(sc.money_to_number, text) == want


@pytest.mark.parametrize("text,want,named", [
    ("Jul 13, 2026", dt.date(2026, 7, 13), dt.date(2026, 7, 13)), ("July 13, 2026", None, None),
    ("x 2026-07-13 y", dt.date(2026, 7, 13), None), ("Feb 31, 2024", None, None), ("", None, None),
    ("July 13, 2026 then 2025-01-02", dt.date(2025, 1, 2), None),
])
def test_parse_date(one, text, want, named):
    assert one(sc.parse_date, text) == want
    assert one(lambda c: sc.parse_date(c, iso=False), text) == named


@pytest.mark.parametrize("text,want", [("2024-05-06T07:08:09Z", dt.date(2024, 5, 6)), ("", None), ("2024", None), ("bad", None)])
def test_iso_date(one, text, want):
    assert one(sc.iso_date, text) == want


@pytest.mark.parametrize("cat,avg,low,want", [
    ("DJ", 1199.0, None, "budget"), ("DJ", 1200.0, None, "mid"), ("DJ", 2500.0, 1.0, "premium"), ("COORD", None, 1499.0, "budget"),
    ("PHOTOBOOTH", 0.0, 900.0, "premium"), ("OTHER", None, 1300.0, "mid"), ("DJ", None, None, "unknown"), ("DJ", None, 0.0, "budget"),
])
def test_price_tier(spark, cat, avg, low, want):
    df = spark.createDataFrame([(cat, avg, low)], "c STRING, a DOUBLE, l DOUBLE")
    assert df.select(sc.price_tier("c", "a", "l").alias("t")).first()["t"] == want


def test_first_filled_and_zero(spark):
    df = spark.createDataFrame([("", None, "x", 0, 5), (None, "", "", 0, 0)], "a STRING, b STRING, c STRING, n INT, m INT")
    rows = df.select(sc.first_filled("a", "b", "c").alias("t"), sc.first_non_zero("n", "m").alias("n")).collect()
    assert [tuple(r) for r in rows] == [("x", 5), ("", 0)]


def test_starting_price_order(spark):
    schema = "c DOUBLE, d DOUBLE, p ARRAY<STRUCT<minCents: DOUBLE>>"
    df = spark.createDataFrame([(1000.0, 5.0, []), (0.0, 5.0, []), (None, 0.0, [(0.0,), (250.0,)]), (None, None, None)], schema)
    assert [r["x"] for r in df.select(sc.starting_price("c", "d", "p").alias("x")).collect()] == [10.0, 5.0, 2.5, None]


def test_labels(one):
    assert one(sc.percent_text, 12.5) == "12%" and one(sc.percent_text, 13.5) == "14%"
    assert one(sc.compact_number, 1250) == "1.3K" and one(sc.compact_number, 3400000) == "3.4M" and one(sc.compact_number, 7) == "7"
    assert one(sc.slugify, "Ann & Bob's DJs, Inc.") == "ann-bobs-djs-inc"
    assert one(sc.display_category, "wedding-djs") == "djs"
    assert one(sc.category_code, "wedding-planners") == "COORD" and one(sc.category_code, "cakes") == "OTHER"
    assert one(lambda c: sc.count_occurrences(c, "aa"), "aaaa a aa") == 3


def test_source_id_rules(spark):
    df = spark.createDataFrame([("m1", "", "s", "n"), ("m2", "v", "s", "n"), ("other", "", "s", "n")],
                               "source STRING, vendor_id STRING, slug STRING, name STRING")
    rules = {"m1": ["vendor_id", "slug"], "m2": ["slug"]}
    assert [r["x"] for r in df.select(sc.source_vendor_id("source", rules).alias("x")).collect()] == ["s", "s", "n"]


@pytest.mark.parametrize("price,avg,want", [(84.0, 100.0, "below"), (85.0, 100.0, "at"), (115.1, 100.0, "above"), (0.0, 1.0, "no price"), (1.0, 0.0, "no data")])
def test_market_position(spark, price, avg, want):
    df = spark.createDataFrame([(price, avg)], "p DOUBLE, a DOUBLE")
    assert df.select(sc.market_position("p", "a").alias("x")).first()["x"] == want


def test_sql_functions(spark):
    from reviewloom.functions.sql_functions import register

    register(spark)
    row = spark.sql("""SELECT review_topics('The DJ was LATE') AS t, review_sentiment('amazing', 5D) AS s, review_sentiment('awful', NULL) AS n,
      vendor_reply('Hi Ann, thank you') AS r, parse_price('From $1,500') AS p, price_tier('COORD', NULL, 1400D) AS c,
      parse_review_date('July 13, 2026, Aug 3, 2025') AS d""").first()
    assert row["t"] == ["punctuality"] and row["s"] == "positive" and row["n"] == "negative" and row["r"] is True
    assert row["p"] == 1500.0 and row["c"] == "budget" and row["d"] is None
