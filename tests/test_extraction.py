import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import markup as mk
from reviewloom.functions import payloads as pl
from reviewloom.functions import review_text as rt

VENDOR_PAGE = """
<html><head><title>Test Vendor Page</title></head><body>
  <h1 class="vendor-name">Test Venue</h1><div class="starting-price">From $2,500</div>
  <section class="packages">
    <div class="package-item"><h3 class="package-name">Basic Package</h3><span class="package-price">$1,500</span>
      <p class="package-description">Basic package description</p></div>
    <div class="package-item"><h3 class="package-name">Premium Package</h3><span class="package-price">$3,500</span>
      <p class="package-description">Premium package description</p></div>
  </section></body></html>"""


def frame(spark, name, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id INT, {name} STRING")


def test_vendor_page(spark):
    from reviewloom.functions.scalars import parse_price

    page = frame(spark, "html", VENDOR_PAGE)
    row = page.select(mk.vendor_name("html").alias("n"), parse_price(mk.starting_price_text("html")).alias("p")).first()
    assert (row["n"], row["p"]) == ("Test Venue", 2500.0)
    assert [tuple(r)[1:] for r in mk.package_rows(page, ["id"]).orderBy("package_number").collect()] == [
        (1, "Basic Package", "$1,500", "Basic package description"), (2, "Premium Package", "$3,500", "Premium package description")]


def test_json_ld(spark):
    block = {"@type": "ItemList", "itemListElement": [
        {"item": {"name": "Ann", "aggregateRating": {"ratingValue": "4.5", "reviewCount": "12"}, "priceRange": "$500-$2,000", "@id": "u1", "url": "u2"}},
        {"item": {"name": "B"}}, {"other": 1}, {"item": {"name": "Cy", "url": "u3"}}]}
    html = f'<script type="application/ld+json">{json.dumps(block)}</script><script type="application/ld+json">{{bad</script>'
    got = [tuple(r) for r in pl.json_ld_vendors(frame(spark, "html", html, "<p>none</p>"), ["id"]).select(
        "name", "star_rating", "review_count", "source_url", "starting_price_min", "starting_price_avg").collect()]
    assert got == [("Ann", 4.5, 12, "u1", 500.0, 1250.0), ("Cy", 0.0, 0, "u3", None, None)]


@pytest.mark.parametrize("phones,want", [
    ([("1", "FAX"), ("2", "PRIMARY"), ("3", "CELL")], "2"), ([("1", "FAX"), ("3", "CELL")], "3"), ([("", "PRIMARY"), ("4", "FAX")], "4"), ([], "single"), (None, "single"),
])
def test_phone(spark, phones, want):
    df = spark.createDataFrame([(phones, "single")], "p ARRAY<STRUCT<number: STRING, type: STRING>>, s STRING")
    assert df.select(pl.pick_phone("p", "s").alias("x")).first()["x"] == want


def test_detail_prefers_the_named_raw_record(spark):
    raw = {"name": "Raw", "pricing": {"noSeason": {"min": {"value": 10}, "average": {"value": 20}}}, "social": {"facebookUrl": "f"},
           "deals": {"items": [{"description": "d" * 300}, {"description": ""}]}}
    plain = {"name": "Plain", "startingPriceRange": "$100-$300", "stars": 4.5, "awards": [{"name": "best"}]}
    states = [{"vendor": {"vendorRaw": raw, "vendor": plain}}, {"vendor": {"vendorRaw": {"name": ""}, "vendor": plain}}, {"other": 1}]
    df = frame(spark, "payload", *[json.dumps(s) for s in states])
    got = {r["id"]: r for r in pl.detail_vendors(df, "payload", "id").collect()}
    assert (got[0]["name"], got[0]["starting_price_min"], got[0]["facebook_url"], got[0]["deal_count"]) == ("Raw", 10.0, "f", 2)
    assert [len(d) for d in got[0]["deal_descriptions"]] == [300] and got[0]["star_rating"] == 4.5
    assert (got[1]["name"], got[1]["starting_price_min"], got[1]["starting_price_avg"]) == ("Plain", 100.0, 200.0)
    assert got[1]["awards"][0]["name"] == "best"
    assert got[2]["scrape_success"] is False


def test_mean_rating_half_even(spark):
    schema = "r ARRAY<STRUCT<value: DOUBLE, name: STRING>>"
    df = spark.createDataFrame([([(4.0, "a"), (4.5, "b")],), ([(5.0, "a"), (0.0, "b"), (None, "c")],), ([],), (None,), ([(4.0, "a"), (4.7, "b")],)], schema)
    assert [r["x"] for r in df.select(pl.mean_rating("r").alias("x")).collect()] == [4.2, 5.0, None, None, 4.4]


def test_mixed_lists(one):
    assert one(pl.mixed_names, '[{"name":"a"},"b",{"x":1}]') == ["a", "b", ""]


BLOB = "Ann B.Rating: 5•Feed•Jul 13, 2026Wonderful evening, everybody danced all night.Mary Ann C. Rating: 4•Feed•Aug 1, 2025Very good music and a friendly team overall••"


def test_split_reviews(spark):
    df = frame(spark, "text", BLOB, "y" * 81, "z" * 80, "Joe K. wrote a long enough single review without header, Rating: 3.5, which is kept as one review.")
    got = {(r["id"], r["position"]): r for r in rt.split_reviews(df, ["id"]).collect()}
    assert set(got) == {(0, 0), (0, 1), (1, 0), (3, 0)}
    a, c = got[0, 0], got[0, 1]
    assert (a["reviewer"], a["rating"], a["review_date"]) == ("Ann B", 5.0, dt.date(2026, 7, 13))
    assert a["body"] == "•Feed•Jul 13, 2026Wonderful evening, everybody danced all night."
    assert (c["reviewer"], c["rating"]) == ("Mary Ann C", 4.0) and c["body"].endswith("team overall")
    assert got[1, 0]["reviewer"] == "Anonymous" and (got[3, 0]["reviewer"], got[3, 0]["rating"]) == ("Joe K", 3.5)


def test_single_block(spark):
    df = frame(spark, "block", "Ann B. Rating: 4.5•Feed•Jul 13, 2026• A truly lovely evening with great music.", "Ann B. Rating: 5 x 2026 short")
    rows = df.select(*rt.block_columns("block")).collect()
    assert tuple(rows[0]) == ("Ann B", 4.5, dt.date(2026, 7, 13), "A truly lovely evening with great music.")
    assert rows[1]["review_text"].startswith("Ann B.")  # cleaned text too short, the original is kept


def test_next_data_first_record_wins(spark):
    state = {"props": {"pageProps": {"searchResults": {"vendors": [{"id": "1", "name": "A", "startingPriceCents": 150000}]},
             "vendorSearchData": {"vendorSearch": {"vendors": [{"id": "1", "name": "late"}, {"slug": "s", "name": "B"}]}}, "adjacentVendors": [{"vendorId": "v", "name": ""}]}}}
    got = {r["vendor_id"]: (r["name"], r["starting_price_min"], r["scrape_success"]) for r in pl.next_data_vendors(frame(spark, "payload", json.dumps(state)), ["id"]).collect()}
    assert got == {"1": ("A", 1500.0, True), "s": ("B", None, True), "v": ("", None, False)}


def test_variant_profile(spark):
    doc = {"a": {"reviewCount": 3, "list": [{"rating": "x"}, {"ignored": 1}]}, "b": None}
    got = {r["path"]: r["type"] for r in pl.variant_paths(frame(spark, "payload", json.dumps(doc), "{bad"), words=["review", "rating"]).collect()}
    assert got == {"$.a.reviewCount": "BIGINT", "$.a.list[0].rating": "STRING"}


def test_variant_profile_goes_to_the_bottom(spark):
    deep = {"rating": 1}
    for level in range(40):
        deep = {"x": deep} if level % 2 else {"y": [0, 1, deep]}
    doc = {"a": [{"x": 1}, {"rating": 2}], "deep": deep, "review": None, "odd key.": {"rating": []}}
    df = frame(spark, "payload", json.dumps(doc), json.dumps(doc), "[{\"rating\":1},{\"rating\":\"s\"}]", "7", "", None, "{bad")
    got = {(r["path"], r["type"]): r["n"] for r in pl.variant_paths(df, words=["rating", "review"]).collect()}
    far = "$.deep" + ".x.y[2]" * 20 + ".rating"
    assert got == {("$.a[1].rating", "BIGINT"): 2, (far, "BIGINT"): 2, ("$.review", "VOID"): 2, ("$.odd key..rating", "ARRAY"): 2, ("$[0].rating", "BIGINT"): 1, ("$[1].rating", "STRING"): 1}
    starred = {(r["path"], r["type"]): r["n"] for r in pl.variant_paths(df, words=["rating"], indexed=False).collect()}
    assert starred["$.a[*].rating", "BIGINT"] == 2 and starred["$[*].rating", "STRING"] == 1
    assert pl.variant_paths(frame(spark, "payload", "{bad", None)).count() == 0


def test_page_type(spark):
    df = spark.createDataFrame([
        ("https://m/marketplace/ann-dj-austin--123?x", ""), ("https://m/marketplace/djs-austin", ""), ("https://m/marketplace/a/b", "<p>"),
        ("https://m/x", '<div class="vendor-card a">1</div><div class="vendor-card b">2</div>'), ("https://m/x", '<h1 class="vendor-name">V</h1>')], "u STRING, h STRING")
    assert [r["x"] for r in df.select(mk.page_type("u", "h").alias("x")).collect()] == ["vendor", "marketplace", "unknown", "marketplace", "vendor"]


def test_unified_vendor(spark):
    df = spark.createDataFrame([("m2", "", "sl", "N", "$2,400.00", "", 0.0, 4.0)], "source STRING, vendor_id STRING, slug STRING, name STRING, starting_price STRING, category STRING, star_rating DOUBLE, rating DOUBLE")
    row = pl.unified_vendor(df, {"m2": ["vendor_id", "slug"]}, "photographers", 7).first()
    assert (row["source_vendor_id"], row["starting_price_min"], row["category"], row["star_rating"], row["phone"], row["scrape_run_id"]) == ("sl", 2400.0, "photographers", 4.0, "", 7)


def test_visible_text_and_links(spark):
    html = '<a href="/p">See <b>Packages</b></a><script>var a = "$1";</script><a href="">plan</a><p>Cost: $1,200.50 and $ 900</p>'
    row = frame(spark, "html", html).select(
        mk.visible_text("html").alias("t"), mk.package_links("html").alias("l"), mk.dollar_amounts(mk.visible_text("html")).alias("d")).first()
    assert row["t"] == "See Packages plan Cost: $1,200.50 and $ 900"
    assert [(x["href"], x["text"]) for x in row["l"]] == [("/p", "See Packages")] and row["d"] == ["$1,200.50", "$ 900"]


def test_nothing_is_cut_unless_asked(spark):
    long = "x" * 6000
    html = "".join(f'<p class="package-name">${i} {long}</p><a href="/p{i}">plan</a>' for i in range(40)) + f'<script type="application/json">{{"nItems":1,"v":"{long}"}}</script>'
    row = frame(spark, "html", html).select(
        mk.dollar_amounts("html").alias("d"), mk.card_texts("html").alias("c"), mk.package_links("html").alias("l"), mk.listing_json_previews("html").alias("j")).first()
    assert [len(row[k]) for k in "dcl"] == [40, 40, 40] and row["c"][0] == f"$0 {long}" and len(row["j"][0]) > 6000
    pages = frame(spark, "html", "".join(f'<a href="https://m.test/api/{long}{i}"><div class="class{i}">' for i in range(30)))
    assert mk.endpoint_urls(pages).count() == 30 and mk.class_frequency(pages).count() == 30
    df = spark.createDataFrame([("m2", "1", "N", long)], "source STRING, vendor_id STRING, name STRING, description STRING")
    assert pl.unified_vendor(df, {"m2": ["vendor_id"]}, "c", 7).first()["description"] == long


def _parts(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_pages_of_a_small_table_are_read_by_many_tasks(spark):
    from reviewloom.catalog import extraction as ex

    sf = "/root/testdata/sf0.001"
    for pages in (ex._nested, ex._shop, ex._next, ex._detail, ex._ld_pages):
        assert _parts(pages(spark, sf)) > 1
