"""Queries of the extraction family.

The synthetic pages carry no listing data, so payload and markup queries wrap
the columns of a table into the payload and read them back: the check computes
the expected rows from the columns directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query, with_ctes
from reviewloom.functions import markup as mk
from reviewloom.functions import payloads as pl
from reviewloom.functions import review_text as rt
from reviewloom.session import spread

# ---- JSON-LD --------------------------------------------------------------


def _ld_pages(spark, sf):
    item = F.expr("""to_json(named_struct('@type', 'ItemList', 'itemListElement', array(
      named_struct('item', named_struct('name', p_name, 'aggregateRating', named_struct('ratingValue', CAST(p_size / 10 AS STRING), 'reviewCount', CAST(p_size AS STRING)),
        'priceRange', concat('$', p_size * 100, '-$9,999'), '@id', concat('https://x.test/', p_partkey), 'url', 'unused', 'description', p_type)),
      named_struct('item', named_struct('name', p_brand, 'aggregateRating', NULL, 'priceRange', NULL, '@id', NULL, 'url', concat('/', p_type), 'description', NULL)),
      named_struct('item', named_struct('name', 'x', 'aggregateRating', NULL, 'priceRange', NULL, '@id', NULL, 'url', NULL, 'description', NULL)))))""")
    offer = F.expr("""to_json(named_struct('@type', CASE WHEN p_size > 25 THEN 'Product' WHEN p_size > 10 THEN 'Service' ELSE 'Event' END,
      'name', p_name, 'offers', named_struct('price', p_retailprice), 'priceRange', p_brand))""")
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    state = F.when(F.col("p_size") > 30, F.lit('<script>window.__INITIAL_STATE__ = {"a": 1};</script>')).otherwise("")
    listing = F.when(F.col("p_size") > 40, F.concat(F.lit('<script type="application/json">{"nItems":'), "p_size", F.lit("}</script>"))).otherwise(
        F.lit('<script type="application/json">{"other":1}</script>')
    )
    html = F.concat(F.lit("<html>"), block(item), block(F.lit("{broken")), block(offer), state, listing, F.lit("</html>"))
    return b.pages_of(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("page_id"), html.alias("html"))


@query("b01_json_ld_vendors", """SELECT p_partkey AS page_id, 0 AS position, p_name AS name, p_size / 10e0 AS star_rating, CAST(p_size AS BIGINT) AS review_count,
    concat('https://x.test/', CAST(p_partkey AS VARCHAR)) AS source_url, p_type AS description,
    CASE WHEN p_size * 100 > 9999 THEN 9999e0 ELSE p_size * 100e0 END AS starting_price_min, (p_size * 100e0 + 9999) / 2 AS starting_price_avg FROM part
    UNION ALL SELECT p_partkey, 1, p_brand, 0, 0, concat('/', p_type), '', NULL, NULL FROM part""")
def b01(spark, sf):
    return pl.json_ld_vendors(_ld_pages(spark, sf), ["page_id"]).drop("starting_price_range")


@query("b02_json_ld_offers", """SELECT p_partkey AS page_id, CASE WHEN p_size > 25 THEN 'Product' ELSE 'Service' END AS type, p_name AS name, p_retailprice AS price,
    p_brand AS price_range FROM part WHERE p_size > 10""")
def b02(spark, sf):
    rows = pl.json_ld_offers(_ld_pages(spark, sf), ["page_id"])
    return rows.select("page_id", "type", "name", F.get_json_object("offers", "$.price").cast("double").alias("price"), "price_range")


@query("b03_structured_data_counts", """SELECT p_partkey AS page_id, CAST(3 AS BIGINT) AS json_ld_blocks, CAST(1 AS BIGINT) AS json_blocks, p_size > 30 AS has_initial_state,
    CASE WHEN p_size > 40 THEN concat('{"nItems":', CAST(p_size AS VARCHAR), '}') ELSE '' END AS preview FROM part""")
def b03(spark, sf):
    return _ld_pages(spark, sf).select(
        "page_id", *mk.structured_counts("html"), F.array_join(mk.listing_json_previews("html"), "|").alias("preview")
    )


# ---- listing and detail states -------------------------------------------


@query("b04_listing_vendors", with_ctes("""SELECT id, source_vendor_id AS vendor_id, name, city, state, coalesce(CAST(review_count AS BIGINT), 0) AS review_count,
    CAST(star_rating AS DOUBLE) AS star_rating,
    CASE WHEN source_url <> '' THEN source_url ELSE concat('https://m.test/', lower(replace(name, '#', '')), '-', CASE WHEN state <> '' THEN
      concat(lower(replace(city, ' ', '-')), '-', lower(state)) ELSE lower(replace(city, ' ', '-')) END, '-', left(CAST(id AS VARCHAR), 8)) END AS source_url
    FROM vendors""", vendors=b.VENDORS))
def b04(spark, sf):
    payload = F.expr("""to_json(named_struct('search', named_struct('total', 1, 'vendors', array(named_struct('id', CAST(id AS STRING), 'vendorId', source_vendor_id,
      'name', name, 'location', named_struct('city', city, 'state', state), 'reviewsCount', CASE WHEN id > 700 THEN review_count END,
      'reviewSummary', named_struct('count', review_count, 'overallRating', star_rating), 'stars', CASE WHEN id > 700 THEN star_rating ELSE 0 END,
      'siteUrls', CASE WHEN source_url <> '' THEN array(named_struct('uri', source_url)) END)))))""")
    pages = spread(b.vendors(spark, sf), "id").select("id", payload.alias("payload"))
    return pl.listing_vendors(pages, "payload", "https://m.test/", "id").select(
        "id", "vendor_id", "name", "city", "state", "review_count", "star_rating", "source_url"
    )


_DETAIL = """named_struct('id', CAST(id AS STRING), 'vendorId', source_vendor_id, 'name', {name},
  'phones', array(named_struct('number', '1', 'type', 'FAX'), named_struct('number', phone, 'type', CASE WHEN id > 500 THEN 'PRIMARY' ELSE 'CELL' END), named_struct('number', '3', 'type', 'CELL')),
  'phone', '9', 'emails', array(named_struct('address', email)), 'email', 'fallback@x.test', 'websiteUrl', website_url, 'displayWebsiteUrl', 'shown.test',
  'location', named_struct('city', '', 'state', state, 'address', named_struct('city', city)), 'serviceArea', source,
  'pricing', named_struct('noSeason', CASE WHEN star_rating > 3 THEN named_struct('min', named_struct('value', starting_price_min), 'average', named_struct('value', starting_price_avg)) END,
    'peak', named_struct('min', named_struct('value', id), 'average', named_struct('value', id + 1))),
  'startingPriceRange', concat('$', review_count + 100, '-$2,000'), 'reviewSummary', named_struct('count', 0, 'overallRating', star_rating), 'reviewsCount', review_count,
  'description', repeat(name, 300), 'adTier', 'GOLD',
  'deals', named_struct('items', array(named_struct('description', repeat('d', 250)), named_struct('description', ''), named_struct('description', category))),
  'socialMedia', array(named_struct('code', 'FBURL', 'value', 'f1'), named_struct('code', 'MY_FACEBOOK', 'value', category), named_struct('code', 'INSTAGRAM', 'value', state)),
  'awards', array(named_struct('name', source)), 'orgDetails', named_struct('startYear', id, 'totalMembers', 3))"""


def _detail(spark, sf):
    raw, plain = _DETAIL.format(name="CASE WHEN id > 300 THEN name ELSE '' END"), _DETAIL.format(name="concat('plain ', name)")
    payload = F.expr(f"to_json(named_struct('vendor', named_struct('vendorRaw', {raw}, 'vendor', {plain})))")
    return pl.detail_vendors(spread(b.vendors(spark, sf), "id").select("id", payload.alias("payload")), "payload", "id")


@query("b05_detail_vendors", with_ctes("""SELECT id, source_vendor_id AS vendor_id, CASE WHEN id > 300 THEN name ELSE concat('plain ', name) END AS name,
    coalesce(nullif(email, ''), 'fallback@x.test') AS email, coalesce(nullif(website_url, ''), 'shown.test') AS website_url, city, state, source AS service_area,
    coalesce(CAST(review_count AS BIGINT), 0) AS review_count, CAST(star_rating AS DOUBLE) AS star_rating, length(repeat(name, 300)) AS description_length,
    'GOLD' AS ad_tier, CAST(id AS INT) AS year_founded, true AS scrape_success FROM vendors""", vendors=b.VENDORS))
def b05(spark, sf):
    return _detail(spark, sf).select(
        "id", "vendor_id", "name", "email", "website_url", "city", "state", "service_area", "review_count", "star_rating",
        F.length("description").cast("bigint").alias("description_length"), "ad_tier", "year_founded", "scrape_success",
    )


@query("b06_two_names_for_one_fact", with_ctes("""SELECT id, coalesce(nullif(CAST(review_count AS BIGINT), 0), 7) AS review_count,
    coalesce(nullif(CAST(star_rating AS DOUBLE), 0), 1) AS star_rating FROM vendors""", vendors=b.VENDORS))
def b06(spark, sf):
    payload = F.expr("""to_json(named_struct('search', named_struct('vendors', array(named_struct('id', CAST(id AS STRING), 'name', name, 'reviewsCount', review_count,
      'stars', star_rating, 'reviewSummary', named_struct('count', 7, 'overallRating', 1.0))))))""")
    pages = spread(b.vendors(spark, sf), "id").select("id", payload.alias("payload"))
    return pl.listing_vendors(pages, "payload", "", "id").select("id", "review_count", "star_rating")


def _next(spark, sf):
    vendor = lambda vid, name: (
        f"named_struct('id', {vid}, 'slug', concat('s', p_partkey), 'name', {name}, 'city', p_brand, 'startingPriceCents', CASE WHEN p_size > 30 THEN p_size * 100 END, "
        "'startingPrice', CASE WHEN p_size > 20 THEN p_size * 2 END, 'prices', array(named_struct('minCents', 0), named_struct('minCents', p_size * 10)), "
        "'reviewCount', 0, 'reviewsCount', p_size, 'averageReviewsRate', p_size / 10, 'categories', array(named_struct('name', p_type)), "
        "'photos', array(named_struct('url', '1'), named_struct('url', '2'), named_struct('url', '3'), named_struct('url', '4'), named_struct('url', '5'), named_struct('url', '6')))"
    )
    payload = F.expr(f"""to_json(named_struct('props', named_struct('pageProps', named_struct(
      'searchResults', named_struct('vendors', CASE WHEN p_size > 5 THEN array({vendor("'a'", 'p_name')}, {vendor("'b'", 'p_brand')}) END),
      'vendorSearchData', named_struct('vendorSearch', named_struct('vendors', array({vendor("'b'", "'late'")}, {vendor("''", "'by slug'")}))),
      'adjacentVendors', array({vendor("'c'", 'p_type')}, {vendor("'a'", "'later'")})))))""")
    return b.pages_of(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("page_id"), payload.alias("payload"))


_NEXT_PRICE = "CASE WHEN p_size > 30 THEN p_size * 1e0 WHEN p_size > 20 THEN p_size * 2e0 ELSE p_size / 10e0 END"


@query("b07_next_data_vendors", f"""SELECT p_partkey AS page_id, vendor_id, name, {_NEXT_PRICE} AS starting_price_min, CAST(p_size AS BIGINT) AS review_count,
    p_type AS categories, '1,2,3,4,5,6' AS images FROM (
    SELECT *, 'a' AS vendor_id, CASE WHEN p_size > 5 THEN p_name ELSE 'later' END AS name FROM part
    UNION ALL SELECT *, 'b', CASE WHEN p_size > 5 THEN p_brand ELSE 'late' END FROM part
    UNION ALL SELECT *, concat('s', CAST(p_partkey AS VARCHAR)), 'by slug' FROM part UNION ALL SELECT *, 'c', p_type FROM part)""")
def b07(spark, sf):
    return pl.next_data_vendors(_next(spark, sf), ["page_id"]).select(
        "page_id", "vendor_id", "name", "starting_price_min", "review_count", b.joined_text("categories").alias("categories"),
        b.joined_text("images").alias("images"),
    )


@query("b07_next_data_first_path", """SELECT p_partkey AS page_id, vendor_id FROM (SELECT p_partkey, unnest(CASE WHEN p_size > 5 THEN ['a', 'b']
    ELSE ['b', concat('s', CAST(p_partkey AS VARCHAR))] END) AS vendor_id FROM part)""")
def b07b(spark, sf):
    return pl.next_data_vendors(_next(spark, sf), ["page_id"], first_path_only=True).select("page_id", "vendor_id")


@query("b08_starting_price", f"SELECT p_partkey, {_NEXT_PRICE} AS price FROM part")
def b08(spark, sf):
    from reviewloom.functions.scalars import starting_price

    prices = F.expr("array(named_struct('minCents', 0D), named_struct('minCents', p_size * 10D))")
    cents, dollars = F.expr("CASE WHEN p_size > 30 THEN p_size * 100 ELSE 0 END"), F.expr("CASE WHEN p_size > 20 THEN p_size * 2D ELSE 0D END")
    return b.table(spark, sf, "part").select("p_partkey", starting_price(cents, dollars, prices).alias("price"))


@query("b09_phone_pick", with_ctes("SELECT id, CASE WHEN phone <> '' AND id > 500 THEN phone ELSE '3' END AS phone FROM vendors", vendors=b.VENDORS))
def b09(spark, sf):
    return _detail(spark, sf).select("id", "phone")


@query("b10_social_links", with_ctes("SELECT id, category AS facebook_url, state AS instagram_username, '' AS pinterest_username FROM vendors", vendors=b.VENDORS))
def b10(spark, sf):
    return _detail(spark, sf).select("id", "facebook_url", "instagram_username", "pinterest_username")


@query("b11_seasonal_prices", with_ctes("""SELECT id, CASE WHEN star_rating > 3 THEN CAST(starting_price_min AS DOUBLE) WHEN review_count IS NULL THEN NULL
      ELSE least(review_count + 100, 2000e0) END AS starting_price_min,
    CASE WHEN star_rating > 3 THEN CAST(starting_price_avg AS DOUBLE) WHEN review_count IS NULL THEN NULL ELSE (review_count + 100 + 2000) / 2e0 END AS starting_price_avg,
    CAST(id AS DOUBLE) AS peak_price_min, id + 1e0 AS peak_price_avg, CAST(NULL AS DOUBLE) AS offpeak_price_min FROM vendors""", vendors=b.VENDORS))
def b11(spark, sf):
    return _detail(spark, sf).select("id", "starting_price_min", "starting_price_avg", "peak_price_min", "peak_price_avg", "offpeak_price_min")


@query("b12_deals", with_ctes("SELECT id, CAST(3 AS BIGINT) AS deal_count, concat(repeat('d', 250), '|', category) AS deals FROM vendors", vendors=b.VENDORS))
def b12(spark, sf):
    return _detail(spark, sf).select("id", F.col("deal_count").cast("bigint").alias("deal_count"), F.array_join("deal_descriptions", "|").alias("deals"))


# ---- review pages ---------------------------------------------------------


def _review_pages(spark, sf):
    payload = F.expr("""to_json(named_struct('reviews', named_struct('totalCount', o_custkey, 'nodes', array(
      named_struct('id', CAST(o_orderkey AS STRING), 'createdAt', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss"), 'comment', named_struct('content', repeat(o_orderpriority, 3)),
        'ratings', array(named_struct('name', 'quality', 'value', CAST(left(o_orderpriority, 1) AS INT)), named_struct('name', 'value', 'value', CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 4 ELSE 5 END),
          named_struct('name', 'time', 'value', 4), named_struct('name', 'price', 'value', 4)),
        'reviewer', named_struct('firstName', o_orderpriority, 'lastName', CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'Doe' END, 'email', 'hidden@x.test')),
      named_struct('id', concat('s', o_orderkey), 'createdAt', '', 'comment', named_struct('content', 'short'), 'ratings', NULL, 'reviewer', NULL)))))""")
    return b.table(spark, sf, "orders").select(payload.alias("payload"))


_SUB = "CAST(left(o_orderpriority, 1) AS INT)"
_MEAN = f"CASE o_orderstatus WHEN 'O' THEN ({_SUB} + 8) / 3e0 WHEN 'P' THEN ({_SUB} + 12) / 4e0 ELSE ({_SUB} + 13) / 4e0 END"


@query("b13_review_nodes", """SELECT CAST(o_orderkey AS VARCHAR) AS source_review_id, repeat(o_orderpriority, 3) AS review_text, CAST(o_orderdate AS DATE) AS review_date,
    CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE concat(o_orderpriority, ' Doe') END AS reviewer_name, o_custkey AS total_count FROM orders""")
def b13(spark, sf):
    return pl.review_nodes(_review_pages(spark, sf), []).select("source_review_id", "review_text", "review_date", "reviewer_name", "total_count")


@query("b14_mean_rating_half_even", f"SELECT CAST(o_orderkey AS VARCHAR) AS source_review_id, {b.r_even(f'CAST({_MEAN} AS DECIMAL(18,6))', 1)} AS rating FROM orders")
def b14(spark, sf):
    return pl.review_nodes(_review_pages(spark, sf), []).select("source_review_id", "rating")


@query("b15_rating_map", f"SELECT CAST(o_orderkey AS VARCHAR) AS source_review_id, CAST({_SUB} AS DOUBLE) AS quality, 4e0 AS price, CAST(4 AS BIGINT) AS n FROM orders")
def b15(spark, sf):
    return pl.review_nodes(_review_pages(spark, sf), []).select(
        "source_review_id", F.col("category_ratings")["quality"].alias("quality"), F.col("category_ratings")["price"].alias("price"),
        F.size("category_ratings").cast("bigint").alias("n"),
    )


@query("b15_repeated_names", "SELECT CAST(o_orderkey AS VARCHAR) AS source_review_id, o_custkey * 1e0 AS quality, CAST(2 AS BIGINT) AS n FROM orders")
def b15b(spark, sf):
    payload = F.expr("""to_json(named_struct('reviews', named_struct('totalCount', 1, 'nodes', array(named_struct('id', CAST(o_orderkey AS STRING), 'comment',
      named_struct('content', repeat('long enough ', 600)), 'ratings', array(named_struct('name', 'quality', 'value', 1L), named_struct('name', CAST(NULL AS STRING), 'value', 3L),
      named_struct('name', 'time', 'value', 4L), named_struct('name', 'quality', 'value', o_custkey)))))))""")
    rows = pl.review_nodes(b.table(spark, sf, "orders").select(payload.alias("payload")), []).filter("length(review_text) = 7200")
    return rows.select("source_review_id", F.col("category_ratings")["quality"].alias("quality"), F.size("category_ratings").cast("bigint").alias("n"))


@query("b01_script_attributes", "SELECT p_partkey AS page_id, p_name AS name FROM part")
def b01b(spark, sf):
    body = F.expr("""to_json(named_struct('@type', 'ItemList', 'itemListElement', array(named_struct('item', named_struct('name', p_name)))))""")
    html = F.concat(F.lit("<html><SCRIPT nonce='a' type = 'application/ld+json' data-x=\"1\">"), body, F.lit("</script ></html>"))
    pages = b.table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    return pl.json_ld_vendors(pages, ["page_id"]).select("page_id", "name")


# ---- review text ----------------------------------------------------------

_BLOB = """concat('Ann B.Rating: 4•Feed•Mar 3, 2024', text, chr(10), 'Mary Ann C. Rating: 5•', source, '•', repeat('good ', 12))"""
_CUT = rt.HEADER.replace("\\", "\\")


#: Reviews of the blobs of a CTE: where headers begin, blobs are cut, and what is left of a bullet list is trimmed.
SPLIT_BLOBS = rf"""SELECT doc_id, i - 2 AS position, regexp_replace(trim(regexp_extract(h, '^([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\s*[A-Z]?\.?)', 1)), '\.+$', '') AS reviewer,
    try_cast(regexp_extract(h, 'Rating:\s*(\d+(?:\.\d+)?)', 1) AS DOUBLE) AS rating, body FROM (
    SELECT doc_id, i, h, regexp_replace(regexp_replace(substr(p, length(h) + 1), '^\s+|\s+$', '', 'g'), '•+$', '') AS body FROM (
    SELECT doc_id, i, p, regexp_extract(p, '^{rt.HEADER}', 1) AS h FROM (
    SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS p FROM (
    SELECT doc_id, string_split(regexp_replace(blob, '{rt.HEADER}', chr(1) || '\1', 'g'), chr(1)) AS parts FROM blobs) WHERE len(parts) > 1)) WHERE i > 1) WHERE length(body) > 30"""


@query("b16_split_review_blobs", with_ctes("SELECT doc_id, position, reviewer, rating, md5(body) AS body FROM pieces", blobs=f"SELECT doc_id, {_BLOB} AS blob FROM documents", pieces=SPLIT_BLOBS))
def b16(spark, sf):
    blobs = b.table(spark, sf, "documents").select("doc_id", F.expr(_BLOB).alias("text"))
    rows = rt.split_reviews(blobs, ["doc_id"])
    return rows.select("doc_id", F.col("position").cast("bigint").alias("position"), "reviewer", "rating", F.md5("body").alias("body"))


@query("b16_review_dates_near_header", """SELECT doc_id, DATE '2024-03-03' AS review_date FROM documents""")
def b16b(spark, sf):
    blobs = b.table(spark, sf, "documents").select("doc_id", F.expr(_BLOB).alias("text"))
    return rt.split_reviews(blobs, ["doc_id"], min_body=0).filter("position = 0").select("doc_id", "review_date")


@query("b16_equal_headers", """SELECT doc_id, position, CASE position WHEN 0 THEN DATE '2024-03-03' ELSE DATE '2023-01-09' END AS review_date
    FROM documents, (SELECT unnest([0, 1]) AS position)""")
def b16c(spark, sf):
    text = F.concat(F.lit("Ann B.Rating: 5•Feed•Mar 3, 2024 "), "text", F.lit(" and all was well. Ann B.Rating: 5•Feed•Jan 9, 2023 "), F.repeat(F.lit("fine "), F.lit(12)))
    rows = rt.split_reviews(b.table(spark, sf, "documents").select("doc_id", text.alias("text")), ["doc_id"])
    return rows.select("doc_id", F.col("position").cast("bigint").alias("position"), "review_date")


@query("b17_blob_without_header", r"""SELECT doc_id, coalesce(nullif(regexp_replace(trim(regexp_extract(text, '^([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\s*[A-Z]?\.?)', 1)), '\.+$', ''), ''), 'Anonymous') AS reviewer,
    md5(text) AS body FROM documents WHERE length(text) > 80""")
def b17(spark, sf):
    rows = rt.split_reviews(b.table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    return rows.select("doc_id", "reviewer", F.md5("body").alias("body"))


@query("b18_single_review_block", with_ctes(r"""SELECT doc_id, 'Ann B' AS reviewer, 4.5e0 AS rating, DATE '2024-03-03' AS review_date,
    md5(CASE WHEN length(clean) < 30 THEN block ELSE clean END) AS review_text FROM (SELECT doc_id, block,
    regexp_replace(regexp_replace(block, '^[A-Z].*?\.\s*Rating:\s*\d+(?:\.\d+)?.*?\d{4}', ''), '^\s*[•\s]+', '') AS clean FROM blocks)""",
    blocks="SELECT doc_id, concat('Ann B. Rating: 4.5•Feed•Mar 3, 2024 • ', text) AS block FROM documents"))
def b18(spark, sf):
    blocks = b.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("Ann B. Rating: 4.5•Feed•Mar 3, 2024 • "), "text").alias("block"))
    return blocks.select("doc_id", *rt.block_columns("block")).withColumn("review_text", F.md5("review_text"))


@query("b19_review_snippets", """SELECT conv_id, concat(CAST(conv_id AS VARCHAR), '-snippet-', CAST(i AS VARCHAR)) AS source_review_id, md5(t) AS review_text,
    CASE i WHEN 0 THEN 4.5e0 END AS rating FROM (SELECT conv_id, 0 AS i, text AS t FROM conversations
    UNION ALL SELECT conv_id, 1, role FROM conversations) WHERE length(t) >= 20""")
def b19(spark, sf):
    snippets = F.expr("array(named_struct('text', text, 'reviewer', role, 'rating', '4.5 of 5'), named_struct('text', role, 'reviewer', '', 'rating', ''))")
    base = b.table(spark, sf, "conversations").select("conv_id", snippets.alias("snippets"))
    return rt.snippet_rows(base, "conv_id").select("conv_id", "source_review_id", F.md5("review_text").alias("review_text"), "rating")


@query("b20_review_like_blocks", """SELECT doc_id, length(text) > 50 AND length(text) < 5000 AS section, length(text) > 100 AND length(text) < 3000
    AND NOT contains(text, 'heit') AND NOT contains(text, 'que') AS fallback FROM documents""")
def b20(spark, sf):
    from reviewloom.operators.selects import text_between

    return b.table(spark, sf, "documents").select(
        "doc_id", text_between("text", 50, 5000).alias("section"), text_between("text", 100, 3000, ["heit", "que"]).alias("fallback")
    )


# ---- prices, cards and links ----------------------------------------------


@query("b21_dollar_amounts", r"""SELECT doc_id, array_to_string(regexp_extract_all(text, '\$\s*[\d,]+(?:\.\d{2})?'), '|') AS prices FROM documents""")
def b21(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", F.array_join(mk.dollar_amounts("text"), "|").alias("prices"))


_SHOP = """concat('<html><a class="nav" href="/', {id}, '">Our Packages</a><a href="/about">About</a><a href="https://m.test/marketplace/', {id}, '--7">See plan</a>',
  '<a href="https://m.test/marketplace/', {id}, '--7">again</a><a href="/biz/', {id}, '">', {name}, '</a><a href="/biz/x">', {name}, '</a><a href="/biz/y">ab</a>',
  '<h1 class="vendor-name">', {name}, '</h1><div class="starting-price">From $2,', {size}, '</div><section class="packages">',
  '<div class="package-item"><h3 class="package-name">Basic ', {brand}, '</h3><span class="package-price">$1,', {size}, '</span><p class="package-description">', {type}, '</p></div>',
  '<div class="package-item"><h3 class="package-name">Premium</h3><span class="package-price">$3,500</span></div></section><p class="card-note">', {brand}, '</p></html>')"""


def _shop(spark, sf):
    html = F.expr(_SHOP.format(id="CAST(p_partkey AS STRING)", name="p_name", brand="p_brand", size="CAST(p_size + 100 AS STRING)", type="p_type"))
    url = F.expr("""CASE WHEN p_size > 40 THEN concat('https://m.test/marketplace/', p_partkey, '--9?x=1') WHEN p_size > 30 THEN 'https://m.test/marketplace/djs-austin'
      ELSE 'https://m.test/other' END""")
    return b.pages_of(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("page_id"), url.alias("url"), html.alias("html"))


_CARDS = "concat('Basic ', p_brand, ' $1,', CAST(p_size + 100 AS VARCHAR), ' ', p_type)"


@query("b22_card_texts", f"""SELECT p_partkey AS page_id, concat({_CARDS}, ' Premium $3,500|', {_CARDS}, '|Basic ', p_brand, '|$1,', CAST(p_size + 100 AS VARCHAR), '|', p_type,
    '|Premium $3,500|Premium|$3,500|', p_brand) AS cards FROM part""")
def b22(spark, sf):
    return _shop(spark, sf).select("page_id", F.array_join(mk.card_texts("html"), "|").alias("cards"))


@query("b23_package_links", """SELECT p_partkey AS page_id, concat('Our Packages>/', CAST(p_partkey AS VARCHAR), '|See plan>https://m.test/marketplace/', CAST(p_partkey AS VARCHAR), '--7') AS links FROM part""")
def b23(spark, sf):
    links = F.transform(mk.package_links("html"), lambda a: F.concat(a["text"], F.lit(">"), a["href"]))
    return _shop(spark, sf).select("page_id", F.array_join(links, "|").alias("links"))


@query("b24_package_items", """SELECT p_partkey AS page_id, 1 AS package_number, concat('Basic ', p_brand) AS name, concat('$1,', CAST(p_size + 100 AS VARCHAR)) AS price, p_type AS description FROM part
    UNION ALL SELECT p_partkey, 2, 'Premium', '$3,500', '' FROM part""")
def b24(spark, sf):
    return mk.package_rows(_shop(spark, sf), ["page_id"])


@query("b25_ordered_patterns", """SELECT p_partkey AS page_id, p_name AS name, concat('From $2,', CAST(p_size + 100 AS VARCHAR)) AS price FROM part""")
def b25(spark, sf):
    return _shop(spark, sf).select("page_id", mk.vendor_name("html").alias("name"), mk.starting_price_text("html").alias("price"))


# Nested and encoded markup: elements of one name inside each other, references, implied ends, single quotes, text that only looks like markup.
_NESTED = """concat('<html><head><title>', {name}, ' &amp; more</title><script>document.write("<div class=''package-item''>no</div>")</script></head><body>',
  '<div class="vendor-name"><div>', {name}, '</div><div>Caf&eacute; &#38; Sons</div></div><!-- <div class="package-item">no</div> -->',
  '<div class=''starting-price''>From <span>$', {size}, '</span>,000</div><div><div class="package-item first"><div><div class="package-name">In <b>and</b> out</div></div>',
  '<div class="package-price"><div>$', {size}, '</div></div><div class="package-description"><ul><li>', {type}, '<li>&lt;', {brand}, '&gt;</ul></div></div>',
  '<div class="package-item"><p class="package-name">Second<p class="package-price">$7 &ndash; $9</div></div><div class="tail">x</body></html>')"""


def _nested(spark, sf):
    html = F.expr(_NESTED.format(name="p_name", brand="p_brand", size="CAST(p_size AS STRING)", type="p_type"))
    return b.pages_of(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("page_id"), html.alias("html"))


_FIRST_ITEM = "concat('In and out $', CAST(p_size AS VARCHAR), ' ', p_type, ' <', p_brand, '>')"


@query("b22_nested_cards", f"""SELECT p_partkey AS page_id, concat({_FIRST_ITEM}, '|In and out|$', CAST(p_size AS VARCHAR), '|', p_type, ' <', p_brand, '>|Second $7 – $9|Second|$7 – $9') AS cards FROM part""")
def b22b(spark, sf):
    return _nested(spark, sf).select("page_id", F.array_join(mk.card_texts("html"), "|").alias("cards"))


@query("b24_nested_packages", """SELECT p_partkey AS page_id, 1 AS package_number, 'In and out' AS name, concat('$', CAST(p_size AS VARCHAR)) AS price,
    concat(p_type, ' <', p_brand, '>') AS description FROM part UNION ALL SELECT p_partkey, 2, 'Second', '$7 – $9', '' FROM part""")
def b24b(spark, sf):
    return mk.package_rows(_nested(spark, sf), ["page_id"])


@query("b25_nested_vendor_pages", f"""SELECT p_partkey AS page_id, concat(p_name, ' & more') AS title, concat(p_name, ' Café & Sons') AS name,
    concat('From $', CAST(p_size AS VARCHAR), ',000') AS price, CAST(2 AS BIGINT) AS packages, CAST(7 AS BIGINT) AS cards FROM part""")
def b25b(spark, sf):
    found = mk.vendor_pages(_nested(spark, sf), ["page_id"])
    return found.withColumns({c: F.size(c).cast("bigint") for c in ("packages", "cards")})


@query("b29_nested_text", f"""SELECT p_partkey AS page_id, concat(p_name, ' & more ', p_name, ' Café & Sons From $', CAST(p_size AS VARCHAR), ',000 ', {_FIRST_ITEM}, ' Second $7 – $9 x') AS text FROM part""")
def b29b(spark, sf):
    return _nested(spark, sf).select("page_id", mk.visible_text("html").alias("text"))


@query("b26_vendor_links", "SELECT p_partkey AS page_id, concat('https://m.test/marketplace/', CAST(p_partkey AS VARCHAR), '--7') AS links FROM part")
def b26(spark, sf):
    return _shop(spark, sf).select("page_id", F.array_join(mk.vendor_links("html"), "|").alias("links"))


@query("b27_page_type", "SELECT p_partkey AS page_id, CASE WHEN p_size > 40 THEN 'vendor' WHEN p_size > 30 THEN 'marketplace' ELSE 'vendor' END AS kind FROM part")
def b27(spark, sf):
    return _shop(spark, sf).select("page_id", mk.page_type("url", "html").alias("kind"))


@query("b27_page_type_of_crawled_pages", """SELECT page_id, CASE WHEN listed AND contains(split_part(tail, '/', 1), '#') THEN 'vendor' WHEN listed AND NOT contains(tail, '/') THEN 'marketplace'
    ELSE 'unknown' END AS kind FROM (SELECT page_id, contains(url, '/en/') AS listed, split_part(string_split(url, '/en/')[-1], '?', 1) AS tail FROM pages)""")
def b27b(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", mk.page_type("url", "html", path="/en/", mark="#").alias("kind"))


@query("b28_fallback_business_links", """SELECT p_partkey AS page_id, p_name AS name, concat('/biz/', CAST(p_partkey AS VARCHAR)) AS url FROM part WHERE p_size <= 10""")
def b28(spark, sf):
    pages = _shop(spark, sf)
    structured = b.table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").alias("page_id"))
    return mk.without_structured(mk.business_links(pages, "page_id"), structured, "page_id").select("page_id", "name", "url")


_DECODED = "html"
for _pattern, _by in ((r"(?is)<(script|style)\b.*?</(script|style)>", " "), ("(?s)<!--.*?-->", " "), ("(?i)</?b>", ""), ("(?s)<[^>]*>", " ")):
    _DECODED = f"regexp_replace({_DECODED}, '{_pattern}', '{_by}', 'g')"
for _name, _char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&"), ("&amp", "&")):
    _DECODED = f"replace({_DECODED}, '{_name}', '{_char}')"


@query("b29_visible_text", rf"""SELECT page_id, md5(trim(regexp_replace({_DECODED}, '\s+', ' ', 'g'))) AS digest FROM pages""")
def b29(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", F.md5(mk.visible_text("html")).alias("digest"))


@query("b30_class_frequency", r"""SELECT cls AS class, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(c, '\s+')) AS cls FROM (
    SELECT unnest(regexp_extract_all(html, '<(?:div|section|article)[^>]*class="([^"]*)"', 1)) AS c FROM pages)) WHERE length(cls) >= 2 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def b30(spark, sf):
    return mk.class_frequency(b.table(spark, sf, "pages"), k=10, min_len=2)


@query("b30_page_structure", """SELECT p_partkey AS page_id, concat('vendor-name:', p_name) AS headings, 'package-price' AS priced, 
    'packages,package-item,package-name,package-price,package-description' AS keyword_classes FROM part""")
def b30b(spark, sf):
    head = F.transform(mk.headings("html"), lambda h: F.concat(h["class"], F.lit(":"), h["text"]))
    return _shop(spark, sf).select(
        "page_id", F.array_join(head, ",").alias("headings"), F.array_join(mk.priced_classes("html"), ",").alias("priced"),
        F.array_join(mk.keyword_classes("html"), ",").alias("keyword_classes"),
    )


@query("b30_vendor_test_ids", """SELECT p_partkey AS page_id, concat('Vendor-', p_brand, '|list-vendor|VENDOR') AS ids, p_name AS shown FROM part""")
def b30c(spark, sf):
    """Test ids that name vendors, and the first of several renderings that is not blank."""
    html = F.expr("""concat('<div data-testid="Vendor-', p_brand, '"><i data-testid="other">', p_type, '</i><p class="vendor" data-testid="list-vendor"></p></div><b DATA-TESTID="VENDOR">')""")
    return b.table(spark, sf, "part").select(
        F.col("p_partkey").alias("page_id"), F.array_join(mk.vendor_test_ids(html), "|").alias("ids"),
        mk.first_text(F.lit(None).cast("string"), F.lit("  "), F.concat(F.lit(" "), "p_name", F.lit(" ")), "p_type").alias("shown"),
    )


@query("b31_endpoint_urls", r"""SELECT DISTINCT u AS endpoint FROM (SELECT unnest(regexp_extract_all(concat('<a href="', url, '">', html), 'https?://[^"'']*(?:api|listing|page|ref)[^"'']*')) AS u FROM pages)""")
def b31(spark, sf):
    pages = b.table(spark, sf, "pages").select(F.concat(F.lit('<a href="'), "url", F.lit('">'), "html").alias("html"))
    return mk.endpoint_urls(pages, hints=["api", "listing", "page", "ref"])


@query("b32_substring_counts", """SELECT page_id, CAST((length(html) - length(replace(html, '<p>', ''))) / 3 AS BIGINT) AS n_0,
    CAST((length(html) - length(replace(html, 'class="', ''))) / 7 AS BIGINT) AS n_1, CAST((length(html) - length(replace(html, 'the ', ''))) / 4 AS BIGINT) AS n_2 FROM pages""")
def b32(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", *mk.substring_counts("html", ["<p>", 'class="', "the "]))


@query("b33_json_path_profile", """SELECT '$.k' AS path, 'BIGINT' AS type, count(*) AS n FROM events
    UNION ALL SELECT '$.review', 'OBJECT', count(*) FROM events UNION ALL SELECT '$.review.rating', 'DOUBLE', count(*) FROM events
    UNION ALL SELECT '$.list', 'ARRAY', count(*) FROM events UNION ALL SELECT '$.list[0].comment', 'STRING', count(*) FROM events
    UNION ALL SELECT '$.list[1].ignored', 'BIGINT', count(*) FROM events""")
def b33(spark, sf):
    payload = F.expr("""concat('{"k":', get_json_object(props, '$.k'), ',"review":{"rating":', value, 'e0},"list":[{"comment":"', event_type, '"},{"ignored":1}]}')""")
    return pl.variant_paths(b.table(spark, sf, "events").select(payload.alias("payload")), words=())


@query("b33_json_review_keys", """SELECT '$.review' AS path, 'OBJECT' AS type, count(*) AS n FROM events
    UNION ALL SELECT '$.a.b.c.rating', 'BIGINT', count(*) FROM events UNION ALL SELECT '$.list[0].comment', 'STRING', count(*) FROM events WHERE event_type = 'view'""")
def b33b(spark, sf):
    payload = F.expr("""concat('{"k":', get_json_object(props, '$.k'), ',"review":{"x":1},"a":{"b":{"c":{"rating":1}}},"list":',
      CASE event_type WHEN 'view' THEN '[{"comment":"c"}]' WHEN 'click' THEN '[]' ELSE '["comment"]' END, '}')""")
    return pl.variant_paths(b.table(spark, sf, "events").select(payload.alias("payload")))


_DEEP = """concat('{"a":{"b":{"c":{"d":{"e":{"f":{"g":{"h":{"rating":', CAST(event_id AS STRING), '}}}}}}}},"list":[{"x":1},[3,{"review":"', event_type, '"}],{"feedback":{"comment":[1,{"rating":null}]}}]}')"""


@query("b33_deep_json_paths", """SELECT '$.a.b.c.d.e.f.g.h.rating' AS path, 'BIGINT' AS type, count(*) AS n FROM events UNION ALL SELECT '$.list[1][1].review', 'STRING', count(*) FROM events
    UNION ALL SELECT '$.list[2].feedback', 'OBJECT', count(*) FROM events UNION ALL SELECT '$.list[2].feedback.comment', 'ARRAY', count(*) FROM events
    UNION ALL SELECT '$.list[2].feedback.comment[1].rating', 'VOID', count(*) FROM events""")
def b33c(spark, sf):
    """Nine levels down, and in the second and third element of a list."""
    return pl.variant_paths(b.table(spark, sf, "events").select(F.expr(_DEEP).alias("payload")))


@query("b34_populated_keys", """SELECT section, key, count(*) AS n, count(*) FILTER (v NOT IN ('', '0')) AS populated FROM (
    SELECT 'vendors' AS section, 'name' AS key, c_name AS v FROM customer UNION ALL SELECT 'vendors', 'phone', CASE WHEN c_acctbal < 0 THEN '' ELSE '1' END FROM customer
    UNION ALL SELECT 'search', 'total', CAST(c_nationkey AS VARCHAR) FROM customer) GROUP BY 1, 2""")
def b34(spark, sf):
    payload = F.expr("""to_json(named_struct('vendors', named_struct('name', c_name, 'phone', CASE WHEN c_acctbal < 0 THEN '' ELSE '1' END),
      'search', named_struct('total', c_nationkey)))""")
    return pl.populated_keys(b.table(spark, sf, "customer").select(payload.alias("payload")))


@query("b35_page_markers", """SELECT page_id, length(html) AS length, contains(lower(html), '<title>') AS has_title, contains(lower(html), '<body') AS has_body, contains(html, '403') AS has_403,
    contains(lower(html), 'captcha') AS has_captcha, contains(lower(html), 'cloudflare') AS has_cloudflare, length(html) > 10000 AS has_content FROM pages""")
def b35(spark, sf):
    pages = b.table(spark, sf, "pages").select("page_id", "html")
    return mk.marker_profile(pages).select("page_id", "length", "has_title", "has_body", "has_403", "has_captcha", "has_cloudflare", "has_content")


@query("b36_mixed_item_lists", """SELECT p_partkey, concat(p_name, ',', p_brand, ',') AS names FROM part""")
def b36(spark, sf):
    mixed = F.expr("""concat('[{"name":"', p_name, '","id":1},"', p_brand, '",{"id":2}]')""")
    return b.table(spark, sf, "part").select("p_partkey", b.joined_text(pl.mixed_names(mixed)).alias("names"))
