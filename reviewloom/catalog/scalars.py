"""Queries of the scalar functions, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query, r, with_ctes
from reviewloom.catalog.tagging import _DEFAULT_REPLY
from reviewloom.functions import scalars as sc
from reviewloom.operators import pricing

V = b.VENDORS

_PRICE_TEXT = """CASE WHEN p_size < 5 THEN 'Contact for pricing' WHEN p_size < 20 THEN concat('Starting at $', CAST(p_partkey + 1 AS {t}), ',', lpad(CAST(p_size AS {t}), 3, '0'))
  WHEN p_size < 35 THEN concat('From $', CAST(p_partkey AS {t}), '.50 per event') ELSE concat('Starting price $', CAST(p_size AS {t}), '00') END"""


@query("c01_parse_price", rf"""SELECT p_partkey, try_cast(replace(regexp_extract(lower(t), '\d+[,\d]*\.?\d*'), ',', '') AS DOUBLE) AS price
    FROM (SELECT p_partkey, {_PRICE_TEXT.format(t='VARCHAR')} AS t FROM part)""")
def c01(spark, sf):
    text = F.expr(_PRICE_TEXT.format(t="STRING"))
    return b.table(spark, sf, "part").select("p_partkey", sc.parse_price(text).alias("price"))


_RANGE_TEXT = """CASE WHEN p_size < 3 THEN '' WHEN p_size < 20 THEN concat('$', CAST(p_size * 100 AS {t}), '-$', CAST(p_size AS {t}), ',', '999')
  ELSE concat('from $', CAST(p_size * 10 AS {t})) END"""


@query("c02_price_range", f"""SELECT p_partkey, CASE WHEN p_size < 3 THEN NULL WHEN p_size < 20 THEN p_size * 100e0 ELSE p_size * 10e0 END AS price_min,
    CASE WHEN p_size < 3 THEN NULL WHEN p_size < 20 THEN (p_size * 100e0 + p_size * 1000e0 + 999) / 2 ELSE p_size * 10e0 END AS price_avg
    FROM (SELECT p_partkey, p_size, {_RANGE_TEXT.format(t='VARCHAR')} AS t FROM part)""")
def c02(spark, sf):
    text = F.expr(_RANGE_TEXT.format(t="STRING"))
    return b.table(spark, sf, "part").select(
        "p_partkey", sc.price_range_min(text).alias("price_min"), sc.price_range_avg(text).alias("price_avg")
    )


@query("c03_money_to_number", """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN floor(o_totalprice) END AS amount FROM orders""")
def c03(spark, sf):
    whole = F.floor("o_totalprice").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0), F.lit(".00")))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("$"), whole, F.lit("-$"), whole))
        .otherwise(F.concat(whole, F.lit("d")))
    )
    return b.table(spark, sf, "orders").select("o_orderkey", sc.money_to_number(text).alias("amount"))


@query("c04_filled_number", """SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL WHEN p_size > 30 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS n FROM part""")
def c04(spark, sf):
    text = F.when(F.col("p_size") > 40, "n/a").when(F.col("p_size") > 30, "0.0").otherwise(F.col("p_size").cast("string"))
    return b.table(spark, sf, "part").select("p_partkey", sc.filled_number(text).alias("n"))


@query("c05_parse_review_date", """SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN CAST(o_orderdate AS DATE) WHEN '2' THEN CAST(o_orderdate AS DATE)
    WHEN '3' THEN CASE WHEN month(o_orderdate) = 5 THEN CAST(o_orderdate AS DATE) END END AS review_date,
    CASE left(o_orderpriority, 1) WHEN '1' THEN CAST(o_orderdate AS DATE) WHEN '3' THEN CASE WHEN month(o_orderdate) = 5 THEN CAST(o_orderdate AS DATE) END END AS named_only
    FROM orders""")
def c05(spark, sf):
    p, d = F.left("o_orderpriority", F.lit(1)), F.col("o_orderdate")
    text = (
        F.when(p == "1", F.concat(F.lit("Ann B.Rating: 5•Feed•"), F.date_format(d, "MMM d, yyyy"), F.lit("Great")))
        .when(p == "2", F.concat(F.lit("on "), F.date_format(d, "yyyy-MM-dd"), F.lit(" we met")))
        .when(p == "3", F.concat(F.lit("on "), F.date_format(d, "MMMM d, yyyy")))
        .when(p == "4", F.lit("no date here"))
    )
    return b.table(spark, sf, "orders").select(
        "o_orderkey", sc.parse_date(text).alias("review_date"), sc.parse_date(text, iso=False).alias("named_only")
    )


@query("c06_iso_date", """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS day FROM events""")
def c06(spark, sf):
    text = F.when(F.col("event_type") == "error", "").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return b.table(spark, sf, "events").select("event_id", sc.iso_date(text).alias("day"))


@query("c07_slugify", """SELECT p_partkey, regexp_replace(replace(replace(replace(replace(lower(concat(p_name, ' & Co., ', p_brand)), ' & ', '-'), ' ', '-'), '--', '-'), ',', ''),
    '[^a-z0-9-]', '', 'g') AS slug, lower(replace(p_name, ' ', '-')) AS simple FROM part""")
def c07(spark, sf):
    name = F.concat("p_name", F.lit(" & Co., "), "p_brand")
    return b.table(spark, sf, "part").select("p_partkey", sc.slugify(name).alias("slug"), sc.simple_slug("p_name").alias("simple"))


@query("c08_first_filled", with_ctes("""SELECT id, coalesce(nullif(phone, ''), nullif(email, ''), nullif(city, ''), '') AS contact,
    coalesce(nullif(CAST(star_rating AS DOUBLE), 0), nullif(CAST(starting_price_min AS DOUBLE), 0), 0) AS number FROM vendors""", vendors=V))
def c08(spark, sf):
    return b.vendors(spark, sf).select(
        "id", sc.first_filled("phone", "email", "city").alias("contact"),
        sc.first_non_zero(F.col("star_rating").cast("double"), F.col("starting_price_min").cast("double"), default=0.0).alias("number"),
    )


_ID_RULES = {"ASIA": ["phone", "city"], "EUROPE": ["city", "email", "name"], "AFRICA": ["website_url", "name"]}


@query("c09_source_vendor_id", with_ctes("""SELECT id, CASE source WHEN 'ASIA' THEN coalesce(nullif(phone, ''), nullif(city, ''), '')
    WHEN 'EUROPE' THEN coalesce(nullif(city, ''), nullif(email, ''), nullif(name, ''), '') WHEN 'AFRICA' THEN coalesce(nullif(website_url, ''), nullif(name, ''), '')
    ELSE coalesce(nullif(source_vendor_id, ''), nullif(name, ''), '') END AS svid FROM vendors""", vendors=V))
def c09(spark, sf):
    return b.vendors(spark, sf).select("id", sc.source_vendor_id("source", _ID_RULES, ["source_vendor_id", "name"]).alias("svid"))


@query("c10_listing_url", with_ctes("""SELECT id, CASE WHEN phone <> '' THEN concat('https://market.example.com/vendors/', category, '/', phone) ELSE '' END AS url
    FROM vendors""", vendors=V))
def c10(spark, sf):
    return b.vendors(spark, sf).select("id", sc.listing_url("https://market.example.com/vendors/", "category", "phone").alias("url"))


@query("c11_url_and_category_choice", with_ctes("""SELECT id, coalesce(nullif(source_url, ''), nullif(website_url, ''), '') AS url,
    coalesce(nullif(nullif(category, 'wedding-djs'), ''), 'wedding-photographers') AS category FROM vendors""", vendors=V))
def c11(spark, sf):
    return b.vendors(spark, sf).select(
        "id", sc.first_filled("source_url", "website_url").alias("url"),
        sc.first_filled(F.nullif("category", F.lit("wedding-djs")), default=lx.DEFAULT_CATEGORY).alias("category"),
    )


@query("c12_named_objects", """SELECT n_nationkey, concat('[{"name":"', n_name, '"},{"name":"', CAST(n_regionkey AS VARCHAR), '"}]') AS awards FROM nation""")
def c12(spark, sf):
    names = F.array("n_name", F.col("n_regionkey").cast("string"))
    return b.table(spark, sf, "nation").select("n_nationkey", F.to_json(sc.named_structs(names)).alias("awards"))


@query("c13_truncations", "SELECT doc_id, length(left(text, 5000)) AS n_5000, left(text, 40) AS head, length(left(text, 2000)) AS n_2000 FROM documents")
def c13(spark, sf):
    return b.table(spark, sf, "documents").select(
        "doc_id", F.length(F.left("text", F.lit(5000))).cast("bigint").alias("n_5000"), F.left("text", F.lit(40)).alias("head"),
        F.length(F.left("text", F.lit(2000))).cast("bigint").alias("n_2000"),
    )


@query("c14_collapse_spaces", r"SELECT doc_id, md5(regexp_replace(text, '\s+', ' ', 'g')) AS digest FROM documents")
def c14(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", F.md5(sc.collapse_spaces("text")).alias("digest"))


_CODE = "CASE category WHEN 'wedding-djs' THEN 'DJ' WHEN 'wedding-planners' THEN 'COORD' WHEN 'wedding-photobooths' THEN 'PHOTOBOOTH' ELSE 'OTHER' END"


@query("c15_price_tier", with_ctes(f"""SELECT id, CASE WHEN p IS NULL THEN 'unknown' WHEN p < lo THEN 'budget' WHEN p < mid THEN 'mid' ELSE 'premium' END AS tier FROM (
    SELECT id, coalesce(nullif(starting_price_avg, 0), starting_price_min) AS p,
    CASE {_CODE} WHEN 'COORD' THEN 1500 WHEN 'PHOTOBOOTH' THEN 400 ELSE 1200 END AS lo,
    CASE {_CODE} WHEN 'COORD' THEN 3500 WHEN 'PHOTOBOOTH' THEN 900 ELSE 2500 END AS mid FROM vendors)""", vendors=V))
def c15(spark, sf):
    return b.vendors(spark, sf).select(
        "id", sc.price_tier(sc.category_code("category"), "starting_price_avg", "starting_price_min").alias("tier")
    )


@query("c16_category_codes", with_ctes(f"""SELECT id, {_CODE} AS code, CASE category WHEN 'wedding-djs' THEN 'DJ / MC' WHEN 'wedding-planners' THEN 'Wedding Coordinator'
    WHEN 'wedding-photobooths' THEN 'Photobooth' ELSE category END AS label FROM vendors""", vendors=V))
def c16(spark, sf):
    return b.vendors(spark, sf).select("id", sc.category_code("category").alias("code"), sc.category_label("category").alias("label"))


@query("c17_market_position", with_ctes(f"""SELECT id, CASE WHEN p IS NULL THEN 'no price' WHEN p < a * 0.85e0 THEN 'below' WHEN p > a * 1.15e0 THEN 'above' ELSE 'at' END AS position,
    {r('(p - lo) / (hi - lo) * 100', 4)} AS pct_of_range FROM (SELECT id, CAST(starting_price_min AS DOUBLE) AS p, avg(starting_price_avg) OVER w AS a,
    CAST(min(starting_price_min) OVER w AS DOUBLE) AS lo, CAST(max(starting_price_min) OVER w AS DOUBLE) AS hi FROM vendors WINDOW w AS (PARTITION BY category))""", vendors=V))
def c17(spark, sf):
    v = b.vendors(spark, sf).withColumn("price_tier", F.lit("unknown"))
    placed = pricing.with_market_position(
        v.withColumn("starting_price_min", F.col("starting_price_min").cast("double")), pricing.market_stats(v)
    )
    return placed.select("id", F.col("market_position").alias("position"), F.round("pct_of_range", 4).alias("pct_of_range"))


@query("c17_null_category", with_ctes("SELECT id, CASE WHEN id % 3 = 0 THEN 'OTHER' ELSE category END AS category FROM vendors", vendors=V))
def c17b(spark, sf):
    v = b.vendors(spark, sf).withColumn("price_tier", F.lit("unknown")).withColumn("category", F.when(F.col("id") % 3 != 0, F.col("category")))
    return pricing.with_market_position(v, pricing.market_stats(v)).select("id", "category")


@query("c18_display_labels", with_ctes("""SELECT id, replace(category, 'wedding-', '') AS label,
    concat(CAST(CAST(round_even(coalesce(star_rating, 0) * 5, 0) AS INT) AS VARCHAR), '%') AS pct,
    CASE WHEN review_count * 50 >= 1000 THEN concat(CAST(CAST(round(review_count * 50 / 1000, 1) AS DECIMAL(10,1)) AS VARCHAR), 'K')
      ELSE CAST(review_count * 50 AS VARCHAR) END AS compact FROM vendors""", vendors=V))
def c18(spark, sf):
    return b.vendors(spark, sf).select(
        "id", sc.display_category("category").alias("label"),
        sc.percent_text(F.coalesce(F.col("star_rating").cast("double"), F.lit(0.0)) * 5).alias("pct"),
        F.when(F.col("review_count").isNotNull(), sc.compact_number(F.col("review_count") * 50)).alias("compact"),
    )


@query("c19_price_key", f"SELECT p_partkey, trim(replace(concat(' ', {_PRICE_TEXT.format(t='VARCHAR')}, ' '), ',', '')) AS key FROM part")
def c19(spark, sf):
    text = F.concat(F.lit(" "), F.expr(_PRICE_TEXT.format(t="STRING")), F.lit(" "))
    return b.table(spark, sf, "part").select("p_partkey", sc.price_key(text).alias("key"))


@query("c20_json_payload", """SELECT n_nationkey, concat('{"n_nationkey":', CAST(n_nationkey AS VARCHAR), ',"tags":["', n_name, '","x"]}') AS payload FROM nation""")
def c20(spark, sf):
    return b.table(spark, sf, "nation").select(
        "n_nationkey", F.to_json(F.struct("n_nationkey", F.array("n_name", F.lit("x")).alias("tags"))).alias("payload")
    )


@query("c21_json_array_elements", """SELECT tag, count(*) AS n, CAST(sum(len) AS BIGINT) AS lengths FROM (
    SELECT unnest([event_type, CAST(user_id AS VARCHAR)]) AS tag, 2 AS len FROM events) GROUP BY 1""")
def c21(spark, sf):
    stored = b.table(spark, sf, "events").select(
        F.to_json(F.array("event_type", F.col("user_id").cast("string"))).alias("tags")
    )
    rows = stored.select(F.json_array_length("tags").alias("len"), F.explode(F.from_json("tags", "array<string>")).alias("tag"))
    return rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("lengths"))


@query("c22_text_measures", f"""SELECT doc_id, length(text) AS n, length(trim(text)) AS n_trim, md5(lower(text)) AS low, {r('n_chars / 7.0e0')} AS ratio FROM documents""")
def c22(spark, sf):
    return b.table(spark, sf, "documents").select(
        "doc_id", F.length("text").cast("bigint").alias("n"), F.length(F.trim("text")).cast("bigint").alias("n_trim"),
        F.md5(F.lower("text")).alias("low"), F.round(F.col("n_chars") / 7.0, 2).alias("ratio"),
    )


@query("c23_foreign_url", "SELECT page_id, url <> '' AND NOT contains(url, 'example.com') AS is_foreign FROM pages")
def c23(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", sc.foreign_url("url", "example.com").alias("is_foreign"))


@query("c24_star_label", with_ctes("""SELECT concat(CAST(CAST(floor(star_rating) AS INT) AS VARCHAR), '★') AS label, count(*) AS n FROM vendors GROUP BY 1""", vendors=V))
def c24(spark, sf):
    return b.vendors(spark, sf).groupBy(sc.star_label(F.floor("star_rating")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("m02_sql_functions", with_ctes(rf"""SELECT id, array_to_string({b.topic_list('lower(review_text)', lx.REVIEW_TOPICS)}, ',') AS topics,
    CASE sign((CASE WHEN rating >= 4.5 THEN 3 WHEN rating >= 1 AND rating < 2 THEN -3 ELSE 0 END) + {b.hits('lower(review_text)', lx.POSITIVE_WORDS)}
      - {b.hits('lower(review_text)', lx.NEGATIVE_WORDS)}) WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' ELSE 'neutral' END AS sentiment,
    {_DEFAULT_REPLY.replace('lower(text)', 'lower(review_text)')} AS reply, CASE WHEN rating IS NULL THEN 'unknown' ELSE 'budget' END AS tier,
    try_cast(replace(regexp_extract(lower(review_text), '\d+[,\d]*\.?\d*'), ',', '') AS DOUBLE) AS price
    FROM (SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN concat('Hi Ann, thank you for your kind words. ', review_text) ELSE review_text END AS review_text) FROM texts)""", texts=b.TEXTS))
def m02(spark, sf):
    from reviewloom.functions.sql_functions import register

    register(spark)
    answered = F.when(F.col("id") % 3 == 0, F.concat(F.lit("Hi Ann, thank you for your kind words. "), "review_text")).otherwise(F.col("review_text"))
    found = b.texts(spark, sf).withColumn("review_text", answered).withColumn("found", F.expr("review_evidence(lower(coalesce(review_text, '')))"))
    return found.selectExpr(
        "id", "array_join(found.topics, ',') AS topics", "polarity_sentiment(found.pos - found.neg, rating) AS sentiment",
        "vendor_reply(review_text) AS reply", "price_tier('DJ', rating, NULL) AS tier", "parse_price(review_text) AS price",
    )
