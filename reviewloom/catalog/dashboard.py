"""Queries of the dashboard family: filters, joins, roll-ups, top lists, insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query, r, with_ctes
from reviewloom.catalog.tagging import _DEFAULT_REPLY
from reviewloom.operators import audits, insights, pricing
from reviewloom.operators import rollups as ru
from reviewloom.operators import selects as se
from reviewloom.operators.dedup import top_by_key
from reviewloom.plans import dashboard as dash
from reviewloom.plans import tagging as plan
from reviewloom.session import Workspace, materialize

V, R, T, LI = b.VENDORS, b.REVIEWS, b.TEXTS, b.LISTINGS


def vr(body: str, **more: str) -> str:
    return with_ctes(body, vendors=V, reviews=R, **more)


_TAGGED = dict(texts=T, tagged=b.tagged("texts", b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE))


def tagged(spark, sf):
    return plan.tag_reviews(b.texts(spark, sf), **b.CORPUS)


_FLAGSHIP_LEX = dict(
    topics={**lx.REVIEW_TOPICS, "nouns": ["tion", "heit", "ment"]},
    positive=lx.POSITIVE_WORDS + b.CORPUS_POSITIVE, negative=lx.NEGATIVE_WORDS + b.CORPUS_NEGATIVE,
)


@query("flagship_tagged_category_coverage", with_ctes(f"""SELECT v.category, count(DISTINCT v.id) AS vendors, count(t.id) AS reviews,
    coalesce({r('avg(t.rating)')}, 0) AS avg_rating,
    CAST(round(count(DISTINCT t.vendor_id) * 100.0 / count(DISTINCT v.id)) AS BIGINT) AS coverage_pct,
    count(t.id) FILTER (t.sentiment = 'positive') AS positive, count(t.id) FILTER (t.sentiment = 'negative') AS negative,
    CAST(coalesce(sum(len(t.praises)), 0) AS BIGINT) AS praise_tags
    FROM vendors v LEFT JOIN tagged t ON t.vendor_id = v.id AND length(t.review_text) > 20
    WHERE v.category <> '' GROUP BY 1""", vendors=V, texts=T,
    tagged=b.tagged("texts", _FLAGSHIP_LEX["topics"], _FLAGSHIP_LEX["positive"], _FLAGSHIP_LEX["negative"])))
def flagship(spark, sf):
    reviews = plan.tag_reviews(b.texts(spark, sf), **_FLAGSHIP_LEX).filter(se.text_longer("review_text", 20))
    per_vendor = reviews.groupBy(F.col("vendor_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("rating").cast("decimal(12,2)")).alias("s"), F.count("rating").alias("c"),
        F.count_if(F.col("sentiment") == "positive").alias("positive"),
        F.count_if(F.col("sentiment") == "negative").alias("negative"),
        F.sum(F.size("praise_categories")).alias("praise_tags"),
    )
    joined = b.vendors(spark, sf).filter(se.filled("category")).select("id", "category").join(per_vendor, "id", "left")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return joined.groupBy("category").agg(
        F.count(F.lit(1)).alias("vendors"), F.coalesce(F.sum("n"), F.lit(0)).alias("reviews"),
        F.coalesce(ru.mean_of(F.sum("s"), F.sum("c")), F.lit(0.0)).alias("avg_rating"),
        F.round(F.count("n") * 100.0 / F.count(F.lit(1)), 0).cast("bigint").alias("coverage_pct"),
        zero("positive"), zero("negative"), zero("praise_tags"),
    )


# ---- E: filters and joins -------------------------------------------------

@query("e01_text_length_filters", with_ctes("""SELECT source, count(*) FILTER (length(review_text) > 50) AS over_50,
    count(*) FILTER (length(review_text) > 80) AS over_80, count(*) FILTER (length(trim(review_text)) < 20) AS under_20,
    count(*) FILTER (length(review_text) >= 30) AS from_30 FROM reviews GROUP BY 1""", reviews=R))
def e01(spark, sf):
    return b.reviews(spark, sf).groupBy("source").agg(
        F.count_if(se.text_longer("review_text", 50)).alias("over_50"),
        F.count_if(se.text_longer("review_text", 80)).alias("over_80"),
        F.count_if(F.length(F.trim("review_text")) < 20).alias("under_20"),
        F.count_if(F.length("review_text") >= 30).alias("from_30"),
    )


@query("e02_not_blank", with_ctes("SELECT id, email, city FROM vendors WHERE email <> '' AND city <> '' AND email IS NOT NULL", vendors=V))
def e02(spark, sf):
    return b.vendors(spark, sf).filter(se.filled("email") & se.filled("city")).select("id", "email", "city")


@query("e03_range_equality_in", with_ctes("""SELECT id, source, category, CAST(star_rating AS DOUBLE) AS star_rating FROM vendors
    WHERE star_rating BETWEEN 2 AND 4.5 AND category IN ('wedding-djs', 'wedding-planners') AND source <> 'ASIA'""", vendors=V))
def e03(spark, sf):
    return (
        b.vendors(spark, sf)
        .filter(F.col("star_rating").between(2, 4.5) & F.col("category").isin("wedding-djs", "wedding-planners")
                & (F.col("source") != "ASIA"))
        .select("id", "source", "category", F.col("star_rating").cast("double").alias("star_rating"))
    )


@query("e04_case_insensitive_patterns", """SELECT doc_id FROM documents WHERE (text ILIKE '%BEST%' OR text ILIKE '%$%' OR text ILIKE '%heit%')
    AND text ILIKE 'd%'""")
def e04(spark, sf):
    return (
        b.table(spark, sf, "documents")
        .filter(se.ilike_any("text", ["BEST", "$", "heit"]) & F.ilike(F.col("text"), F.lit("d%")))
        .select("doc_id")
    )


@query("e05_reachable_pages", """SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 < 400""")
def e05(spark, sf):
    pages = b.table(spark, sf, "events").select(
        "event_id", (F.get_json_object("props", "$.k").try_cast("bigint") * 10).alias("status")
    )
    return se.reachable_pages(pages).select("event_id")


@query("e06_short_names_dropped", "SELECT p_partkey AS id, p_name AS name FROM part WHERE length(p_name) > 9")
def e06(spark, sf):
    return b.listings(spark, sf).filter(F.length("name") > 9).select("id", "name")


@query("e07_review_vendor_join", vr("""SELECT r.id, v.name, v.category FROM reviews r JOIN vendors v ON v.id = r.vendor_id"""))
def e07(spark, sf):
    return se.with_vendor(b.reviews(spark, sf), b.vendors(spark, sf), "name", "category").select("id", "name", "category")


@query("e08_left_join_condition_in_on", vr("""SELECT v.id, count(r.id) AS n FROM vendors v LEFT JOIN reviews r
    ON r.vendor_id = v.id AND length(r.review_text) > 50 AND r.source = 'feed-O' GROUP BY 1"""))
def e08(spark, sf):
    where = se.text_longer("review_text", 50) & (F.col("source") == "feed-O")
    return se.vendors_with_totals(b.vendors(spark, sf).select("id"), b.reviews(spark, sf), where).select(
        "id", F.col("n_reviews").alias("n")
    )


@query("e09_stored_counts_default_zero", with_ctes("""SELECT v.id, count(t.id) AS stored FROM vendors v LEFT JOIN texts t
    ON t.vendor_id = v.id GROUP BY 1""", vendors=V, texts=T))
def e09(spark, sf):
    return se.vendors_with_totals(b.vendors(spark, sf).select("id"), b.texts(spark, sf)).select(
        "id", F.col("n_reviews").alias("stored")
    )


@query("e10_backfill_work_list", vr("""SELECT v.id, coalesce(v.review_count, 0) - count(r.id) AS needed FROM vendors v
    LEFT JOIN reviews r ON r.vendor_id = v.id GROUP BY v.id, v.review_count HAVING count(r.id) < coalesce(v.review_count, 0)"""))
def e10(spark, sf):
    return se.backfill(b.vendors(spark, sf), b.reviews(spark, sf)).select("id", "needed")


@query("e11_known_and_new", """SELECT l_orderkey * 10 + l_linenumber AS id,
    CASE WHEN l_partkey IN (SELECT o_custkey FROM orders) THEN 'matching' ELSE 'new' END AS kind FROM lineitem""")
def e11(spark, sf):
    incoming = b.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("k")
    )
    existing = b.table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct()
    known, new = se.split_known(incoming, existing, ["k"])
    return known.select("id", F.lit("matching").alias("kind")).unionByName(new.select("id", F.lit("new").alias("kind")))


@query("e13_attach_vendor_id", vr("""SELECT t.id AS review, v.id AS vendor_id FROM (SELECT o.o_orderkey AS id, v0.source AS source,
    v0.source_vendor_id AS sid FROM orders o JOIN vendors v0 ON v0.id = o.o_custkey) t
    JOIN vendors v ON v.source = t.source AND v.source_vendor_id = t.sid"""))
def e13(spark, sf):
    vendors = b.vendors(spark, sf)
    landed = b.table(spark, sf, "orders").join(vendors, F.col("o_custkey") == F.col("id")).select(
        F.col("o_orderkey").alias("review"), "source", "source_vendor_id"
    )
    return se.attach_vendor_id(landed, vendors).select("review", "vendor_id")


@query("e14_vendor_cards", with_ctes("""SELECT left(name, 40) AS name, coalesce(city, '') AS city, coalesce(state, '') AS state,
    replace(category, 'wedding-', '') AS category, CAST(review_count AS BIGINT) AS review_count,
    CASE WHEN star_rating = 0 THEN '-' ELSE CAST(CAST(star_rating AS DOUBLE) AS VARCHAR) END AS star_rating FROM vendors""", vendors=V))
def e14(spark, sf):
    return b.vendors(spark, sf).select(*se.vendor_card())


@query("e15_observed_totals", vr("""SELECT v.id, coalesce(o.total, v.review_count) AS review_count,
    o.total IS NOT NULL AND o.total IS DISTINCT FROM v.review_count AS count_changed
    FROM vendors v LEFT JOIN (SELECT vendor_id, count(*) AS total FROM reviews GROUP BY 1) o ON o.vendor_id = v.id"""))
def e15(spark, sf):
    seen = b.reviews(spark, sf).groupBy("vendor_id").agg(F.count(F.lit(1)).alias("total"))
    return se.observed_totals(b.vendors(spark, sf), seen).select("id", "review_count", "count_changed")


@query("e15_repeated_observations", vr("""SELECT v.id, coalesce(o.total + 1, v.review_count) AS review_count FROM vendors v
    LEFT JOIN (SELECT vendor_id, count(*) AS total FROM reviews GROUP BY 1) o ON o.vendor_id = v.id"""))
def e15b(spark, sf):
    seen = b.reviews(spark, sf).groupBy("vendor_id").agg(F.count(F.lit(1)).alias("total")).withColumn("page", F.lit(1))
    later = seen.select("vendor_id", (F.col("total") + 1).alias("total"), F.lit(2).alias("page"))
    return se.observed_totals(b.vendors(spark, sf), seen.unionByName(later), order="page").select("id", "review_count")


# ---- F: aggregations ------------------------------------------------------

@query("f01_count_by_key", with_ctes("SELECT coalesce(email, '?') = '?' AS unknown, source, count(*) AS n FROM vendors GROUP BY 1, 2", vendors=V))
def f01(spark, sf):
    flagged = b.vendors(spark, sf).withColumn("key", F.when(F.col("email").isNotNull(), F.col("source")))
    known = ru.count_by(flagged.filter("key IS NOT NULL"), "key").select(F.lit(False).alias("unknown"), F.col("key").alias("source"), "n")
    unknown = b.vendors(spark, sf).filter("email IS NULL")
    return known.unionByName(ru.count_by(unknown, "source").select(F.lit(True).alias("unknown"), "source", "n"))


@query("f01_count_by_category_missing", with_ctes("""SELECT coalesce(nullif(category, 'wedding-djs'), '?') AS category, count(*) AS n
    FROM vendors GROUP BY 1""", vendors=V))
def f01b(spark, sf):
    return ru.count_by(b.vendors(spark, sf).withColumn("category", F.nullif("category", F.lit("wedding-djs"))), "category")


@query("f02_review_kpis", with_ctes(f"""SELECT count(*) AS total_reviews, count(*) FILTER (length(review_text) > 50) AS with_text,
    count(DISTINCT vendor_id) AS vendors_with_reviews, {r('avg(rating)')} AS avg_rating, CAST(min(rating) AS DOUBLE) AS min_rating,
    CAST(max(rating) AS DOUBLE) AS max_rating FROM reviews""", reviews=R))
def f02(spark, sf):
    return ru.review_kpis(b.reviews(spark, sf))


@query("f02_vendor_kpis", with_ctes("""SELECT count(*) AS total_vendors, count(DISTINCT nullif(state, '')) AS states_covered,
    count(DISTINCT source) AS sources FROM vendors""", vendors=V))
def f02b(spark, sf):
    return ru.vendor_kpis(b.vendors(spark, sf))


@query("f03_contact_by_source", with_ctes("""SELECT source, count(*) AS total, count(*) FILTER (phone <> '') AS with_phone,
    count(*) FILTER (email <> '') AS with_email, count(starting_price_min) AS with_pricing FROM vendors GROUP BY 1""", vendors=V))
def f03(spark, sf):
    return ru.contact_by_source(b.vendors(spark, sf))


def _rollup_sql(by, body="SELECT * FROM roll", texts=False):
    return with_ctes(body, vendors=V, reviews=T if texts else R, roll=f"""SELECT v.{by}, count(DISTINCT v.id) AS vendors, count(r.id) AS reviews,
      coalesce({r('avg(r.rating)')}, 0) AS avg_rating,
      CAST(round(count(DISTINCT r.vendor_id) * 100.0 / count(DISTINCT v.id)) AS BIGINT) AS coverage_pct
      FROM vendors v LEFT JOIN reviews r ON r.vendor_id = v.id AND length(r.review_text) > 20 WHERE v.{by} <> '' GROUP BY 1""")


@query("f04_category_rollup", _rollup_sql("category"))
def f04(spark, sf):
    return ru.coverage_rollup(b.vendors(spark, sf), b.reviews(spark, sf), "category")


@query("f04_category_coverage_of_texts", _rollup_sql("category", texts=True))
def f04b(spark, sf):
    return ru.coverage_rollup(b.vendors(spark, sf), b.texts(spark, sf), "category")


@query("f05_state_rollup", _rollup_sql("state"))
def f05(spark, sf):
    return ru.coverage_rollup(b.vendors(spark, sf), b.reviews(spark, sf), "state")


@query("f05_top_states", _rollup_sql("state", "SELECT * FROM roll ORDER BY reviews DESC, state LIMIT 15"))
def f05b(spark, sf):
    return ru.top_groups(ru.coverage_rollup(b.vendors(spark, sf), b.reviews(spark, sf), "state"), "state")


_SPLIT = """SELECT l.sentiment, count(r.id) AS n, (SELECT count(*) FROM {t} WHERE sentiment <> '') AS total,
    count(r.id) * 100e0 / greatest((SELECT count(*) FROM {t} WHERE sentiment <> ''), 1) AS pct
    FROM (SELECT unnest(['positive', 'neutral', 'negative']) AS sentiment) l LEFT JOIN {t} r ON r.sentiment = l.sentiment GROUP BY 1"""


@query("f06_sentiment_split", with_ctes(_SPLIT.format(t="reviews"), reviews=R))
def f06(spark, sf):
    return ru.sentiment_split(b.reviews(spark, sf))


@query("f07_complaint_tags", with_ctes("""SELECT tag, count(*) AS n FROM (SELECT unnest(complaints) AS tag FROM tagged
    WHERE sentiment = 'negative') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""", **_TAGGED))
def f07a(spark, sf):
    flagged = plan.flag_vendor_replies(tagged(spark, sf))
    return ru.tag_frequency(flagged, "complaint_categories", ru.complaint_filter())


@query("f07_praise_tags", with_ctes("""SELECT tag, count(*) AS n FROM (SELECT unnest(praises) AS tag FROM tagged)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""", **_TAGGED))
def f07b(spark, sf):
    return ru.tag_frequency(tagged(spark, sf), "praise_categories")


@query("f08_negative_by_category", vr("""SELECT v.category, count(DISTINCT r.vendor_id) AS vendor_count, count(r.id) AS negative_count
    FROM reviews r JOIN vendors v ON v.id = r.vendor_id WHERE r.sentiment = 'negative' AND NOT coalesce(r.is_vendor_reply, false)
    AND v.category <> '' GROUP BY 1"""))
def f08(spark, sf):
    return ru.negative_by_category(b.vendors(spark, sf), b.reviews(spark, sf))


@query("f09_star_distribution", with_ctes("""SELECT CAST(s.star AS INT) AS star, concat(s.star, '★') AS label, count(r.id) AS n
    FROM (SELECT unnest([1, 2, 3, 4, 5]) AS star) s LEFT JOIN reviews r ON round(r.rating) = s.star AND r.rating BETWEEN 1 AND 5
    GROUP BY s.star""", reviews=R))
def f09(spark, sf):
    return ru.star_distribution(b.reviews(spark, sf))


@query("f10_rating_bands", with_ctes("""SELECT count(*) FILTER (rating >= 4.5) AS high, count(*) FILTER (rating >= 3.5 AND rating < 4.5) AS mid,
    count(*) FILTER (rating >= 1 AND rating < 3.5) AS low FROM reviews""", reviews=R))
def f10(spark, sf):
    return ru.rating_bands(b.reviews(spark, sf))


@query("f11_rating_by_sentiment", with_ctes(f"""SELECT sentiment, {r('avg(rating)')} AS avg_rating, count(*) FILTER (rating >= 4) AS high_rated,
    count(*) FILTER (rating <= 2) AS low_rated, count(*) AS total FROM reviews WHERE rating IS NOT NULL GROUP BY 1""", reviews=R))
def f11(spark, sf):
    return ru.rating_by_sentiment(b.reviews(spark, sf))


@query("f12_price_by_source", with_ctes(f"""SELECT source, {r('avg(starting_price_min)', 0)} AS avg_min, {r('avg(starting_price_avg)', 0)} AS avg_avg,
    CAST(min(starting_price_min) AS DOUBLE) AS lowest, CAST(max(starting_price_avg) AS DOUBLE) AS highest
    FROM vendors WHERE starting_price_min IS NOT NULL GROUP BY 1""", vendors=V))
def f12(spark, sf):
    return ru.price_by_source(b.vendors(spark, sf))


_TIERED = """SELECT *, CASE WHEN coalesce(nullif(starting_price_avg, 0), starting_price_min) IS NULL THEN 'unknown'
    WHEN coalesce(nullif(starting_price_avg, 0), starting_price_min) < 1900 THEN 'budget'
    WHEN coalesce(nullif(starting_price_avg, 0), starting_price_min) < 1950 THEN 'mid' ELSE 'premium' END AS price_tier FROM listings"""


def tiered(spark, sf):
    from reviewloom.functions.scalars import price_tier

    limits = {"ALL": (1900.0, 1950.0)}
    return b.listings(spark, sf).withColumn(
        "price_tier", price_tier("category", "starting_price_avg", "starting_price_min", limits, default="ALL")
    )


_MARKET = f"""SELECT category, count(*) AS count, count(starting_price_min) AS with_price, coalesce(min(starting_price_min), 0) AS min_price,
    coalesce(max(starting_price_min), 0) AS max_price, coalesce(avg(starting_price_avg), 0) AS avg_price,
    coalesce({b.r_even('avg(CAST(nullif(star_rating, 0) AS DECIMAL(12,2)))', 2)}, 0) AS avg_rating,
    CAST(coalesce(sum(review_count), 0) AS BIGINT) AS total_reviews,
    count(*) FILTER (price_tier = 'budget') AS tier_budget, count(*) FILTER (price_tier = 'mid') AS tier_mid,
    count(*) FILTER (price_tier = 'premium') AS tier_premium, count(*) FILTER (price_tier = 'unknown') AS tier_unknown,
    count(*) FILTER (price_tier NOT IN ('budget', 'mid', 'premium', 'unknown')) AS tier_other,
    coalesce(list_sort(list(starting_price_min) FILTER (starting_price_min IS NOT NULL))[count(starting_price_min) // 2 + 1], 0) AS median_price
    FROM tiered GROUP BY 1"""


@query("f13_market_stats", with_ctes(f"SELECT * REPLACE ({r('avg_price', 4)} AS avg_price) FROM ({_MARKET})", listings=LI, tiered=_TIERED))
def f13(spark, sf):
    return pricing.market_stats(tiered(spark, sf)).withColumn("avg_price", F.round("avg_price", 4))


_NO_CATEGORY = "SELECT * REPLACE (CASE WHEN id % 7 <> 0 THEN category END AS category) FROM listings"


@query("f13_null_category", with_ctes("""SELECT coalesce(category, 'OTHER') AS category, count(*) AS count, coalesce(list_sort(list(starting_price_min) FILTER (starting_price_min IS NOT NULL))[count(starting_price_min) // 2 + 1], 0) AS median_price
    FROM missing GROUP BY 1""", listings=LI, missing=_NO_CATEGORY))
def f13c(spark, sf):
    rows = tiered(spark, sf).withColumn("category", F.when(F.col("id") % 7 != 0, F.col("category")))
    return pricing.market_stats(rows).select("category", "count", "median_price")


@query("f15_null_category", with_ctes("""SELECT coalesce(category, 'OTHER') AS category, count(starting_price_min) AS n FROM missing WHERE starting_price_min IS NOT NULL
    GROUP BY 1 HAVING count(*) > 1""", listings=LI, missing=_NO_CATEGORY))
def f15b(spark, sf):
    rows = b.listings(spark, sf).withColumn("category", F.when(F.col("id") % 7 != 0, F.col("category")))
    return pricing.price_histogram(rows).groupBy("category").agg(F.sum("n").alias("n"))


@query("f13_upper_median", with_ctes("""SELECT source, CAST(list_sort(list(starting_price_min))[count(*) // 2 + 1] AS DOUBLE) AS median_price
    FROM vendors WHERE starting_price_min IS NOT NULL GROUP BY 1""", vendors=V))
def f13b(spark, sf):
    return pricing.upper_median(b.vendors(spark, sf), "source", "starting_price_min")


@query("f14_tier_counts", with_ctes("""SELECT category, count(*) FILTER (t = 'budget') AS budget, count(*) FILTER (t = 'mid') AS mid,
    count(*) FILTER (t = 'premium') AS premium, count(*) FILTER (t = 'unknown' OR t IS NULL) AS unknown, count(*) FILTER (t = 'vip') AS tier_other
    FROM (SELECT category, CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN 'vip' ELSE price_tier END AS t FROM tiered) GROUP BY 1""",
    listings=LI, tiered=_TIERED))
def f14(spark, sf):
    odd = F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 13 == 0, "vip").otherwise(F.col("price_tier"))
    return pricing.tier_counts(tiered(spark, sf).withColumn("price_tier", odd))


@query("f15_price_histogram", with_ctes("""SELECT source, CAST(floor((p - lo) / step) AS BIGINT) AS bin,
    min(lo + floor((p - lo) / step) * step) AS bin_start, count(*) AS n FROM (
      SELECT source, CAST(starting_price_min AS DOUBLE) AS p, min(CAST(starting_price_min AS DOUBLE)) OVER w AS lo, count(*) OVER w AS c,
      greatest(1e0, (max(CAST(starting_price_min AS DOUBLE)) OVER w - min(CAST(starting_price_min AS DOUBLE)) OVER w) / 5) AS step
      FROM vendors WHERE starting_price_min IS NOT NULL WINDOW w AS (PARTITION BY source)) WHERE c > 1 GROUP BY 1, 2""", vendors=V))
def f15(spark, sf):
    return pricing.price_histogram(b.vendors(spark, sf), "source")


@query("f16_reviews_per_vendor", vr("""SELECT v.name, v.source, count(r.id) AS reviews FROM reviews r JOIN vendors v ON v.id = r.vendor_id
    GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""))
def f16(spark, sf):
    return ru.reviews_per_vendor(b.vendors(spark, sf), b.reviews(spark, sf))


@query("f17_best_rated", vr("""SELECT v.id, left(v.name, 40) AS name, coalesce(v.city, '') AS city, CAST(v.star_rating AS DOUBLE) AS star_rating,
    count(r.id) AS stored FROM vendors v JOIN reviews r ON r.vendor_id = v.id AND length(r.review_text) > 50
    WHERE v.star_rating >= 4 GROUP BY v.id, v.name, v.city, v.star_rating HAVING count(r.id) >= 8
    ORDER BY star_rating DESC, stored DESC, v.id LIMIT 10"""))
def f17(spark, sf):
    return ru.best_rated(b.vendors(spark, sf), b.reviews(spark, sf), min_rating=4.0, min_stored=8)


@query("f18_claimed_vs_stored", vr("""SELECT v.id, v.name, CAST(v.review_count AS BIGINT) AS claimed, count(r.id) AS stored
    FROM vendors v LEFT JOIN reviews r ON r.vendor_id = v.id WHERE v.review_count > 100 GROUP BY 1, 2, 3"""))
def f18(spark, sf):
    return ru.claimed_vs_stored(b.vendors(spark, sf), b.reviews(spark, sf))


@query("f19_review_metrics_by_source", with_ctes(f"""SELECT source, count(*) AS vendors, CAST(sum(review_count) AS BIGINT) AS total_reviews,
    {r('avg(star_rating)')} AS avg_rating, {r('avg(review_count)', 0)} AS avg_reviews FROM vendors WHERE review_count > 0 GROUP BY 1""", vendors=V))
def f19(spark, sf):
    return ru.review_metrics_by_source(b.vendors(spark, sf))


@query("f19_claimed_total", with_ctes("SELECT CAST(sum(review_count) AS BIGINT) AS claimed_reviews FROM vendors", vendors=V))
def f19b(spark, sf):
    return ru.claimed_total(b.vendors(spark, sf))


@query("f20_text_by_source", with_ctes("""SELECT source, count(*) AS reviews, count(*) FILTER (length(review_text) > 50) AS with_text,
    count(DISTINCT vendor_id) AS vendors FROM reviews GROUP BY 1""", reviews=R))
def f20(spark, sf):
    return ru.text_by_source(b.reviews(spark, sf))


@query("f21_review_presence", with_ctes("""SELECT count(*) AS vendors, count(t.vendor_id) AS with_reviews,
    count(*) - count(t.vendor_id) AS without_reviews FROM vendors v LEFT JOIN (SELECT DISTINCT vendor_id FROM texts) t ON t.vendor_id = v.id""",
    vendors=V, texts=T))
def f21(spark, sf):
    return ru.review_presence(b.vendors(spark, sf), b.texts(spark, sf))


@query("f22_sources", with_ctes("SELECT DISTINCT coalesce(source, '?') AS source FROM vendors", vendors=V))
def f22(spark, sf):
    return ru.source_list(b.vendors(spark, sf))


@query("f23_bar_widths", with_ctes("""SELECT state, n, greatest(n * 100e0 / max(n) OVER (), 0.5e0) AS width
    FROM (SELECT state, count(*) AS n FROM vendors GROUP BY 1)""", vendors=V))
def f23(spark, sf):
    return ru.bar_width(ru.count_by(b.vendors(spark, sf), "state"), "n", 0.5)


@query("f24_extraction_summary", with_ctes("""SELECT source, count(*) AS found, count(*) FILTER (email IS NOT NULL) AS successful,
    count(*) FILTER (email IS NULL) AS failed, count(*) FILTER (phone <> '') AS with_phone, count(*) FILTER (email <> '') AS with_email,
    count(*) FILTER (star_rating > 0) AS with_rating, count(starting_price_min) AS with_pricing FROM vendors GROUP BY 1""", vendors=V))
def f24(spark, sf):
    return ru.extraction_summary(b.vendors(spark, sf).withColumn("scrape_success", F.col("email").isNotNull()))


# ---- G: sorts and top lists -----------------------------------------------

@query("g01_most_reviewed", with_ctes("""SELECT id, name, CAST(review_count AS BIGINT) AS review_count FROM vendors WHERE source = 'ASIA'
    ORDER BY vendors.review_count DESC NULLS FIRST, id LIMIT 10""", vendors=V))
def g01(spark, sf):
    return (
        b.vendors(spark, sf).filter(F.col("source") == "ASIA").orderBy(F.col("review_count").desc_nulls_first(), "id").limit(10)
        .select("id", "name", F.col("review_count").cast("bigint").alias("review_count"))
    )


@query("g02_top_per_category", with_ctes("""SELECT id, category, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY category
    ORDER BY coalesce(review_count, 0) DESC, name, id) AS rank FROM listings) WHERE rank <= 5""", listings=LI))
def g02(spark, sf):
    return pricing.top_per_category(b.listings(spark, sf)).select("id", "category", "rank")


@query("g03_catalogue_order", with_ctes("""SELECT id, category, CAST(row_number() OVER (PARTITION BY category
    ORDER BY CASE WHEN star_rating > 0 THEN star_rating ELSE 99999 END, name, id) AS INT) AS place FROM listings""", listings=LI))
def g03(spark, sf):
    catalogue = b.listings(spark, sf).withColumn("market_avg", F.nullif("star_rating", F.lit(0.0)))
    return pricing.catalogue_order(catalogue, "place", ["id"]).select("id", "category", "place")


@query("g04_work_list", with_ctes("""SELECT id, CAST(review_count AS BIGINT) AS review_count FROM vendors WHERE vendors.review_count > 0
    ORDER BY vendors.review_count DESC, id""", vendors=V))
def g04(spark, sf):
    return (
        b.vendors(spark, sf).filter(F.col("review_count") > 0)
        .select("id", F.col("review_count").cast("bigint").alias("review_count"))
        .orderBy(F.col("review_count").desc(), "id")
    )


@query("g05_first_per_group", with_ctes("""SELECT id, state, category FROM (SELECT *, row_number() OVER (PARTITION BY state, category ORDER BY id)
    AS rn FROM vendors) WHERE rn <= 5""", vendors=V))
def g05(spark, sf):
    return top_by_key(b.vendors(spark, sf), ["state", "category"], ["id"], 5).select("id", "state", "category")


@query("g06_random_sample", with_ctes("""SELECT id, CAST(rating AS DOUBLE) AS rating, review_text AS text FROM reviews WHERE sentiment = 'negative' AND length(review_text) > 40
    ORDER BY md5(concat('7:', CAST(id AS VARCHAR))), id LIMIT 8""", reviews=R))
def g06(spark, sf):
    negative = b.reviews(spark, sf).filter((F.col("sentiment") == "negative") & se.text_longer("review_text", 40))
    return se.seeded_sample(negative, ["id"], 8, 7).select("id", F.col("rating").cast("double").alias("rating"), F.col("review_text").alias("text"))


@query("g07_recent_runs", """SELECT o_orderkey AS id, o_orderdate AS started_at FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC LIMIT 10""")
def g07(spark, sf):
    from reviewloom.sources.sinks import recent_runs

    runs = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("started_at"))
    return recent_runs(runs)


# ---- J: audits ------------------------------------------------------------

@query("j01_vendor_coverage", with_ctes("""SELECT field, n, total, CAST(n * 100 // total AS BIGINT) AS pct FROM (
    SELECT unnest(['phone', 'email', 'website', 'pricing', 'rating', 'reviews', 'city']) AS field, total,
      unnest([a, b2, c, d, e, f, g]) AS n FROM (SELECT count(*) AS total, count(*) FILTER (phone <> '') AS a,
      count(*) FILTER (email <> '') AS b2, count(*) FILTER (website_url <> '') AS c,
      count(*) FILTER (starting_price_min IS NOT NULL OR starting_price_avg IS NOT NULL) AS d,
      count(*) FILTER (star_rating > 0) AS e, count(*) FILTER (review_count > 0) AS f, count(*) FILTER (city <> '') AS g FROM vendors))""", vendors=V))
def j01(spark, sf):
    return audits.vendor_coverage(b.vendors(spark, sf))


@query("j02_fill_rate", with_ctes("""SELECT field, n, total, n * 100e0 / total AS pct FROM (SELECT unnest(['name', 'star_rating', 'review_count',
    'starting_price_avg']) AS field, total, unnest([a, b2, c, d]) AS n FROM (SELECT count(*) AS total, count(*) FILTER (name <> '') AS a,
    count(*) FILTER (star_rating <> 0) AS b2, count(*) FILTER (review_count <> 0) AS c, count(*) FILTER (starting_price_avg <> 0) AS d FROM listings))""",
    listings=LI))
def j02(spark, sf):
    return audits.fill_rate(b.listings(spark, sf), ["name", "star_rating", "review_count", "starting_price_avg"])


@query("j03_rating_range", with_ctes("""SELECT count(nullif(star_rating, 0)) AS rated, CAST(min(nullif(star_rating, 0)) AS DOUBLE) AS lowest,
    CAST(max(nullif(star_rating, 0)) AS DOUBLE) AS highest FROM listings""", listings=LI))
def j03(spark, sf):
    return audits.rating_range(b.listings(spark, sf))


@query("j04_suspicious_positives", with_ctes("""SELECT id FROM tagged WHERE sentiment = 'positive' AND (review_text ILIKE '%schaft%'
    OR review_text ILIKE '%NICHT%' OR review_text ILIKE '%ou%')""", **_TAGGED))
def j04(spark, sf):
    return se.suspicious_positives(tagged(spark, sf), ["schaft", "NICHT", "ou"]).select("id")


@query("j05_likely_replies", """SELECT conv_id, turn FROM (SELECT conv_id, turn, CASE role WHEN 'assistant' THEN concat('Hi there, ', text,
    ' thank you so much') ELSE text END AS t FROM conversations) WHERE t ILIKE 'hi %' AND (t ILIKE '%thank you for your review%'
    OR t ILIKE '%thank you so much%' OR t ILIKE '%thanks for the review%')""")
def j05(spark, sf):
    text = F.when(F.col("role") == "assistant", F.concat(F.lit("Hi there, "), "text", F.lit(" thank you so much"))).otherwise(F.col("text"))
    return se.likely_replies(b.table(spark, sf, "conversations").select("conv_id", "turn", text.alias("review_text"))).select("conv_id", "turn")


@query("j06_contradictions", with_ctes("""SELECT count(*) FILTER (sentiment = 'negative' AND rating >= 5) AS five_star_negative,
    count(*) FILTER (sentiment = 'positive' AND rating <= 2) AS low_star_positive FROM reviews""", reviews=R))
def j06(spark, sf):
    return audits.contradictions(b.reviews(spark, sf))


@query("j07_j08_tag_audit", with_ctes("""SELECT count(*) FILTER (sentiment = 'negative' AND rating >= 5) AS five_star_negative,
    count(*) FILTER (sentiment = 'positive' AND rating <= 2) AS low_star_positive,
    count(*) FILTER (length(trim(review_text)) < 20) AS short_texts, count(*) FILTER (len(complaints) > 0 OR len(praises) > 0) AS with_any_topic
    FROM tagged""", **_TAGGED))
def j07(spark, sf):
    return audits.tag_audit(tagged(spark, sf))


@query("j07_any_tag", with_ctes("""SELECT sentiment, count(*) AS n, count(*) FILTER (len(complaints) > 0 OR len(praises) > 0) AS tagged FROM tagged GROUP BY 1""", **_TAGGED))
def j07b(spark, sf):
    return tagged(spark, sf).groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"), F.count_if(ru.any_tag()).alias("tagged"))


@query("j09_final_distribution", with_ctes("""SELECT coalesce(nullif(sentiment, ''), '(empty)') AS sentiment, count(*) AS n,
    count(*) FILTER (is_vendor_reply) AS vendor_replies FROM reviews GROUP BY 1""", reviews=R))
def j09(spark, sf):
    return audits.sentiment_distribution(b.reviews(spark, sf))


@query("j10_orphan_reviews", """SELECT user_id AS vendor_id, count(*) AS n FROM events WHERE user_id NOT IN
    (SELECT s_suppkey FROM supplier) GROUP BY 1""")
def j10a(spark, sf):
    child = b.table(spark, sf, "events").select(F.col("user_id").alias("vendor_id"))
    lost = audits.orphans(child, b.table(spark, sf, "supplier"), "vendor_id", "s_suppkey")
    return lost.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("n"))


@query("j10_duplicate_keys", """SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def j10b(spark, sf):
    return audits.duplicate_keys(b.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query("j10_review_violations", with_ctes("""SELECT 'unique_review_key' AS check, count(*) AS violations FROM (SELECT source, source_review_id FROM texts
    GROUP BY 1, 2 HAVING count(*) > 1) UNION ALL SELECT 'vendor_exists', count(*) FROM texts WHERE vendor_id NOT IN (SELECT id FROM vendors)
    UNION ALL SELECT 'sentiment_label', count(*) FROM texts WHERE CASE rating WHEN 5 THEN 'positive' WHEN 1 THEN 'bad' ELSE '' END
      NOT IN ('', 'positive', 'neutral', 'negative')
    UNION ALL SELECT 'text_present', count(*) FROM texts WHERE review_text IS NULL""", texts=T, vendors=V))
def j10c(spark, sf):
    label = F.when(F.col("rating") == 5, "positive").when(F.col("rating") == 1, "bad").otherwise("")
    return audits.review_violations(b.texts(spark, sf).withColumn("sentiment", label), b.vendors(spark, sf))


# ---- L: insights ----------------------------------------------------------

_L = dict(
    **_TAGGED, vendors=V,
    complaints="SELECT tag, count(*) AS n FROM (SELECT unnest(complaints) AS tag FROM tagged WHERE sentiment = 'negative') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    praise="SELECT tag, count(*) AS n FROM (SELECT unnest(praises) AS tag FROM tagged) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    split=_SPLIT.format(t="tagged"),
)


def _roll_cte(by):
    return f"""SELECT v.{by}, count(DISTINCT v.id) AS vendors, count(t.id) AS reviews, coalesce({r('avg(t.rating)')}, 0) AS avg_rating,
      CAST(round(count(DISTINCT t.vendor_id) * 100.0 / count(DISTINCT v.id)) AS BIGINT) AS coverage_pct
      FROM vendors v LEFT JOIN tagged t ON t.vendor_id = v.id AND length(t.review_text) > 20 WHERE v.{by} <> '' GROUP BY 1"""


def _fmt(template, *args):
    pieces, out = template.replace("%%", "\0").split("%s"), []
    for i, piece in enumerate(pieces):
        if piece:
            out.append(b.q(piece.replace("\0", "%")))
        if i < len(args):
            out.append(f"CAST({args[i]} AS VARCHAR)")
    return "concat(" + ", ".join(out) + ")"


_PCT = "CAST(CAST(round_even({x}, 0) AS INT) AS VARCHAR) || '%'"
_TOP = f"""SELECT 1 AS rule_no, 'warning' AS type, {_fmt(insights.TOP_COMPLAINT, 'tag', _PCT.format(x='n * 100e0 / greatest(neg, 1)'), 'neg')} AS text
    FROM (SELECT tag, n, (SELECT n FROM split WHERE sentiment = 'negative') AS neg FROM complaints ORDER BY n DESC, tag LIMIT 1)"""
_GAP = f"""SELECT 2 AS rule_no, 'warning' AS type, {_fmt(insights.COVERAGE_GAP, 'names')} AS text FROM (
    SELECT string_agg(replace(category, 'wedding-', ''), ', ' ORDER BY category) AS names FROM categories WHERE coverage_pct = 0) WHERE names IS NOT NULL"""
_STATES = f"""SELECT 3 AS rule_no, 'info' AS type, {_fmt(insights.STATE_GAP, 'n', 'vendors', 'names')} AS text FROM (
    SELECT count(*) AS n, CAST(sum(vendors) AS BIGINT) AS vendors, array_to_string(list_sort(list(state))[1:5], ', ') AS names
    FROM states WHERE reviews = 0 AND vendors > 20) WHERE n > 0"""
_SKEW = f"""SELECT 4 AS rule_no, 'info' AS type, {_fmt(insights.POSITIVE_SKEW, _PCT.format(x='pct'))} AS text FROM split
    WHERE sentiment = 'positive' AND pct > {{above}}"""
_PRAISED = f"""SELECT 5 AS rule_no, 'success' AS type, {_fmt(insights.PRAISED_QUALITY, 'rank', 'n')} AS text FROM (
    SELECT tag, n, row_number() OVER (ORDER BY n DESC, tag) AS rank FROM praise) WHERE tag = '{{tag}}'"""


def _spot(marker, rule_no, third):
    return f"""SELECT {rule_no} AS rule_no, 'success' AS type, {_fmt(insights.CATEGORY_SPOTLIGHTS[marker], 'vendors', 'reviews', third)} AS text
      FROM (SELECT * FROM categories WHERE contains(category, '{marker}') ORDER BY reviews DESC, category LIMIT 1)"""


_RATING_TEXT = "CASE WHEN avg_rating = 0 THEN 'N/A' ELSE CAST(avg_rating AS VARCHAR) END"


@query("l01_top_complaint", with_ctes(_TOP, **_L))
def l01(spark, sf):
    t = materialize(dash.slim(plan.flag_vendor_replies(tagged(spark, sf))))
    return insights.top_complaint(ru.tag_frequency(t, "complaint_categories", ru.complaint_filter()), ru.sentiment_split(t))


_UNCOVERED = dict(vendors=V, categories="""SELECT v.category, count(*) AS vendors, CAST(round(count(s.s_suppkey) * 100.0 / count(*)) AS BIGINT)
    AS coverage_pct FROM vendors v LEFT JOIN supplier s ON s.s_suppkey = v.id AND v.category = 'wedding-djs' WHERE v.category <> '' GROUP BY 1""")


@query("l02_coverage_gap", with_ctes(_GAP, **_UNCOVERED))
def l02(spark, sf):
    vendors = b.vendors(spark, sf).filter(se.filled("category"))
    covered = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sid"))
    joined = vendors.join(covered, (F.col("id") == F.col("sid")) & (F.col("category") == "wedding-djs"), "left")
    cats = joined.groupBy("category").agg(
        F.round(F.count("sid") * 100.0 / F.count(F.lit(1)), 0).cast("bigint").alias("coverage_pct")
    )
    return insights.coverage_gap(cats)


@query("l03_state_gap", with_ctes(_STATES, vendors=V, states="""SELECT v.state, count(DISTINCT v.id) AS vendors, count(e.event_id) AS reviews
    FROM vendors v LEFT JOIN events e ON e.user_id = v.id AND v.source = 'ASIA' GROUP BY 1"""))
def l03(spark, sf):
    per_vendor = b.table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    v = b.vendors(spark, sf)
    joined = v.join(per_vendor, (F.col("user_id") == F.col("id")) & (F.col("source") == "ASIA"), "left")
    states = joined.groupBy("state").agg(F.count(F.lit(1)).alias("vendors"), F.coalesce(F.sum("n"), F.lit(0)).alias("reviews"))
    return insights.state_gap(states)


@query("l04_positive_skew", with_ctes(_SKEW.format(above=10), **_L))
def l04(spark, sf):
    return insights.positive_skew(ru.sentiment_split(tagged(spark, sf)), above=10.0)


@query("l05_praised_quality", with_ctes(_PRAISED.format(tag="nouns"), **_L))
def l05(spark, sf):
    return insights.praised_quality(ru.tag_frequency(tagged(spark, sf), "praise_categories"), tag="nouns")


@query("l06_category_spotlight", with_ctes(_spot("djs", 6, _RATING_TEXT) + " UNION ALL " + _spot("planners", 7, "coverage_pct"),
       **_L, categories=_roll_cte("category")))
def l06(spark, sf):
    cats = ru.coverage_rollup(b.vendors(spark, sf), b.texts(spark, sf), "category")
    return insights.category_spotlight(cats, "djs", 6, "avg_rating").unionByName(
        insights.category_spotlight(cats, "planners", 7, "coverage_pct")
    )


_INSIGHTS = " UNION ALL ".join(f"SELECT * FROM ({s})" for s in (
    _TOP, _GAP, _STATES, _SKEW.format(above=90), _PRAISED.format(tag="transparency"), _spot("djs", 6, _RATING_TEXT), _spot("planners", 7, "coverage_pct")))


@query("l07_all_insights", with_ctes(_INSIGHTS, **_L, categories=_roll_cte("category"), states=_roll_cte("state")))
def l07(spark, sf):
    space = Workspace(spark, "insights")
    return dash.insight_rows(dash.gather(b.vendors(spark, sf), dash.slim(plan.flag_vendor_replies(tagged(spark, sf))), space))


@query("m04_vendor_search", with_ctes("""SELECT id, name, CAST(star_rating AS DOUBLE) AS star_rating,
    (SELECT count(*) FROM vendors WHERE contains(lower(name), 'customer#0000') AND source = 'ASIA' AND vendors.star_rating >= 2) AS total
    FROM vendors WHERE contains(lower(name), 'customer#0000') AND source = 'ASIA' AND vendors.star_rating >= 2
    ORDER BY vendors.star_rating DESC, id LIMIT 20 OFFSET 20""", vendors=V))
def m04(spark, sf):
    page, total = se.search_vendors(
        b.vendors(spark, sf), "customer#0000", {"source": "ASIA"}, 2.0, [F.col("star_rating").desc(), "id"], page=2
    )
    return page.select("id", "name", F.col("star_rating").cast("double").alias("star_rating"), total.scalar().alias("total"))


@query("m04_keyset_paging", with_ctes("""SELECT id, name, CAST(star_rating AS DOUBLE) AS star_rating, review_count, CAST(1 + (n - 1) // 20 AS INT) AS page, total FROM (
    SELECT *, row_number() OVER (ORDER BY vendors.star_rating DESC NULLS LAST, vendors.review_count NULLS LAST, id) AS n, count(*) OVER () AS total
    FROM vendors WHERE contains(lower(name), '1')) WHERE n <= 60""", vendors=V))
def m04b(spark, sf):
    """Three pages of a search, each started after the last row of the one before, with ties in the sort columns."""
    vendors, pages, after = b.vendors(spark, sf).withColumn("review_count", F.col("review_count").cast("int")), [], None
    for number in (1, 2, 3):
        page = se.search_page(vendors, "1", order=[("star_rating", True), ("review_count", False), ("id", False)], after=after)
        pages += [(r["id"], r["name"], float(r["star_rating"]), r["review_count"], number, page.total) for r in page.rows]
        after = page.after
        if after is None:
            break
    return spark.createDataFrame(pages, "id BIGINT, name STRING, star_rating DOUBLE, review_count INT, page INT, total BIGINT")


def _section(name, order, columns, source):
    """Rows of a section as JSON, numbered in their order."""
    fields = ", ".join(f"{c.rsplit(' AS ', 1)[-1]}: {c.rsplit(' AS ', 1)[0]}" for c in columns)
    return f"SELECT '{name}' AS section, row_number() OVER (ORDER BY {order}) AS place, to_json({{{fields}}}) AS record FROM ({source})"


_ROLLED = ["vendors", "reviews", "avg_rating", "coverage_pct"]
_DOCUMENT = [
    _section("vendor_kpis", "1", ["total_vendors", "states_covered", "sources"],
             "SELECT count(*) AS total_vendors, count(DISTINCT nullif(state, '')) AS states_covered, count(DISTINCT source) AS sources FROM vendors"),
    _section("review_kpis", "1", ["total_reviews", "with_text", "vendors_with_reviews", "avg_rating", "min_rating", "max_rating"],
             f"""SELECT count(*) AS total_reviews, count(*) FILTER (length(review_text) > 50) AS with_text, count(DISTINCT vendor_id) AS vendors_with_reviews,
             {r('avg(rating)')} AS avg_rating, min(rating) AS min_rating, max(rating) AS max_rating FROM flagged"""),
    _section("sentiment", "list_position(['positive', 'neutral', 'negative'], sentiment)", ["sentiment", "n", "total", "pct"], _SPLIT.format(t="flagged")),
    _section("rating_dist", "star", ["star", "label", "n"], """SELECT s.star, concat(CAST(s.star AS VARCHAR), '★') AS label, count(f.id) AS n
             FROM (SELECT unnest([1, 2, 3, 4, 5]) AS star) s LEFT JOIN flagged f ON f.rating BETWEEN 1 AND 5 AND round(f.rating) = s.star GROUP BY 1"""),
    _section("categories", "category", ["category", *_ROLLED], "SELECT * FROM categories"),
    _section("top_states", "reviews DESC, state", ["state", *_ROLLED], "SELECT * FROM states ORDER BY reviews DESC, state LIMIT 15"),
    _section("all_states", "state", ["state", *_ROLLED], "SELECT * FROM states"),
    _section("complaints", "n DESC, tag", ["tag", "n"], "SELECT * FROM complaints"),
    _section("negative_by_category", "category", ["category", "vendor_count", "negative_count"], """SELECT category, count(DISTINCT v.id) AS vendor_count, count(*) AS negative_count
             FROM flagged f JOIN vendors v ON v.id = f.vendor_id WHERE f.sentiment = 'negative' AND NOT f.is_vendor_reply AND category <> '' GROUP BY 1"""),
    _section("praise", "n DESC, tag", ["tag", "n"], "SELECT * FROM praise"),
    _section("top_vendors", "review_count DESC NULLS FIRST, id", ["left(name, 40) AS name", "coalesce(city, '') AS city", "coalesce(state, '') AS state", "replace(category, 'wedding-', '') AS category",
             "CAST(review_count AS BIGINT) AS review_count", "coalesce(CAST(CAST(nullif(star_rating, 0) AS DOUBLE) AS VARCHAR), '-') AS star_rating"],
             "SELECT * FROM vendors WHERE source = 'ASIA' ORDER BY vendors.review_count DESC NULLS FIRST, id LIMIT 10"),
    _section("best_vendors", "star_rating DESC, stored DESC, id", ["id", "left(name, 40) AS name", "coalesce(city, '') AS city", "CAST(star_rating AS DOUBLE) AS star_rating", "stored"],
             """SELECT v.*, stored FROM vendors v JOIN (SELECT vendor_id, count(*) AS stored FROM flagged WHERE length(review_text) > 50 GROUP BY 1 HAVING count(*) >= 50) f
             ON f.vendor_id = v.id WHERE source = 'ASIA' AND v.star_rating >= 4.8 ORDER BY v.star_rating DESC, stored DESC, v.id LIMIT 10"""),
    _section("insights", "rule_no", ["rule_no", "type", "text"], "SELECT * FROM insight"),
]
_FLAGGED = f"SELECT *, {_DEFAULT_REPLY.replace('lower(text)', 'lower(review_text)')} AS is_vendor_reply FROM tagged"


@query("dashboard_document", with_ctes(
    "SELECT section, place, field, try_cast(value AS DOUBLE) AS number, CASE WHEN try_cast(value AS DOUBLE) IS NULL THEN value END AS text FROM (SELECT section, place, field, "
    "json_extract_string(record, '$.\"' || field || '\"') AS value FROM (SELECT *, unnest(json_keys(record)) AS field FROM document))",
    **_TAGGED, vendors=V, flagged=_FLAGGED, **{k: v.replace("FROM tagged", "FROM flagged").replace("JOIN tagged", "JOIN flagged") for k, v in dict(
        complaints=_L["complaints"].replace("sentiment = 'negative'", "sentiment = 'negative' AND NOT is_vendor_reply"), praise=_L["praise"], split=_L["split"],
        categories=_roll_cte("category"), states=_roll_cte("state"), insight=_INSIGHTS).items()}, document=" UNION ALL ".join(_DOCUMENT)))
def dashboard_document(spark, sf):
    """The whole document, parsed again: a row for every field of every record."""
    t = plan.flag_vendor_replies(tagged(spark, sf))
    doc = dash.document(b.vendors(spark, sf), t, "ASIA")
    parts = doc.select(F.explode(F.from_json("value", "map<string,string>")).alias("section", "body"))
    listed = F.when(F.startswith("body", F.lit("[")), F.col("body")).otherwise(F.concat(F.lit("["), F.col("body"), F.lit("]")))
    records = parts.select("section", F.posexplode(F.from_json(listed, "array<map<string,string>>")).alias("pos", "record"))
    fields = records.select("section", (F.col("pos") + 1).cast("bigint").alias("place"), F.explode("record").alias("field", "value"))
    number = F.col("value").try_cast("double")
    return fields.select("section", "place", "field", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"))
