"""Listing, detail and review payloads (JSON text) to rows with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions import markup
from reviewloom.functions.scalars import (
    cut_to,
    col_of,
    contains_any,
    first_filled,
    first_non_zero,
    iso_date,
    money_to_number,
    named_structs,
    non_blank,
    non_zero,
    price_range_avg,
    price_range_min,
    slugify,
    simple_slug,
    source_vendor_id,
    starting_price,
)
from reviewloom.operators.dedup import first_by_key
from reviewloom.session import Workspace

JSON_LD_LIST = """`@type` STRING, itemListElement ARRAY<STRUCT<item: STRUCT<
  name: STRING, aggregateRating: STRUCT<ratingValue: STRING, reviewCount: STRING>,
  priceRange: STRING, `@id`: STRING, url: STRING, description: STRING>>>"""
JSON_LD_OFFER = "`@type` STRING, name STRING, offers STRING, priceRange STRING"

LISTING_STATE = """search STRUCT<total: BIGINT, vendors: ARRAY<STRUCT<
  id: STRING, vendorId: STRING, name: STRING, adTier: STRING, vendorTier: STRING, claimedStatus: STRING,
  serviceArea: STRING, location: STRUCT<city: STRING, state: STRING>, startingPriceRange: STRING,
  reviewsCount: BIGINT, stars: DOUBLE, starCount: DOUBLE, reviewSummary: STRUCT<count: BIGINT, overallRating: DOUBLE>,
  deals: ARRAY<STRUCT<description: STRING>>, hasAward: BOOLEAN, siteUrls: ARRAY<STRUCT<uri: STRING>>>>>"""

_MONEY = "STRUCT<min: STRUCT<value: DOUBLE>, average: STRUCT<value: DOUBLE>>"
_VENDOR = f"""STRUCT<id: STRING, vendorId: STRING, name: STRING,
  phones: ARRAY<STRUCT<number: STRING, type: STRING>>, phone: STRING,
  emails: ARRAY<STRUCT<address: STRING>>, email: STRING, websiteUrl: STRING, displayWebsiteUrl: STRING,
  location: STRUCT<city: STRING, state: STRING, serviceArea: STRING, address: STRUCT<city: STRING, state: STRING>>,
  serviceArea: STRING, pricing: STRUCT<noSeason: {_MONEY}, peak: {_MONEY}, offPeak: {_MONEY}>,
  startingPriceRange: STRING, reviewSummary: STRUCT<count: BIGINT, overallRating: DOUBLE>, reviewsCount: BIGINT,
  starCount: DOUBLE, stars: DOUBLE, description: STRING, headline: STRING, adTier: STRING, vendorTier: STRING,
  claimedStatus: STRING, deals: STRUCT<items: ARRAY<STRUCT<description: STRING>>>,
  social: STRUCT<facebookUrl: STRING, instagramUsername: STRING, pinterestUsername: STRING>,
  socialMedia: ARRAY<STRUCT<code: STRING, value: STRING>>, awards: ARRAY<STRUCT<name: STRING>>,
  orgDetails: STRUCT<startYear: INT, totalMembers: INT, travelAvailability: INT>>"""
DETAIL_STATE = f"vendor STRUCT<vendorRaw: {_VENDOR}, vendor: {_VENDOR}>"

_NEXT_VENDOR = """STRUCT<id: STRING, vendorId: STRING, slug: STRING, name: STRING, phone: STRING,
  social: STRUCT<web: STRING>, websiteUrl: STRING, city: STRING, stateProvince: STRING,
  address: STRUCT<city: STRING, stateProvince: STRING>, startingPriceCents: DOUBLE, startingPrice: DOUBLE,
  prices: ARRAY<STRUCT<minCents: DOUBLE>>, priceTier: STRING, reviewCount: BIGINT, reviewsCount: BIGINT,
  averageReviewsRate: DOUBLE, starRating: DOUBLE, categories: ARRAY<STRUCT<name: STRING>>,
  photos: ARRAY<STRUCT<url: STRING>>>"""
NEXT_DATA = f"""props STRUCT<pageProps: STRUCT<
  searchResults: STRUCT<vendors: ARRAY<{_NEXT_VENDOR}>>,
  vendorSearchData: STRUCT<vendorSearch: STRUCT<vendors: ARRAY<{_NEXT_VENDOR}>>>,
  adjacentVendors: ARRAY<{_NEXT_VENDOR}>>>"""

REVIEW_PAGE = """reviews STRUCT<totalCount: BIGINT, pageInfo: STRUCT<hasNextPage: BOOLEAN>, nodes: ARRAY<STRUCT<
  id: STRING, createdAt: STRING, title: STRING, comment: STRUCT<content: STRING>,
  ratings: ARRAY<STRUCT<value: DOUBLE, name: STRING>>, reviewer: STRUCT<firstName: STRING, lastName: STRING>>>>"""


# ---- JSON-LD --------------------------------------------------------------

def json_ld_vendors(pages: DataFrame, key: Sequence[str], html: str = "html", min_name: int = 2) -> DataFrame:
    """Vendor rows of the JSON-LD item lists of a page; broken blocks are skipped."""
    parsed = F.transform(markup.json_ld_blocks(html), lambda block: F.from_json(block, JSON_LD_LIST))
    # Chosen inside the list: a filter after the explode would parse every block twice.
    lists = pages.select(*key, F.explode(F.filter(parsed, lambda d: d["@type"] == "ItemList")).alias("l"))
    items = lists.select(*key, F.posexplode("l.itemListElement").alias("position", "e")).select(
        *key, "position", F.col("e.item").alias("b")
    )
    rows = items.filter(F.col("b").isNotNull()).select(
        *key, "position",
        first_filled("b.name").alias("name"),
        F.coalesce(F.col("b.aggregateRating.ratingValue").try_cast("double"), F.lit(0.0)).alias("star_rating"),
        F.coalesce(F.col("b.aggregateRating.reviewCount").try_cast("bigint"), F.lit(0)).alias("review_count"),
        first_filled("b.priceRange").alias("starting_price_range"),
        first_filled("b.`@id`", "b.url").alias("source_url"),
        first_filled("b.description").alias("description"),
    )
    return rows.filter(F.length("name") >= min_name).withColumns(
        {
            "starting_price_min": price_range_min("starting_price_range"),
            "starting_price_avg": price_range_avg("starting_price_range"),
        }
    )


def json_ld_offers(
    pages: DataFrame, key: Sequence[str], html: str = "html", types: Sequence[str] = ("Product", "Service", "LocalBusiness")
) -> DataFrame:
    """(type, name, offers, price range) of the products and services of a page."""
    parsed = F.transform(markup.json_ld_blocks(html), lambda block: F.from_json(block, JSON_LD_OFFER))
    offers = pages.select(*key, F.explode(F.filter(parsed, lambda d: d["@type"].isin(*types))).alias("o"))
    return offers.select(
        *key, F.col("o.`@type`").alias("type"), "o.name", "o.offers", F.col("o.priceRange").alias("price_range")
    )


# ---- listing and detail states -------------------------------------------

def listing_vendors(payloads: DataFrame, payload: str = "payload", base_url: str = "", *keep: str) -> DataFrame:
    """Vendor rows of a listing state; the url is the first site url or is built from the name."""
    state = F.from_json(payload, LISTING_STATE)
    rows = payloads.select(*keep, F.explode(state["search"]["vendors"]).alias("v"))
    city, region = first_filled("v.location.city"), first_filled("v.location.state")
    place = F.when(region != "", F.concat(simple_slug(city), F.lit("-"), F.lower(region))).otherwise(simple_slug(city))
    built = F.concat(
        F.lit(base_url), F.concat_ws("-", slugify("v.name"), place, F.left(first_filled("v.id"), F.lit(8)))
    )
    return rows.select(
        *keep,
        F.col("v.id").alias("marketplace_id"), F.col("v.vendorId").alias("vendor_id"), F.col("v.name").alias("name"),
        F.col("v.adTier").alias("ad_tier"), F.col("v.vendorTier").alias("vendor_tier"),
        F.col("v.claimedStatus").alias("claimed_status"), first_filled("v.serviceArea").alias("service_area"),
        city.alias("city"), region.alias("state"),
        first_filled("v.startingPriceRange").alias("starting_price_range"),
        first_non_zero("v.reviewsCount", "v.reviewSummary.count").alias("review_count"),
        first_non_zero("v.stars", "v.starCount", "v.reviewSummary.overallRating", default=0.0).alias("star_rating"),
        F.coalesce(F.size("v.deals"), F.lit(0)).alias("deal_count"),
        F.coalesce(F.try_element_at(F.col("v.siteUrls"), F.lit(1))["uri"], F.lit("")).alias("_uri"),
        built.alias("_built"),
    ).withColumn("source_url", first_filled("_uri", "_built")).drop("_uri", "_built")


def pick_phone(phones: Column | str, fallback: Column | str) -> Column:
    """First primary number, else the last number of the list, else the single field."""
    numbered = F.filter(col_of(phones), lambda p: F.coalesce(p["number"], F.lit("")) != "")
    primary = F.filter(numbered, lambda p: p["type"] == "PRIMARY")
    return F.coalesce(
        F.try_element_at(primary, F.lit(1))["number"],
        F.try_element_at(numbered, F.lit(-1))["number"],
        non_blank(fallback),
        F.lit(""),
    )


def social_value(links: Column | str, *codes: str) -> Column:
    """Last social link whose code holds one of the given words."""
    def wanted(link: Column) -> Column:
        hit = F.contains(link["code"], F.lit(codes[0]))
        for code in codes[1:]:
            hit = hit | F.contains(link["code"], F.lit(code))
        return hit

    return F.try_element_at(F.filter(col_of(links), wanted), F.lit(-1))["value"]


def deal_texts(items: Column | str, width: int | None = None) -> Column:
    """Non-empty deal descriptions, cut to a column width if one is given."""
    filled = F.filter(col_of(items), lambda d: F.coalesce(d["description"], F.lit("")) != "")
    return F.coalesce(F.transform(filled, lambda d: cut_to(d["description"], width)), F.array().cast("array<string>"))


def detail_vendors(payloads: DataFrame, payload: str = "payload", *keep: str) -> DataFrame:
    """Vendor rows of a detail state: the raw record when it has a name, else the plain one."""
    parsed = payloads.select(*keep, F.from_json(payload, DETAIL_STATE)["vendor"].alias("d"))
    # No filter on the parsed column: it would be pushed below and parse twice. A
    # payload without a vendor gives a row with scrape_success = false.
    chosen = parsed.select(
        *keep,
        F.when(F.coalesce(F.col("d.vendorRaw.name"), F.lit("")) != "", F.col("d.vendorRaw"))
        .otherwise(F.col("d.vendor")).alias("s"),
        F.col("d.vendor").alias("o"),
    )
    season = lambda name, part: F.col(f"s.pricing.{name}.{part}.value")
    seasonless = season("noSeason", "min").isNull() & season("noSeason", "average").isNull()
    range_text = first_filled("o.startingPriceRange")
    deals = F.col("s.deals.items")
    return chosen.select(
        *keep,
        first_filled("s.id").alias("marketplace_id"), first_filled("s.vendorId").alias("vendor_id"),
        first_filled("s.name").alias("name"),
        pick_phone("s.phones", "s.phone").alias("phone"),
        F.coalesce(
            non_blank(F.try_element_at(F.col("s.emails"), F.lit(1))["address"]), non_blank("s.email"), F.lit("")
        ).alias("email"),
        first_filled("s.websiteUrl", "s.displayWebsiteUrl").alias("website_url"),
        first_filled("s.location.city", "s.location.address.city").alias("city"),
        first_filled("s.location.state", "s.location.address.state").alias("state"),
        first_filled("s.location.serviceArea", "s.serviceArea").alias("service_area"),
        F.when(seasonless, price_range_min(range_text)).otherwise(season("noSeason", "min")).alias("starting_price_min"),
        F.when(seasonless, price_range_avg(range_text)).otherwise(season("noSeason", "average")).alias("starting_price_avg"),
        range_text.alias("starting_price_range"),
        season("peak", "min").alias("peak_price_min"), season("peak", "average").alias("peak_price_avg"),
        season("offPeak", "min").alias("offpeak_price_min"), season("offPeak", "average").alias("offpeak_price_avg"),
        first_non_zero("s.reviewSummary.count", "s.reviewsCount").alias("review_count"),
        first_non_zero("s.reviewSummary.overallRating", "o.starCount", "o.stars", default=0.0).alias("star_rating"),
        first_filled("s.description").alias("description"),
        first_filled("s.headline").alias("headline"),
        first_filled("s.adTier").alias("ad_tier"), first_filled("s.vendorTier").alias("vendor_tier"),
        first_filled("s.claimedStatus").alias("claimed_status"),
        F.coalesce(F.size(deals), F.lit(0)).alias("deal_count"), deal_texts(deals).alias("deal_descriptions"),
        F.coalesce(non_blank("s.social.facebookUrl"), social_value("s.socialMedia", "FBURL", "FACEBOOK"), F.lit(""))
        .alias("facebook_url"),
        F.coalesce(non_blank("s.social.instagramUsername"), social_value("s.socialMedia", "INSTAGRAM"), F.lit(""))
        .alias("instagram_username"),
        F.coalesce(non_blank("s.social.pinterestUsername"), social_value("s.socialMedia", "PINTEREST"), F.lit(""))
        .alias("pinterest_username"),
        F.coalesce(
            F.when(F.size("s.awards") > 0, F.col("s.awards")), F.when(F.size("o.awards") > 0, F.col("o.awards")),
            F.array().cast("array<struct<name:string>>"),
        ).alias("awards"),
        F.col("s.orgDetails.startYear").alias("year_founded"), F.col("s.orgDetails.totalMembers").alias("team_size"),
        F.col("s.orgDetails.travelAvailability").alias("travel_distance"),
        (first_filled("s.name") != "").alias("scrape_success"),
    )


def next_data_vendors(
    payloads: DataFrame, key: Sequence[str], payload: str = "payload", first_path_only: bool = False
) -> DataFrame:
    """Vendor rows of a page state with three possible lists; the first record of an id wins.

    ``first_path_only`` uses the second list only when the first is empty and
    never the third, as the pricing reader does.
    """
    parsed = payloads.select(*key, F.from_json(payload, NEXT_DATA).alias("_p"))
    page = F.col("_p.props.pageProps")
    nothing = F.array().cast(f"array<{' '.join(_NEXT_VENDOR.split())}>")
    one = F.coalesce(page["searchResults"]["vendors"], nothing)
    two = F.coalesce(page["vendorSearchData"]["vendorSearch"]["vendors"], nothing)
    three = F.coalesce(page["adjacentVendors"], nothing)
    combined = F.when(F.size(one) > 0, one).otherwise(two) if first_path_only else F.concat(one, two, three)
    rows = parsed.select(*key, F.posexplode(combined).alias("position", "v")).withColumn(
        "vendor_id", first_filled("v.id", "v.vendorId", "v.slug")
    )
    # a record without any id keeps a row of its own
    own = F.when(F.col("vendor_id") == "", F.col("position"))
    kept = first_by_key(rows, [*key, "vendor_id", own], ["position"])
    return kept.select(
        *key, "position", "vendor_id",
        first_filled("v.name").alias("name"), first_filled("v.slug").alias("slug"),
        first_filled("v.phone").alias("phone"),
        first_filled("v.social.web", "v.websiteUrl").alias("website_url"),
        first_filled("v.city", "v.address.city").alias("city"),
        first_filled("v.stateProvince", "v.address.stateProvince").alias("state"),
        starting_price("v.startingPriceCents", "v.startingPrice", "v.prices").alias("starting_price_min"),
        first_filled("v.priceTier").alias("price_tier"),
        first_non_zero("v.reviewCount", "v.reviewsCount").alias("review_count"),
        first_non_zero("v.averageReviewsRate", "v.starRating", default=0.0).alias("star_rating"),
        F.transform("v.categories", lambda c: c["name"]).alias("categories"),
        F.transform("v.photos", lambda p: p["url"]).alias("images"),
        (first_filled("v.name") != "").alias("scrape_success"),
    )


def mixed_names(json_array: Column | str, field: str = "name") -> Column:
    """Names of a JSON list whose items are objects or plain strings."""
    items = F.from_json(col_of(json_array), "array<string>")
    # An object item arrives as its JSON text, a plain string as itself.
    return F.transform(
        items,
        lambda i: F.when(F.startswith(i, F.lit("{")), F.coalesce(F.get_json_object(i, f"$.{field}"), F.lit(""))).otherwise(i),
    )


# ---- review pages ---------------------------------------------------------

def mean_rating(ratings: Column | str) -> Column:
    """Mean of the non-zero sub-ratings to one decimal, ties to even; null without any."""
    values = F.transform(
        F.filter(col_of(ratings), lambda r: F.coalesce(r["value"], F.lit(0.0)) != 0), lambda r: r["value"]
    )
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.bround(F.try_divide(total, F.size(values)), 1)


def rating_map(ratings: Column | str) -> Column:
    """Sub-ratings by name; the last of a repeated name counts, those without a name are left out."""
    named = F.filter(col_of(ratings), lambda r: r["name"].isNotNull())
    names = F.transform(named, lambda r: r["name"])
    last = F.filter(named, lambda r, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), r["name"]))
    return F.map_from_entries(F.transform(last, lambda r: F.struct(r["name"], r["value"])))


def review_nodes(payloads: DataFrame, keep: Sequence[str], payload: str = "payload", min_text: int = 10) -> DataFrame:
    """Review rows of landed review-service pages. Reviewer e-mail is not carried."""
    page = payloads.select(*keep, F.from_json(payload, REVIEW_PAGE).alias("_p"))
    nodes = page.select(*keep, F.col("_p.reviews.totalCount").alias("total_count"), F.explode("_p.reviews.nodes").alias("n"))
    name = F.trim(F.concat_ws(" ", F.col("n.reviewer.firstName"), F.col("n.reviewer.lastName")))
    rows = nodes.select(
        *keep, "total_count",
        F.col("n.id").alias("source_review_id"),
        F.coalesce(F.col("n.comment.content"), F.lit("")).alias("review_text"),
        F.col("n.title").alias("review_title"),
        mean_rating("n.ratings").alias("rating"),
        rating_map("n.ratings").alias("category_ratings"),
        iso_date("n.createdAt").alias("review_date"),
        name.alias("reviewer_name"),
    )
    return rows.filter(F.length("review_text") > min_text)


# ---- payload profiling ----------------------------------------------------

def variant_paths(
    payloads: DataFrame, payload: str = "payload", words: Sequence[str] = tuple(lx.JSON_REVIEW_KEYS), indexed: bool = True
) -> DataFrame:
    """(path, type, n) of the keys that mention one of the words, at any depth and in every list element; no words means every key.

    Level by level: the objects and lists of one level are opened, their members
    counted, and those that are objects or lists again are the next level, until one
    is empty. A level is written before it is read twice, and dropped when the next one
    is there. ``indexed=False`` writes ``[*]`` for the place in a list, for long lists.
    """
    space = Workspace(payloads.sparkSession, "json-paths")
    level = payloads.select(F.lit("$").alias("path"), F.try_parse_json(F.col(payload)).alias("v")).where("v is not null")
    place = F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")) if indexed else F.lit("[*]")
    # an object's member has a key, a list's element has none and is not reported itself
    path = F.concat("path", F.when(F.col("key").isNull(), place).otherwise(F.concat(F.lit("."), "key")))
    counts, depth = [], 0
    while True:
        opened = level.lateralJoin(payloads.sparkSession.tvf.variant_explode(F.col("v").outer()))
        members = opened.select(path.alias("path"), "key", F.col("value").alias("v"), F.regexp_extract(F.schema_of_variant("value"), r"^(\w+)", 1).alias("type"))
        members = space.write(members, f"level-{depth}")
        if depth:
            space.drop(f"level-{depth - 1}")
        if members.isEmpty():
            break
        keys = members.where("key is not null")
        if words:
            keys = keys.where(contains_any(F.lower("key"), words))
        counts.append(space.write(keys.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n")), f"counts-{depth}"))
        level, depth = members.where(F.col("type").isin("OBJECT", "ARRAY")).select("path", "v"), depth + 1
    if not counts:
        return payloads.sparkSession.createDataFrame([], "path STRING, type STRING, n BIGINT")
    # paths of different levels differ, so the levels are put one after the other
    return payloads.sparkSession.read.schema(counts[0].schema).parquet(*[space.path(f"counts-{k}") for k in range(depth)])


def populated_keys(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """(section, key, n, populated): how often each key of a top-level section carries a value."""
    top = payloads.select(F.explode(F.from_json(payload, "map<string,string>")).alias("section", "body"))
    inner = top.select("section", F.explode(F.from_json("body", "map<string,string>")).alias("key", "value"))
    empty = F.coalesce(F.col("value"), F.lit("")).isin("", "[]", "{}", "0", "false", "null")
    return inner.groupBy("section", "key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~empty).alias("populated")
    )


# ---- unified vendor record ------------------------------------------------

def unified_vendor(
    records: DataFrame, id_rules: dict[str, Sequence[str]], default_category: str = lx.DEFAULT_CATEGORY,
    run_id: int | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Source records of any shape to the columns of the vendor table.

    Columns a source lacks count as blank. ``id_rules`` lists, per source, the
    fields that may hold its natural id.
    """
    have = set(records.columns)

    def text(*names: str) -> Column:
        present = [n for n in names if n in have]
        return first_filled(*[F.col(n).cast("string") for n in present]) if present else F.lit("")

    def number(*names: str, default: float | int | None = 0) -> Column:
        present = [n for n in names if n in have]
        return first_non_zero(*present, default=default) if present else F.lit(default)

    wanted = {n for fields in [*id_rules.values(), ("vendor_id", "name")] for n in fields}
    base = records.withColumns({n: F.lit(None).cast("string") for n in wanted if n not in have})
    price_min = non_zero(F.col("starting_price_min").try_cast("double")) if "starting_price_min" in have else F.lit(None).cast("double")
    if "starting_price" in have:
        price_min = F.coalesce(price_min, money_to_number("starting_price"))
    price_avg = non_zero(F.col("starting_price_avg").try_cast("double")) if "starting_price_avg" in have else F.lit(None).cast("double")
    return base.select(
        "source",
        source_vendor_id("source", id_rules).alias("source_vendor_id"),
        text("listing_url", "source_url", "biz_url").alias("source_url"),
        text("name").alias("name"),
        F.coalesce(F.nullif(text("category"), F.lit("")), F.lit(default_category)).alias("category"),
        text("address_city", "city").alias("city"),
        text("address_state", "state").alias("state"),
        text("phone").alias("phone"), text("email").alias("email"),
        text("website_url", "display_website_url", "website").alias("website_url"),
        price_min.alias("starting_price_min"), price_avg.alias("starting_price_avg"),
        text("starting_price_range").alias("starting_price_range"), text("price_tier").alias("price_tier"),
        number("star_rating", "rating", default=0.0).cast("double").alias("star_rating"),
        number("review_count", "reviewsCount").cast("bigint").alias("review_count"),
        text("description").alias("description"), text("headline").alias("headline"),
        text("ad_tier").alias("ad_tier"), text("vendor_tier").alias("vendor_tier"),
        text("service_area").alias("service_area"),
        F.lit(run_id).cast("bigint").alias("scrape_run_id"), *keep,
        *([named_structs("award_names").alias("awards")] if "award_names" in have else []),
    )
