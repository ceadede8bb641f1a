"""HTML pages to values.

What depends on nesting or on character references (visible text, named elements,
cards, packages) is read element by element, see ``elements``. What is a matter of
the raw markup (embedded JSON, links, markers, class attributes) is a regular
expression over the whole page and stays in generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions.elements import Markers, page_record
from reviewloom.functions.scalars import col_of, contains_any, count_occurrences, cut_to
from reviewloom.operators.dedup import top_by_key

JSON_LD = r"""(?is)<script\b[^>]*\btype\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script\s*>"""
PLAIN_JSON = r"""(?is)<script\b[^>]*\btype\s*=\s*["']application/json["'][^>]*>(.*?)</script\s*>"""
INITIAL_STATE = r"(?s)window\.__INITIAL_STATE__\s*=\s*(\{.*?\});"
NEXT_DATA = r"""(?is)<script\b[^>]*\bid\s*=\s*["']__NEXT_DATA__["'][^>]*>(.*?)</script\s*>"""
PRICE = r"\$\s*[\d,]+(?:\.\d{2})?"
# Patterns of the page analysis.
CONTAINER_CLASSES = r'<(?:div|section|article)[^>]*class="([^"]*)"'
CLASSED_HEADING = r'(?i)<h1[^>]*class="([^"]*)"[^>]*>([^<]+)</h1>'
PRICED_ELEMENT = r'<[^>]*class="([^"]*)"[^>]*>\$[\d,]+</[^>]*>'
VENDOR_TEST_ID = r'(?i)data-testid="([^"]*vendor[^"]*)"'
ENDPOINT_HINTS = ("api", "graphql", "vendor", "search", "listing", "recommend")
ANCHOR = r'(?s)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>'


def all_matches(text: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(F.coalesce(col_of(text), F.lit("")), F.lit(pattern), F.lit(group))


def json_ld_blocks(html: Column | str) -> Column:
    return all_matches(html, JSON_LD)


def visible_text(html: Column | str) -> Column:
    """Text of a page without scripts, styles and tags, references decoded, spaces collapsed."""
    return page_record(html, ["text"])["text"]


def first_text(*candidates: Column | str) -> Column:
    """First of several text renderings that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(col_of(c)), F.lit("")) for c in candidates], F.lit(""))


def page_title(html: Column | str) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(col_of(html), F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))


def dollar_amounts(text: Column | str, first: int | None = None) -> Column:
    """Dollar amounts in reading order; a report can keep the first few."""
    found = all_matches(text, PRICE, 0)
    return found if first is None else F.slice(found, 1, first)


def first_class_text(html: Column | str, markers: Sequence[str]) -> Column:
    """Ordered list of class (or test id) markers: text of the first element of the first marker that yields any."""
    return page_record(html, ["name"], Markers(name=tuple(markers)))["name"]


def _quoted(literal: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+?^$|" else ch for ch in literal)


def vendor_name(html: Column | str, markers: Sequence[str] = tuple(lx.VENDOR_NAME_CLASSES)) -> Column:
    return first_class_text(html, markers)


def starting_price_text(html: Column | str, markers: Sequence[str] = tuple(lx.STARTING_PRICE_CLASSES)) -> Column:
    return first_class_text(html, markers)


VENDOR_MARKERS = Markers(
    name=tuple(lx.VENDOR_NAME_CLASSES), price=tuple(lx.STARTING_PRICE_CLASSES), items=tuple(lx.PACKAGE_ITEM_CLASSES), item_name=tuple(lx.PACKAGE_NAME_CLASSES),
    item_price=tuple(lx.PACKAGE_PRICE_CLASSES), item_description=tuple(lx.PACKAGE_DESCRIPTION_CLASSES), cards=tuple(lx.CARD_CLASS_WORDS),
)


def vendor_pages(pages: DataFrame, key: Sequence[str], html: str = "html", markers: Markers = VENDOR_MARKERS) -> DataFrame:
    """(key, title, name, price, packages, cards) of vendor pages, each page read once."""
    return pages.select(*key, page_record(html, ["title", "name", "price", "packages", "cards"], markers).alias("_page")).select(*key, "_page.*")


def package_rows(pages: DataFrame, key: Sequence[str], html: str = "html", items: Sequence[str] = tuple(lx.PACKAGE_ITEM_CLASSES)) -> DataFrame:
    """(key, package_number, name, price, description) of every package item of a page; the first item marker that finds any counts."""
    wanted = replace(VENDOR_MARKERS, items=tuple(items))
    return pages.select(*key, F.inline(page_record(html, ["packages"], wanted)["packages"]))


def card_texts(
    html: Column | str, words: Sequence[str] = tuple(lx.CARD_CLASS_WORDS), first: int | None = None, max_len: int | None = None
) -> Column:
    """Texts of elements whose class mentions packages or pricing, outer ones too; a report can keep the first few, and those under a length."""
    found = page_record(html, ["cards"], Markers(cards=tuple(words)))["cards"]
    if max_len is not None:
        found = F.filter(found, lambda t: F.length(t) < max_len)
    return found if first is None else F.slice(found, 1, first)


def anchors(html: Column | str) -> Column:
    """(href, text) of every link of a page, in page order."""
    h = col_of(html)
    hrefs = all_matches(h, ANCHOR, 1)
    texts = F.transform(all_matches(h, ANCHOR, 2), lambda t: F.trim(F.regexp_replace(t, r"(?s)<[^>]*>", "")))
    return F.zip_with(hrefs, texts, lambda href, text: F.struct(href.alias("href"), text.alias("text")))


def package_links(
    html: Column | str, words: Sequence[str] = tuple(lx.PACKAGE_LINK_WORDS), first: int | None = None
) -> Column:
    """Links whose text mentions packages or prices; a report can keep the first few."""
    hits = F.filter(anchors(html), lambda a: (a["href"] != "") & contains_any(F.lower(a["text"]), words))
    return hits if first is None else F.slice(hits, 1, first)


def vendor_links(html: Column | str, path: str = "/marketplace/", mark: str = "--", first: int | None = None) -> Column:
    """Distinct vendor page links of a listing page in page order."""
    hrefs = all_matches(html, r'href="([^"]*)"')
    wanted = F.array_distinct(F.filter(hrefs, lambda h: F.contains(h, F.lit(path)) & F.contains(h, F.lit(mark))))
    return wanted if first is None else F.slice(wanted, 1, first)


def page_type(
    url: Column | str, html: Column | str, path: str = "/marketplace/", mark: str = "--", card: str = "vendor-card",
    names: Sequence[str] = tuple(lx.VENDOR_NAME_CLASSES),
) -> Column:
    """vendor, marketplace or unknown: from the url, else from the page content."""
    u, h = col_of(url), col_of(html)
    tail = F.split_part(F.element_at(F.split(u, _quoted(path)), -1), F.lit("?"), F.lit(1))
    listed = F.contains(u, F.lit(path))
    cards = F.size(all_matches(h, r'class="([^"]*' + _quoted(card) + r'[^"]*)"'))
    return (
        F.when(listed & F.contains(F.split_part(tail, F.lit("/"), F.lit(1)), F.lit(mark)), "vendor")
        .when(listed & ~F.contains(tail, F.lit("/")), "marketplace")
        .when(cards > 1, "marketplace")
        .when(vendor_name(h, names) != "", "vendor")
        .otherwise("unknown")
    )


def business_links(pages: DataFrame, key: str, html: str = "html", path: str = "/biz/") -> DataFrame:
    """Fallback listing rows from business links, one per page and name."""
    links = pages.select(key, F.posexplode(anchors(html)).alias("position", "a")).select(
        key, "position", F.col("a.text").alias("name"), F.col("a.href").alias("url")
    )
    n = F.length("name")
    named = links.filter(F.contains(F.col("url"), F.lit(path)) & (n > 2) & (n < 100))
    return top_by_key(named, [key, "name"], ["position"], 1)


def without_structured(fallback: DataFrame, structured: DataFrame, key: str) -> DataFrame:
    """Fallback rows of pages that gave no structured row."""
    return fallback.join(structured.select(key), key, "left_anti")


def marker_profile(pages: DataFrame, html: str = "html") -> DataFrame:
    """Presence of titles, bodies and protection markers on each page."""
    prepared = pages.withColumn("_low", F.lower(F.coalesce(F.col(html), F.lit(""))))
    has = lambda w: F.contains(F.col("_low"), F.lit(w))
    return prepared.select(
        *[c for c in pages.columns if c != html],
        F.length(html).cast("bigint").alias("length"),
        has("<title>").alias("has_title"),
        has("<body").alias("has_body"),
        F.contains(F.col(html), F.lit("403")).alias("has_403"),
        has("forbidden").alias("has_forbidden"),
        has("access denied").alias("has_access_denied"),
        has("blocked").alias("has_blocked"),
        has("captcha").alias("has_captcha"),
        (has("perimeterx") | F.contains(F.col(html), F.lit("_px"))).alias("has_perimeterx"),
        has("datadome").alias("has_datadome"),
        has("cloudflare").alias("has_cloudflare"),
        (F.length(html) > 10000).alias("has_content"),
    )


def structured_counts(html: Column | str, prefix: str = "") -> list[Column]:
    """How much structured data a page carries."""
    h = col_of(html)
    state = F.regexp_extract(F.coalesce(h, F.lit("")), INITIAL_STATE, 1)
    return [
        F.size(json_ld_blocks(h)).cast("bigint").alias(prefix + "json_ld_blocks"),
        F.size(all_matches(h, PLAIN_JSON)).cast("bigint").alias(prefix + "json_blocks"),
        (state != "").alias(prefix + "has_initial_state"),
    ]


def listing_json_previews(html: Column | str, width: int | None = None) -> Column:
    """The application/json blocks that hold a vendor listing, or their openings of a width."""
    blocks = all_matches(html, PLAIN_JSON)
    listed = F.filter(
        blocks,
        lambda b: F.coalesce(
            (F.get_json_object(b, "$.nItems").isNotNull()) | (F.get_json_object(b, "$.vendors").isNotNull()),
            F.lit(False),
        ),
    )
    return F.transform(listed, lambda b: cut_to(b, width))


def class_frequency(pages: DataFrame, html: str = "html", k: int | None = None, min_len: int = 4) -> DataFrame:
    """Classes of container elements and their counts; with ``k`` the most frequent ones."""
    lists = pages.select(F.explode(all_matches(html, CONTAINER_CLASSES)).alias("classes"))
    names = lists.select(F.explode(F.split("classes", r"\s+")).alias("class")).filter(F.length("class") >= min_len)
    counts = names.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return counts if k is None else counts.orderBy(F.col("n").desc(), "class").limit(k)


def headings(html: Column | str) -> Column:
    """(class, text) of the first level headings that have a class."""
    return F.zip_with(
        all_matches(html, CLASSED_HEADING, 1),
        all_matches(html, CLASSED_HEADING, 2),
        lambda c, t: F.struct(c.alias("class"), F.trim(t).alias("text")),
    )


def priced_classes(html: Column | str) -> Column:
    """Classes of elements that hold a price."""
    return F.array_distinct(all_matches(html, PRICED_ELEMENT))


def keyword_classes(html: Column | str, words: Sequence[str] = tuple(lx.PACKAGE_CLASS_WORDS)) -> Column:
    """Distinct class attributes that mention one of the words."""
    return F.array_distinct(all_matches(html, r'(?i)class="([^"]*(?:' + "|".join(words) + r')[^"]*)"'))


def vendor_test_ids(html: Column | str) -> Column:
    return all_matches(html, VENDOR_TEST_ID)


def endpoint_urls(
    pages: DataFrame, html: str = "html", hints: Sequence[str] = ENDPOINT_HINTS,
    k: int | None = None, width: int | None = None,
) -> DataFrame:
    """Distinct endpoint urls mentioned in pages; with ``k`` the first in alphabetical order. A report can shorten them, after whole urls were told apart."""
    pattern = "https?://[^\"']*(?:" + "|".join(hints) + ")[^\"']*"
    found = pages.select(F.explode(all_matches(html, pattern, 0)).alias("u"))
    urls = found.select(F.col("u").alias("endpoint")).distinct()
    urls = urls if k is None else urls.orderBy("endpoint").limit(k)
    return urls.select(cut_to(F.col("endpoint"), width).alias("endpoint"))


def substring_counts(html: Column | str, needles: Sequence[str], width: int | None = None) -> list[Column]:
    """Occurrences of literal substrings, in the whole page unless a width is given."""
    h = col_of(html) if width is None else F.left(col_of(html), F.lit(width))
    return [count_occurrences(h, n).alias(f"n_{i}") for i, n in enumerate(needles)]
