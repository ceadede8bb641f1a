"""Scalar normalisation of prices, dates, ids and labels as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom import lexicons as lx

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    text = col_of(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def non_zero(c: Column | str) -> Column:
    """Null for a zero, the value otherwise."""
    return F.nullif(col_of(c), F.lit(0))


def non_blank(c: Column | str) -> Column:
    """Null for an empty string, the value otherwise."""
    return F.nullif(col_of(c), F.lit(""))


def cut_to(text: Column, width: int | None) -> Column:
    """The first ``width`` characters, or the whole text without a width."""
    return text if width is None else F.left(text, F.lit(width))


def first_filled(*cols: Column | str, default: str | None = "") -> Column:
    """First text that is neither null nor empty."""
    parts = [non_blank(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def first_non_zero(*cols: Column | str, default: float | int | None = 0) -> Column:
    """First number that is neither null nor zero."""
    parts = [non_zero(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


# ---- prices ---------------------------------------------------------------

def parse_price(c: Column | str) -> Column:
    """First number in a price text, thousands separators removed."""
    text = F.lower(col_of(c))
    for phrase in ("starting at", "from", "starting price"):
        text = F.replace(text, F.lit(phrase), F.lit(""))
    number = F.regexp_extract(text, r"\d+[,\d]*\.?\d*", 0)
    return F.replace(number, F.lit(","), F.lit("")).try_cast("double")


def price_range_numbers(c: Column | str) -> Column:
    """All two to six digit numbers of a range text such as ``$500-$2,000``."""
    plain = F.replace(F.coalesce(col_of(c), F.lit("")), F.lit(","), F.lit(""))
    found = F.regexp_extract_all(plain, F.lit(r"\$?(\d{2,6})"), F.lit(1))
    return F.transform(found, lambda n: n.cast("double"))


def price_range_min(c: Column | str) -> Column:
    return F.array_min(price_range_numbers(c))


def price_range_avg(c: Column | str) -> Column:
    """Mean of every number in the range text, null when there is none."""
    numbers = price_range_numbers(c)
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, n: acc + n)
    return F.try_divide(total, F.size(numbers))


def money_to_number(c: Column | str) -> Column:
    """``$2,400.00`` to 2400.0; ranges and free text give null."""
    text = col_of(c)
    for piece in ("$", ",", ".00"):
        text = F.replace(text, F.lit(piece), F.lit(""))
    return try_double(text)


def filled_number(c: Column | str) -> Column:
    """Number of a text or numeric field; failures, blanks and zeros are null."""
    return non_zero(try_double(c))


def starting_price(cents: Column | str, dollars: Column | str, prices: Column | str) -> Column:
    """Listing price in dollars: cents first, then dollars, then the first priced entry."""
    priced = F.filter(col_of(prices), lambda p: F.coalesce(p["minCents"], F.lit(0)) != 0)
    return F.coalesce(
        non_zero(cents) / F.lit(100.0),
        non_zero(dollars).cast("double"),
        F.try_element_at(priced, F.lit(1))["minCents"] / F.lit(100.0),
    )


def price_key(c: Column | str) -> Column:
    """Spelling-independent key of a price text."""
    return F.trim(F.replace(col_of(c), F.lit(","), F.lit("")))


def price_tier(
    category: Column | str,
    price_avg: Column | str,
    price_min: Column | str,
    thresholds: Mapping[str, tuple[float, float]] | None = None,
    default: str = lx.DEFAULT_TIER_CATEGORY,
) -> Column:
    """budget / mid / premium / unknown from the average price, else the lowest."""
    table = dict(thresholds or lx.TIER_THRESHOLDS)
    cat = col_of(category)
    price = F.coalesce(non_zero(price_avg), col_of(price_min))

    def bound(i: int) -> Column:
        value = F.lit(float(table[default][i]))
        for code, limits in table.items():
            if code != default:
                value = F.when(cat == code, F.lit(float(limits[i]))).otherwise(value)
        return value

    return (
        F.when(price.isNull(), "unknown")
        .when(price < bound(0), "budget")
        .when(price < bound(1), "mid")
        .otherwise("premium")
    )


def market_position(price: Column | str, market_avg: Column | str) -> Column:
    """below / at / above market with a 15 % band around the category mean."""
    p, avg = col_of(price), col_of(market_avg)
    return (
        F.when(F.coalesce(non_zero(p), F.lit(0.0)) == 0, "no price")
        .when(F.coalesce(non_zero(avg), F.lit(0.0)) == 0, "no data")
        .when(p < avg * 0.85, "below")
        .when(p > avg * 1.15, "above")
        .otherwise("at")
    )


def percent_of_range(price: Column | str, low: Column | str, high: Column | str) -> Column:
    """Where a price sits between the lowest and highest of its market, in percent."""
    p, lo, hi = col_of(price), col_of(low), col_of(high)
    return F.try_divide(p - lo, hi - lo) * 100


# ---- dates ----------------------------------------------------------------

def parse_date(c: Column | str, iso: bool = True) -> Column:
    """``Mon D, YYYY`` with a three letter month, else (optionally) ``YYYY-MM-DD``."""
    text = col_of(c)
    pattern = r"([A-Z][a-z]+)\s+(\d+),\s*(\d{4})"
    part = [F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]
    named = F.when(
        F.length(part[0]) == 3,
        F.try_to_date(F.concat(part[0], F.lit(" "), part[1], F.lit(", "), part[2]), "MMM d, yyyy"),
    )
    if not iso:
        return named
    return F.coalesce(named, F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0).try_cast("date"))


def iso_date(c: Column | str) -> Column:
    """Calendar day of an ISO timestamp text; blank or malformed text is null."""
    return F.regexp_extract(col_of(c), r"^\d{4}-\d{2}-\d{2}", 0).try_cast("date")


# ---- text -----------------------------------------------------------------

def collapse_spaces(c: Column | str) -> Column:
    return F.regexp_replace(col_of(c), r"\s+", " ")


def slugify(c: Column | str) -> Column:
    """Lower-case url slug of a business name."""
    slug = F.lower(col_of(c))
    for old, new in ((" & ", "-"), (" ", "-"), ("--", "-"), (",", "")):
        slug = F.replace(slug, F.lit(old), F.lit(new))
    return F.regexp_replace(slug, "[^a-z0-9-]", "")


def simple_slug(c: Column | str) -> Column:
    return F.lower(F.replace(col_of(c), F.lit(" "), F.lit("-")))


def count_occurrences(text: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of a literal substring."""
    t = F.coalesce(col_of(text), F.lit(""))
    removed = F.length(t) - F.length(F.replace(t, F.lit(needle), F.lit("")))
    return (removed / F.lit(len(needle))).cast("bigint")


def contains_any(text: Column | str, needles: Sequence[str]) -> Column:
    """True when the text holds at least one literal substring."""
    t = col_of(text)
    return reduce(lambda a, b: a | b, [F.contains(t, F.lit(n)) for n in needles])


def matched_words(text: Column | str, needles: Sequence[str]) -> Column:
    """The literal substrings that occur, in list order."""
    t = col_of(text)
    return F.array_compact(F.array(*[F.when(F.contains(t, F.lit(n)), F.lit(n)) for n in needles]))


# ---- ids, urls, categories ------------------------------------------------

def source_vendor_id(
    source: Column | str, rules: Mapping[str, Sequence[str]], default: Sequence[str] = ("vendor_id", "name")
) -> Column:
    """Natural id of a record: per source an ordered list of candidate columns."""
    src = col_of(source)
    out = first_filled(*default)
    for name, fields in rules.items():
        out = F.when(src == name, first_filled(*fields)).otherwise(out)
    return out


def listing_url(base: str, *parts: Column | str) -> Column:
    """``base/part/part``, empty unless the last part (the slug) is filled."""
    cols = [col_of(p) for p in parts]
    return F.when(
        F.coalesce(cols[-1], F.lit("")) != "", F.concat_ws("/", F.lit(base.rstrip("/")), *cols)
    ).otherwise("")


def category_label(slug: Column | str, table: Mapping[str, tuple[str, str]] | None = None) -> Column:
    """Readable category; an unknown slug is its own label."""
    c = col_of(slug)
    out = c
    for name, (label, _code) in (table or lx.CATEGORY_CODES).items():
        out = F.when(c == name, label).otherwise(out)
    return out


def category_code(slug: Column | str, table: Mapping[str, tuple[str, str]] | None = None) -> Column:
    """Short category code; ``OTHER`` for an unknown slug."""
    c = col_of(slug)
    out = F.lit("OTHER")
    for name, (_label, code) in (table or lx.CATEGORY_CODES).items():
        out = F.when(c == name, code).otherwise(out)
    return out


def display_category(c: Column | str, prefix: str = lx.CATEGORY_PREFIX) -> Column:
    return F.replace(F.coalesce(col_of(c), F.lit("")), F.lit(prefix), F.lit(""))


def named_structs(names: Column | str) -> Column:
    """List of names to list of ``{name}`` objects."""
    return F.transform(col_of(names), lambda n: F.struct(n.alias("name")))


def foreign_url(url: Column | str, own_host: str) -> Column:
    """True for a filled url that does not belong to the marketplace itself."""
    u = F.coalesce(col_of(url), F.lit(""))
    return (u != "") & ~F.contains(u, F.lit(own_host))


# ---- display --------------------------------------------------------------

def percent_text(c: Column | str, digits: int = 0) -> Column:
    """Percent label; ties round to the even neighbour."""
    return F.concat(F.format_string(f"%.{digits}f", F.bround(col_of(c).cast("double"), digits)), F.lit("%"))


def compact_number(c: Column | str) -> Column:
    """1234 as 1.2K, 3400000 as 3.4M."""
    n = col_of(c).cast("double")
    return (
        F.when(n >= 1e6, F.concat(F.format_string("%.1f", F.round(n / 1e6, 1)), F.lit("M")))
        .when(n >= 1e3, F.concat(F.format_string("%.1f", F.round(n / 1e3, 1)), F.lit("K")))
        .otherwise(F.format_string("%.0f", F.round(n, 0)))
    )


def star_label(star: Column | str) -> Column:
    return F.concat(col_of(star).cast("int").cast("string"), F.lit("★"))
