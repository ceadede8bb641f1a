"""Review text blobs and blocks to review rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.scalars import col_of, cut_to, parse_date

# The shape of a review header such as "Ann B.Rating: 5".
HEADER = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\s*[A-Z]?\.?\s*Rating:\s*\d+)"
NAME = r"^([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\s*[A-Z]?\.?)"
RATING = r"Rating:\s*(\d+(?:\.\d+)?)"
PREAMBLE = r"^[A-Z].*?\.\s*Rating:\s*\d+(?:\.\d+)?.*?\d{4}"
BULLET = "•"
_MARK = "\u0001"


def reviewer_of(text: Column | str) -> Column:
    """Leading person name without its closing dots, blank when there is none."""
    return F.regexp_replace(F.trim(F.regexp_extract(col_of(text), NAME, 1)), r"\.+$", "")


def rating_of(text: Column | str) -> Column:
    return F.regexp_extract(col_of(text), RATING, 1).try_cast("double")


def trim_bullets(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), BULLET + "+$", "")


def split_reviews(
    df: DataFrame, key: Sequence[str], text: str = "text", min_body: int = 30, width: int | None = None,
    single: tuple[int, int | None] = (80, None), min_single: int = 50,
) -> DataFrame:
    """(key, position, reviewer, rating, review_date, body) of every review in a text blob.

    A blob is cut in front of each ``Name. Rating: N`` header. A blob without a
    header is one review when it has the length of ``single`` (from, below). Bodies are
    whole unless a ``width`` is given.
    """
    # Header and body are worked out inside the list, before it is exploded: a filter
    # on an exploded value stays above the generator and nothing is computed twice.
    pieces = F.split(F.regexp_replace(F.col(text), HEADER, _MARK + "$1"), _MARK)
    headed = F.transform(pieces, lambda p: F.struct(p.alias("piece"), F.regexp_extract(p, "^" + HEADER, 1).alias("header")))
    parts = F.transform(headed, lambda h: F.struct(h["header"].alias("header"), F.left(h["piece"], F.lit(200)).alias("head"), _body_after(h["header"], h["piece"]).alias("body")))
    # The outer form: a plain explode of a column gets a "not empty" filter, which is
    # pushed below this projection and would work out the list three times.
    cut = df.select(*key, F.col(text).alias("_text"), parts.alias("_parts"))
    counted = cut.select(*key, "_text", F.size("_parts").alias("_n"), "_parts")
    rows = counted.select(*key, "_text", "_n", F.posexplode_outer("_parts").alias("_pos", "_part"))
    several, header, whole = F.col("_n") > 1, F.col("_part.header"), F.col("_text")
    low, high = single
    n = F.length(whole)
    kept = F.when(several, (F.col("_pos") > 0) & (F.length("_part.body") > min_body)).otherwise(
        (n > low) & (n < high if high is not None else F.lit(True)) & (n > min_single)
    )
    alone = F.coalesce(F.nullif(reviewer_of(whole), F.lit("")), F.lit("Anonymous"))
    return rows.filter(kept).select(
        *key,
        F.greatest(F.col("_pos") - 1, F.lit(0)).alias("position"),
        F.when(several, reviewer_of(header)).otherwise(alone).alias("reviewer"),
        F.when(several, rating_of(header)).otherwise(rating_of(whole)).alias("rating"),
        F.when(several, parse_date("_part.head", iso=False)).alias("review_date"),
        cut_to(F.when(several, F.col("_part.body")).otherwise(whole), width).alias("body"),
    )


def _body_after(header: Column, piece: Column) -> Column:
    return trim_bullets(F.substring(piece, F.length(header) + 1, F.length(piece)))


def block_columns(block: Column | str, iso: bool = True, width: int | None = None) -> list[Column]:
    """reviewer, rating, review_date and cleaned text of a single review block."""
    b = col_of(block)
    clean = F.regexp_replace(F.regexp_replace(b, PREAMBLE, ""), r"^\s*[•\s]+", "")
    return [
        F.coalesce(F.nullif(reviewer_of(b), F.lit("")), F.lit("Anonymous")).alias("reviewer"),
        rating_of(b).alias("rating"),
        parse_date(b, iso=iso).alias("review_date"),
        cut_to(F.when(F.length(clean) < 30, b).otherwise(clean), width).alias("review_text"),
    ]


def snippet_rows(df: DataFrame, owner: str, snippets: str = "snippets", min_text: int = 20, width: int | None = None) -> DataFrame:
    """Review snippet cards ``{text, reviewer, rating}`` to rows with a positional id."""
    rows = df.select(owner, F.posexplode(snippets).alias("_pos", "s"))
    return rows.filter(F.length("s.text") >= min_text).select(
        owner,
        cut_to(F.col("s.text"), width).alias("review_text"),
        F.regexp_extract("s.rating", r"(\d+(?:\.\d+)?)", 1).try_cast("double").alias("rating"),
        F.col("s.reviewer").alias("reviewer_name"),
        F.concat_ws("-snippet-", F.col(owner).cast("string"), F.col("_pos").cast("string")).alias("source_review_id"),
    )
