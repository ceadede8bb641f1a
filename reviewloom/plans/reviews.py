"""Review ingest: landed review pages to the rows that are new to the review table.

pages -> review rows -> vendor id -> validation -> known keys out -> tagging of what is
new -> rows to append. Totals that the pages observed update the vendors. Whatever is
not taken is in ``rejected`` with a reason; a second run over the same pages adds nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.payloads import review_nodes
from reviewloom.functions.review_text import split_reviews
from reviewloom.operators.selects import attach_vendor_id, observed_totals
from reviewloom.operators.upsert import REVIEW_KEY, new_rows, validate_reviews
from reviewloom.plans.tagging import repair, tag_and_repair, tag_reviews, untagged


class Ingest(NamedTuple):
    """New tagged reviews, rows not taken with ``reject_reason``, vendors with their observed totals."""

    new: DataFrame
    rejected: DataFrame
    vendors: DataFrame


def ingest_rows(rows: DataFrame, vendors: DataFrame, stored: DataFrame, order: str = "scraped_at", min_text: int = 30, **lexicon) -> tuple[DataFrame, DataFrame]:
    """(new tagged reviews, rejected rows) of review rows with source, source_vendor_id and source_review_id."""
    ids = vendors.groupBy("source", "source_vendor_id").agg(F.min("id").alias("vendor_id"))
    placed = rows.join(ids, ["source", "source_vendor_id"], "left")
    unknown = placed.where("vendor_id is null").drop("vendor_id").withColumn("reject_reason", F.lit("unknown storefront"))
    valid, short = validate_reviews(placed.where("vendor_id is not null"), min_text)
    fresh = new_rows(stored, valid, REVIEW_KEY, [order])
    return tag_and_repair(fresh, **lexicon), unknown.unionByName(short, allowMissingColumns=True)


def ingest_pages(pages: DataFrame, vendors: DataFrame, stored: DataFrame, payload: str = "payload", order: str = "scraped_at", min_text: int = 30, **lexicon) -> Ingest:
    """The plan over landed pages with source, source_vendor_id, ``order`` and the review payload."""
    rows = review_nodes(pages, ["source", "source_vendor_id", order], payload, min_text=0)
    new, rejected = ingest_rows(rows, vendors, stored, order, min_text, **lexicon)
    seen = attach_vendor_id(rows.select("source", "source_vendor_id", order, F.col("total_count").alias("total")), vendors)
    return Ingest(new, rejected, observed_totals(vendors, seen, "total", order))


def ingest_blobs(blobs: DataFrame, vendors: DataFrame, stored: DataFrame, text: str = "text", order: str = "scraped_at", min_text: int = 30, **lexicon) -> tuple[DataFrame, DataFrame]:
    """The plan over text blobs that hold the reviews of one storefront each; the id is made of storefront, reviewer and text."""
    rows = split_reviews(blobs, ["source", "source_vendor_id", order], text).withColumnRenamed("body", "review_text")
    made = F.sha2(F.concat_ws("\u0001", "source_vendor_id", "reviewer", "review_text"), 256)
    return ingest_rows(rows.withColumn("source_review_id", made), vendors, stored, order, min_text, **lexicon)


def tag_untagged(reviews: DataFrame, key: str = "id", **lexicon) -> DataFrame:
    """The review table with tags on the rows that had none; the others stay as they are."""
    fresh = repair(tag_reviews(untagged(reviews), **lexicon))
    kept = reviews.join(untagged(reviews).select(key), key, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)
