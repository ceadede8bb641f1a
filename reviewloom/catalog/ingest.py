"""Queries of the review ingest: landed pages and text blobs to the rows that are new to the review table.

Every document is the text of a review. Storefronts are vendors; some are unknown, some
reviews are known, some come twice, and every page also holds a review that is too short.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query, with_ctes
from reviewloom.catalog.extraction import _BLOB, SPLIT_BLOBS
from reviewloom.catalog.tagging import _DEFAULT_REPLY, _WRONG
from reviewloom.plans import reviews as plan

#: Every document is a review of one of the first vendors, so that all of them are taken at every size.
STOREFRONTS = 150
# The column list is SQL understood by both engines, over documents joined to vendors.
_LANDED = ["CASE WHEN doc_id % 10 = 3 THEN 'NOWHERE' ELSE v.source END AS source", "source_vendor_id", "CAST(date '2024-01-01' + CAST(doc_id % 300 AS INT) AS {text}) AS day", "doc_id", "text"]
LANDED = f"SELECT {', '.join(_LANDED)} FROM documents JOIN vendors v ON v.id = 1 + doc_id % {STOREFRONTS}".format(text="VARCHAR")
_KNOWN = "SELECT source, concat('r', CAST(id AS VARCHAR)) AS source_review_id FROM vendors WHERE id % 7 = 0"


def _landed(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    vendors = b.vendors(spark, sf).select("id", "source", "source_vendor_id").alias("v")
    return docs.join(vendors, F.col("id") == 1 + F.col("doc_id") % STOREFRONTS).selectExpr(*[c.format(text="STRING") for c in _LANDED])


def _pages(spark, sf):
    payload = F.expr("""to_json(named_struct('reviews', named_struct('totalCount', doc_id % 50 + 1, 'nodes', array(
      named_struct('id', concat('r', doc_id DIV 2), 'comment', named_struct('content', text), 'ratings', array(named_struct('name', 'all', 'value', 1 + doc_id % 5))),
      named_struct('id', concat('s', doc_id), 'comment', named_struct('content', 'too short'), 'ratings', NULL)))))""")
    return _landed(spark, sf).select("source", "source_vendor_id", F.struct("day", "doc_id").alias("scraped_at"), payload.alias("payload"))


def _known(spark, sf):
    return b.vendors(spark, sf).filter("id % 7 = 0").select("source", F.concat(F.lit("r"), F.col("id").cast("string")).alias("source_review_id"))


_PAGE_ROWS = """SELECT source, source_vendor_id, concat('r', CAST(doc_id // 2 AS VARCHAR)) AS source_review_id, day, doc_id, coalesce(text, '') AS review_text, 1e0 + doc_id % 5 AS rating FROM landed
    UNION ALL SELECT source, source_vendor_id, concat('s', CAST(doc_id AS VARCHAR)), day, doc_id, 'too short', NULL FROM landed"""
_FRESH = """SELECT p.*, (SELECT min(id) FROM vendors v WHERE v.source = p.source AND v.source_vendor_id = p.source_vendor_id) AS vendor_id
    FROM rows p WHERE source <> 'NOWHERE' AND length(review_text) >= 30 AND (source, source_review_id) NOT IN (SELECT (source, source_review_id) FROM known)
    QUALIFY row_number() OVER (PARTITION BY source, source_review_id ORDER BY day, doc_id) = 1"""
_TAGS = f"""CASE WHEN {_WRONG} THEN CASE WHEN rating >= 4 THEN 'positive' ELSE 'negative' END ELSE sentiment END AS sentiment, array_to_string(complaints, ',') AS complaints, array_to_string(praises, ',') AS praises
    FROM (SELECT *, {_DEFAULT_REPLY.replace('lower(text)', 'lower(review_text)')} AS is_vendor_reply FROM tagged)"""
_CTES = dict(vendors=b.VENDORS, landed=LANDED, known=_KNOWN)
_TAGGED = b.tagged("fresh", b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE)


def _shown(new, *columns):
    return new.select("source", "source_review_id", "vendor_id", *columns, F.md5("review_text").alias("digest"), "rating", "sentiment",
                      b.joined_text("complaint_categories").alias("complaints"), b.joined_text("praise_categories").alias("praises"))


@query("review_ingest_pages", with_ctes(f"SELECT source, source_review_id, vendor_id, md5(review_text) AS digest, rating, {_TAGS}", **_CTES, rows=_PAGE_ROWS, fresh=_FRESH, tagged=_TAGGED))
def ingest_pages(spark, sf):
    return _shown(plan.ingest_pages(_pages(spark, sf), b.vendors(spark, sf), _known(spark, sf), **b.CORPUS).new)


@query("review_ingest_rejected", with_ctes("""SELECT source, source_vendor_id, source_review_id, CASE WHEN source = 'NOWHERE' THEN 'unknown storefront' ELSE 'text too short' END AS reject_reason
    FROM rows WHERE length(review_text) > 0 AND (source = 'NOWHERE' OR length(review_text) < 30)""", **_CTES, rows=_PAGE_ROWS))
def ingest_rejected(spark, sf):
    found = plan.ingest_pages(_pages(spark, sf), b.vendors(spark, sf), _known(spark, sf), **b.CORPUS).rejected
    return found.select("source", "source_vendor_id", "source_review_id", "reject_reason")


@query("review_ingest_totals", with_ctes("""SELECT v.id, coalesce(CAST(o.total AS BIGINT), v.review_count) AS review_count FROM vendors v LEFT JOIN
    (SELECT v.id, arg_max(1 + doc_id % 50, row(day, doc_id)) AS total FROM landed l JOIN vendors v ON v.source = l.source AND v.source_vendor_id = l.source_vendor_id GROUP BY 1) o ON o.id = v.id""", **_CTES))
def ingest_totals(spark, sf):
    """Vendors with the totals their pages showed."""
    found = plan.ingest_pages(_pages(spark, sf), b.vendors(spark, sf), _known(spark, sf), **b.CORPUS).vendors
    return found.select("id", F.col("review_count").cast("bigint").alias("review_count"))


_BLOB_ROWS = """SELECT l.source, l.source_vendor_id, sha256(concat(l.source_vendor_id, chr(1), p.reviewer, chr(1), p.body)) AS source_review_id, l.day, l.doc_id, p.position, p.body AS review_text, p.rating
    FROM pieces p JOIN landed l USING (doc_id)"""


@query("review_ingest_blobs", with_ctes(f"SELECT source, source_review_id, vendor_id, md5(review_text) AS digest, rating, {_TAGS}", **_CTES, blobs=f"SELECT doc_id, {_BLOB} AS blob FROM landed",
    pieces=SPLIT_BLOBS, rows=_BLOB_ROWS, fresh=_FRESH, tagged=_TAGGED))
def ingest_blobs(spark, sf):
    blobs = _landed(spark, sf).select("source", "source_vendor_id", F.struct("day", "doc_id").alias("scraped_at"), F.expr(_BLOB).alias("text"))
    return _shown(plan.ingest_blobs(blobs, b.vendors(spark, sf), _known(spark, sf), **b.CORPUS)[0])
