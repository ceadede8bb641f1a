"""Queries of the upsert, dedup and package families."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query, with_ctes
from reviewloom.operators import dedup, packages
from reviewloom.operators import upsert as up
from reviewloom.session import shared_dir
from reviewloom.sources.keyed_table import KeyedTable

V, R = b.VENDORS, b.REVIEWS

# ---- H: upserts -----------------------------------------------------------
# Stored table: one row per vendor. Batch: every order is an observation of its
# customer and every part an observation of a (mostly unknown) vendor, so a key
# occurs many times, some keys are new and some stored rows are never seen.

_STORED = """SELECT source, source_vendor_id, name, phone, city, CAST(starting_price_min AS DOUBLE) AS price, review_count, state AS first_seen
  FROM vendors"""
_BATCH = """SELECT v.source, v.source_vendor_id, concat(v.name, ' #', CAST(o.o_orderkey AS VARCHAR)) AS name,
    CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE concat('9-', CAST(o.o_orderkey AS VARCHAR)) END AS phone,
    CASE WHEN o.o_orderstatus = 'F' THEN NULL WHEN o.o_orderstatus = 'P' THEN '' ELSE o.o_orderpriority END AS city,
    CASE WHEN o.o_totalprice > 250000 THEN o.o_totalprice END AS price, CAST(o.o_orderkey AS INT) AS review_count,
    concat('seen ', CAST(o.o_orderkey AS VARCHAR)) AS first_seen, o.o_orderkey AS seq
  FROM orders o JOIN vendors v ON v.id = o.o_custkey WHERE o.o_orderstatus <> 'O' OR o.o_totalprice < 400000
  UNION ALL SELECT 'NEW', p_type, p_name, p_brand, CASE WHEN p_size < 20 THEN NULL ELSE p_brand END, p_retailprice, p_size, p_name, p_partkey
  FROM part"""
_POLICY = {"name": up.OVERWRITE, "phone": up.COALESCE, "city": up.COALESCE, "price": up.COALESCE, "review_count": up.OVERWRITE}
KEY = ["source", "source_vendor_id"]


def stored(spark, sf):
    return b.vendors(spark, sf).select(
        *KEY, "name", "phone", "city", F.col("starting_price_min").cast("double").alias("price"), "review_count",
        F.col("state").alias("first_seen"),
    )


def batch(spark, sf):
    orders = b.table(spark, sf, "orders").filter("o_orderstatus <> 'O' OR o_totalprice < 400000")
    seen = orders.join(b.vendors(spark, sf).select("id", *KEY, "name"), F.col("o_custkey") == F.col("id")).selectExpr(
        *KEY, "concat(name, ' #', o_orderkey) AS name",
        "CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat('9-', o_orderkey) END AS phone",
        "CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS city",
        "CASE WHEN o_totalprice > 250000 THEN o_totalprice END AS price", "CAST(o_orderkey AS INT) AS review_count",
        "concat('seen ', o_orderkey) AS first_seen", "o_orderkey AS seq",
    )
    fresh = b.table(spark, sf, "part").selectExpr(
        "'NEW' AS source", "p_type AS source_vendor_id", "p_name AS name", "p_brand AS phone",
        "CASE WHEN p_size < 20 THEN NULL ELSE p_brand END AS city", "p_retailprice AS price", "p_size AS review_count",
        "p_name AS first_seen", "p_partkey AS seq",
    )
    return seen.unionByName(fresh)


def _upsert_sql(blank: bool) -> str:
    """Row-by-row semantics from ordered lists of each key's batch values."""
    nn = (lambda c: f"nullif({c}, '')") if blank else (lambda c: c)
    last = lambda c: f"last({c} ORDER BY seq) FILTER ({c} IS NOT NULL)"
    return with_ctes(
        f"""SELECT coalesce(s.source, n.source) AS source, coalesce(s.source_vendor_id, n.source_vendor_id) AS source_vendor_id,
        CASE WHEN n.source IS NOT NULL THEN n.name ELSE s.name END AS name,
        coalesce(n.phone, CASE WHEN s.source IS NULL THEN n.phone0 ELSE s.phone END) AS phone,
        coalesce(n.city, CASE WHEN s.source IS NULL THEN n.city0 ELSE s.city END) AS city, coalesce(n.price, s.price) AS price,
        CASE WHEN n.source IS NOT NULL THEN n.review_count ELSE s.review_count END AS review_count,
        CASE WHEN s.source IS NOT NULL THEN s.first_seen ELSE n.first_seen END AS first_seen,
        CASE WHEN n.source IS NULL THEN 'kept' WHEN s.source IS NULL THEN 'inserted' ELSE 'updated' END AS action
        FROM stored s FULL JOIN folded n ON s.source = n.source AND s.source_vendor_id = n.source_vendor_id""",
        vendors=V, stored=_STORED, batch=_BATCH,
        folded=f"""SELECT source, source_vendor_id, last(name ORDER BY seq) AS name, {last(nn('phone'))} AS phone, {last(nn('city'))} AS city,
          first(phone ORDER BY seq) AS phone0, first(city ORDER BY seq) AS city0,
          {last('price')} AS price, last(review_count ORDER BY seq) AS review_count, first(first_seen ORDER BY seq) AS first_seen
          FROM batch GROUP BY 1, 2""",
    )


@query("h01_vendor_upsert", _upsert_sql(False))
def h01(spark, sf):
    return up.upsert(stored(spark, sf), batch(spark, sf), KEY, _POLICY, "seq", action="action")


@query("h02_vendor_upsert_blank_as_null", _upsert_sql(True))
def h02(spark, sf):
    return up.upsert(stored(spark, sf), batch(spark, sf), KEY, _POLICY, "seq", blank_as_null=True, action="action")


def _keyed(spark, name, key, rows, buckets=16):
    table = KeyedTable(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", key, buckets)
    table.create(rows)
    return table


@query("h01_vendor_table_merge", f"SELECT * EXCLUDE (action) FROM ({_upsert_sql(False)})")
def h01b(spark, sf):
    """The batch in three parts, one after the other, into a table by key hash."""
    table, rows = _keyed(spark, "vendors", KEY, stored(spark, sf)), batch(spark, sf)
    for low, high in ((0, 40), (40, 200), (200, None)):
        table.merge(rows.where(F.col("seq") >= low if high is None else F.col("seq").between(low, high - 1)), _POLICY, "seq")
    return table.read()


_BULK_STORED = """SELECT source, source_vendor_id, name, city, state, 'old' AS starting_price_range, CAST(star_rating AS DOUBLE) AS star_rating, review_count,
    CAST(NULL AS VARCHAR) AS service_area, CASE WHEN id % 3 = 0 THEN 'gold' END AS ad_tier, '' AS vendor_tier, 'open' AS claimed_status, CAST(NULL AS VARCHAR) AS awards, 1 AS last_seen, phone FROM vendors"""
_BULK_SEEN = """SELECT v.source, v.source_vendor_id, concat(v.name, ' ', o_orderpriority) AS name, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS city,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS state, CASE WHEN o_totalprice > 300000 THEN 'high' END AS starting_price_range, o_totalprice AS star_rating, CAST(o_custkey AS INT) AS review_count,
    CASE WHEN o_orderkey % 5 = 0 THEN 'far' END AS service_area, CASE WHEN o_orderkey % 7 = 0 THEN 'silver' END AS ad_tier, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS vendor_tier,
    CASE WHEN o_orderkey % 11 = 0 THEN 'claimed' ELSE '' END AS claimed_status, o_orderpriority AS awards, 2 AS last_seen, 'batch' AS phone, o_orderkey AS seq
  FROM orders JOIN vendors v ON v.id = o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END
  UNION ALL SELECT 'NEW', p_type, p_name, p_brand, '', NULL, 0e0, p_size, NULL, NULL, '', 'open', '', 2, 'batch', p_partkey FROM part"""
_BULK_OVER, _BULK_KEEP = ([c for c, rule in up.BULK_VENDOR_POLICY.items() if rule == r] for r in (up.OVERWRITE, up.COALESCE))


@query("h02_bulk_vendor_merge", with_ctes(
    "SELECT coalesce(s.source, n.source) AS source, coalesce(s.source_vendor_id, n.source_vendor_id) AS source_vendor_id, "
    + ", ".join(f"CASE WHEN n.source IS NOT NULL THEN n.{c} ELSE s.{c} END AS {c}" for c in _BULK_OVER)
    + ", " + ", ".join(f"coalesce(n.{c}, CASE WHEN s.source IS NULL THEN n.{c}0 ELSE s.{c} END) AS {c}" for c in _BULK_KEEP)
    + ", CASE WHEN s.source IS NOT NULL THEN s.phone ELSE n.phone END AS phone FROM held s FULL JOIN folded n ON s.source = n.source AND s.source_vendor_id = n.source_vendor_id",
    vendors=V, held=_BULK_STORED, seen=_BULK_SEEN,
    folded="SELECT source, source_vendor_id, first(phone ORDER BY seq) AS phone, " + ", ".join(f"last({c} ORDER BY seq) AS {c}" for c in _BULK_OVER) + ", "
    + ", ".join(f"last(nullif({c}, '') ORDER BY seq) FILTER (nullif({c}, '') IS NOT NULL) AS {c}, first({c} ORDER BY seq) AS {c}0" for c in _BULK_KEEP) + " FROM seen GROUP BY 1, 2"))
def h02b(spark, sf):
    """The bulk policy over a whole snapshot; blanks keep what is stored."""
    vendors = b.vendors(spark, sf)
    held = vendors.selectExpr(
        *KEY, "name", "city", "state", "'old' AS starting_price_range", "CAST(star_rating AS DOUBLE) AS star_rating", "review_count", "CAST(NULL AS STRING) AS service_area",
        "CASE WHEN id % 3 = 0 THEN 'gold' END AS ad_tier", "'' AS vendor_tier", "'open' AS claimed_status", "CAST(NULL AS STRING) AS awards", "1 AS last_seen", "phone")
    owner = F.expr("o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END")
    seen = b.table(spark, sf, "orders").join(vendors.select("id", *KEY, "name"), owner == F.col("id")).selectExpr(
        *KEY, "concat(name, ' ', o_orderpriority) AS name", "CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS city", "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS state",
        "CASE WHEN o_totalprice > 300000 THEN 'high' END AS starting_price_range", "o_totalprice AS star_rating", "CAST(o_custkey AS INT) AS review_count", "CASE WHEN o_orderkey % 5 = 0 THEN 'far' END AS service_area",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'silver' END AS ad_tier", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS vendor_tier", "CASE WHEN o_orderkey % 11 = 0 THEN 'claimed' ELSE '' END AS claimed_status",
        "o_orderpriority AS awards", "2 AS last_seen", "'batch' AS phone", "o_orderkey AS seq")
    fresh = b.table(spark, sf, "part").selectExpr(
        "'NEW' AS source", "p_type AS source_vendor_id", "p_name AS name", "p_brand AS city", "'' AS state", "CAST(NULL AS STRING) AS starting_price_range", "0D AS star_rating", "p_size AS review_count",
        "CAST(NULL AS STRING) AS service_area", "CAST(NULL AS STRING) AS ad_tier", "'' AS vendor_tier", "'open' AS claimed_status", "'' AS awards", "2 AS last_seen", "'batch' AS phone", "p_partkey AS seq")
    table = _keyed(spark, "vendors", KEY, held)
    table.merge(seen.unionByName(fresh), up.BULK_VENDOR_POLICY, "seq", blank_as_null=True)
    return table.read()


@query("h03_upsert_counts", with_ctes("""SELECT count(*) FILTER (s.source IS NULL) AS inserted,
    CAST(sum(n.rows - CASE WHEN s.source IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS updated
    FROM (SELECT source, source_vendor_id, count(*) AS rows FROM batch GROUP BY 1, 2) n
    LEFT JOIN stored s ON s.source = n.source AND s.source_vendor_id = n.source_vendor_id""", vendors=V, stored=_STORED, batch=_BATCH))
def h03(spark, sf):
    return up.upsert_counts(stored(spark, sf), batch(spark, sf), KEY)


_LANDED = """SELECT l_returnflag AS source, CAST(l_orderkey // 2 AS VARCHAR) AS source_review_id, l_extendedprice AS price,
    l_orderkey * 10 + l_linenumber AS seq, l_partkey, l_suppkey FROM lineitem"""
_HELD = "SELECT 'A' AS source, CAST(o_orderkey AS VARCHAR) AS source_review_id FROM orders WHERE o_orderstatus = 'F'"


def _landed(spark, sf):
    return b.table(spark, sf, "lineitem").selectExpr(
        "l_returnflag AS source", "CAST(l_orderkey DIV 2 AS STRING) AS source_review_id",
        "l_extendedprice AS price", "l_orderkey * 10 + l_linenumber AS seq", "l_partkey", "l_suppkey",
    )


@query("h04_insert_ignore_known", with_ctes("""SELECT source, source_review_id, min(seq) AS seq, first(price ORDER BY seq, l_partkey, l_suppkey, price) AS price FROM landed
    WHERE (source, source_review_id) NOT IN (SELECT (source, source_review_id) FROM held) GROUP BY 1, 2""", landed=_LANDED, held=_HELD))
def h04(spark, sf):
    held = b.table(spark, sf, "orders").filter("o_orderstatus = 'F'").selectExpr(
        "'A' AS source", "CAST(o_orderkey AS STRING) AS source_review_id"
    )
    return up.new_rows(held, _landed(spark, sf), up.REVIEW_KEY, ["seq", "l_partkey", "l_suppkey", "price"]).select("source", "source_review_id", "seq", "price")


@query("h04_known_key_table", with_ctes("""SELECT source, source_review_id, min(seq) AS seq, first(price ORDER BY seq, price) AS price FROM landed
    WHERE (source, source_review_id) NOT IN (SELECT (source, source_review_id) FROM held) GROUP BY 1, 2 UNION ALL SELECT source, source_review_id, NULL, NULL FROM held""", landed=_LANDED, held=_HELD))
def h04b(spark, sf):
    """Drops by ship year into a table by key hash, the last one twice: each reads the keys of its buckets and appends what is unknown."""
    held = b.table(spark, sf, "orders").filter("o_orderstatus = 'F'").selectExpr(
        "'A' AS source", "CAST(o_orderkey AS STRING) AS source_review_id", "CAST(NULL AS BIGINT) AS seq", "CAST(NULL AS DOUBLE) AS price")
    table, rows = _keyed(spark, "known", up.REVIEW_KEY, held), _landed(spark, sf).select("source", "source_review_id", "seq", "price")
    step = b.table(spark, sf, "lineitem").agg(F.max(F.col("l_orderkey") * 10) / 3).first()[0]
    for k in (0, 1, 2, 2):
        part = F.least(F.lit(2), F.floor(F.col("seq") / step)) == k
        table.insert_new(rows.where(part), ["seq", "price"], files=2)
    return table.read()


@query("h05_review_upsert_newest", with_ctes("""SELECT coalesce(s.id, n.id) AS id, CASE WHEN n.id IS NULL THEN s.review_text ELSE n.review_text END AS review_text,
    CASE WHEN n.id IS NULL THEN s.rating ELSE n.rating END AS rating FROM (SELECT id, review_text, CAST(rating AS DOUBLE) AS rating FROM reviews) s
    FULL JOIN (SELECT l_orderkey // 2 AS id, last(l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS review_text,
    last(l_quantity ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rating
    FROM lineitem GROUP BY 1) n ON n.id = s.id""", reviews=R))
def h05(spark, sf):
    """Stored as a table by key hash: only the buckets the batch touches are written."""
    fresh = b.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey DIV 2 AS id", "l_returnflag AS review_text", "l_quantity AS rating",
        "struct(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq",
    )
    table = _keyed(spark, "reviews", ["id"], b.reviews(spark, sf).select("id", "review_text", F.col("rating").cast("double").alias("rating")))
    table.merge(fresh, up.REVIEW_POLICY, "seq")
    return table.read()


@query("h06_validation_gate", with_ctes("""SELECT id, CASE WHEN length(review_text) < 30 THEN 'text too short'
    WHEN src = '' THEN 'source missing' ELSE 'valid' END AS verdict FROM (SELECT *, CASE source WHEN 'feed-P' THEN '' ELSE source END AS src FROM reviews)""",
    reviews=R))
def h06(spark, sf):
    base = b.reviews(spark, sf).withColumn("source", F.nullif("source", F.lit("feed-P")))
    valid, rejected = up.validate_reviews(base, 30)
    return valid.select("id", F.lit("valid").alias("verdict")).unionByName(
        rejected.select("id", F.col("reject_reason").alias("verdict"))
    )


# ---- I: dedup and set operations ------------------------------------------

@query("i01_first_by_key", """SELECT l_suppkey, l_returnflag, min(l_orderkey * 10 + l_linenumber) AS seq,
    first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS price FROM lineitem GROUP BY 1, 2""")
def i01(spark, sf):
    rows = b.table(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "l_returnflag", "l_orderkey * 10 + l_linenumber AS seq", "l_extendedprice AS price", "l_partkey"
    )
    return dedup.first_by_key(rows, ["l_suppkey", "l_returnflag"], ["seq", "l_partkey", "price"]).drop("l_partkey")


@query("i02_first_by_name", """SELECT min(p_partkey) AS id, lower(trim(upper(p_name))) AS name FROM part GROUP BY 2""")
def i02(spark, sf):
    rows = b.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("  "), F.upper("p_name")).alias("name"))
    return dedup.first_by_name(rows, "name", ["id"]).select("id", F.lower(F.trim("name")).alias("name"))


@query("i03_near_duplicate_reviews", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY lang, left(text, 100)")
def i03(spark, sf):
    docs = b.table(spark, sf, "documents")
    return dedup.first_review(docs, "lang", "text", ["doc_id"]).select("doc_id")


@query("i04_block_prefix_dedup", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY left(text, 100)")
def i04(spark, sf):
    return dedup.first_block(b.table(spark, sf, "documents"), [], "text", ["doc_id"]).select("doc_id")


@query("i05_distinct_prices_in_row", """SELECT c_custkey, array_to_string(CASE WHEN a = k2 THEN [p1] ELSE [p1, p3] END, '|') AS prices FROM (
    SELECT c_custkey, concat('$1,', CAST(c_nationkey + 100 AS VARCHAR)) AS p1, concat('$1,', CAST(c_nationkey + 100 AS VARCHAR)) AS a,
    concat('$1,', CAST(100 + CAST(abs(c_acctbal) AS BIGINT) // 400 AS VARCHAR)) AS p3,
    concat('$1,', CAST(100 + CAST(abs(c_acctbal) AS BIGINT) // 400 AS VARCHAR)) AS k2 FROM
    (SELECT c_custkey, c_nationkey, trunc(abs(c_acctbal)) AS c_acctbal FROM customer))""")
def i05(spark, sf):
    n = (F.col("c_nationkey") + 100).cast("string")
    m = (F.lit(100) + F.floor(F.floor(F.abs("c_acctbal")) / 400)).cast("bigint").cast("string")
    prices = F.array(F.concat(F.lit("$1,"), n), F.concat(F.lit(" $1"), n), F.concat(F.lit("$1,"), m))
    return b.table(spark, sf, "customer").select("c_custkey", F.array_join(dedup.distinct_prices(prices), "|").alias("prices"))


@query("i06_distinct_url_prefix", "SELECT min(page_id) AS page_id, left(url, 24) AS prefix FROM pages GROUP BY 2")
def i06(spark, sf):
    pages = b.table(spark, sf, "pages")
    return dedup.distinct_prefix(pages, "url", ["page_id"], 24).select("page_id", F.left("url", F.lit(24)).alias("prefix"))


@query("i07_union_of_sources", """SELECT 'customer' AS source, CAST(c_custkey AS VARCHAR) AS key, c_acctbal AS balance, NULL AS size FROM customer
    UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), NULL, p_size FROM part
    UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_acctbal, NULL FROM supplier""")
def i07(spark, sf):
    return dedup.unify([
        b.table(spark, sf, "customer").selectExpr("'customer' AS source", "CAST(c_custkey AS STRING) AS key", "c_acctbal AS balance"),
        b.table(spark, sf, "part").selectExpr("'part' AS source", "CAST(p_partkey AS STRING) AS key", "p_size AS size"),
        b.table(spark, sf, "supplier").selectExpr("'supplier' AS source", "CAST(s_suppkey AS STRING) AS key", "s_acctbal AS balance"),
    ])


@query("i08_review_ids", """SELECT conv_id, turn, concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS position_id,
    concat(CAST(conv_id AS VARCHAR), '-snippet-', CAST(turn AS VARCHAR)) AS snippet_id,
    sha256(concat(CAST(conv_id AS VARCHAR), chr(1), role, chr(1), text)) AS content_id FROM conversations""")
def i08(spark, sf):
    return b.table(spark, sf, "conversations").select(
        "conv_id", "turn", dedup.positional_id("conv_id", "turn").alias("position_id"),
        dedup.positional_id("conv_id", "turn", "snippet").alias("snippet_id"),
        dedup.content_id("conv_id", "role", "text").alias("content_id"),
    )


# ---- E12: packages of three sources ---------------------------------------
# part by name is the first source, lineitem by part name the direct probe,
# customer segments the website source

_FIRST = "SELECT p_name AS name, p_partkey AS seq, p_brand AS pkg, p_type AS price FROM part"
_DIRECT = """SELECT p_name AS name, row(l_orderkey, l_linenumber, l_partkey, l_suppkey) AS seq, l_returnflag AS pkg, l_linestatus AS price, CAST(l_suppkey AS VARCHAR) AS phone
  FROM lineitem JOIN part ON p_partkey = l_partkey"""
_SITES = "SELECT c_mktsegment AS name, c_custkey AS seq, CAST(c_custkey AS VARCHAR) AS phone FROM customer UNION ALL SELECT p_name, p_partkey, 'site' FROM part"


def _package_inputs(spark, sf):
    part = b.table(spark, sf, "part")
    pkg = "array(named_struct('name', {n}, 'price', {p})) AS packages"
    first = part.selectExpr("p_name AS name", "p_partkey AS seq", pkg.format(n="p_brand", p="p_type"), "array(p_type) AS prices_found")
    direct = (
        b.table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr("p_name AS name", "struct(l_orderkey, l_linenumber, l_partkey, l_suppkey) AS seq", pkg.format(n="l_returnflag", p="l_linestatus"),
                    "array(l_linestatus) AS prices_clean", "array(l_returnflag) AS prices", "CAST(l_suppkey AS STRING) AS phone",
                    "'' AS description", "1 AS pages_ok", "'' AS website_url")
    )
    sites = b.table(spark, sf, "customer").selectExpr(
        "c_mktsegment AS name", "c_custkey AS seq", "CAST(c_custkey AS STRING) AS phone", "'w' AS website_url"
    ).unionByName(part.selectExpr("p_name AS name", "p_partkey AS seq", "'site' AS phone", "'w' AS website_url"))
    return first, direct, sites


@query("e12_package_scalars", with_ctes("""SELECT n.name, CASE WHEN d.name IS NOT NULL THEN d.phone ELSE w.phone END AS phone,
    CASE WHEN d.name IS NOT NULL THEN '' ELSE w.url END AS website_url FROM
    (SELECT name FROM f UNION SELECT name FROM d0 UNION SELECT name FROM s) n
    LEFT JOIN (SELECT name, arg_max(phone, seq) AS phone FROM d0 GROUP BY 1) d ON d.name = n.name
    LEFT JOIN (SELECT name, arg_min(phone, seq) AS phone, 'w' AS url FROM s GROUP BY 1) w ON w.name = n.name""", f=_FIRST, d0=_DIRECT, s=_SITES))
def e12a(spark, sf):
    first, direct, sites = _package_inputs(spark, sf)
    return packages.merge_scalars(first, direct, sites).select("name", "phone", "website_url")


@query("e12_package_rows", with_ctes("""SELECT name, 0 AS source_rank, arg_max(pkg, seq) AS package, arg_max(price, seq) AS price FROM f GROUP BY 1
    UNION ALL SELECT name, 1, pkg, price FROM d0""", f=_FIRST, d0=_DIRECT))
def e12b(spark, sf):
    first, direct, _ = _package_inputs(spark, sf)
    return packages.merge_packages(first, direct).select(
        "name", "source_rank", F.col("package.name").alias("package"), F.col("package.price").alias("price")
    )


@query("e12_package_prices", with_ctes("""SELECT name, arg_max(price, seq) AS price FROM f GROUP BY 1
    UNION SELECT name, price FROM d0 UNION SELECT name, pkg FROM d0""", f=_FIRST, d0=_DIRECT))
def e12c(spark, sf):
    first, direct, _ = _package_inputs(spark, sf)
    return packages.merge_prices(first, direct)


# ---- whole plans ----------------------------------------------------------


@query("dataset_build", with_ctes("""SELECT coalesce(s.source, n.source) AS source, coalesce(s.svid, n.svid) AS source_vendor_id,
    coalesce(n.name, s.name) AS name, CASE WHEN n.svid IS NOT NULL THEN n.phone ELSE s.phone END AS phone, coalesce(s.category, n.category) AS category,
    coalesce(n.price, s.price) AS starting_price_min, CASE WHEN n.svid IS NOT NULL THEN n.rating ELSE s.rating END AS star_rating,
    CASE WHEN n.svid IS NOT NULL THEN 7 END AS scrape_run_id FROM
    (SELECT source, source_vendor_id AS svid, name, phone, category, CAST(starting_price_min AS DOUBLE) AS price, CAST(star_rating AS DOUBLE) AS rating FROM vendors) s
    FULL JOIN (SELECT 'ASIA' AS source, s_name AS svid, concat(s_name, ' listed') AS name, '' AS phone, 'wedding-photographers' AS category,
        CASE WHEN s_acctbal > 0 THEN floor(s_acctbal) END AS price, 0e0 AS rating FROM supplier
      UNION ALL SELECT v.source, v.source_vendor_id, concat(v.name, ' new'), concat('9', v.phone), v.category, NULL, 3e0 FROM vendors v) n
    ON s.source = n.source AND s.svid = n.svid""", vendors=V))
def dataset_build(spark, sf):
    """Two source shapes into the stored vendor table: suppliers are new, vendors are seen again."""
    from datetime import datetime

    from reviewloom.plans.dataset import build_vendors

    vendors = b.vendors(spark, sf)
    held = vendors.select(
        "source", "source_vendor_id", "name", "phone", "category", F.col("starting_price_min").cast("double").alias("starting_price_min"),
        F.col("star_rating").cast("double").alias("star_rating"), F.lit(None).cast("bigint").alias("scrape_run_id"),
    )
    listed = b.table(spark, sf, "supplier").select(
        F.lit("ASIA").alias("source"), F.col("s_name").alias("slug"), F.concat("s_name", F.lit(" listed")).alias("name"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("$"), F.format_number(F.floor("s_acctbal"), 0), F.lit(".00"))).otherwise("call").alias("starting_price"),
        F.col("s_suppkey").alias("seq"),
    )
    detailed = vendors.select(
        "source", F.col("source_vendor_id").alias("vendor_id"), F.concat("name", F.lit(" new")).alias("name"), F.concat(F.lit("9"), "phone").alias("phone"),
        "category", F.lit(3.0).alias("rating"), F.col("id").alias("seq"),
    )
    rules = {"ASIA": ["vendor_id", "slug"], "EUROPE": ["vendor_id"]}
    return build_vendors(held, [listed, detailed], rules, 7, datetime(2024, 1, 1))


@query("pricing_build", """SELECT source, key, name, category, starting_price_min, CASE WHEN p IS NULL THEN 'unknown' WHEN p < lo THEN 'budget' WHEN p < mid THEN 'mid' ELSE 'premium' END AS price_tier
    FROM (SELECT *, coalesce(nullif(a, 0), starting_price_min) AS p, CASE category WHEN 'COORD' THEN 1500 ELSE 1200 END AS lo, CASE category WHEN 'COORD' THEN 3500 ELSE 2500 END AS mid,
    row_number() OVER (PARTITION BY source, key ORDER BY r, pos) AS rn FROM (
      SELECT 'one' AS source, p_brand AS key, p_name AS name, 'COORD' AS category, p_size * 100e0 AS starting_price_min, NULL AS a, 0 AS r, p_partkey AS pos FROM part
      UNION ALL SELECT 'two', concat('/s/', CAST(s_nationkey AS VARCHAR)), s_name, 'DJ', NULL, CASE WHEN s_acctbal > 0 THEN s_acctbal END, 1, s_suppkey FROM supplier)) WHERE rn = 1""")
def pricing_build(spark, sf):
    from reviewloom.functions.scalars import first_filled
    from reviewloom.plans.dataset import priced_listings

    one = b.table(spark, sf, "part").selectExpr(
        "'one' AS source", "p_brand AS vendor_id", "p_name AS name", "'COORD' AS category", "p_size * 100D AS starting_price_min",
        "CAST(NULL AS DOUBLE) AS starting_price_avg", "0 AS source_rank", "p_partkey AS position",
    )
    two = b.table(spark, sf, "supplier").selectExpr(
        "'two' AS source", "'' AS vendor_id", "concat('/s/', s_nationkey) AS source_url", "s_name AS name", "'DJ' AS category",
        "CASE WHEN s_acctbal > 0 THEN s_acctbal END AS starting_price_avg", "1 AS source_rank", "s_suppkey AS position",
    )
    return priced_listings([one, two]).select(
        "source", first_filled("vendor_id", "source_url").alias("key"), "name", "category", "starting_price_min", "price_tier"
    )
