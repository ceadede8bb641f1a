"""Queries of sources, sinks and streams: every one writes table data to files and reads it back.

Files go below the session's shared folder, a new folder for each run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reviewloom import schemas
from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query, with_ctes
from reviewloom.session import shared_dir
from reviewloom.sources import readers, sinks
from reviewloom.streaming import incremental as inc

V, R = b.VENDORS, b.REVIEWS


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_RECORD_COLUMNS = ["source", "vendor_id", "name", "category", "starting_price_min", "star_rating", "review_count"]
_RECORDS = """SELECT source, source_vendor_id AS vendor_id, name, category, CAST(starting_price_min AS DOUBLE) AS starting_price_min,
    CAST(star_rating AS DOUBLE) AS star_rating, review_count FROM vendors"""


def _records(spark, sf):
    return b.vendors(spark, sf).select(
        "source", F.col("source_vendor_id").alias("vendor_id"), "name", "category",
        F.col("starting_price_min").cast("double").alias("starting_price_min"),
        F.col("star_rating").cast("double").alias("star_rating"), "review_count",
        F.array(F.struct(F.col("state").alias("name"))).alias("awards"),
    )


@query("a01_read_record_file", with_ctes(_RECORDS, vendors=V))
def a01(spark, sf):
    path = _folder(spark, "records")
    sinks.write_records(_records(spark, sf), path)
    return readers.read_records(spark, path, lines=True).select(*_RECORD_COLUMNS)


@query("a01_read_large_array", with_ctes(_RECORDS, vendors=V))
def a01b(spark, sf):
    """One file with one array, its records indented and on several lines, read in splits."""
    path, rows = _folder(spark, "array"), _records(spark, sf)
    text = F.concat(F.lit('  {"note": "a } in a \\"text\\" {",\n   '), F.expr("substring(r, 2)"), F.lit(","))
    body = rows.select(F.to_json(F.struct(*rows.columns)).alias("r")).select(F.lit(1).alias("place"), text.alias("line"))
    ends = spark.createDataFrame([(0, "["), (2, '"end"]')], "place INT, line STRING")
    body.unionByName(ends).coalesce(1).sortWithinPartitions("place").select("line").write.text(path)
    return readers.read_records(spark, f"{path}/*.txt", split=True).select(*_RECORD_COLUMNS)


@query("a02_newest_file", with_ctes(f"SELECT * FROM ({_RECORDS}) WHERE source = 'EUROPE'", vendors=V))
def a02(spark, sf):
    root = _folder(spark, "snapshots")
    for stamp, source in (("20240101", "ASIA"), ("20240301", "EUROPE"), ("20240201", "AFRICA")):
        sinks.write_records(_records(spark, sf).filter(F.col("source") == source), f"{root}/pricing_{stamp}")
    return readers.newest_file(spark, f"{root}/pricing_*", schemas.PRICING_RECORD, lines=True).select(*_RECORD_COLUMNS)


@query("a02_newest_batch", with_ctes("SELECT id FROM reviews WHERE review_date = (SELECT max(review_date) FROM reviews)", reviews=R))
def a02b(spark, sf):
    return readers.newest_batch(b.reviews(spark, sf).select("id", "review_date"), "review_date").select("id")


@query("a03_three_package_sources", """SELECT 'first' AS kind, count(*) AS records, count(DISTINCT p_name) AS names, count(*) AS packages FROM part
    UNION ALL SELECT 'direct', count(*), count(DISTINCT c_name), 2 * count(*) FROM customer UNION ALL SELECT 'website', count(*), count(DISTINCT s_name), 0 FROM supplier""")
def a03(spark, sf):
    """Arrays of two shapes and objects keyed by name, one JSON document per line."""
    root = _folder(spark, "packages")
    b.table(spark, sf, "part").select(F.expr("""to_json(array(named_struct('name', p_name, 'packages', array(named_struct('name', p_brand, 'price', p_type)),
      'prices_found', array(p_type))))""")).write.text(f"{root}/first")
    b.table(spark, sf, "customer").select(F.expr("""to_json(array(named_struct('name', c_name, 'packages', array(named_struct('name', 'a'), named_struct('name', 'b')),
      'prices', array('1'), 'url', 'u')))""")).write.text(f"{root}/direct")
    b.table(spark, sf, "supplier").select(F.expr("to_json(map(s_name, named_struct('phone', '5', 'website_url', 'w')))")).write.text(f"{root}/web")
    first, direct, web = readers.read_package_files(spark, f"{root}/first", f"{root}/direct", f"{root}/web", lines=True)
    count = lambda df, kind, size: df.agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("name").alias("names"), F.coalesce(F.sum(size), F.lit(0)).alias("packages")
    ).select(F.lit(kind).alias("kind"), "records", "names", "packages")
    return (
        count(first, "first", F.size("packages")).unionByName(count(direct, "direct", F.size("packages")))
        .unionByName(count(web, "website", F.lit(0)))
    )


@query("a04_table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000")
def a04(spark, sf):
    return readers.read_table(spark, f"{sf}/orders.parquet").filter("o_orderstatus = 'F' AND o_totalprice > 250000").select("o_orderkey", "o_totalprice")


@query("a05_saved_pages", "SELECT md5(html) AS digest, length(html) AS n FROM pages")
def a05(spark, sf):
    root = _folder(spark, "html")
    sinks.write_files(b.table(spark, sf, "pages"), root, "html", "page_id", folders=False)
    pages = readers.read_saved_pages(spark, root).withColumn("html", F.regexp_replace("html", "\n$", ""))
    return pages.select(F.md5("html").alias("digest"), F.length("html").cast("bigint").alias("n"))


@query("a05_payload_files", "SELECT concat('p=', CAST(s_suppkey AS VARCHAR)) AS folder, s_name AS name FROM supplier")
def a05b(spark, sf):
    """One payload per file, with the file it came from."""
    root = _folder(spark, "payload-files")
    rows = b.table(spark, sf, "supplier").select(F.to_json(F.struct(F.col("s_name").alias("name"))).alias("payload"), F.col("s_suppkey").alias("p"))
    sinks.write_files(rows, root, "payload", "p")
    read = readers.read_payloads(spark, root, below=True)
    return read.select(F.element_at(F.split("path", "/"), -2).alias("folder"), F.get_json_object("payload", "$.name").alias("name"))


@query("a06_landed_review_pages", """SELECT CAST(o_orderkey AS VARCHAR) AS source_review_id, repeat(o_orderpriority, 3) AS review_text FROM orders""")
def a06(spark, sf):
    from reviewloom.catalog.extraction import _review_pages
    from reviewloom.functions.payloads import review_nodes

    path = _folder(spark, "payloads")
    _review_pages(spark, sf).select(F.col("payload").alias("value")).write.text(path)
    return review_nodes(readers.read_payload_lines(spark, path), []).select("source_review_id", "review_text")


@query("a07_write_records", with_ctes(_RECORDS, vendors=V))
def a07(spark, sf):
    path = _folder(spark, "out")
    sinks.write_records(_records(spark, sf), path)
    return spark.read.schema(schemas.PRICING_RECORD).json(path).select(*_RECORD_COLUMNS)


@query("a08_latest_and_archive", with_ctes(f"SELECT * FROM ({_RECORDS}) WHERE star_rating >= 3", vendors=V))
def a08(spark, sf):
    root = _folder(spark, "archive")
    sinks.write_latest_and_archive(_records(spark, sf), root, "20240101_000000")
    sinks.write_latest_and_archive(_records(spark, sf).filter("star_rating >= 3"), root, "20240201_000000")
    return sinks.read_latest(spark, root, schemas.PRICING_RECORD).select(*_RECORD_COLUMNS)


@query("a09_pricing_csv", with_ctes("""SELECT source, category, name, CAST(starting_price_min AS DOUBLE) AS starting_price_min,
    CAST(star_rating AS DOUBLE) AS star_rating, review_count FROM vendors""", vendors=V))
def a09(spark, sf):
    path = _folder(spark, "csv")
    records = readers.union_sources(spark.createDataFrame([], schemas.PRICING_RECORD), _records(spark, sf))
    sinks.write_pricing_csv(records, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == schemas.PRICING_CSV_COLUMNS
    return back.select(
        "source", "category", "name", F.col("starting_price_min").cast("double").alias("starting_price_min"),
        F.col("star_rating").cast("double").alias("star_rating"), F.col("review_count").cast("int").alias("review_count"),
    )


def _with_packages(spark, sf):
    package = lambda n, name, price: f"named_struct('package_number', {n}, 'name', {name}, 'price', {price}, 'description', p_type)"
    return b.table(spark, sf, "part").selectExpr(
        "p_name AS business_name", "concat('/v/', p_partkey) AS url",
        f"CASE WHEN p_size > 25 THEN array({package(1, 'p_brand', 'CAST(p_size AS STRING)')}, {package(2, 'p_name', 'p_brand')}) "
        f"WHEN p_size > 5 THEN array({package(1, 'p_brand', 'CAST(p_size AS STRING)')}) END AS packages",
    )


@query("a10_vendor_summary_csv", """SELECT p_name AS business_name, concat('/v/', CAST(p_partkey AS VARCHAR)) AS url,
    CASE WHEN p_size > 25 THEN 2 WHEN p_size > 5 THEN 1 ELSE 0 END AS num_packages FROM part""")
def a10(spark, sf):
    path = _folder(spark, "summary")
    sinks.write_vendor_summary_csv(_with_packages(spark, sf), path, ["business_name", "url"])
    return spark.read.option("header", True).schema("business_name STRING, url STRING, num_packages INT").csv(path)


@query("a11_package_csv", """SELECT p_name AS business_name, concat('/v/', CAST(p_partkey AS VARCHAR)) AS url, 1 AS package_number, p_brand AS name, CAST(p_size AS VARCHAR) AS price, p_type AS description
    FROM part WHERE p_size > 5 UNION ALL SELECT p_name, concat('/v/', CAST(p_partkey AS VARCHAR)), 2, p_name, p_brand, p_type FROM part WHERE p_size > 25""")
def a11(spark, sf):
    path = _folder(spark, "children")
    sinks.write_package_csv(_with_packages(spark, sf), path)
    return spark.read.option("header", True).schema(
        "business_name STRING, url STRING, package_number INT, name STRING, price STRING, description STRING"
    ).csv(path)


@query("a12_dashboard_document", with_ctes("""SELECT count(*) AS total_vendors, (SELECT count(*) FROM reviews) AS total_reviews,
    (SELECT count(*) FROM reviews WHERE sentiment = 'negative') AS negative, count(DISTINCT category) AS categories FROM vendors""", vendors=V, reviews=R))
def a12(spark, sf):
    from reviewloom.operators import rollups as ru

    v, r = b.vendors(spark, sf), b.reviews(spark, sf)
    path = _folder(spark, "document")
    doc = sinks.dashboard_document(
        {"vendor_kpis": ru.vendor_kpis(v), "review_kpis": ru.review_kpis(r), "sentiment": ru.sentiment_split(r),
         "categories": ru.coverage_rollup(v, r)}, single=("vendor_kpis", "review_kpis"),
    )
    sinks.write_document(doc, path)
    back = spark.read.text(path)
    get = lambda p: F.get_json_object("value", p)
    return back.select(
        get("$.vendor_kpis.total_vendors").cast("bigint").alias("total_vendors"),
        get("$.review_kpis.total_reviews").cast("bigint").alias("total_reviews"),
        get("$.sentiment[2].n").cast("bigint").alias("negative"),
        F.json_array_length(get("$.categories")).cast("bigint").alias("categories"),
    )


@query("a13_run_audit", """SELECT o_orderkey AS id, o_orderdate AS started_at, CASE WHEN n IS NULL THEN 'running' ELSE 'completed' END AS status,
    CAST(n AS INT) AS vendors_found, CAST(ok AS INT) AS vendors_successful FROM orders LEFT JOIN
    (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag <> 'R') AS ok FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def a13(spark, sf):
    runs = b.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS source", "o_orderpriority AS category", "'' AS city", "'' AS state", "o_orderdate AS started_at",
        "CAST(NULL AS TIMESTAMP) AS completed_at", "CAST(NULL AS INT) AS vendors_found", "CAST(NULL AS INT) AS vendors_successful",
        "'running' AS status", "CAST(NULL AS STRING) AS notes",
    )
    results = b.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.max("l_shipdate").alias("completed_at"), F.count(F.lit(1)).alias("vendors_found"),
        F.count_if(F.col("l_returnflag") != "R").alias("vendors_successful"), F.lit("").alias("notes"),
    )
    return sinks.finish_runs(runs, results).select("id", "started_at", "status", "vendors_found", "vendors_successful")


@query("versioned_table_write", with_ctes("SELECT source, count(*) AS n FROM vendors GROUP BY 1", vendors=V))
def versioned(spark, sf):
    root = _folder(spark, "table")
    sinks.write_version(b.vendors(spark, sf).filter("source = 'ASIA'"), root, "0001", partition_by=["source"])
    sinks.write_version(b.vendors(spark, sf), root, "0002", partition_by=["source"])
    return sinks.read_current(spark, root).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


# ---- M3: incremental work -------------------------------------------------


@query("m03_stream_tagging", with_ctes(
    """SELECT id, CASE WHEN (rating <= 2 AND sentiment = 'positive') OR (rating >= 4.5 AND sentiment = 'negative') THEN
      CASE WHEN rating >= 4 THEN 'positive' ELSE 'negative' END ELSE sentiment END AS sentiment,
      array_to_string(complaints, ',') AS complaints, array_to_string(praises, ',') AS praises FROM tagged""", texts=b.TEXTS,
    tagged=b.tagged("texts", b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE)))
def m03(spark, sf):
    """Drops of 10:00, 01:00 and 11:00: the second, far behind the first, is stored as well, and repeats in the third are known."""
    root, landed = _folder(spark, "stream"), b.texts(spark, sf)
    for hour, parts in ((10, [0]), (1, [1]), (11, [0, 1, 2])):
        drop = landed.where(F.pmod("id", F.lit(3)).isin(parts)).withColumn("scraped_at", F.lit(f"2024-01-01 {hour}:00:00").cast("timestamp"))
        drop.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(drop.schema).parquet(f"{root}/in")
        inc.start_tagging(spark, stream, f"{root}/out", f"{root}/chk", buckets=16, **b.CORPUS).awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "id", "sentiment", b.joined_text("complaint_categories").alias("complaints"), b.joined_text("praise_categories").alias("praises")
    )


@query("m03_stream_hourly", with_ctes("""SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (status = 'ok') AS successful, count(*) AS total FROM log
    GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM log) - INTERVAL 10 MINUTE""", log=b.LOG))
def m03b(spark, sf):
    """Append mode: an hour is written once the watermark has passed its end."""
    root = _folder(spark, "hours")
    log = b.request_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    log.write.parquet(f"{root}/in")
    stream = inc.hourly_stream(spark.readStream.schema(log.schema).parquet(f"{root}/in"))
    stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/chk").option("path", f"{root}/out").outputMode("append").trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").withColumn("hour", F.col("hour").cast("timestamp_ntz"))
