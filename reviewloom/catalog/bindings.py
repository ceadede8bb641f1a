"""Stand-in inputs: the driver's tables in the roles of vendors, reviews, pages and logs.

Every binding exists twice, as a DataFrame and as the SQL of the check query.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say it, its check."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pages_of(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table whose rows are made into pages or payloads, which are long and costly to read: dealt by key while they are short."""
    return spread(table(spark, sf, name), key)


# ---- vendors --------------------------------------------------------------
# customer in the role of vendors, nation as state, region as marketplace

SEGMENTS = {
    "MACHINERY": "wedding-djs",
    "BUILDING": "wedding-planners",
    "HOUSEHOLD": "wedding-photobooths",
    "AUTOMOBILE": "wedding-photographers",
    "FURNITURE": "wedding-florists",
}
_SEGMENT_CASE = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENTS.items()) + " ELSE '' END"

# The column list is plain SQL understood by both engines.
_VENDOR_COLUMNS = f"""
  c_custkey AS id,
  r_name AS source,
  c_name AS source_vendor_id,
  CASE WHEN c_acctbal < 0 THEN '' ELSE concat('https://', lower(r_name), '.example.com/v/', CAST(c_custkey AS {{text}})) END AS source_url,
  c_name AS name,
  {_SEGMENT_CASE} AS category,
  CASE WHEN c_acctbal < 0 THEN '' ELSE concat(n_name, ' City') END AS city,
  n_name AS state,
  CASE WHEN c_acctbal >= 5000 THEN concat('555-', CAST(c_custkey AS {{text}})) ELSE '' END AS phone,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE concat(lower(replace(c_name, '#', '')), '@example.com') END AS email,
  CASE WHEN c_acctbal > 8000 THEN '' ELSE concat('https://', lower(replace(c_name, '#', '')), '.example.com') END AS website_url,
  CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(10,2)) END AS starting_price_min,
  CASE WHEN c_acctbal > 2000 THEN CAST(c_acctbal + 500 AS DECIMAL(10,2)) END AS starting_price_avg,
  CASE WHEN c_acctbal < 0 THEN CAST(0 AS DECIMAL(3,1)) ELSE CAST(1 + floor(c_acctbal / 250) / 10 AS DECIMAL(3,1)) END AS star_rating,
  CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal < 0 THEN 0 ELSE CAST(floor(c_acctbal / 20) AS INT) END AS review_count
"""
VENDORS = f"""SELECT {_VENDOR_COLUMNS.format(text='VARCHAR')}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def vendors(spark: SparkSession, sf: str) -> DataFrame:
    joined = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.selectExpr(*_split_columns(_VENDOR_COLUMNS.format(text="STRING")))


def _split_columns(text: str) -> list[str]:
    """Select list to single expressions: every line ends one, except inside brackets."""
    return [part.strip().rstrip(",") for part in text.strip().split(",\n")]


# ---- reviews --------------------------------------------------------------
# orders in the role of short reviews, several per vendor

_REVIEW_COLUMNS = """
  o_orderkey AS id,
  o_custkey AS vendor_id,
  concat('feed-', o_orderstatus) AS source,
  CAST(o_orderkey AS {text}) AS source_review_id,
  repeat(concat(o_orderpriority, ' review. '), CAST(left(o_orderpriority, 1) AS INT)) AS review_text,
  CASE WHEN o_totalprice >= 20000 THEN CAST(CAST(left(o_orderpriority, 1) AS INT) - CASE WHEN o_orderstatus = 'P' THEN 0.5 ELSE 0 END AS DECIMAL(3,1)) END AS rating,
  CAST(o_orderdate AS DATE) AS review_date,
  o_orderdate AS scraped_at,
  CASE WHEN o_totalprice > 490000 THEN '' WHEN o_orderstatus = 'O' THEN 'positive' WHEN o_orderstatus = 'P' THEN 'neutral' ELSE 'negative' END AS sentiment,
  o_totalprice > 300000 AS is_vendor_reply
"""
REVIEWS = f"SELECT {_REVIEW_COLUMNS.format(text='VARCHAR')} FROM orders"


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*_split_columns(_REVIEW_COLUMNS.format(text="STRING")))


# ---- review texts ---------------------------------------------------------
# documents in the role of long reviews; labels give the rating where there is one

TEXTS = """SELECT d.doc_id AS id, d.doc_id AS vendor_id, d.source AS source, CAST(d.doc_id AS VARCHAR) AS source_review_id,
  d.text AS review_text, CASE l.quality WHEN 1 THEN 5.0e0 WHEN 0 THEN 1.0e0 END AS rating
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def texts(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels").select("doc_id", "quality")
    rating = F.when(F.col("quality") == 1, F.lit(5.0)).when(F.col("quality") == 0, F.lit(1.0))
    # dealt by the key of the join: the files here are a single split each, and tagging would run in one task
    return docs.repartition("doc_id").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("vendor_id"), "source",
        F.col("doc_id").cast("string").alias("source_review_id"), F.col("text").alias("review_text"),
        rating.alias("rating"),
    )


# ---- listings with prices -------------------------------------------------
# part in the role of priced listings

LISTINGS = """SELECT p_partkey AS id, p_type AS source, p_name AS name, p_brand AS category,
  CASE WHEN p_size > 2 THEN p_retailprice END AS starting_price_min,
  CASE WHEN p_size > 4 THEN p_retailprice * 2 END AS starting_price_avg,
  CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) / 10 ELSE 0 END AS star_rating,
  CASE WHEN p_size > 1 THEN p_size END AS review_count
  FROM part"""


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS id", "p_type AS source", "p_name AS name", "p_brand AS category",
        "CASE WHEN p_size > 2 THEN p_retailprice END AS starting_price_min",
        "CASE WHEN p_size > 4 THEN p_retailprice * 2 END AS starting_price_avg",
        "CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) / 10 ELSE 0D END AS star_rating",
        "CASE WHEN p_size > 1 THEN p_size END AS review_count",
    )


# ---- request log ----------------------------------------------------------
# events in the role of crawl requests

LOG = """SELECT event_id AS idx, ts, concat('s', CAST(user_id AS VARCHAR)) AS source,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'blocked' WHEN 'signup' THEN 'captcha' ELSE 'ok' END AS status,
  event_type IN ('click', 'signup') AS blocked, event_type AS reason,
  CASE WHEN value < 20 THEN 'gentle' WHEN value < 60 THEN 'moderate' WHEN value < 120 THEN 'aggressive' ELSE 'abusive' END AS phase,
  value AS elapsed, value / 100 AS html_mb FROM events"""


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id AS idx", "ts", "concat('s', CAST(user_id AS STRING)) AS source",
        "CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'blocked' WHEN 'signup' THEN 'captcha' ELSE 'ok' END AS status",
        "event_type IN ('click', 'signup') AS blocked", "event_type AS reason",
        "CASE WHEN value < 20 THEN 'gentle' WHEN value < 60 THEN 'moderate' WHEN value < 120 THEN 'aggressive' "
        "ELSE 'abusive' END AS phase",
        "value AS elapsed", "value / 100 AS html_mb",
    )


# ---- lexicon that occurs in the synthetic texts ---------------------------

CORPUS_TOPICS: dict[str, list[str]] = {
    "articles": ["the ", " der ", " la "],
    "nouns": ["tion", "heit", "ment"],
    "verbs": ["ing", "ieren", "ado"],
    "pronouns": [" ich ", "que", "elle"],
    "price": ["$", "€"],
    "experience": ["best", "fun"],
    "junk": ["%%%", "###", "***"],
}
CORPUS_POSITIVE = ["tion", "eau", "ble", "best", "que", "and"]
CORPUS_NEGATIVE = ["sch", "oui", "erst", "ou", "###", "ció", "oun"]
CORPUS_REPLIES = ["that is", "of the", "the the", "de la"]
CORPUS_GREETINGS = ["the ", "is ", "la ", "die "]
CORPUS_COURTESIES = ["and", "que", "und"]
CORPUS = {"topics": CORPUS_TOPICS, "positive": CORPUS_POSITIVE, "negative": CORPUS_NEGATIVE}


# ---- SQL fragments of the checks ------------------------------------------

def q(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def r(expr: str, digits: int = 2) -> str:
    """Round halves away from zero on the decimal value, as Spark does for doubles."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def r_even(expr: str, digits: int) -> str:
    return f"CAST(round_even({expr}, {digits}) AS DOUBLE)"


def any_of(text: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(w)})" for w in words) + ")"


def hits(text: str, words: Sequence[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, {q(w)}) AS INT)" for w in words) + ")"


def topic_list(text: str, topics: Mapping[str, Sequence[str]]) -> str:
    items = ", ".join(f"CASE WHEN {any_of(text, w)} THEN {q(n)} END" for n, w in topics.items())
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def with_ctes(body: str, **ctes: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + " " + body


def tagged(source: str, topics: Mapping[str, Sequence[str]], pos: Sequence[str], neg: Sequence[str], version: str = "v2") -> str:
    """Tag every row of a CTE with review_text and rating."""
    if version == "v1":
        signal = ("CASE WHEN rating IS NULL OR rating = 0 THEN 0 WHEN rating >= 4.5 THEN 2 WHEN rating >= 4 THEN 1 "
                  "WHEN rating <= 2 THEN -2 WHEN rating <= 3 THEN -1 ELSE 0 END")
        conf = "least(0.99e0, 0.5e0 + 0.15e0 * CAST({h} + abs(signal) AS DOUBLE))"
        complaints, praises = "sentiment <> 'positive'", "sentiment = 'positive'"
        topic_sql, never = f"list_sort({topic_list('low', topics)})", ""
    else:
        pos, neg = list(dict.fromkeys(pos)), list(dict.fromkeys(neg))
        signal = ("CASE WHEN rating >= 4.5 THEN 3 WHEN rating >= 4 THEN 2 WHEN rating >= 3 THEN 0 "
                  "WHEN rating >= 2 THEN -2 WHEN rating >= 1 THEN -3 ELSE 0 END")
        conf = "round(least(0.99e0, 0.6e0 + 0.05e0 * CAST(least(8, {h} + abs(signal)) AS DOUBLE)), 2)"
        complaints, praises = "sentiment = 'negative'", "sentiment <> 'negative'"
        topic_sql, never = topic_list("low", topics), "experience,recommendation"
    kept = "topics"
    if never:
        kept = "list_filter(topics, lambda x: x NOT IN ('experience', 'recommendation'))"
    return f"""SELECT * EXCLUDE (low, topics, pos, neg, signal, score), topics,
      CASE WHEN score = 0 THEN 0.5e0 WHEN score > 0 THEN {conf.format(h='pos')} ELSE {conf.format(h='neg')} END AS sentiment_confidence,
      CASE WHEN {complaints} THEN {kept} ELSE [] END AS complaints,
      CASE WHEN {praises} THEN topics ELSE [] END AS praises,
      'heuristic-rulebased-v1' AS analysis_model
    FROM (SELECT *, CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM (SELECT *, signal + pos - neg AS score FROM (
      SELECT *, {topic_sql} AS topics, {hits('low', pos)} AS pos, {hits('low', neg)} AS neg, {signal} AS signal
      FROM (SELECT *, lower(coalesce(review_text, '')) AS low FROM {source}))))"""


def joined_text(column: str) -> F.Column:
    """Tag list as one comma text, so the comparison does not depend on array handling."""
    return F.array_join(column, ",")
