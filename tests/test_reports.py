import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import audits, insights, pricing
from reviewloom.operators import crawl_health as ch
from reviewloom.operators import rollups as ru
from reviewloom.operators import selects as se
from reviewloom.plans import dashboard as dash


@pytest.fixture(scope="module")
def vendors(spark):
    rows = [
        (1, "m1", "s1", "Ann", "wedding-djs", "X", "TX", "5", "", 4.9, 120), (2, "m1", "s2", "Bob", "wedding-djs", None, "TX", "", "b@x", 4.0, 0),
        (3, "m2", "s3", "Cy", "wedding-planners", "Y", "", "7", None, 0.0, None), (4, "m2", "s4", "Di", "", "", "CA", None, "d@x", 5.0, 200),
    ]
    return spark.createDataFrame(
        rows, "id BIGINT, source STRING, source_vendor_id STRING, name STRING, category STRING, city STRING, state STRING, phone STRING, "
        "email STRING, star_rating DOUBLE, review_count INT",
    ).withColumn("starting_price_min", F.when(F.col("id") < 3, F.col("id") * 100.0))


@pytest.fixture(scope="module")
def reviews(spark):
    long = "x" * 60
    rows = [
        (10, 1, "m1", long, 5.0, "positive", [], ["price", "quality"], False), (11, 1, "m1", long, 4.5, "positive", [], ["price"], None),
        (12, 1, "m1", "x" * 20, 1.0, "negative", ["price"], [], False), (13, 2, "m1", "x" * 21, 2.5, "negative", ["late"], [], False),
        (14, 2, "m1", long, None, "", [], [], False), (15, 4, "m2", long, 1.0, "negative", ["price"], [], True),
        (16, 4, "m2", long, 0.5, "neutral", [], [], False), (17, 1, "m1", long, 3.5, None, [], [], False),
    ]
    return spark.createDataFrame(rows, "id BIGINT, vendor_id BIGINT, source STRING, review_text STRING, rating DOUBLE, sentiment STRING, "
                                       "complaint_categories ARRAY<STRING>, praise_categories ARRAY<STRING>, is_vendor_reply BOOLEAN")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_category_rollup_keeps_uncovered_vendors(vendors, reviews):
    got = {r["category"]: r.asDict() for r in ru.coverage_rollup(vendors, reviews).collect()}
    assert set(got) == {"wedding-djs", "wedding-planners"}  # the blank category is left out
    djs = got["wedding-djs"]
    # text of exactly 20 characters does not qualify; mean of 5, 4.5, 3.5 and 2.5
    assert (djs["vendors"], djs["reviews"], djs["avg_rating"], djs["coverage_pct"]) == (2, 5, 3.88, 100)
    assert (got["wedding-planners"]["reviews"], got["wedding-planners"]["coverage_pct"]) == (0, 0)


def test_sentiment_split_is_zero_filled(spark, reviews):
    split = {r["sentiment"]: (r["n"], r["total"]) for r in ru.sentiment_split(reviews).collect()}
    assert split == {"positive": (2, 6), "neutral": (1, 6), "negative": (3, 6)}
    empty = ru.sentiment_split(reviews.limit(0)).collect()
    assert [(r["n"], r["total"], r["pct"]) for r in empty] == [(0, 0, 0.0)] * 3


def test_stars_round_half_up_within_one_to_five(reviews):
    assert [r["n"] for r in ru.star_distribution(reviews).orderBy("star").collect()] == [2, 0, 1, 1, 2]


def test_tag_frequency_and_negatives(vendors, reviews):
    assert rows(ru.tag_frequency(reviews, "complaint_categories", ru.complaint_filter()), "tag") == [("late", 1), ("price", 1)]
    assert rows(ru.tag_frequency(reviews, "praise_categories", k=1), "tag") == [("price", 2)]
    assert rows(ru.negative_by_category(vendors, reviews), "category") == [("wedding-djs", 2, 2)]


def test_vendor_reports(vendors, reviews):
    assert rows(ru.contact_by_source(vendors), "source") == [("m1", 2, 1, 1, 2), ("m2", 2, 1, 1, 0)]
    assert ru.review_presence(vendors, reviews).first().asDict() == {"vendors": 4, "with_reviews": 3, "without_reviews": 1}
    assert rows(se.backfill(vendors, reviews).select("id", "needed"), "id") == [(1, 116), (4, 198)]
    assert rows(ru.claimed_vs_stored(vendors, reviews).select("id", "claimed", "stored"), "id") == [(1, 120, 4), (4, 200, 2)]
    cov = {r["field"]: r["pct"] for r in audits.vendor_coverage(vendors.withColumns({"website_url": F.lit(""), "starting_price_avg": F.lit(None)})).collect()}
    assert cov == {"phone": 50, "email": 50, "website": 0, "pricing": 50, "rating": 75, "reviews": 50, "city": 50}


def test_audits(vendors, reviews):
    assert audits.contradictions(reviews).first().asDict() == {"five_star_negative": 0, "low_star_positive": 0}
    labels = {r["sentiment"]: (r["n"], r["vendor_replies"]) for r in audits.sentiment_distribution(reviews).collect()}
    assert labels == {"positive": (2, 0), "negative": (3, 1), "neutral": (1, 0), "(empty)": (2, 0)}
    keyed = reviews.withColumn("source_review_id", F.lit("same"))
    got = {r["check"]: r["violations"] for r in audits.review_violations(keyed, vendors.filter("id <> 4")).collect()}
    assert got == {"unique_review_key": 2, "vendor_exists": 2, "sentiment_label": 0, "text_present": 0}


def test_text_filters_at_their_bounds(spark):
    df = spark.createDataFrame([("x" * n,) for n in (19, 20, 21, 50, 51)], "t STRING")
    assert df.filter(se.text_longer("t", 20)).count() == 3 and df.filter(se.text_longer("t", 50)).count() == 1
    assert df.filter(se.text_between("t", 20, 51)).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_median_and_histogram_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    groups = {"hot": [round(rnd.choice([rnd.uniform(0, 5000), 700.0, 1e6]), 2) for _ in range(400)], "one": [5.0],
              "even": [1.0, 2.0, 3.0, 4.0], "equal": [9.0] * 6, "odd": [3.0, 1.0, 2.0]}
    data = [(g, p) for g, ps in groups.items() for p in ps] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(data, "category STRING, starting_price_min DOUBLE").repartition(5)
    got = {r["category"]: r["median_price"] for r in pricing.upper_median(df, "category", "starting_price_min").collect()}
    assert got == {g: sorted(ps)[len(ps) // 2] for g, ps in groups.items()}
    bins = {}
    for g, ps in groups.items():
        if len(ps) > 1:
            step = max(1, (max(ps) - min(ps)) / 5)
            for p in ps:
                k = (g, int((p - min(ps)) / step))
                bins[k] = bins.get(k, 0) + 1
    assert {(r["category"], r["bin"]): r["n"] for r in pricing.price_histogram(df).collect()} == bins
    assert ("hot", 5) in bins  # the highest price opens a sixth bin


def test_market_stats_of_an_unpriced_group(spark):
    df = spark.createDataFrame([("A", None, None, 0.0, None, None)], "category STRING, starting_price_min DOUBLE, starting_price_avg DOUBLE, star_rating DOUBLE, review_count INT, price_tier STRING")
    row = pricing.market_stats(df).first()
    assert (row["count"], row["with_price"], row["median_price"], row["avg_price"], row["avg_rating"], row["total_reviews"], row["tier_unknown"]) == (1, 0, 0, 0, 0, 0, 1)


def test_crawl_health(spark):
    pages = spark.createDataFrame([("a", "x" * 1000 + " Access Denied captcha"), ("b", "g-recaptcha" + "x" * 2000), ("c", "tiny"), ("d", "y" * 1000)], "id STRING, html STRING")
    got = {r["id"]: (r["status"], r["evidence"]) for r in ch.with_page_status(pages).collect()}
    assert got == {"a": ("blocked", ["access denied"]), "b": ("captcha", ["g-recaptcha"]), "c": ("error", ["empty_content"]), "d": ("ok", [])}


@pytest.mark.parametrize("html,want", [('<div class="g-recaptcha">', True), ('<div class="h-captcha">', True), ('<div id="px-captcha">', True),
                                       ("<p>plain</p>", False), ('<iframe src="https://www.recaptcha.net/x">', True)])
def test_captcha(one, html, want):
    assert one(ch.is_captcha, html) is want


@pytest.mark.parametrize("text,title,want", [("403 Forbidden", "", True), ("Access Denied", "", True), ("You have been blocked", "", True),
                                             ("Welcome to our site", "Home", False), ("fine", "403 - Access Denied", True)])
def test_blocked(one, text, title, want):
    assert one(ch.is_blocked, text, title) is want


def test_alerts_and_rules(spark):
    log = spark.createDataFrame([("s", "blocked", 1.0)] * 8 + [("s", "ok", 2.0)] * 4 + [("t", "captcha", 1.0)], "source STRING, status STRING, elapsed DOUBLE")
    metrics = ch.run_metrics(log, "source")
    got = {(r["source"], r["alert"]): r["value"] for r in ch.alerts(metrics, "source").collect()}
    assert got == {("s", "low_success"): 33.3333, ("s", "high_block"): 0.6667, ("t", "high_captcha"): 1.0}
    rules = spark.createDataFrame([("name", "a", i < 4) for i in range(5)] + [("price", "b", False)], "element STRING, rule STRING, success BOOLEAN")
    health = {r["element"]: (r["success_rate"], r["healthy"], r["element_failing"]) for r in ch.rule_health(rules).collect()}
    assert health == {"name": (80.0, True, False), "price": (0.0, False, True)}


def test_first_block(spark):
    log = spark.createDataFrame([("s", 2, True, "p2", 0.5, "r"), ("s", 1, True, "p1", 0.1, "q"), ("s", 0, False, "p0", 0.1, "")],
                                "source STRING, idx BIGINT, blocked BOOLEAN, phase STRING, delay DOUBLE, reason STRING")
    assert [tuple(r) for r in ch.first_block(log).collect()] == [("s", 2, 1, "p1", 0.1, "q")]


def test_insights(vendors, reviews):
    parts = dash.sections(vendors, reviews)
    texts = {r["rule_no"]: r["text"] for r in parts["insights"].collect()}
    assert list(texts) == [1, 2, 6, 7]
    assert "<b>late</b>" in texts[1] and "33%" in texts[1]  # one of three negatives; the reply is only in the denominator
    assert "<b>planners</b>" in texts[2] and "2 DJs tracked with 5 reviews" in texts[6] and "Coverage: 0%" in texts[7]


def test_percent_text_rounds_to_even(spark):
    split = spark.createDataFrame([("positive", 25, 26, 92.5)], "sentiment STRING, n BIGINT, total BIGINT, pct DOUBLE")
    assert "92% of reviews" in insights.positive_skew(split).first()["text"]


def test_dashboard_document(vendors, reviews):
    doc = json.loads(dash.document(vendors, reviews, "m1").first()["value"])
    assert doc["vendor_kpis"]["total_vendors"] == 4 and doc["review_kpis"]["total_reviews"] == 8
    assert sum(c["vendors"] for c in doc["categories"]) == 3 and sum(s["n"] for s in doc["sentiment"]) == 6
    assert [v["name"] for v in doc["top_vendors"]] == ["Ann", "Bob"]


def test_one_pass_equals_the_single_roll_ups(spark, vendors, reviews):
    parts = dash.sections(vendors, reviews, "m1")
    listed = vendors.filter("source = 'm1'")
    complaints, praise = ru.tag_frequency(reviews, "complaint_categories", ru.complaint_filter()), ru.tag_frequency(reviews, "praise_categories")
    split, categories, states = ru.sentiment_split(reviews), ru.coverage_rollup(vendors, reviews, "category"), ru.coverage_rollup(vendors, reviews, "state")
    want = {
        "vendor_kpis": ru.vendor_kpis(vendors), "review_kpis": ru.review_kpis(reviews), "sentiment": split, "rating_dist": ru.star_distribution(reviews), "categories": categories,
        "all_states": states, "top_states": ru.top_groups(states, "state"), "complaints": complaints, "praise": praise, "negative_by_category": ru.negative_by_category(vendors, reviews),
        "best_vendors": ru.best_rated(listed, reviews), "insights": insights.all_insights(complaints, praise, split, categories, states)}
    for name, df in want.items():
        assert parts[name].columns == df.columns, name
        assert sorted(map(str, parts[name].collect())) == sorted(map(str, df.collect())), name
    empty = dash.sections(vendors.limit(0), reviews.limit(0))
    assert empty["vendor_kpis"].first()["total_vendors"] == 0 and empty["review_kpis"].first()["total_reviews"] == 0 and empty["categories"].count() == 0
    doc = json.loads(dash.document(vendors.limit(0), reviews.limit(0)).first()["value"])
    assert doc["categories"] == [] and doc["vendor_kpis"]["sources"] == 0


def test_reviews_are_read_once_for_the_dashboard(spark, tmp_path, reviews):
    reviews.write.parquet(str(tmp_path / "r"))
    plan = dash.review_facts(dash.slim(spark.read.parquet(str(tmp_path / "r"))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_search(vendors):
    page, total = se.search_vendors(vendors, text="i", page_size=1)
    assert total.first()["total"] == 1 and page.first()["name"] == "Di"


def test_hourly(spark):
    log = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, m), "ok" if m < 30 else "error") for m in (0, 29, 30, 59)], "ts TIMESTAMP, status STRING")
    assert [(r["successful"], r["total"]) for r in ch.hourly(log).collect()] == [(2, 4)]


def test_every_tier_is_counted(spark):
    rows = spark.createDataFrame([("c", "budget"), ("c", None), ("c", "unknown"), ("c", "vip"), (None, "mid")], "category STRING, price_tier STRING")
    got = {r["category"]: tuple(r)[1:] for r in pricing.tier_counts(rows).collect()}
    assert got == {"c": (1, 0, 0, 2, 1), "OTHER": (0, 1, 0, 0, 0)}


def test_catalogue_is_sorted(spark):
    rows = [("b", 0.0, "x"), ("a", None, "z"), ("a", 5.0, "y"), ("a", 5.0, "x"), ("b", 7.0, "q")]
    got = pricing.catalogue_order(spark.createDataFrame(rows, "category STRING, market_avg DOUBLE, name STRING").repartition(3), "place").collect()
    assert [(r["category"], r["name"], r["place"]) for r in got] == [("a", "x", 1), ("a", "y", 2), ("a", "z", 3), ("b", "q", 1), ("b", "x", 2)]


def test_pages_follow_each_other_over_ties_and_nulls(spark):
    rows = [(i, f"N {i % 3}", None if i % 5 == 0 else float(i % 4), None if i % 7 == 0 else i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id INT, name STRING, star_rating DOUBLE, review_count INT").repartition(4)
    for order in ([("star_rating", True), ("review_count", False), ("id", False)], [("review_count", True), ("name", False), ("id", True)]):
        got, after = [], None
        while True:
            page = se.search_page(df, "n", order=order, after=after, page_size=7)
            assert page.total == 100
            got, after = got + [r["id"] for r in page.rows], page.after
            if after is None:
                break
        place = {c: k for k, c in enumerate(("id", "name", "star_rating", "review_count"))}
        want = list(rows)
        for name, down in reversed(order):
            known, null = [r for r in want if r[place[name]] is not None], [r for r in want if r[place[name]] is None]
            want = sorted(known, key=lambda r: r[place[name]], reverse=down) + null
        assert got == [r[0] for r in want]
    plan = df.orderBy("id").limit(3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert se.search_page(df, "none").rows == [] and se.search_page(df, "none").total == 0


def test_sample_is_the_same_at_any_partitioning(spark):
    df = spark.range(1000).withColumn("text", F.repeat(F.lit("x"), 500))
    picks = [sorted(r["id"] for r in se.seeded_sample(df.repartition(n), ["id"], 20, 3).collect()) for n in (1, 3, 8)]
    assert picks[0] == picks[1] == picks[2] and len(set(picks[0])) == 20
    assert picks[0] != sorted(r["id"] for r in se.seeded_sample(df, ["id"], 20, 4).collect())
    assert len(se.seeded_sample(df, ["id"], 1).first()["text"]) == 500
