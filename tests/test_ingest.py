import json

from pyspark.sql import functions as F

from reviewloom.plans import reviews as R
from reviewloom.plans import tagging


def page(total, *nodes):
    return json.dumps({"reviews": {"totalCount": total, "nodes": [{"id": i, "createdAt": "2024-03-03T00:00:00", "comment": {"content": t}, "ratings": [{"name": "quality", "value": v}, {"name": "quality", "value": v}, {"value": 2}]} for i, t, v in nodes]}})


LONG = "The band was great and everybody danced until the very end of the night. " * 100


def frames(spark):
    pages = spark.createDataFrame([
        ("a", "s1", "2024-01-01", page(9, ("r1", LONG, 5), ("r2", "too short", 5))),
        ("a", "s1", "2024-01-02", page(11, ("r1", LONG, 5), ("r3", "They never showed up and it was a terrible awful night for us.", 1))),
        ("a", "s9", "2024-01-01", page(3, ("r4", LONG, 5))),
    ], "source string, source_vendor_id string, scraped_at string, payload string")
    vendors = spark.createDataFrame([(1, "a", "s1", 5), (2, "a", "s2", 7), (3, "a", "s1", 5)], "id bigint, source string, source_vendor_id string, review_count bigint")
    stored = spark.createDataFrame([], "source string, source_review_id string")
    return pages, vendors, stored


def test_pages_to_new_reviews_and_second_run_adds_nothing(spark):
    pages, vendors, stored = frames(spark)
    out = R.ingest_pages(pages, vendors, stored)
    new = {r["source_review_id"]: r for r in out.new.collect()}
    assert set(new) == {"r1", "r3"} and new["r1"]["review_text"] == LONG and new["r1"]["vendor_id"] == 1
    assert new["r3"]["sentiment"] == "negative" and new["r1"]["category_ratings"] == {"quality": 5.0}
    reasons = sorted((r["source_review_id"], r["reject_reason"]) for r in out.rejected.collect())
    assert reasons == [("r2", "text too short"), ("r4", "unknown storefront")]
    assert {r["id"]: r["review_count"] for r in out.vendors.collect()} == {1: 11, 2: 7, 3: 5}
    again = R.ingest_pages(pages, vendors, out.new.select("source", "source_review_id"))
    assert again.new.count() == 0


def test_blobs(spark):
    _, vendors, stored = frames(spark)
    blobs = spark.createDataFrame([("a", "s1", "2024-01-01", "Ann B.Rating: 5•Feed•Mar 3, 2024 " + LONG + "Bob C.Rating: 1•Feed•Jan 9, 2023 It was a terrible evening and nobody came.")],
                                  "source string, source_vendor_id string, scraped_at string, text string")
    new, rejected = R.ingest_blobs(blobs, vendors, stored)
    assert sorted(r["reviewer"] for r in new.collect()) == ["Ann B", "Bob C"] and rejected.count() == 0


def test_only_untagged_rows_are_tagged(spark):
    rows = spark.createDataFrame([(1, "a great and wonderful day", 5.0, None, None), (2, "a great day", 5.0, "neutral", "by hand")], "id bigint, review_text string, rating double, sentiment string, analysis_model string")
    out = {r["id"]: r for r in R.tag_untagged(rows).collect()}
    assert out[1]["sentiment"] == "positive" and (out[2]["sentiment"], out[2]["analysis_model"]) == ("neutral", "by hand")


def test_reply_suffix_is_added_once_after_a_fill(spark):
    rows = spark.createDataFrame([(1, "Hi Ann, thank you so much for your kind words!", 5.0, None, "m", None)], "id bigint, review_text string, rating double, sentiment string, analysis_model string, sentiment_confidence double")
    once = tagging.repair(rows)
    assert once.first()["analysis_model"] == tagging.repair(once).first()["analysis_model"] == "m+vendor-reply-flag+rating-fill"


def test_records_without_a_key_stay(spark):
    from reviewloom.functions import payloads as pl

    payload = json.dumps({"props": {"pageProps": {"searchResults": {"vendors": [{"name": "x"}, {"name": "y"}, {"id": "1", "name": "z"}, {"id": "1", "name": "late"}]}}}})
    df = spark.createDataFrame([(7, payload)], "page_id int, payload string")
    assert sorted(r["name"] for r in pl.next_data_vendors(df, ["page_id"]).collect()) == ["x", "y", "z"]


def test_no_size_switch_in_the_tagging_plan(spark):
    small = tagging.tag_and_repair(spark.createDataFrame([("x", 1.0)], "review_text string, rating double"))
    assert "Exchange" not in small._jdf.queryExecution().executedPlan().toString()
    assert small.select(F.count("*")).first()[0] == 1
