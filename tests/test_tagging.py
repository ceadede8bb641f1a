import itertools

import pytest

from reviewloom import lexicons as lx
from reviewloom.functions import tagging as tg
from reviewloom.plans import tagging as plan

TEXTS = [
    "Amazing and professional, best day ever!", "They were rude and late, total SCAM", "unprofessional", "chocolate fountain", "",
    None, "It was fine", "no-show, refund refused", "wonderful and exceptional", "Hidden fees and an extra charge", "worth every penny",
]
RATINGS = [None, 0.0, 0.5, 1.0, 1.9, 2.0, 2.5, 3.0, 3.9, 4.0, 4.4, 4.5, 5.0]


def by_hand_v2(text, rating):
    low = (text or "").lower()
    pos = sum(w in low for w in set(lx.POSITIVE_WORDS))
    neg = sum(w in low for w in set(lx.NEGATIVE_WORDS))
    steps = [(4.5, 3), (4.0, 2), (3.0, 0), (2.0, -2), (1.0, -3)]
    signal = next((s for bound, s in steps if rating is not None and rating >= bound), 0)
    score = signal + pos - neg
    label = "positive" if score > 0 else "negative" if score < 0 else "neutral"
    hits = pos if score > 0 else neg
    confidence = 0.5 if score == 0 else round(min(0.99, 0.6 + 0.05 * min(8, hits + abs(signal))), 2)
    topics = [t for t, words in lx.REVIEW_TOPICS.items() if any(w in low for w in words)]
    complaints = [t for t in topics if t not in lx.NEVER_COMPLAINTS] if label == "negative" else []
    return label, confidence, complaints, topics if label != "negative" else []


def by_hand_v1(text, rating):
    low = (text or "").lower()
    pos = sum(w in low for w in lx.POSITIVE_WORDS_V1)
    neg = sum(w in low for w in lx.NEGATIVE_WORDS_V1)
    signal = 0
    if rating:
        signal = 2 if rating >= 4.5 else 1 if rating >= 4 else -2 if rating <= 2 else -1 if rating <= 3 else 0
    score = signal + pos - neg
    if score == 0:
        return "neutral", 0.5
    return ("positive" if score > 0 else "negative"), min(0.99, 0.5 + 0.15 * ((pos if score > 0 else neg) + abs(signal)))


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [(i, t, r) for i, (t, r) in enumerate(itertools.product(TEXTS, RATINGS))]
    return spark.createDataFrame(rows, "id INT, review_text STRING, rating DOUBLE")


@pytest.mark.parametrize("engine", ["arrow", "native"])
def test_production_tagger(reviews, engine):
    for r in plan.tag_reviews(reviews, engine=engine).collect():
        got = (r["sentiment"], r["sentiment_confidence"], r["complaint_categories"], r["praise_categories"])
        assert got == by_hand_v2(r["review_text"], r["rating"]), r


@pytest.mark.parametrize("engine", ["arrow", "native"])
def test_first_tagger(reviews, engine):
    for r in plan.tag_reviews(reviews, version="v1", engine=engine).collect():
        label, confidence = by_hand_v1(r["review_text"], r["rating"])
        assert r["sentiment"] == label and abs(r["sentiment_confidence"] - confidence) < 1e-9
        if label == "neutral":
            assert r["praise_categories"] == []
        assert r["praise_categories"] == sorted(r["praise_categories"])


def test_substrings_not_words(spark):
    df = spark.createDataFrame([("unprofessional",), ("chocolate",)], "t STRING")
    topics = {"professional": ["professional"], "late": ["late"]}
    rows = df.select(tg.lexicon_evidence("t", topics, ["professional"], ["unprofessional"]).alias("e")).collect()
    assert [(r["e"]["topics"], r["e"]["pos"], r["e"]["neg"]) for r in rows] == [(["professional"], 1, 1), (["late"], 0, 0)]


def test_overlapping_keywords_are_all_found(spark):
    df = spark.createDataFrame([("a no-show, did not show",)], "t STRING")
    topics = {"a": ["show"], "b": ["no-show"], "c": ["not show"], "d": ["t s"], "e": ["shown"]}
    assert df.select(tg.lexicon_evidence("t", topics).alias("e")).first()["e"]["topics"] == ["a", "b", "c", "d"]


@pytest.mark.parametrize("text,want", [
    ("Hi Ann, thank you so much", True), ("Hello Ann, sorry about that", True), ("Hello, sorry about that", False), ("Hi there, great DJ", False), ("thank you all", False),
    ("x" * 150 + "thank you for your review", True), ("x" * 190 + "thank you for your review", False), ("hi " + "x" * 150 + "thank", False),
    (None, False), ("We appreciate your feedback!", True),
])
def test_vendor_reply(one, text, want):
    assert one(tg.is_vendor_reply, text) is want


def test_repair_chain(spark):
    rows = [
        (1, "Hi Ann, thank you", 5.0, "positive", 0.7, "m"), (2, "bad", 1.0, "positive", 0.7, "m"), (3, "x", 5.0, "negative", 0.7, "m"),
        (4, "x", 4.5, "", None, None), (5, "x", None, None, None, "m"), (6, "x", 2.5, "", None, "m"), (7, "Hello sorry", 2.0, "positive", 0.6, "m"),
    ]
    df = spark.createDataFrame(rows, "id INT, review_text STRING, rating DOUBLE, sentiment STRING, sentiment_confidence DOUBLE, analysis_model STRING")
    got = {r["id"]: (r["sentiment"], r["sentiment_confidence"], r["analysis_model"], r["is_vendor_reply"]) for r in plan.repair(df).collect()}
    assert got[1] == ("positive", 0.7, "m+vendor-reply-flag", True)
    assert got[2] == ("negative", 0.9, "rating-dominant-v2", False)
    assert got[3] == ("positive", 0.9, "rating-dominant-v2", False)
    assert got[4] == ("positive", None, "+rating-fill", False)
    assert got[5] == ("neutral", None, "m+rating-fill", False)
    assert got[6] == ("negative", None, "m+rating-fill", False)
    assert got[7] == ("negative", 0.9, "rating-dominant-v2", True)


def test_lexicon_is_a_parameter(tmp_path):
    path = tmp_path / "topics.json"
    path.write_text('{"food": ["Cake", "soup"]}')
    assert lx.load_topics(str(path)) == {"food": ["cake", "soup"]}
    with pytest.raises(ValueError):
        lx.check_topics({"empty": []})


def test_plan_has_no_shuffle_by_key(reviews):
    text = plan.tag_and_repair(reviews)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text


def test_sql_functions_run_the_matcher_once(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["m02_sql_functions"](spark, entry.ENTRY_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_sql_functions_of_a_text_and_of_its_evidence_agree(spark):
    from reviewloom.functions.sql_functions import register

    register(spark)
    rows = spark.createDataFrame([("great work, so professional", 4.0), ("terrible and late", 1.0), (None, None)], "t STRING, r DOUBLE")
    both = rows.selectExpr("review_sentiment(t, r) AS a", "review_topics(t) AS x", "review_evidence(lower(coalesce(t, ''))) AS e", "r").selectExpr(
        "a", "polarity_sentiment(e.pos - e.neg, r) AS b", "x", "e.topics AS y").collect()
    assert all(r.a == r.b and r.x == r.y for r in both) and [r.a for r in both] == ["positive", "negative", "neutral"]


def test_matcher_holds_the_texts_of_a_batch_once(spark):
    import tracemalloc

    import pyarrow as pa

    batch = pa.array(["fun " + "x" * 100_000] * 100)
    tracemalloc.start()
    found = list(tg.lexicon_udf({"experience": ["fun"]}, ["fun"], []).func(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0].to_pylist() == [{"topics": ["experience"], "pos": 1, "neg": 0}] * 100 and peak < 5_000_000
