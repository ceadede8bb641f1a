import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import dedup, packages
from reviewloom.operators import upsert as up

KEY = ["source", "svid"]
POLICY = {"name": up.OVERWRITE, "phone": up.COALESCE, "price": up.COALESCE}
SCHEMA = "source STRING, svid STRING, name STRING, phone STRING, price DOUBLE, city STRING"


def apply_rows(stored, batch, blank_as_null):
    """The batch applied row by row to a dict."""
    table, actions = {(r[0], r[1]): list(r[2:]) for r in stored}, {}
    for source, svid, name, phone, price, city, _seq in sorted(batch, key=lambda r: r[6]):
        key = (source, svid)
        if key not in table:
            table[key], actions[key] = [name, phone, price, city], "inserted"
            continue
        row = table[key]
        row[0] = name
        new_phone = None if blank_as_null and phone == "" else phone
        row[1] = row[1] if new_phone is None else new_phone
        row[2] = price if price is not None else row[2]
        actions.setdefault(key, "updated")
    return {k: tuple(v) for k, v in table.items()}, actions


def random_rows(seed, hot):
    rnd = random.Random(seed)
    key = lambda: ("a", "hot") if rnd.random() < hot else (rnd.choice("ab"), str(rnd.randint(0, 20)))
    keys = {("a", str(i)) for i in range(10)} | {("b", str(i)) for i in range(5)}
    stored = [(*k, "old", rnd.choice(["", "1", None]), rnd.choice([None, 2.0]), "c") for k in sorted(keys)]
    batch = [(*key(), f"n{i}", rnd.choice(["", "5", None]), rnd.choice([None, 7.0 + i]), f"c{i}", i) for i in range(300)]
    rnd.shuffle(batch)
    return stored, batch


@pytest.mark.parametrize("blank_as_null", [False, True])
@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_upsert_equals_row_by_row(spark, blank_as_null, hot):
    stored, batch = random_rows(3, hot)
    want, actions = apply_rows(stored, batch, blank_as_null)
    s = spark.createDataFrame(stored, SCHEMA)
    n = spark.createDataFrame(batch, SCHEMA + ", seq INT").repartition(4)
    got = up.upsert(s, n, KEY, POLICY, "seq", blank_as_null, action="action").collect()
    assert len(got) == len(want)
    for r in got:
        key = (r["source"], r["svid"])
        assert (r["name"], r["phone"], r["price"], r["city"]) == want[key], (key, r)
        assert r["action"] == actions.get(key, "kept")
    counts = up.upsert_counts(s, n, KEY).first()
    inserted = sum(a == "inserted" for a in actions.values())
    assert (counts["inserted"], counts["updated"]) == (inserted, len(batch) - inserted)


def test_blank_overwrites_unless_told(spark):
    s = spark.createDataFrame([("a", "1", "n", "555", 1.0, "c")], SCHEMA)
    n = spark.createDataFrame([("a", "1", "m", "", None, "d", 1)], SCHEMA + ", seq INT")
    assert up.upsert(s, n, KEY, POLICY, "seq").first()["phone"] == ""
    row = up.upsert(s, n, KEY, POLICY, "seq", blank_as_null=True).first()
    assert (row["phone"], row["price"], row["city"], row["name"]) == ("555", 1.0, "c", "m")


def test_new_rows_keep_first(spark):
    held = spark.createDataFrame([("a", "1")], "source STRING, source_review_id STRING")
    batch = spark.createDataFrame([("a", "1", "x", 1), ("a", "2", "late", 9), ("a", "2", "early", 3)],
                                  "source STRING, source_review_id STRING, t STRING, seq INT")
    assert [r["t"] for r in up.new_rows(held, batch, up.REVIEW_KEY, ["seq"]).collect()] == ["early"]


def test_validation_keeps_rejects(spark):
    df = spark.createDataFrame([("s", "1", "x" * 30), ("s", "2", "x" * 29), ("", "3", "y" * 40), ("s", None, "y" * 40), ("s", "5", None)],
                               "source STRING, source_review_id STRING, review_text STRING")
    valid, rejected = up.validate_reviews(df, 30)
    assert valid.count() == 1
    assert sorted(r["reject_reason"] for r in rejected.collect()) == [
        "source missing", "source_review_id missing", "text too short", "text too short"]


def test_first_by_key_under_skew(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k STRING, seq INT").repartition(8)
    want = {}
    for k, i in rows:
        want[k] = min(i, want.get(k, i))
    out = dedup.first_by_key(df, ["k"], ["seq"])
    assert {r["k"]: r["seq"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("WindowGroupLimit") == 2, "the limit must run before the shuffle as well"


def test_top_by_key_is_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    out = dedup.top_by_key(df, ["g"], [F.col("id").desc()], 5, rank="rank")
    assert out.count() == 15 and "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_names_and_prefixes(spark):
    df = spark.createDataFrame([(1, " Ann "), (2, "ANN"), (3, "ab"), (4, "Bob")], "id INT, name STRING")
    assert sorted(r["id"] for r in dedup.first_by_name(df, "name", ["id"]).collect()) == [1, 4]
    prices = spark.createDataFrame([(["$1,500", "$1500", " $2", "$2", "$1,500"],), ([],)], "p ARRAY<STRING>")
    assert [r["x"] for r in prices.select(dedup.distinct_prices("p").alias("x")).collect()] == [["$1,500", " $2"], []]
    a, b = spark.createDataFrame([(1, "x")], "a INT, b STRING"), spark.createDataFrame([(2, 3.0)], "a INT, c DOUBLE")
    assert dedup.unify([a, b]).columns == ["a", "b", "c"]


def test_package_merge(spark):
    pk = "ARRAY<STRUCT<name: STRING, price: STRING>>"
    first = spark.createDataFrame([("A", [("old", "1")], ["$1"], 1), ("A", [("p", "2")], ["$2"], 2)], f"name STRING, packages {pk}, prices_found ARRAY<STRING>, seq INT")
    direct = spark.createDataFrame([("A", [("q", "3")], ["$2"], ["$3"], "", "d", 1, "u", 1)],
                                   f"name STRING, packages {pk}, prices_clean ARRAY<STRING>, prices ARRAY<STRING>, phone STRING, description STRING, pages_ok INT, website_url STRING, seq INT")
    sites = spark.createDataFrame([("A", "9", "w", 1), ("B", "8", "w", 1)], "name STRING, phone STRING, website_url STRING, seq INT")
    got = {r["name"]: (r["phone"], r["website_url"]) for r in packages.merge_scalars(first, direct, sites).collect()}
    assert got == {"A": ("", "u"), "B": ("8", "w")}
    rows = packages.merge_packages(first, direct).orderBy("source_rank").collect()
    assert [r["package"]["name"] for r in rows] == ["p", "q"]
    assert sorted(r["price"] for r in packages.merge_prices(first, direct).collect()) == ["$2", "$3"]
