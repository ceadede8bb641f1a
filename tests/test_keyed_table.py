import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import upsert as up
from reviewloom.sources.keyed_table import KeyedTable
from reviewloom.streaming import incremental as inc
from tests.test_keyed import KEY, POLICY, SCHEMA, apply_rows, random_rows


def listing(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


@pytest.mark.parametrize("blank_as_null", [False, True])
def test_merges_equal_row_by_row(spark, tmp_path, blank_as_null):
    stored, batch = random_rows(5, 0.3)
    table = KeyedTable(spark, str(tmp_path / "t"), KEY, 8)
    table.create(spark.createDataFrame(stored, SCHEMA))
    rows = sorted(batch, key=lambda r: r[6])
    for part in (rows[:7], rows[7:150], rows[150:]):
        table.merge(spark.createDataFrame(part, SCHEMA + ", seq INT"), POLICY, "seq", blank_as_null)
    want, _ = apply_rows(stored, batch, blank_as_null)
    assert {(r["source"], r["svid"]): tuple(r)[2:] for r in table.read().select(*KEY, "name", "phone", "price", "city").collect()} == want
    assert not os.path.exists(tmp_path / "t" / "_pending")


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    stored, _ = random_rows(5, 0.0)
    table = KeyedTable(spark, str(tmp_path / "t"), KEY, 16)
    table.create(spark.createDataFrame(stored, SCHEMA))
    before = listing(tmp_path / "t")
    batch = spark.createDataFrame([(*stored[0][:2], "new", "1", 1.0, "c", 1)], SCHEMA + ", seq INT")
    touched = table.touched(batch)
    plan = table.read_for(batch)._jdf.queryExecution().executedPlan().toString()
    assert len(touched) == 1 and "PartitionFilters: [isnotnull(bucket" in plan
    table.merge(batch, POLICY, "seq")
    changed = {os.path.basename(os.path.dirname(f)) for f in before ^ listing(tmp_path / "t")}
    assert changed == {f"bucket={touched[0]}"}
    assert table.read().count() == len(stored)


def test_a_change_that_stopped_half_way_is_finished_or_forgotten(spark, tmp_path):
    rows = [("a", str(i), "n", "", 1.0, "c") for i in range(20)]
    table = KeyedTable(spark, str(tmp_path / "t"), KEY, 4)
    table.create(spark.createDataFrame(rows, SCHEMA))
    bucket = table.touched(spark.createDataFrame(rows[:1], SCHEMA))
    size = table._part(bucket).count()
    table._write(table._part(bucket).drop("bucket").withColumn("name", F.lit("moved")), table.pending, "overwrite")  # written beside the table, not moved in
    assert table.read().where("name = 'moved'").count() == 0
    table.recover()
    moved = table.read().where("name = 'moved'").count()
    assert moved == size > 0 and table.read().count() == 20
    table._write(table._part(bucket).drop("bucket").withColumn("name", F.lit("lost")), table.pending, "overwrite")
    os.remove(tmp_path / "t" / "_pending" / "_SUCCESS")
    table.recover()
    assert table.read().where("name = 'lost'").count() == 0 and not os.path.exists(table.pending)


def test_fifty_drops_keep_few_files_and_nothing_is_stored_twice(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], 2)
    for n in range(50):  # each drop has new keys, keys of earlier drops and a repeat
        rows = [(n * 4 + i, n, f"x{i}") for i in range(6)] + [(n * 4, n, "again")]
        table.insert_new(spark.createDataFrame(rows, "k INT, n INT, v STRING").coalesce(1), ["n", F.desc("v")], files=4)
        assert max(table.files().values()) <= 4
    got = table.read().collect()
    assert sorted(r["k"] for r in got) == list(range(202))
    assert all(r["n"] == max(0, -(-(r["k"] - 5) // 4)) for r in got)  # the first drop that has the key


def test_insert_new_takes_the_first_of_a_key_and_can_be_repeated(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], 4)
    batch = spark.createDataFrame([(1, 2, "late"), (1, 1, "first"), (2, 1, "b")], "k INT, n INT, v STRING")
    for _ in range(3):
        table.insert_new(batch, ["n"], lambda rows: rows.withColumn("tag", F.upper("v")))
    assert sorted(map(tuple, table.read().collect())) == [(1, 1, "first", "FIRST"), (2, 1, "b", "B")]
    empty = KeyedTable(spark, str(tmp_path / "e"), ["k"], 4)
    empty.insert_new(batch.limit(0), ["n"])
    assert not empty.exists()
    empty.insert_new(batch, ["n"])
    assert empty.read().count() == 2


def test_folding_needs_no_sorted_aggregate(spark):
    stored, batch = random_rows(3, 0.5)
    s, n = spark.createDataFrame(stored, SCHEMA), spark.createDataFrame(batch, SCHEMA + ", seq INT")
    for policy in (POLICY, {c: up.OVERWRITE for c in ("name", "phone", "price", "city")}):
        assert "SortAggregate" not in up.upsert(s, n, KEY, policy, "seq")._jdf.queryExecution().executedPlan().toString()


def test_late_reviews_are_stored_and_a_second_run_adds_nothing(spark, tmp_path):
    schema = "source STRING, source_review_id STRING, review_text STRING, rating DOUBLE, scraped_at TIMESTAMP"
    hours = [10, 1, 11]
    for n, hour in enumerate(hours):
        rows = [("m", f"r{n}", "amazing", 5.0, dt.datetime(2024, 1, 1, hour)), ("m", "same", f"text {n}", 1.0, dt.datetime(2024, 1, 1, hour))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for chk in ("chk", f"again{n}"):  # a new checkpoint reads every drop again
            stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
            inc.start_tagging(spark, stream, str(tmp_path / "out"), str(tmp_path / chk), buckets=4).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["source_review_id"] for r in got) == ["r0", "r1", "r2", "same"]
    assert {r["review_text"] for r in got if r["source_review_id"] == "same"} == {"text 0"}
    assert all(r["sentiment"] for r in got)
