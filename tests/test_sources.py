import datetime as dt
import json

from pyspark.sql import functions as F

from reviewloom import materialize, schemas
from reviewloom.sources import readers, sinks
from reviewloom.streaming import incremental as inc


def test_missing_and_array_files(spark, tmp_path):
    assert readers.read_records(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "a.json").write_text(json.dumps([{"name": "A", "star_rating": 4.5}, {"name": "B"}], indent=2))
    got = readers.read_records(spark, str(tmp_path / "a.json")).orderBy("name").collect()
    assert [(r["name"], r["star_rating"]) for r in got] == [("A", 4.5), ("B", None)]


def test_newest_file(spark, tmp_path):
    for stamp in ("20240101", "20240301", "20240201"):
        (tmp_path / f"p_{stamp}.json").write_text(json.dumps([{"name": stamp}]))
    assert readers.newest_file(spark, str(tmp_path / "p_*.json"), schemas.PRICING_RECORD).first()["name"] == "20240301"
    assert readers.newest_file(spark, str(tmp_path / "q_*.json"), schemas.PRICING_RECORD).count() == 0


def test_package_files(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"name": "A", "packages": [{"name": "p"}], "prices_found": [], "starting_prices_raw": ["$1"]}, {"packages": []}]))
    (tmp_path / "direct.json").write_text(json.dumps([{"name": "A", "prices_clean": ["$2"], "url": "u"}]))
    (tmp_path / "web.json").write_text(json.dumps({"A": {"phone": "1"}, "B": {"website_url": "w"}}))
    first, direct, web = readers.read_package_files(spark, str(tmp_path / "one.json"), str(tmp_path / "direct.json"), str(tmp_path / "web.json"))
    assert [(r["name"], r["prices_found"]) for r in first.orderBy("seq").collect()] == [("A", ["$1"]), ("", [])]
    assert direct.first()["website_url"] == "u" and sorted(r["name"] for r in web.collect()) == ["A", "B"]
    none = readers.read_package_files(spark, *[str(tmp_path / f"no{i}") for i in range(3)])
    assert [d.count() for d in none] == [0, 0, 0]


def test_csv_keeps_quotes_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", ok', "a")], "name STRING, b STRING")
    sinks.write_csv(df, str(tmp_path / "c"), ["name"])
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert back.first()["name"] == 'say "hi", ok' and back.columns == ["name"]


def test_latest_is_the_newest_archive(spark, tmp_path):
    root = str(tmp_path / "arch")
    assert sinks.read_latest(spark, root, schemas.PRICING_RECORD).count() == 0
    for stamp in ("1", "2"):
        sinks.write_latest_and_archive(spark.createDataFrame([(stamp,)], "name STRING"), root, stamp)
    assert [r["name"] for r in sinks.read_latest(spark, root, schemas.PRICING_RECORD).collect()] == ["2"]


def test_unfinished_versions_are_not_seen(spark, tmp_path):
    root = str(tmp_path / "t")
    for version in ("0001", "0002"):
        sinks.write_version(spark.createDataFrame([(version,)], "v STRING"), root, version)
    unmarked = spark.createDataFrame([("0003",)], "v STRING").write
    unmarked.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/version=0003")
    assert sinks.read_current(spark, root).first()["v"] == "0002"


def test_run_audit(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    runs = sinks.start_run(spark, 1, "m1", "djs", started_at=t0).unionByName(sinks.start_run(spark, 2, "m2", "djs", started_at=t1))
    done = spark.createDataFrame([(1, t1, 10, 8, None), (9, t1, 1, 1, None)], "id BIGINT, completed_at TIMESTAMP_NTZ, vendors_found INT, vendors_successful INT, notes STRING")
    got = {r["id"]: (r["status"], r["vendors_found"], r["source"], r["notes"]) for r in sinks.finish_runs(runs, done).collect()}
    assert got == {1: ("completed", 10, "m1", ""), 2: ("running", None, "m2", None)}
    assert sinks.recent_runs(runs, 1).first()["id"] == 2


def test_materialized_frames_live_in_the_shared_folder(spark):
    df = materialize(spark.range(5), "t")
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0] and df.count() == 5


def test_stream_ignores_repeats_across_batches(spark, tmp_path):
    schema = "id BIGINT, source STRING, source_review_id STRING, review_text STRING, rating DOUBLE, scraped_at TIMESTAMP"
    ts = dt.datetime(2024, 1, 1)
    drops = [[(1, "m", "a", "amazing", 5.0, ts), (2, "m", "a", "again", 1.0, ts + dt.timedelta(seconds=1)), (3, "m", "b", "awful", 1.0, ts)],
             [(4, "m", "a", "late repeat", 1.0, ts + dt.timedelta(days=9)), (5, "n", "a", "fine", None, ts + dt.timedelta(days=9))]]
    for rows in drops:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        inc.start_tagging(spark, stream, str(tmp_path / "out"), str(tmp_path / "chk")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["source"], r["source_review_id"]) for r in got) == [("m", "a"), ("m", "b"), ("n", "a")]
    assert {r["source_review_id"]: r["sentiment"] for r in got if r["source"] == "m"}["b"] == "negative"


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    for name in ("left", "right"):
        sinks.write_bucketed(spark.range(1000).withColumn("v", F.col("id") * 2), f"bucketed_{name}", ["id"], 4, str(tmp_path / name))
    try:
        joined = spark.table("bucketed_left").hint("merge").join(spark.table("bucketed_right"), "id")
        assert joined.count() == 1000 and "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("left", "right"):
            spark.sql(f"DROP TABLE bucketed_{name}")


def test_payload_files_know_their_path(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text('{"x":\n 2}')
    got = readers.read_payloads(spark, str(tmp_path / "*.json")).collect()
    assert sorted((r["path"][-6:], json.loads(r["payload"])["x"]) for r in got) == [("a.json", 1), ("b.json", 2)]
    assert readers.with_file_path(spark.read.text(str(tmp_path / "a.json"))).first()["file_path"].endswith("a.json")


def test_a_file_per_row_is_written_by_many_tasks_and_read_from_the_folder_above(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("p"), F.concat(F.lit("page "), "id").alias("payload")).coalesce(1)
    sinks.write_files(rows, str(tmp_path / "files"), "payload", "p")
    got = readers.read_payloads(spark, str(tmp_path / "files"), below=True).collect()
    assert sorted((r.path.split("/")[-2], r.payload) for r in got) == sorted((f"p={i}", f"page {i}\n") for i in range(40))
    assert len({r.path.split("/")[-1].split("-")[1] for r in got}) > 1  # the number of the task that wrote it


def test_payload_files_are_listed_once_from_one_folder(spark):
    import __spark_entry__ as entry

    df = entry.queries()["a05_payload_files"](spark, entry.ENTRY_DIR)
    files = df.inputFiles()
    assert len(files) == len({f.split("/")[-2] for f in files}) == df.count()  # each file is read once
    assert len({f.split("/")[-1].split("-")[1] for f in files}) > 1


def test_saved_pages_lie_in_one_folder_written_by_many_tasks(spark):
    import __spark_entry__ as entry

    df = entry.queries()["a05_saved_pages"](spark, entry.ENTRY_DIR)
    files = df.inputFiles()
    assert len({f.rsplit("/", 1)[0] for f in files}) == 1 and len(files) == df.count()
    assert len({f.split("/")[-1].split("-")[1] for f in files}) > 1
