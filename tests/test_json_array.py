import json
import random

import pytest
from pyspark.sql import functions as F

from reviewloom import schemas
from reviewloom.sources import json_array as ja

NASTY = ['plain', 'br}ace {', 'quo"te', 'back\\slash', '\\', '\\"', '"}', '},{', '[', ']', 'new\nline', 'é}日', '', '{"a":1}', '\\\\"}']


def records(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))
    return [{"name": f"{i} {word()}", "category": word(), "star_rating": rng.choice([None, 4.5, 3]), "awards": [{"name": word()} for _ in range(rng.randint(0, 3))]} for i in range(n)]


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
@pytest.mark.parametrize("size", ["900", "6000"])
def test_equals_the_multi_line_reader(spark, tmp_path, style, size):
    for name, rows in (("a", records(1, 300)), ("b", []), ("c", records(2, 1)), ("d", [{"name": "x" * 5000, "category": "}" * 400}, {"name": "y"}])):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, **style))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = ja.read_array(spark, str(tmp_path / "*.json"), schemas.PRICING_RECORD).select("name", "category", "star_rating", "awards")
        rows = got.collect()
        splits = ja.array_records(spark, str(tmp_path / "a.json")).select("start").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = spark.read.schema(schemas.PRICING_RECORD).option("multiLine", True).json(str(tmp_path / "*.json")).select(*got.columns).collect()
    assert sorted(map(str, rows)) == sorted(map(str, want)) and len(rows) == 303 and splits > 3


def test_order_and_odd_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('  [ {"name":"1"} , 7, "x}y", "{", {"name":"2","z":[{},[{}]]},{"name":"3"}\n]\n')
    (tmp_path / "e.json").write_text("")
    got = ja.array_records(spark, str(tmp_path / "*.json")).orderBy("path", "start", "n").collect()
    assert [json.loads(r["value"])["name"] for r in got] == ["1", "2", "3"]


def test_many_tasks_read_one_file(spark, tmp_path):
    rows = [{"name": f"n{i}", "category": "}" * (i % 5), "review_count": i} for i in range(60_000)]
    (tmp_path / "big.json").write_text(json.dumps(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        read = ja.read_array(spark, str(tmp_path / "big.json"), schemas.PRICING_RECORD)
        tasks = ja.array_records(spark, str(tmp_path / "big.json")).select(F.spark_partition_id().alias("p")).distinct().count()
        assert read.agg(F.sum("review_count"), F.count_distinct("name")).first()[:] == (sum(range(60_000)), 60_000) and tasks > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
